"""Removal of repeated spans of sentences across documents.

A text is cut into sentences: after . ! ? (and closing marks) or at a line
break. A sentence of more than LONG words is cut further, after words that
their own hash picks, so the cuts inside a passage do not depend on what stand
around it; where the hash picks none for long, after every LONG words. Every run of ``run`` consecutive sentences, lengthened until it has
``least_words`` words, is hashed (words only, A-Z in lower case).

A passage that begins and ends inside a sentence may hold no such run, so runs
of WINDOW words are hashed too, whatever the sentences. They begin at anchors:
words whose hash is the smallest of REACH consecutive ones (of equal ones the
last). Any REACH words hold an anchor that depends on nothing else, so any
REACH - 1 + WINDOW = 50 words hold a whole run, wherever they stand.

Of equal runs in the whole table the first by (doc_id, text, position) counts
as original; words that any later one covers are removed.

Runs that repeat within an Arrow batch are settled there; only the first of
each goes through the shuffle, so a passage that sits in a third of all
documents reaches its partition once per batch.

Defined cases: a null or empty text has no sentence and stays empty (null stays
null). Texts shorter than every sort of run are kept whole. Rows
with equal doc_id and text are one document and get the same result. Null ids
order last. A document all of whose words go keeps its row with an empty
text. Columns beyond id and text pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts

RUN = 3
LEAST_WORDS = 12
LONG = 24
# Of the words of a long sentence one in this many ends a part.
PART = 8
# Words of a run that begins at an anchor, and of the stretches that hold an anchor each.
WINDOW = 31
REACH = 20

_END = np.zeros(256, bool)
_END[list(b".!?")] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b"\"')]}")] = True


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first bytes of the words, words per row, first words of the sentences and sentences per row."""
    hashes, starts, counts = texts.words(data, offsets)
    n = len(hashes)
    if not n:
        return hashes, starts, counts, np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    nexts = np.append(starts[1:], len(data))
    solid = ~texts._SPACE[data]
    # Last byte of each word: the last solid byte before the next word.
    last = np.maximum.accumulate(np.where(solid, np.arange(len(data)), -1))[nexts - 1]
    mark = last.copy()
    for _ in range(2):
        mark = np.where(_CLOSING[data[mark]] & (mark > starts), mark - 1, mark)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    ends = _END[data[mark]] | (breaks[nexts] > breaks[last + 1])
    row_ends = np.cumsum(counts)[counts > 0] - 1
    ends[row_ends] = True
    firsts = np.append(0, np.flatnonzero(ends)[:-1] + 1)
    length = np.diff(np.append(firsts, n))
    ends |= (np.repeat(length, length) > LONG) & (hashes % np.uint64(PART) == 0)
    firsts = np.append(0, np.flatnonzero(ends)[:-1] + 1)
    # Where no hash picks a word for long (one word over and over, say), cut by number.
    length = np.diff(np.append(firsts, n))
    place = np.arange(n) - np.repeat(firsts, length)
    ends |= (np.repeat(length, length) > 4 * LONG) & (place % LONG == LONG - 1)
    firsts = np.append(0, np.flatnonzero(ends)[:-1] + 1)
    row_starts = np.concatenate([[0], np.cumsum(counts)])
    per_row = np.diff(np.searchsorted(firsts, row_starts))
    return hashes, starts, counts, firsts, per_row


def anchors(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words that are the smallest of some REACH consecutive words of their row, of equal ones the last."""
    at = np.arange(len(hashes))
    row_start, row_stop = np.repeat(np.cumsum(counts) - counts, counts), np.repeat(np.cumsum(counts), counts)
    reach = np.ones(len(hashes), np.int64)
    before, after = np.ones(len(hashes), bool), np.ones(len(hashes), bool)
    for d in range(1, min(REACH, len(hashes))):
        before[d:] &= (hashes[:-d] >= hashes[d:]) & (at[d:] - d >= row_start[d:])
        before[:d] = False
        after[:-d] &= (hashes[d:] > hashes[:-d]) & (at[:-d] + d < row_stop[:-d])
        after[-d:] = False
        reach += before
        reach += after
    return np.flatnonzero(reach >= REACH)


def runs(hashes: np.ndarray, counts: np.ndarray, firsts: np.ndarray, per_row: np.ndarray, run: int, least_words: int) -> tuple[np.ndarray, ...]:
    """Of every run its hash, first word and number of words (both counted in the whole slice), and its row."""
    total = len(firsts)
    stops = np.append(firsts[1:], len(hashes))
    row_stop = np.repeat(np.cumsum(per_row), per_row)
    at = np.arange(total)
    # The sentence after the run: at least `run` on, and far enough for `least_words` words.
    enough = np.searchsorted(stops, firsts + least_words, side="left") + 1
    after = np.maximum(at + run, enough)
    fits = after <= row_stop
    at, after = at[fits], after[fits]
    marked = anchors(hashes, counts)
    marked = marked[marked + WINDOW <= np.repeat(np.cumsum(counts), counts)[marked]]
    begin = np.concatenate([firsts[at], marked])
    end = np.concatenate([stops[after - 1], marked + WINDOW])
    up, down = texts._power_tables(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(texts.mix(hashes) * up[: len(hashes)], dtype=np.uint64)])
    spans = texts.mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return spans, begin, end - begin, np.repeat(np.arange(len(counts)), counts)[begin]


_ROW = "place long, span long, doc_id long, content long, word int, words int"


def _occurrences(docs: DataFrame, run: int, least_words: int) -> DataFrame:
    """Runs by document: those that may be the first (span set), and later ones already settled (span null)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            ids, lacking = batch.column("doc_id").fill_null(0).to_numpy(), np.array(batch.column("doc_id").is_null())
            content = batch.column("content").to_numpy()
            row = 0
            for part in texts.slices(batch):
                hashes, _, counts, firsts, per_row = sentences(*texts.utf8(part.column("text")))
                spans, at, size, rows = runs(hashes, counts, firsts, per_row, run, least_words)
                parts.append((spans, rows + row, at - (np.cumsum(counts) - counts)[rows], size))
                row += part.num_rows
            if not parts:
                continue
            spans, rows, at, size = (np.concatenate([p[k] for p in parts]) for k in range(4))
            spans = spans.view(np.int64)
            order = np.lexsort((at, content[rows], ids[rows], lacking[rows], spans))
            spans, rows, at, size = spans[order], rows[order], at[order], size[order]
            later = np.zeros(len(spans), bool)
            later[1:] = spans[1:] == spans[:-1]
            # The same document again (a repeated row) is no later occurrence.
            group = np.cumsum(~later) - 1
            head = np.flatnonzero(~later)[group]
            same = (ids[rows] == ids[rows[head]]) & (lacking[rows] == lacking[rows[head]]) & (content[rows] == content[rows[head]]) & (at == at[head])
            later &= ~same
            place = np.where(later, texts.mix(content[rows].view(np.uint64) + at.astype(np.uint64)).view(np.int64), spans)
            # By document again, so that ids beside each other compress in the shuffle.
            order = np.lexsort((at, rows))
            place, spans, later, rows, at, size = (x[order] for x in (place, spans, later, rows, at, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(spans, mask=later), pa.array(ids[rows], mask=lacking[rows]), pa.array(content[rows]),
                 pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32))],
                ["place", "span", "doc_id", "content", "word", "words"],
            )

    return docs.mapInArrow(find, _ROW)


def _later(rows: DataFrame) -> DataFrame:
    """Occurrences that are not the first of their span; rows come sorted by span and document, and are not held."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # span and (null id, id, content, word) of the original of the span under way
        for batch in batches:
            if not batch.num_rows:
                continue
            settled = np.array(batch.column("span").is_null())
            keys = batch.column("span").fill_null(0).to_numpy()
            lacking = np.array(batch.column("doc_id").is_null())
            place = [lacking, batch.column("doc_id").fill_null(0).to_numpy(), batch.column("content").to_numpy(), batch.column("word").to_numpy()]
            begins = np.append(True, (keys[1:] != keys[:-1]) | (settled[1:] != settled[:-1]))
            heads = np.flatnonzero(begins)
            head = heads[np.cumsum(begins) - 1]
            same = np.logical_and.reduce([x == x[head] for x in place])
            if held is not None and not settled[0] and held[0] == keys[0]:
                stop = heads[1] if len(heads) > 1 else len(keys)
                same[:stop] = np.logical_and.reduce([x[:stop] == y for x, y in zip(place, held[1], strict=True)])
                if stop == len(keys):
                    heads = heads[:0]  # the original stays the held one
            keep = settled | ~same
            if len(heads):
                held = None if settled[heads[-1]] else (keys[heads[-1]], [x[heads[-1]] for x in place])
            yield batch.filter(pa.array(keep)).select(["doc_id", "content", "word", "words"])

    return (
        rows.repartition("place")
        .sortWithinPartitions(F.col("span"), F.col("doc_id").asc_nulls_last(), "content", "word")
        .mapInArrow(pick, "doc_id long, content long, word int, words int")
    )


def remove_repeated(docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``text`` rid of repeated spans, and two columns behind: how many sentences it had, how many went whole.

    These are _sentences and _removed, or these names and underscores where
    ``docs`` has such columns.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc, content, marks, done_name, n_all, n_gone = texts.free_names(docs, "_doc", "_content", "_gone", "_cut", "_sentences", "_removed")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content"))
    later = _later(_occurrences(own, run, least_words))
    gone = later.groupBy(F.col("doc_id").alias(doc), F.col("content").alias(content)).agg(F.collect_set(F.struct("word", "words")).alias(marks))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(content))
    met = docs.join(gone, on, "left").drop(doc, content)

    def cut(frames: Iterator) -> Iterator:
        import pandas as pd

        for column, marks in frames:
            found = pa.array(column, pa.string(), from_pandas=True)
            kept, total, lost, row = [], [], [], 0
            batch = pa.RecordBatch.from_arrays([found.fill_null("")], ["text"])
            for part in texts.slices(batch):
                data, offsets = texts.utf8(part.column("text"))
                _, starts, counts, firsts, per_row = sentences(data, offsets)
                first_word, first_part = np.cumsum(counts) - counts, np.cumsum(per_row) - per_row
                for k in range(part.num_rows):
                    own_text, n, parts = data[offsets[k] : offsets[k + 1]], int(counts[k]), int(per_row[k])
                    total.append(parts)
                    asked = marks.iloc[row]
                    row += 1
                    if asked is None or not len(asked):
                        kept.append(None)
                        lost.append(0)
                        continue
                    gone_here = np.zeros(n + 1, np.int64)
                    for mark in asked:
                        gone_here[mark["word"]] += 1
                        gone_here[mark["word"] + mark["words"]] -= 1
                    stays = np.cumsum(gone_here)[:n] == 0
                    cuts = np.append(starts[first_word[k] : first_word[k] + n] - offsets[k], len(own_text))
                    turns = cuts[np.flatnonzero(np.diff(stays, prepend=False, append=False))]
                    kept.append(b"".join(own_text[a:b].tobytes() for a, b in turns.reshape(-1, 2)).decode().rstrip())
                    own_firsts = firsts[first_part[k] : first_part[k] + parts] - first_word[k]
                    lost.append(int((~np.logical_or.reduceat(stays, own_firsts)).sum()))
            whole = found.to_pylist()
            yield pd.DataFrame({"text": [w if k is None else k for k, w in zip(kept, whole, strict=True)], "sentences": total, "removed": lost})

    one = F.pandas_udf(cut, "text string, sentences long, removed long", functionType=F.PandasUDFType.SCALAR_ITER)
    done = met.withColumn(done_name, one(F.col("text").cast("string"), F.col(marks)))
    columns = [F.col(f"{done_name}.text").alias("text") if name == "text" else F.col(f"`{name}`") for name in docs.columns]
    return done.select(*columns, F.col(f"{done_name}.sentences").alias(n_all), F.col(f"{done_name}.removed").alias(n_gone))
