"""Exact ranked lexical search with per-term geometric blocks.

Documents become rows of a forward index: the terms that the items ask for and
how often each occurs. A task cuts its rows into shards. In a shard each term's
posting list is clustered by the similarity of its documents (random
projections of their impacts, nearest of a few members) into blocks, and a
block's summary is the coordinatewise maximum of its documents' impacts. The
product of an item's weights and a summary bounds the score of every document
of the block, so a block is scored only for items whose tenth best score its
bound reaches. Lists are worked through in falling order of weight times
largest impact; an item leaves the shard when the sum of these products over
its remaining lists is below its tenth best score, since a document not met
until then holds none of the earlier terms. The tenth best scores are carried
from shard to shard of a task. All bounds are exact integers, so nothing
that could be ranked is skipped, ties included.

Blocks and summaries live only while their list is worked through: a list
that no item needs is never clustered, and memory stays that of one list.

Items go through in blocks of a bounded size, each a pass over the documents,
with the block's terms and weights as broadcast. Document counts and lengths
cover all documents.

Defined cases: terms are runs of digits, letters and characters beyond ASCII,
A-Z in lower case. Null texts and texts without terms are never ranked and do
not count. Items without terms, or whose terms no document holds, have no
rows. Equal document rows are ranked each; null doc_ids come last among equal
scores. Equal items (item_id and text) count once; a null item_id is kept.
Other columns are ignored. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.session import materialise

BEST = 10
# Items and terms of one pass over the documents.
PASS_ITEMS = 4_096
PASS_TERMS = 1 << 18
# Documents and postings of a shard; one longer document is a shard of its own.
SHARD_DOCS = 4_096
SHARD_POSTINGS = 1 << 20
BLOCK_DOCS = 64
# Dimensions of the projection by which documents are compared when a list is clustered.
PROJECTED = 32
# Distinct terms of the items whose bounds are computed together.
TOGETHER = 16_384


class Asked(NamedTuple):
    """One pass of items: sorted term hashes, per item its id and places in them."""

    terms: np.ndarray
    items: list[tuple[str | None, np.ndarray]]


def _split(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in texts.slices(batch):
        hashes, _, counts = texts.words(*texts.utf8(part.column("text")), gaps=texts.SYMBOLS)
        yield part, hashes, counts


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id and the distinct term hashes of every distinct item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, hashes, counts in _split(batch):
                own = [np.unique(x).view(np.int64) for x in np.split(hashes, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column("item_id"), part.column("key"), pa.array(own, pa.list_(pa.int64()))], ["item_id", "key", "terms"])

    own = items.select(F.col("item_id").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    return own.withColumn("key", F.xxhash64("item_id", "text")).mapInArrow(run, "item_id string, key long, terms array<long>").filter(F.size("terms") > 0)


def passes(items: DataFrame, pass_items: int = PASS_ITEMS, pass_terms: int = PASS_TERMS) -> Iterator[Asked]:
    """The items in blocks of at most so many items and about so many terms."""
    made = materialise(_item_terms(items), "items")
    size = made.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("t")).first()
    blocks = max(math.ceil(2 * size["n"] / pass_items), math.ceil(2 * size["t"] / pass_terms), 1)
    for block in range(blocks):
        rows = made.filter(F.pmod("key", F.lit(blocks)) == block).orderBy("key").collect()  # one block, of a bounded size
        if rows:
            terms = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in rows]).view(np.uint64))
            yield Asked(terms, [(r["item_id"], np.searchsorted(terms, np.array(r["terms"], np.int64).view(np.uint64))) for r in rows])


def forward_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats), terms (places in ``terms``) and counts of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            for part, hashes, counts in _split(batch):
                place = np.searchsorted(asked, hashes)
                place[place == len(asked)] = 0
                held = np.flatnonzero(asked[place] == hashes)
                row = np.repeat(np.arange(len(counts)), counts)[held]
                both, times = np.unique(row * len(asked) + place[held], return_counts=True)
                cuts = np.searchsorted(both, np.arange(len(counts) + 1) * len(asked))
                own, times = (both % len(asked)).astype("<i4"), times.astype("<i4")
                with_terms = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(with_terms)), pa.array(counts[with_terms].astype(np.int64)),
                     pa.array([own[cuts[k] : cuts[k + 1]].tobytes() for k in with_terms], pa.binary()),
                     pa.array([times[cuts[k] : cuts[k + 1]].tobytes() for k in with_terms], pa.binary())],
                    ["doc_id", "n", "terms", "counts"],
                )

    return materialise(texts.id_and_text(docs).mapInArrow(run, "doc_id long, n long, terms binary, counts binary"), "forward")


def _frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each asked term occurs; one row per term and task before the sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4")
            total += np.bincount(held, minlength=n_terms)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["term", "n"])

    out = np.zeros(n_terms, np.int64)
    for row in index.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def weights(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequencies], np.int64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


class Ranking:
    """The best documents of every item so far, over all shards of a task."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, best: int):
        self.weight, self.best = weight, best
        self.items = items
        of_term = np.concatenate(items)
        order = np.argsort(of_term, kind="stable")
        self._item = np.repeat(np.arange(len(items)), [len(x) for x in items])[order]
        self._cuts = np.searchsorted(of_term[order], np.arange(len(weight) + 1))
        self.found: list[list[tuple]] = [[] for _ in items]
        self.least = np.ones(len(items))  # a score must reach this to be ranked
        self.scored = self.blocks = self.skipped = 0

    def asking(self, term: int) -> np.ndarray:
        return self._item[self._cuts[term] : self._cuts[term + 1]]

    def take(self, item: int, scores: np.ndarray, ids: np.ndarray, lacking: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least[item])
        if not len(good):
            return
        good = good[np.lexsort((ids[good], lacking[good], -scores[good]))[: self.best]]
        new = [(-int(scores[k]), bool(lacking[k]), int(ids[k])) for k in good]
        self.found[item] = sorted(self.found[item] + new)[: self.best]
        if len(self.found[item]) == self.best:
            self.least[item] = -self.found[item][-1][0]


class Shard:
    """Impacts of some documents, by document and by term."""

    def __init__(self, ids: np.ndarray, lacking: np.ndarray, cuts: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.ids, self.lacking, self.cuts, self.terms, self.impacts = ids, lacking, cuts, terms, impacts

    def _blocks(self, rows: np.ndarray, sketches: np.ndarray, block_docs: int) -> tuple[np.ndarray, int]:
        """For each document of a posting list its block."""
        n = math.ceil(len(rows) / block_docs)
        if n == 1:
            return np.zeros(len(rows), np.int64), 1
        centres = sketches[rows[:: math.ceil(len(rows) / n)]]
        near = (sketches[rows] @ centres.T).argmax(1)
        used, near = np.unique(near, return_inverse=True)
        return near, len(used)

    def search(self, ranking: Ranking, block_docs: int = BLOCK_DOCS, together: int = TOGETHER) -> None:
        n_terms, sizes = len(ranking.weight), np.diff(self.cuts)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        value = (self.impacts * ranking.weight[self.terms]).astype(float)
        turn = texts.mix(self.terms.astype(np.uint64) + np.uint64(1))
        sign = np.where(turn >> np.uint64(63), 1.0, -1.0)
        flat = np.bincount(doc * PROJECTED + (turn % np.uint64(PROJECTED)).astype(np.int64), sign * value, len(sizes) * PROJECTED)
        sketches = flat.reshape(len(sizes), PROJECTED).astype(np.float32)
        sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
        by_term = np.argsort(self.terms, kind="stable")
        held, at = np.unique(self.terms[by_term], return_index=True)
        stops = np.append(at[1:], len(by_term))
        most = np.maximum.reduceat(value[by_term], at)
        bound = np.zeros(n_terms)
        bound[held] = most
        rest = np.array([bound[own].sum() for own in ranking.items])  # what the lists not yet worked through can still give
        seen = np.zeros((len(ranking.items), len(sizes)), bool)
        for k in np.lexsort((held, -most)):
            asking = ranking.asking(held[k])
            active = asking[rest[asking] >= ranking.least[asking]]
            if len(active):
                self._list(doc[by_term[at[k] : stops[k]]], sizes, sketches, active, ranking, seen, block_docs, together)
            rest[asking] -= most[k]

    def _list(self, rows, sizes, sketches, active, ranking, seen, block_docs, together) -> None:
        block, n = self._blocks(rows, sketches, block_docs)
        order = np.argsort(block, kind="stable")
        rows, block = rows[order], block[order]
        entries = _ranges(self.cuts[rows], sizes[rows])
        of_row = np.repeat(np.arange(len(rows)), sizes[rows])
        terms, impacts = self.terms[entries], self.impacts[entries].astype(float)
        group, used = [], 0
        for item in [*active.tolist(), None]:
            if group and (item is None or used + len(ranking.items[item]) > together):
                self._score(rows, block, n, of_row, terms, impacts, np.array(group), ranking, seen)
                group, used = [], 0
            if item is not None:
                group.append(item)
                used += len(ranking.items[item])

    def _score(self, rows, block, n, of_row, terms, impacts, group, ranking, seen) -> None:
        columns = np.unique(np.concatenate([ranking.items[q] for q in group]))
        weight = np.zeros((len(columns), len(group)))
        for k, q in enumerate(group):
            own = ranking.items[q]
            weight[np.searchsorted(columns, own), k] = ranking.weight[own]
        place = np.searchsorted(columns, terms)
        place[place == len(columns)] = 0
        asked = np.flatnonzero(columns[place] == terms)
        of_row, place, impacts = of_row[asked], place[asked], impacts[asked]
        summary = np.zeros(n * len(columns))
        np.maximum.at(summary, block[of_row] * len(columns) + place, impacts)
        bounds = summary.reshape(n, len(columns)) @ weight  # integers below 2^53: exact
        open_blocks = bounds >= ranking.least[group]
        ranking.blocks += open_blocks.size
        ranking.skipped += int(open_blocks.size - open_blocks.sum())
        first = np.searchsorted(of_row, np.searchsorted(block, np.arange(n + 1)))
        for k, q in enumerate(group):
            own = np.flatnonzero(open_blocks[:, k])
            if not len(own):
                continue
            entry = _ranges(first[own], first[own + 1] - first[own])
            scores = np.bincount(of_row[entry], impacts[entry] * weight[place[entry], k], len(rows))
            fresh = np.flatnonzero((scores >= ranking.least[q]) & ~seen[q, rows])
            ranking.scored += len(fresh)
            met = rows[fresh]
            seen[q, met] = True
            ranking.take(int(q), scores[fresh], self.ids[met], self.lacking[met])


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, length: int, shard_docs: int, shard_postings: int) -> Iterator[Shard]:
    def made(rows: list[tuple]) -> Shard:
        ids = np.array([0 if r[0] is None else r[0] for r in rows], np.int64)
        terms = np.frombuffer(b"".join(r[2] for r in rows), "<i4").astype(np.int64)
        counts = np.frombuffer(b"".join(r[3] for r in rows), "<i4").astype(np.int64)
        cuts = np.cumsum([0, *(len(r[2]) // 4 for r in rows)])
        m = np.array([100 - 90 + 90 * r[1] * n_docs // length for r in rows], np.int64)  # whole numbers of any size
        impacts = 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, np.diff(cuts)))
        return Shard(ids, np.array([r[0] is None for r in rows]), cuts, terms, impacts)

    rows, postings = [], 0
    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "n", "terms", "counts")), strict=True):
            if not row[2]:
                continue
            if rows and (len(rows) >= shard_docs or postings + len(row[2]) // 4 > shard_postings):
                yield made(rows)
                rows, postings = [], 0
            rows.append(row)
            postings += len(row[2]) // 4
    if rows:
        yield made(rows)


def search(index: DataFrame, asked: Asked, best: int = BEST, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item, doc_id, score: the best documents of every item of a pass, from each task (item is the place in the pass)."""
    size = index.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    n_docs, length = size["n"], size["l"]
    weight = weights(_frequencies(index, len(asked.terms)), n_docs)
    shared = index.sparkSession.sparkContext.broadcast((weight, [own for _, own in asked.items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, items = shared.value
        ranking = Ranking(items, weight, best)
        for shard in _shards(batches, n_docs, length, shard_docs, shard_postings):
            shard.search(ranking)
        rows = [(q, None if lacking else doc_id, -score) for q, own in enumerate(ranking.found) for score, lacking, doc_id in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
            ["item", "doc_id", "score"],
        )

    return index.mapInArrow(run, "item int, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` highest-scoring documents of each item."""
    spark = docs.sparkSession
    out = None
    for asked in passes(items):
        found = search(forward_index(docs, asked.terms), asked, best)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(asked.items)], "item int, item_id string")
        own = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # at most PASS_ITEMS names
        own = materialise(own, "ranked")
        out = own if out is None else out.unionByName(own)
    return spark.createDataFrame([], "item_id string, rank int, doc_id long, score long") if out is None else out
