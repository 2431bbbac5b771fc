"""Language-model scores by a weighted backoff automaton.

The model smooths n-gram counts hierarchically: the probability of a word
after a history is (count of both + m * lower-order probability) / (count of
the history + m). Each history that training texts go on from is a state, each
seen n-gram an arc that carries its smoothed log-probability, and each state
has a failure arc of weight log m / (count + m) to the state of the shorter
history. A text is read from left to right: where its state has no arc for the
word, the failure arc is taken, until one has; the weights on the way add up.

Documents are dealt into blocks by the hash of id and text. A block asks for
the counts of its distinct n-grams, which meet, from all blocks, in partitions
by n-gram hash; there the training counts are summed and sent back as arrays
in the order of the question. With them the block compiles the automaton of its
own n-grams and traverses its documents, all in step. Nothing is gathered on
the driver but two numbers, no partition holds more than its share of hashes, and an
n-gram's frequency costs nothing since each block sends it once.

Defined cases: a null or empty text is its end token alone. A null id counts
as a training row. Without training rows all counts are 0. Equal rows count
as often as they occur; rows with one id and text that hold more than
HOT_BYTES together go through their block as one row with a number of copies. Words are told apart by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.operators.skew import bounded

ORDER = 2
# Weight of the lower order, as a number of observations.
BACKOFF_MASS = 8.0
# Text of a block, and of the n-grams that one counting partition gets, in bytes.
BLOCK_BYTES = 12 << 20
# Words of a text that are read in one go; longer texts are read in stretches, side by side.
STRETCH = 512
# Bytes of equal rows (id and text) that go singly; where they hold more, they are gathered into one.
HOT_BYTES = 1 << 20
# Copies of a row that are given out again by one row.
_DEAL = 100_000
_START = np.uint64(0x8F1BBCDC8F1BBCDC)
_END = np.uint64(0x5BE0CD195BE0CD19)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then one end per text) and the token offsets of the texts."""
    chunks, sizes = [], [np.zeros(1, np.int64)]
    for part in texts.slices(pa.RecordBatch.from_arrays([column], ["text"])):
        hashes, _, counts = texts.words(*texts.utf8(part.column("text")))
        chunks.append(np.insert(hashes, np.cumsum(counts), _END))
        sizes.append(counts + 1)
    return np.concatenate(chunks) if chunks else np.zeros(0, np.uint64), np.cumsum(np.concatenate(sizes))


def grams_of(tokens: np.ndarray, offsets: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For each n from 1 the hash of the n-gram that ends at each token; starts are padded."""
    grams = tokens
    yield grams
    starts = offsets[:-1]
    for n in range(2, order + 1):
        before = np.empty_like(grams)
        before[1:] = grams[:-1]
        before[starts] = _START + np.uint64(n)
        grams = texts.mix(before * np.uint64(0x9FB21C651E98DF25) + tokens + np.uint64(n))
        yield grams


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _asked(grams: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in the order of the question (by partition, then hash), their cuts per partition, and the inverse."""
    distinct, inverse = np.unique(grams, return_inverse=True)
    part = (distinct % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], np.searchsorted(part[order], np.arange(parts + 1)), place[inverse]


def _short(counts: np.ndarray) -> bytes:
    """Counts in one byte each where they fit; larger ones follow in eight."""
    large = counts[counts >= 255]
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.astype("<u8").tobytes()


def _long(blob: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(blob, "<u8", offset=n)
    return counts


def _copies(table: pa.Table) -> np.ndarray:
    """How many rows each row stands for."""
    return _column(table, "copies").to_numpy() if "copies" in table.column_names else np.ones(len(table), np.int64)


_QUESTION = "n int, part int, block int, asked binary, counts binary"


def _questions(table: pa.Table, block: int, order: int, parts: int) -> pa.Table:
    tokens, offsets = tokens_of(_column(table, "text"))
    learnt = np.where(_column(table, "held_out").to_numpy(zero_copy_only=False), 0, _copies(table))
    training = np.repeat(learnt, np.diff(offsets))
    rows: dict[str, list] = {"n": [], "part": [], "block": [], "asked": [], "counts": []}
    for n, grams in enumerate(grams_of(tokens, offsets, order), 1):
        distinct, cuts, inverse = _asked(grams, parts)
        counts = np.bincount(inverse, training, len(distinct)).astype(np.int64)
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[part], cuts[part + 1])
            for name, value in zip(rows, (n, part, block, distinct[own].tobytes(), _short(counts[own])), strict=True):
                rows[name].append(value)
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(rows[name], kind) for name, kind in zip(rows, kinds, strict=True)], names=list(rows))


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Distinct hashes and total counts of a partition; the inverse of all its questions and their sizes."""
    blobs = table.column("asked").to_pylist()
    asked = np.frombuffer(b"".join(blobs), "<u8")
    sizes = [len(x) // 8 for x in blobs]
    counts = np.concatenate([_long(x, n) for x, n in zip(table.column("counts").to_pylist(), sizes, strict=True)])
    distinct, inverse = np.unique(asked, return_inverse=True)
    return distinct, np.bincount(inverse, counts, len(distinct)).astype(np.int64), inverse, sizes


def _answers(table: pa.Table) -> pa.Table:
    _, total, inverse, sizes = _summed(table)
    cuts = np.cumsum([0, *sizes])
    found = total[inverse]
    counts = [_short(found[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.table([table.column("n"), table.column("part"), table.column("block"), pa.array(counts, pa.binary())],
                    names=["n", "part", "block", "counts"])


def _totals(table: pa.Table) -> pa.Table:
    _, total, _, _ = _summed(table)
    return pa.table([pa.array([int(total.sum())]), pa.array([int((total > 0).sum())])], names=["tokens", "types"])


class Automaton:
    """States, arcs and failure arcs of the n-grams of a block.

    A state is a history that training texts go on from: the empty one (0), the
    start of a text, or the last words of one. An arc of a state reads a word
    that was seen after the history, a failure arc reads nothing and leads to
    the history without its first word. Arcs are kept sorted by state and word.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], offsets: np.ndarray, n_tokens: int, n_types: int, mass: float):
        """``levels`` holds for n = 1, 2, ... the n-gram that ends at each place (as a number) and the count of each n-gram."""
        order, heads = len(levels), offsets[:-1]
        n_places = len(levels[0][0])
        self.words = levels[0][0]
        self.n_words = len(levels[0][1])
        starts = int(levels[0][1][self.words[offsets[1:] - 1][0]]) if len(heads) else 0  # every training text starts as often as it ends
        head = np.zeros(n_places, bool)
        head[heads] = True
        # States: the empty history, the starts (one for each length of history), then the seen n-grams below the order.
        fail, fail_weight, numbered, size = [np.zeros(1, np.int64)], [np.zeros(1)], [], 1
        start_states = [0]
        for _ in range(1, order):
            if starts:
                fail.append(np.array([start_states[-1]]))
                fail_weight.append(np.log10(np.array([mass / (starts + mass)])))
                start_states.append(size)
                size += 1
            else:
                start_states.append(0)
        firsts = [self._first_places(gram, len(count)) for gram, count in levels]
        for k in range(order - 1):
            gram, count = levels[k]
            seen = np.flatnonzero(count > 0)
            state = np.zeros(len(count), np.int64)
            state[seen] = size + np.arange(len(seen))
            size += len(seen)
            numbered.append(state)
            fail.append(np.zeros(len(seen), np.int64) if k == 0 else numbered[k - 1][levels[k - 1][0][firsts[k][seen]]])
            fail_weight.append(np.log10(mass / (count[seen] + mass)))
        self.fail, self.fail_weight = np.concatenate(fail), np.concatenate(fail_weight)
        self.start = start_states[-1]

        count = levels[0][1].astype(float)
        self.base = np.log10((count + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
        keys, weights = [np.arange(self.n_words, dtype=np.int64)], [self.base]
        targets = [numbered[0] if order > 1 else np.zeros(self.n_words, np.int64)]
        lower = self.base
        for k in range(1, order):
            gram, count = levels[k]
            seen = np.flatnonzero(count > 0)
            at = firsts[k][seen]
            before = np.maximum(at - 1, 0)
            history, context = levels[k - 1][0][before], levels[k - 1][1]
            source = np.where(head[at], start_states[k], numbered[k - 1][history])
            met = np.where(head[at], starts, context[history]).astype(float)
            weight = np.full(len(count), -np.inf)
            weight[seen] = np.log10((count[seen] + mass * 10.0 ** lower[levels[k - 1][0][at]]) / (met + mass))
            keys.append(source * self.n_words + self.words[at])
            weights.append(weight[seen])
            targets.append(numbered[k][seen] if k < order - 1 else numbered[k - 1][levels[k - 1][0][at]])
            lower = weight
        keys, weights, targets = (np.concatenate(x) for x in (keys, weights, targets))
        sort = np.argsort(keys)
        self.keys, self.weights, self.targets = keys[sort], weights[sort], targets[sort]
        self.order = order

    @staticmethod
    def _first_places(gram: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[gram[::-1]] = np.arange(len(gram))[::-1]
        return out

    def read(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one word each, and the log-probabilities gathered on the way: failure arcs, then one arc."""
        state, total, waiting = state.copy(), np.zeros(len(state)), np.arange(len(state))
        while len(waiting):
            key = state[waiting] * self.n_words + word[waiting]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            hit = self.keys[place] == key
            done, arcs = waiting[hit], place[hit]
            total[done] += self.weights[arcs]
            state[done] = self.targets[arcs]
            waiting = waiting[~hit]
            total[waiting] += self.fail_weight[state[waiting]]
            state[waiting] = self.fail[state[waiting]]
        return state, total

    def traverse(self, offsets: np.ndarray) -> np.ndarray:
        """Log-probability of every word, the texts read from left to right in step.

        A long text is read in stretches. A state holds no more than the last
        order - 1 words, so a stretch that begins that many words early, without
        adding weights, arrives in the state that the whole text would have.
        """
        sizes = np.diff(offsets)
        parts = -(-sizes // STRETCH)
        head = np.repeat(offsets[:-1], parts)
        begin = head + STRETCH * (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts))
        stop = np.minimum(begin + STRETCH, np.repeat(offsets[1:], parts))
        early = np.maximum(begin - (self.order - 1), head)
        longest_first = np.argsort(-(stop - early), kind="stable")
        begin, stop, early, head = (x[longest_first] for x in (begin, stop, early, head))
        state = np.where(early == head, self.start, 0)
        out = np.zeros(len(self.words))
        left = stop - early
        for step in range(int(left.max(initial=0))):
            n = int(np.searchsorted(-left, -step, side="left"))  # stretches with more than ``step`` words
            at = early[:n] + step
            state[:n], weight = self.read(state[:n], self.words[at])
            own = at >= begin[:n]
            out[at[own]] = weight[own]
        return out


def _scored(docs: pa.Table, answers: pa.Table, order: int, parts: int, n_tokens: int, n_types: int, mass: float) -> pa.Table:
    tokens, offsets = tokens_of(_column(docs, "text"))
    heads = offsets[:-1]
    by_order: dict[int, list] = {}
    for n, part, counts in zip(*(answers.column(x).to_pylist() for x in ("n", "part", "counts")), strict=True):
        by_order.setdefault(n, []).append((part, counts))
    levels = []
    for n, grams in enumerate(grams_of(tokens, offsets, order), 1):
        _, cuts, inverse = _asked(grams, parts)
        asked = np.flatnonzero(np.diff(cuts))
        answered = dict(by_order.get(n, []))
        if sorted(answered) != asked.tolist():
            raise RuntimeError("a block's n-grams differ from the ones it asked for; the documents changed meanwhile")
        levels.append((inverse, np.concatenate([_long(answered[part], cuts[part + 1] - cuts[part]) for part in asked.tolist()])))
    model = Automaton(levels, offsets, n_tokens, n_types, mass)
    add = np.add.reduceat
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "copies": pa.array(_copies(docs)),
            "n_tokens": pa.array(np.diff(offsets)),
            "n_known": pa.array(add((levels[0][1] > 0).astype(np.int64)[model.words], heads)),
            "train_tokens": pa.array(np.full(len(heads), n_tokens)),
            "base_score": pa.array(add(model.base[model.words], heads)),
            "score": pa.array(add(model.traverse(offsets), heads)),
        }
    )


def _gathered(own: DataFrame, hot_bytes: int) -> DataFrame:
    """``own`` with ``copies``: equal rows of more than ``hot_bytes`` together as one row, all others singly.

    The counts are by hash and combined map-side; equal rows then meet by
    their columns, so two texts with one hash stay apart.
    """
    key = F.xxhash64("doc_id", "text")
    sizes = own.select(key.alias("key"), (F.octet_length("text") + F.lit(8)).alias("size"))
    counts = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    hot = bounded(counts.filter((F.col("n") > 1) & (F.col("size") > hot_bytes)).select("key"))
    if hot.isEmpty():
        return own.withColumn("copies", F.lit(1).cast("long"))
    keyed = own.withColumn("key", key)
    single = keyed.join(hot, "key", "left_anti").select(*own.columns, F.lit(1).cast("long").alias("copies"))
    several = keyed.join(hot, "key", "left_semi").groupBy(*own.columns).agg(F.count(F.lit(1)).alias("copies"))
    return single.unionByName(several)


def _given_out(scored: DataFrame) -> DataFrame:
    """Each row as often as it has copies."""
    dealt = scored.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(_DEAL).cast("long"))))
    upto = F.least(F.col("copies"), F.col("from") + F.lit(_DEAL - 1))
    return dealt.withColumn("copy", F.explode(F.sequence("from", upto))).drop("from", "copy", "copies")


def score(docs: DataFrame, held_out, order: int = ORDER, mass: float = BACKOFF_MASS, block_bytes: int = BLOCK_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``held_out`` is a boolean column over ``docs``; the model learns from the
    other rows. ``base_score`` is the root's part alone.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size = own.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(8)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(size / block_bytes))
    dealt = _gathered(own, hot_bytes).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def first_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in texts.slices(batch, limit=block_bytes):
                held.append(part)
                rows += part.nbytes
                if rows >= block_bytes:
                    yield from _questions(pa.Table.from_batches(held), 0, 1, blocks).to_batches()
                    held, rows = [], 0
        if held:
            yield from _questions(pa.Table.from_batches(held), 0, 1, blocks).to_batches()

    training = own.filter(~F.col("held_out")).select("text", "held_out")
    whole = training.mapInArrow(first_order, _QUESTION).groupBy("part").applyInArrow(_totals, "tokens long, types long")
    totals = whole.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
    n_tokens, n_types = totals["n"], totals["v"]

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        return _questions(table, key[0].as_py(), order, blocks)

    def traverse(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, order, blocks, n_tokens, n_types, mass)

    grouped = dealt.groupBy("block")
    answers = grouped.applyInArrow(ask, _QUESTION).groupBy("n", "part").applyInArrow(_answers, "n int, part int, block int, counts binary")
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        traverse,
        "doc_id long, held_out boolean, copies long, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    # Narrow rows, so that a reader or writer gets few and even parts.
    return _given_out(scored).hint("rebalance")
