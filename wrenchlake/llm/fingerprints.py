"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. On each level runs of one symbol become one
symbol; then deterministic coin tossing labels every symbol by the lowest bit
in which it differs from its left neighbour, a few times over, until few labels
are left. Local maxima of the labels begin phrases, and each phrase gets the
hash of its symbols as its name. A phrase depends only on the symbols around
it, so equal substrings get equal names inside, wherever they stand.

The fingerprint is a sketch of the names of all levels: the ``NAMES`` that come
first in an order by hash in which a name of level 2 stands 16 times as far
back as one of the levels above it, and a name of level 1 256 times. Short
phrases, which most texts share, so fill a sketch only where longer ones leave
room, by one rule for texts of any length. The likeness of two fingerprints is
the share of the first names of both together that occur in both, which
estimates the Jaccard likeness of the name sets, weighted alike.

Defined cases: a null or empty text has the empty fingerprint; two empty ones
have likeness 1, an empty and a filled one 0. Equal texts have equal
fingerprints. Rows are ordered by descending id, null ids last, equal ids by
the hash of their text; the next document of the last row is the first row, a
lone row is its own next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.session import materialise

NAMES = 64
# Levels below this one hold phrases of a few characters that most texts share; each
# level further down stands back by so many more bits of the hash.
LEVEL = 3
BACK = 4
# Characters parsed at once.
CHUNK = 1 << 18


def _low_bit_labels() -> np.ndarray:
    """label[a, b] for labels below 128: twice the lowest differing bit, plus a's bit there."""
    a, b = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    low = (a ^ b) & -(a ^ b)
    bit = np.bitwise_count((np.maximum(low, 1) - 1).astype(np.uint8)).astype(np.int64)
    return (2 * bit + ((a >> bit) & 1)).astype(np.uint8)


_LABEL = _low_bit_labels().ravel()
_PLACE = texts.mix(np.arange(1, 65, dtype=np.uint64))


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0, 1, 2 such that neighbours within a text differ; neighbours of ``symbols`` must differ."""
    n = len(symbols)
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = ~symbols[first]
    different = symbols ^ left
    bit = np.bitwise_count((different & (~different + np.uint64(1))) - np.uint64(1))
    labels = 2 * bit + ((symbols >> bit.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    near = np.empty(n, np.uint8)
    for _ in range(3):
        near[1:] = labels[:-1]
        near[first] = labels[first] ^ 1
        labels = _LABEL[labels.astype(np.intp) * 128 + near]
    after = np.empty(n, np.uint8)
    for high in (3, 4, 5):  # a high label gives way to the least one that no neighbour has
        near[1:], after[:-1] = labels[:-1], labels[1:]
        near[first] = 9
        after[-1] = 9
        after[first[1:] - 1] = 9
        least = np.where((near != 0) & (after != 0), 0, np.where((near != 1) & (after != 1), 1, 2))
        labels = np.where(labels == high, least, labels).astype(np.uint8)
    return labels


def _parse(symbols: np.ndarray, starts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the names of the phrases and the starts of the texts among them."""
    begins = np.empty(len(symbols), bool)
    begins[1:] = symbols[1:] != symbols[:-1]
    begins[starts] = True
    if not begins.all():
        at = np.flatnonzero(begins)
        length = np.diff(np.append(at, len(symbols))).astype(np.uint64)
        starts = np.searchsorted(at, starts)
        symbols = np.where(length > 1, texts.mix(symbols[at] + length * np.uint64(0xA0761D6478BD642F)), symbols[at])
    labels = _toss(symbols, starts)
    n = len(symbols)
    begins = np.zeros(n, bool)
    begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    begins[starts[1:] - 1] = False
    begins[starts] = True
    at = np.flatnonzero(begins)
    place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    names = texts.mix(np.add.reduceat(symbols * _PLACE[np.minimum(place, 63)], at) + np.uint64(level))
    return names, np.searchsorted(at, starts)


def _codes(names: np.ndarray, level: int) -> np.ndarray:
    """Names as 32 bits: 30 of the hash, then by how many levels the name lies below LEVEL."""
    return ((names >> np.uint64(34)) << np.uint64(2) | np.uint64(max(LEVEL - level, 0))).astype(np.uint32)


def _ranks(codes: np.ndarray) -> np.ndarray:
    """Where each code stands in the order of names; different codes differ."""
    below = (codes & np.uint32(3)).astype(np.uint64)
    return (codes.astype(np.uint64) >> np.uint64(2)) << (np.uint64(BACK) * below + np.uint64(2)) | below


def name_sets(found: list[str]) -> list[np.ndarray]:
    """Sketch of each text: the first of its distinct names, as codes, in order."""
    out = [np.zeros(0, np.uint32)] * len(found)
    own = [k for k, text in enumerate(found) if text]
    if not own:
        return out
    points = np.frombuffer("".join(found[k] for k in own).encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = texts.mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    starts = np.cumsum([0, *(len(found[k]) for k in own)])[:-1]
    levels = []
    while len(symbols) > len(own):
        # A text that is down to one symbol is done, whatever stands beside it.
        under_way = np.diff(np.append(starts, len(symbols))) > 1
        symbols, starts = _parse(symbols, starts, len(levels) + 1)
        levels.append((_codes(symbols, len(levels) + 1), np.append(starts, len(symbols)), under_way))
    for row, k in enumerate(own):
        codes = [s[c[row] : c[row + 1]] for s, c, under_way in levels if under_way[row]]
        # A lone character has no phrases and stands for itself.
        every = np.concatenate(codes or [_codes(texts.mix(np.array([ord(found[k][0])], np.uint64)), 1)])
        out[k] = _first(every)
    return out


def _first(codes: np.ndarray) -> np.ndarray:
    """The first NAMES distinct codes in order."""
    ranks = _ranks(codes)
    order = np.argsort(ranks)
    ranks = ranks[order]
    new = np.append(True, ranks[1:] != ranks[:-1])
    return codes[order][new][:NAMES]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the first names of two sketches together that occur in both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = _ranks(np.concatenate([a, b]))
    both.sort()
    twice = both[1:][both[1:] == both[:-1]]
    size = min(NAMES, len(both) - len(twice))
    if size < NAMES:
        return len(twice) / size
    distinct = both[np.append(True, both[1:] != both[:-1])]
    return int(np.searchsorted(twice, distinct[size - 1], side="right")) / size


def edited(text: str, following: str) -> str:
    """The last half of the text gives way to as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("names", pa.binary()),
        ("edited_names", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 binary, names binary, edited_names binary, near_edited double, near_next double"


def _describe(ids: list, own: list[str], following: list[str]) -> list[pa.Array]:
    """Columns of _OUT for rows and the text that follows each."""
    new = [edited(a, b) for a, b in zip(own, following, strict=True)]
    # Where the following text is the next row's own, its sketch is needed once.
    shared = [k + 1 < len(own) and following[k] is own[k + 1] for k in range(len(own))]
    rest = [following[k] for k in range(len(own)) if not shared[k]]
    sketches = name_sets(own + new + rest)
    mine, theirs, others = sketches[: len(own)], sketches[len(own) : 2 * len(own)], iter(sketches[2 * len(own) :])
    nexts = [mine[k + 1] if shared[k] else next(others) for k in range(len(own))]
    columns = [
        ids, [len(x) for x in own],
        [hashlib.sha256(x.encode("utf-8", "surrogatepass")).digest() for x in new],
        [x.astype(">u4").tobytes() for x in mine], [x.astype(">u4").tobytes() for x in theirs],
        [likeness(a, b) for a, b in zip(mine, theirs, strict=True)], [likeness(a, b) for a, b in zip(mine, nexts, strict=True)],
    ]
    return [pa.array(column, kind) for column, (_, kind) in zip(columns, _OUT, strict=True)]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range of ids in order; the range's first text and its last row stay to be joined."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    names = [*(name for name, _ in _OUT), "task", "head_text", "tail_text"]
    pending, head = [], None
    for batch in batches:
        for part in texts.slices(batch, limit=CHUNK):
            pending += zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)
            if head is None:
                head = pending[0][1]
            if len(pending) > 1:
                ids, own = [x[0] for x in pending[:-1]], [x[1] for x in pending]
                columns = _describe(ids, own[:-1], own[1:])
                n = len(ids)
                yield pa.RecordBatch.from_arrays([*columns, pa.array([task] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)
                pending = pending[-1:]
    if pending:
        empty = [pa.array([pending[0][0]], pa.int64()), *(pa.nulls(1, kind) for _, kind in _OUT[1:])]
        yield pa.RecordBatch.from_arrays([*empty, pa.array([task], pa.int32()), pa.array([head]), pa.array([pending[0][1]])], names)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in texts.slices(batch):
            columns = _describe(*(part.column(name).to_pylist() for name in ("doc_id", "text", "following")))
            yield pa.RecordBatch.from_arrays(columns, [name for name, _ in _OUT])


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and the fingerprint (hex) of every document; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, limit=CHUNK):
                own = part.column("text").to_pylist()
                made = [x.astype(">u4").tobytes().hex() for x in name_sets(own)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) for x in own], pa.int64()), pa.array(made, pa.string())],
                    ["doc_id", "n_chars", "fingerprint"],
                )

    return texts.id_and_text(docs).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to each other and to the next document.

    One range shuffle puts the texts in descending order of id. Each range
    compares its rows as they pass; only the last row of a range needs the
    first text of the next one, and those few rows are joined afterwards.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranges = texts.id_and_text(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    done = materialise(ranges.mapInArrow(_neighbours, f"{_SCHEMA}, task int, head_text string, tail_text string"), "fingerprints")
    ends = done.filter(F.col("tail_text").isNotNull())
    tasks = sorted(row["task"] for row in ends.select("task").collect())  # at most one per partition
    follows = spark.createDataFrame(
        list(zip(tasks, tasks[1:] + tasks[:1], strict=True)), "task int, next_task int"
    )
    heads = ends.select(F.col("task").alias("next_task"), F.col("head_text").alias("following"))
    last = ends.select("task", "doc_id", F.col("tail_text").alias("text")).join(follows, "task").join(heads, "next_task")
    joined = last.select("doc_id", "text", "following").mapInArrow(_pairs, _SCHEMA)
    every = done.filter(F.col("tail_text").isNull()).select(*(name for name, _ in _OUT)).unionByName(joined)
    return every.select(
        "doc_id", "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.lower(F.hex("names")).alias("fingerprint"), F.lower(F.hex("edited_names")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
