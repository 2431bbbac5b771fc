"""Shared helpers: document columns, bounded slices of Arrow batches, word and shingle hashes.

Conventions of this subpackage: a null text is an empty text, a null id stays
null, columns beyond the ones an operator names are ignored, so they may bear
any name. Words are runs of bytes other than space and 0x09-0x0D, with A-Z in
lower case; they are hashed to 64 bits.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text handled at once inside a task, in UTF-8 bytes; one longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Bytes between alphanumeric words: all of ASCII but digits and letters.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

# Odd 64-bit multipliers of the hashes below.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                   0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25], np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


_C = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory to the system, so that a worker between two tasks holds little."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):  # glibc
        _C.malloc_trim(0)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Just the id (long) and the text (null as empty)."""
    return docs.select(*columns_of_id_and_text(id_column, text_column))


def columns_of_id_and_text(id_column: str = "doc_id", text_column: str = "text") -> list:
    return [F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts hold at most ``limit`` bytes, or one row."""
    if not batch.num_rows:
        return
    ends = utf8(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array in one buffer, and the offsets of its rows."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    buffers = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n; tables up to one slice are kept."""
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            table[0] = 1
            made.append(np.multiply.accumulate(table))
        if n > SLICE_BYTES + 1:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, word starts and the number of words of each row; ``gaps`` marks the bytes between words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    solid = ~gaps[data]
    first = np.empty(n, bool)
    first[0], first[1:] = True, ~solid[:-1]
    first[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(solid & first)
    last = np.empty(n, bool)
    last[-1], last[:-1] = True, ~solid[1:]
    cuts = offsets[1:][offsets[1:] > 0] - 1
    last[cuts] = True
    stops = np.flatnonzero(solid & last) + 1
    up, down = _power_tables(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, starts, counts


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of ``size`` consecutive words.

    A row with fewer words has its whole sequence as one shingle, a row without
    words has none.
    """
    steps = np.resize(_STEPS, size) + np.arange(size, dtype=np.uint64) * np.uint64(2)
    total = len(hashes)
    runs = np.zeros(max(total - size + 1, 0), np.uint64)
    for k in range(size):
        runs += hashes[k : total - size + 1 + k] * steps[k] if total >= size else np.uint64(0)
    runs = mix(runs)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(runs[at : at + n - size + 1]))
        elif n:
            whole = (hashes[at : at + n] * steps[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([whole])))
        else:
            out.append(runs[:0])
        at += n
    return out
