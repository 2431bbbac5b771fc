"""Packing by power-of-two decomposition.

A document of n tokens is cut into as many pieces of the full length as fit and
then into the powers of two of the binary form of the rest. Each piece is a
sequence of its own: its length is a power of two, so nothing is padded, and no
sequence crosses documents. Sequences of one length form a bucket, a range of
sequence ids; a training batch is drawn from one bucket.

Defined cases: a null or empty text is its end token alone, one piece of length
1. Equal rows are packed each on their own. An empty table gives no piece.
Ids and other columns may repeat or be null; they are carried, never joined on.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts, words

LONGEST = 1024
END_ID = 0

_encoders: dict[tuple[str, str], Callable] = {}


def pieces(totals: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the pieces of documents of so many tokens, in order."""
    full, rest = totals // longest, totals % longest
    rows, starts, sizes = [np.repeat(np.arange(len(totals)), full)], [], [np.full(int(full.sum()), longest)]
    starts.append(longest * (np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)))
    for k in range(longest.bit_length() - 1):
        own = np.flatnonzero(rest >> k & 1)
        rows.append(own)
        starts.append(totals[own] - rest[own] % (2 << k))  # what is behind it are the smaller powers and itself
        sizes.append(np.full(len(own), 1 << k))
    row, start, size = map(np.concatenate, (rows, starts, sizes))
    order = np.lexsort((start, row))
    return row[order], start[order], size[order]


def _encoder(path: str, pattern: str) -> Callable:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = words.tokenizer_ids(path, pattern)
    return _encoders[path, pattern]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    longest: int = LONGEST,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per sequence: doc_id, start, length, ids, doc_tokens, ids_crc32, bucket, sequence_id, offset.

    ``ids`` (little-endian unsigned 32-bit) is left out with ``with_ids=False``.
    ``bucket`` is the binary logarithm of the length. Sequences of one bucket
    have ids of one range, so a reader of ids meets buckets one by one; ids are
    unique. Rows are made where their document is read, without a shuffle.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"]
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path, pattern)
        for batch in batches:
            for part in texts.slices(batch):
                ids = [own + end for own in encode(part.column("text").to_pylist())]
                totals = np.array([len(own) // 4 for own in ids])
                row, start, length = pieces(totals, longest)
                cuts = zip(row.tolist(), (4 * start).tolist(), (4 * (start + length)).tolist(), strict=True)
                found = [ids[k][a:b] for k, a, b in cuts]
                crc = np.fromiter(map(zlib.crc32, found), np.int64, len(found))
                bucket = np.bitwise_count((length - 1).astype(np.uint64)).astype(np.int64)
                columns = [part.column("doc_id").take(pa.array(row)), *map(pa.array, (start, length, crc, totals[row], bucket))]
                if with_ids:
                    columns.append(pa.array(found, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*names, "ids"][: len(columns)])

    schema = ", ".join(f"{name} long" for name in names) + (", ids binary" if with_ids else "")
    made = texts.id_and_text(docs).mapInArrow(cut, schema)
    sequence = F.shiftleft("bucket", 58).bitwiseOR(F.monotonically_increasing_id())
    return made.withColumns({"sequence_id": sequence, "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences into one folder per length, ready for length-pure batches."""
    pieces.write.partitionBy("length").parquet(path)
