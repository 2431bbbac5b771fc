"""Keys that may occur more than once, found without shuffling all keys.

A uniqueness check over a table whose keys are nearly all different shuffles
every key only to find that it stands alone. Here each task marks the hashes of
its keys in two bitmaps, "seen" and "seen again", and sends the marked places,
two bytes each, gathered by page of the bitmap. A place that one task saw again,
or that two tasks saw, may belong to a repeated key; all others cannot. The
places that stay are broadcast, and only rows that hit one go on to be counted
exactly. Their number is that of the rows of repeated keys plus the rows whose
hash meets another key's, about one in sixteen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrenchlake.session import materialise

# Most places of a bitmap: 32 MB, which is the largest size of the broadcast.
MOST_PLACES = 1 << 28
PLACES_EACH = 16
# Below this many rows the shuffle of all keys is cheaper than the two passes. The
# marking costs CPU to save shuffle: where shuffles are cheap, set it higher.
LEAST_ROWS = 16_000_000
_PAGE = 1 << 15
_MARKS = "page long, seen binary, again binary"
_PAGES = "_again_page long, _again_words array<long>"


def _comparable(df: DataFrame, keys: list[str]) -> bool:
    """Whether equal keys have equal hashes: plain columns without a collation."""
    kinds = [df.schema[k].dataType for k in keys]
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return not any(isinstance(k, nested) or (isinstance(k, T.StringType) and k != T.StringType()) for k in kinds)


def _place(keys: list[str], places: int) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys]).bitwiseAND(F.lit(places - 1))


def _pages(df: DataFrame, keys: list[str], places: int) -> DataFrame:
    """Pages of the bitmap of places that were hit more than once, as 512 words each."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(places >> 3, np.uint8), np.zeros(places >> 3, np.uint8)
        for batch in batches:
            place, times = np.unique(batch.column(0).to_numpy(), return_counts=True)
            byte, bit = place >> 3, np.left_shift(1, place & 7).astype(np.uint8)
            twice = (times > 1) | ((seen[byte] & bit) > 0)
            np.bitwise_or.at(seen, byte, bit)
            np.bitwise_or.at(again, byte[twice], bit[twice])
        seen, again = seen.reshape(-1, _PAGE >> 3), again.reshape(-1, _PAGE >> 3)
        touched = np.flatnonzero(seen.any(axis=1))
        for some in np.array_split(touched, -(-len(touched) // 256)) if len(touched) else []:
            marks = [
                [np.flatnonzero(np.unpackbits(bits[page], bitorder="little")).astype("<u2").tobytes() for page in some]
                for bits in (seen, again)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), *(pa.array(x, pa.binary()) for x in marks)], ["page", "seen", "again"]
            )

    def meet(marks: pa.Table) -> pa.Table:
        page = marks.column("page").to_numpy()
        found = []
        seen, again = marks.column("seen").to_pylist(), marks.column("again").to_pylist()
        order = np.argsort(page, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(page[order])) + 1):
            hits = [np.frombuffer(b"".join([x[row] for row in rows]), "<u2") for x in (seen, again)]
            twice = np.bincount(hits[0], minlength=_PAGE) > 1
            twice[hits[1]] = True
            if twice.any():
                found.append((page[rows[0]], np.packbits(twice, bitorder="little").view("<i8")))
        return pa.table(
            [pa.array([k for k, _ in found], pa.int64()), pa.array([w for _, w in found], pa.list_(pa.int64()))],
            names=["_again_page", "_again_words"],
        )

    marked = df.select(_place(keys, places).alias("place")).mapInArrow(mark, _MARKS)
    return materialise(marked.groupBy(F.shiftright("page", 5)).applyInArrow(meet, _PAGES), "repeated")


def may_repeat(
    df: DataFrame,
    keys: list[str],
    least_rows: int = LEAST_ROWS,
    most_places: int = MOST_PLACES,
    rows: int | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key may occur more than once; every row of a repeated key is among them.

    NULL keys count as equal. ``df`` is read once on its key columns and once
    whole, so it should be a table; ``rows`` is its number of rows where that
    is known. Tables below ``least_rows``, tables of more rows than the bitmap
    has places, and nested or collated keys come back whole, so that what
    follows is exact in any case.
    """
    if not keys or not _comparable(df, keys):
        return df
    n = df.count() if rows is None else rows
    if n < least_rows or n > most_places:
        return df
    places = min(most_places, max(_PAGE, 1 << (PLACES_EACH * n).bit_length()))
    place = _place(keys, places)
    pages = F.broadcast(_pages(df, keys, places))  # at most places / 8 bytes
    hit = df.join(pages, F.shiftright(place, 15) == F.col("_again_page"))
    offset = place.bitwiseAND(F.lit(_PAGE - 1))
    word = F.get("_again_words", F.shiftright(offset, 6).cast("int"))
    return hit.filter(F.getbit(word, offset.bitwiseAND(F.lit(63)).cast("int")) == 1).select(*[df[f"`{c}`"] for c in df.columns])
