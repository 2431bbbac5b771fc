"""Passages of a benchmark inside documents, found by winnowing.

Every window of ``span`` words of a test item is looked for in all documents;
an item with fewer words is one window. A window's fingerprint is the least
hash of the ``gram``-word runs inside it. Moving the window by a word mostly
keeps that minimum, so a text has few fingerprints, and two texts that share
``span`` words share the fingerprint of that window, whatever surrounds it.
Items of a length below ``span`` have windows of their own length, with
shorter runs where they need them, so the guarantee holds for them as well.

The fingerprints of the items make a bitmap of at most 8 MB. Documents extend
only the places whose fingerprint may be in it to whole windows, and join
fingerprint and window hash with the distinct windows of the items. A document
window meets at most one row, however common the passage is on either side.
Windows name their items through the set of items that hold them, and
documents through the sets they hit, so each distinct set is listed once.

Defined cases: A-Z count as a-z; words are runs of digits, letters and
characters beyond ASCII. Null and empty texts, or texts of symbols only, have
no words and no hits. Items without words hold no window; a row without
item_id takes no part. Rows with one item_id are one item. Equal document
rows each give a row, with equal values; null doc_ids are kept. Without items
nothing is hit. Other columns are ignored. Words are compared by 64-bit
hashes, windows by two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.llm.membership import Membership
from wrenchlake.operators.skew import bounded
from wrenchlake.session import materialise

SPAN = 10
GRAM = 5
# Bits of the bitmap for each fingerprint of the items, up to its largest size.
BITS_EACH = 256
_TURN = np.uint64(0xC2B2AE3D27D4EB4F)


def _runs(hashes: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``size`` words from each place (all, or those given)."""
    places = np.arange(max(len(hashes) - size + 1, 0)) if at is None else at
    total = np.full(len(places), np.uint64(size))
    for k in range(size):
        total = texts.mix(total * _TURN + hashes[places + k])
    return total


def windows(hashes: np.ndarray, counts: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window of ``length`` words of one row begins, and the windows' fingerprints."""
    gram = min(gram, length)
    runs = _runs(hashes, gram)
    least = runs[: max(len(runs) - (length - gram), 0)].copy()
    for k in range(1, length - gram + 1):
        np.minimum(least, runs[k : len(least) + k], out=least)
    ends = np.repeat(np.cumsum(counts), counts)
    places = np.flatnonzero(np.arange(len(least)) + length <= ends[: len(least)])
    return places, least[places]


def _sign(fingerprints: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of windows of different lengths are kept apart."""
    return texts.mix(fingerprints ^ texts.mix(np.array([length], np.uint64))).view(np.int64)


def _split(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in texts.slices(batch):
        hashes, _, counts = texts.words(*texts.utf8(part.column("text")), gaps=texts.SYMBOLS)
        yield part, hashes, counts


def item_windows(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """item_id, length, print, win: every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item_id", "length", "print", "win"]
        for batch in batches:
            for part, hashes, counts in _split(batch):
                for length in np.unique(np.minimum(counts[counts > 0], span)).tolist():
                    own = counts == length if length < span else counts >= span
                    words = hashes[np.repeat(own, counts)]
                    places, prints = windows(words, counts[own], length, gram)
                    row = np.flatnonzero(own)[np.searchsorted(np.cumsum(counts[own]), places, side="right")]
                    columns = [
                        part.column("item_id").take(pa.array(row)), pa.array(np.full(len(places), length, np.int32)),
                        pa.array(_sign(prints, length)), pa.array(_runs(words, length, places).view(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    own = benchmark.select(F.col("item_id").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    made = own.filter(F.col("item_id").isNotNull()).mapInArrow(run, "item_id string, length int, print long, win long")
    return made.distinct()


_HIT = pa.struct([("start", pa.int64()), ("length", pa.int32()), ("print", pa.int64()), ("win", pa.int64())])


def _scanned(docs: DataFrame, found: DataFrame, gram: int) -> DataFrame:
    """doc_id, twin, n_words and the windows whose fingerprint may be an item's; rows with one doc_id and twin are equal."""
    lengths = [r["length"] for r in found.select("length").distinct().orderBy("length").collect()]  # at most ``span``
    may_be = Membership(found.select("print").distinct(), "print", BITS_EACH) if lengths else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, hashes, counts in _split(batch):
                ends = np.cumsum(counts)
                parts = []
                for length in lengths:
                    places, prints = windows(hashes, counts, length, gram)
                    prints = _sign(prints, length)
                    near = np.flatnonzero(may_be.possible(prints))
                    places, prints = places[near], prints[near]
                    parts.append((places, np.full(len(places), length, np.int32), prints, _runs(hashes, length, places).view(np.int64)))
                joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, t) for t in ("i8", "i4", "i8", "i8")]
                order = np.argsort(joined[0], kind="stable")
                joined = [x[order] for x in joined]
                row = np.searchsorted(ends, joined[0], side="right")
                joined[0] = joined[0] - (ends - counts)[row]
                cuts = np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32)
                hits = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(x) for x in joined], fields=list(_HIT)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("twin"), pa.array(counts.astype(np.int64)), hits], ["doc_id", "twin", "n_words", "hits"]
                )

    own = texts.id_and_text(docs).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("twin"))
    schema = "doc_id long, twin long, n_words long, hits array<struct<start long, length int, print long, win long>>"
    return materialise(own.mapInArrow(run, schema), "scanned")


def _set_sign(*columns: str):
    """Order-free signature of a group of distinct rows."""
    return F.concat_ws(
        ":", F.count(F.lit(1)).cast("string"), F.hex(F.bit_xor(F.xxhash64(*columns))), F.hex(F.bit_xor(F.xxhash64(F.lit(1), *columns)))
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The scanned documents, their hits (doc_id, twin, start, length, items) and the sets of items (items, item_id)."""
    found = materialise(item_windows(benchmark, span, gram), "item_windows")
    scanned = _scanned(docs, found, gram)
    keys = ["length", "print", "win"]
    by_window = found.groupBy(*keys).agg(_set_sign("item_id").alias("items"))
    candidates = scanned.filter(F.size("hits") > 0).select("doc_id", "twin", F.explode("hits").alias("hit")).select("doc_id", "twin", "hit.*")
    hits = materialise(candidates.join(bounded(by_window), keys).select("doc_id", "twin", "start", "length", "items").distinct(), "hits")
    sets = found.join(bounded(by_window), keys).select("items", "item_id").distinct()
    return scanned, hits, sets


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    A word is hit where any window of an item covers it; items_sha256 is the
    digest of the sorted item_ids, comma-joined.
    """
    scanned, hits, sets = overlaps(docs, benchmark, span, gram)
    key = ["doc_id", "twin"]
    # Words covered by the windows of a document: what each adds beyond the furthest end so far.
    before = Window.partitionBy(*key).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    furthest = F.coalesce(F.max(end).over(before), F.lit(0))
    covered = hits.select(*key, "start", "length").distinct().withColumn("added", F.greatest(end - F.greatest("start", furthest), F.lit(0)))
    words = covered.groupBy(*key).agg(F.sum("added").alias("n_hit"))
    named = hits.select(*key, "items").distinct()
    groups = materialise(named.groupBy(*key).agg(_set_sign("items").alias("group")).join(words.withColumnsRenamed({"doc_id": "_id", "twin": "_twin"}),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("twin") == F.col("_twin"))).drop("_id", "_twin"), "groups")
    # Documents that hit the same sets share one list of items.
    members = named.join(groups.select(F.col("doc_id").alias("_id"), F.col("twin").alias("_twin"), "group"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("twin") == F.col("_twin"))).select("group", "items").distinct()
    listed = members.join(sets, "items").groupBy("group").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    listed = listed.select("group", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    result = groups.join(bounded(listed), "group").select(F.col("doc_id").alias("_id"), F.col("twin").alias("_twin"), "n_hit", "n_items", "items_sha256")
    whole = scanned.select("doc_id", "twin", "n_words").join(
        bounded(result), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("twin") == F.col("_twin")), "left"
    )
    return whole.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
