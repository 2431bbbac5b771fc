"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Character n-grams (over UTF-8 bytes, A-Z in lower case) of three lengths are
hashed into bins. Over all labelled training rows the presence of each bin is
counted per class; the log ratio of its two smoothed frequencies is the bin's
scale. Only bins that are told apart from chance carry a feature: presence of
the bin, times its scale. A logistic regression over these features is fitted
on at most ``FIT_ROWS`` labelled rows, the ones whose hash is smallest, of
each class, equal rows once (label 1 keeps its true share of the weight);
scoring covers every text whole. A text's score is that of its worst window of
WINDOW bytes; windows overlap by half and cover it, and a shorter text is one
window. Presence alone adds up with length: a long enough clean text holds most
bins.

Defined cases: a null or empty text has no feature, its score is the model's
intercept alone. Training rows with a null label or id are left out. Without
training rows of both classes, or without a bin that stands out, every score is
the share of label 1 (0 if there are no labels). Rows that repeat an id are labelled and scored one by one. A
doc_id with several labels counts as toxic if any of them says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.llm.membership import Membership
from wrenchlake.session import materialise

ORDERS = (4, 5, 6)
BINS = 1 << 18
# A bin needs this many training texts and this many standard errors of its log ratio.
LEAST_TEXTS = 5
LEAST_Z = 6.0
# Most labelled rows of either class that the linear fit sees (documented bound of the fit).
FIT_ROWS = 4_000
# Bytes of a window; a text's score is that of its worst window, of which a shorter text has one.
WINDOW = 1 << 17
# Tasks that sum up the slopes of a step; each sends one number per feature to the driver, BINS at most.
FIT_TASKS = 8
SMOOTHING = 1.0
RIDGE = 1e-4
# Most steps of the fit, the steps it remembers, and the slope at which it ends.
STEPS = 60
MEMORY = 8
TOLERANCE = 1e-5


@dataclass(frozen=True)
class Model:
    """weights[bin] already holds scale times coefficient; zero for bins without a feature."""

    weights: np.ndarray
    intercept: float


def _bins(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each order the bin of the n-gram that starts at each byte; -1 where it would leave its text."""
    lower = texts._LOWER[data].astype(np.uint32)
    n = len(data)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    out, rolled = [], np.zeros(n, np.uint32)
    for k in range(max(ORDERS)):
        if k < n:
            rolled[: n - k] = rolled[: n - k] * np.uint32(0x01000193) + lower[k:] + np.uint32(1)
        if k + 1 in ORDERS:
            mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(k * 0x9E37)
            out.append(np.where(room > k, ((mixed ^ (mixed >> np.uint32(13))) & np.uint32(BINS - 1)).astype(np.int32), -1))
    return out


def _present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The distinct bins of each text, of the wanted ones where given."""
    per_order = _bins(data, offsets)
    if wanted is None:
        flags = np.zeros(BINS + 1, bool)  # the last one takes the -1
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            flags[:] = False
            for bins in per_order:
                flags[bins[a:b]] = True
            yield np.flatnonzero(flags[:BINS])
        return
    where, what = [], []
    for bins in per_order:
        hit = np.flatnonzero(wanted[bins])  # wanted[-1] is False
        where.append(hit)
        what.append(bins[hit])
    rows = np.searchsorted(offsets, np.concatenate(where), side="right") - 1
    pairs = np.unique(rows * np.int64(BINS) + np.concatenate(what))
    cuts = np.searchsorted(pairs // BINS, np.arange(len(offsets)))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield pairs[a:b] % BINS


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of windows that cover each text, overlapping by half, and the first window of each text."""
    if np.diff(offsets).max(initial=0) <= WINDOW:
        return data, offsets, np.arange(len(offsets) - 1)
    half = WINDOW // 2
    starts = [np.arange(a, max(a + 1, b - half), half) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    counts = np.array([len(x) for x in starts])
    begins = np.concatenate(starts)
    ends = np.minimum(begins + WINDOW, np.repeat(offsets[1:], counts))
    cut = np.concatenate([data[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)])
    return cut, np.append(0, np.cumsum(ends - begins)), np.cumsum(counts) - counts


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """doc_id, text, y (0 or 1) of the documents with a label.

    A bounded filter drops most other documents before their texts are shuffled.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .dropna()
        .groupBy("doc_id")
        .agg((F.max("y") > 0).cast("int").alias("y"))
    )
    marks = materialise(marks, "marks")
    filtered = Membership(marks.select(F.xxhash64("doc_id").alias("hash")), "hash")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(filtered.possible(batch.column("hash").to_numpy()))).select(["doc_id", "text"])

    own = texts.id_and_text(docs).withColumn("hash", F.xxhash64("doc_id")).mapInArrow(possible, "doc_id long, text string")
    # Labels grow with the table, so they are never broadcast, however few there are.
    return own.join(marks.hint("merge"), "doc_id")


def _class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts per class, and texts per class and bin. At most 2 * (BINS + 1) rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS + 1), np.int64)
        for batch in batches:
            for part in texts.slices(batch):
                labels = part.column("y").to_pylist()
                for y, bins in zip(labels, _present(*texts.utf8(part.column("text"))), strict=True):
                    total[y, bins] += 1
                    total[y, BINS] += 1
        y, bins = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(bins), pa.array(total[y, bins])], ["y", "bin", "n"])

    summed = rows.select("y", "text").mapInArrow(count, "y long, bin long, n long").groupBy("y", "bin").agg(F.sum("n").alias("n"))
    packed = summed.toArrow()
    total = np.zeros((2, BINS + 1))
    total[packed.column("y").to_numpy(), packed.column("bin").to_numpy()] = packed.column("n").to_numpy()
    return total[:, BINS], total[:, :BINS]


def _scales(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-count ratio of each bin that stands out, else zero."""
    rate = (counts + SMOOTHING) / (sizes + 2 * SMOOTHING)[:, None]
    ratio = np.log(rate[1]) - np.log(rate[0])
    error = np.sqrt((1 - rate[1]) / (counts[1] + SMOOTHING) + (1 - rate[0]) / (counts[0] + SMOOTHING))
    z = np.abs(ratio) / np.maximum(error, 1e-9)
    z[(counts.sum(0) < LEAST_TEXTS) | (z < LEAST_Z)] = 0
    return np.where(z > 0, ratio, 0.0)


def _slopes(batches: Iterator[pa.RecordBatch], scaled: np.ndarray, bias: float, by_class: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of the rows of a task: weighted loss, its slope in the bias, and in each scaled feature (before its scale)."""
    loss, pull, slope = 0.0, 0.0, np.zeros(len(scaled))
    for batch in batches:
        y = batch.column("y").to_numpy().astype(float)
        blobs = batch.column("found").to_pylist()
        index = np.frombuffer(b"".join(blobs), "<i4")
        rows = np.repeat(np.arange(len(blobs)), [len(x) // 4 for x in blobs])
        margin = np.bincount(rows, scaled[index], len(blobs)) + bias
        weight = by_class[y.astype(int)]
        loss += float((weight * np.logaddexp(0, np.where(y == 1, -margin, margin))).sum())
        wrong = weight * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y)
        pull += float(wrong.sum())
        slope += np.bincount(index, wrong[rows], len(scaled))
    yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([pull]), pa.array([slope.tobytes()], pa.binary())], ["loss", "pull", "slope"])


def _fit(features: DataFrame, scale: np.ndarray, by_class: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by limited-memory BFGS; the rows stay in Spark, each step sums one slope per task.

    ``features`` holds y and the places of a row's features; ``by_class`` is the
    weight of a row of either class.
    """
    context = features.sparkSession.sparkContext

    def look(at: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast((scale * at[:-1], float(at[-1]), by_class))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _slopes(batches, *shared.value)

        found = features.mapInArrow(run, "loss double, pull double, slope binary").collect()  # FIT_TASKS rows
        slope = sum((np.frombuffer(r["slope"]) for r in found), np.zeros(len(scale)))
        shared.destroy()
        ridge = RIDGE * at[:-1]
        return sum(r["loss"] for r in found) + 0.5 * float(ridge @ at[:-1]), np.append(scale * slope + ridge, sum(r["pull"] for r in found))

    at = np.zeros(len(scale) + 1)
    value, slope = look(at)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        if np.abs(slope).max() < TOLERANCE:
            break
        way, kept = -slope, []
        for moved, turned in reversed(steps):
            share = float(moved @ way) / float(moved @ turned)
            kept.append(share)
            way = way - share * turned
        if steps:
            moved, turned = steps[-1]
            way = way * float(moved @ turned) / float(turned @ turned)
        for (moved, turned), share in zip(steps, reversed(kept), strict=True):
            way = way + (share - float(turned @ way) / float(moved @ turned)) * moved
        size = 1.0 if steps else min(1.0, 1.0 / float(np.abs(slope).sum()))
        down = float(slope @ way)
        while True:
            new = at + size * way
            new_value, new_slope = look(new)
            if new_value <= value + 1e-4 * size * down or size < 1e-8:
                break
            size /= 2
        if float((new - at) @ (new_slope - slope)) > 1e-12:
            steps = [*steps, (new - at, new_slope - slope)][-MEMORY:]
        done = value - new_value < 1e-9 * max(abs(value), 1.0)
        at, value, slope = new, new_value, new_slope
        if done:
            break
    return at[:-1], float(at[-1])


def train(rows: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on rows of (doc_id, text, y); counts use all of them, the linear fit at most ``fit_rows`` per class."""
    rows = materialise(rows.select("doc_id", "text", "y"), "labelled")
    sizes, counts = _class_counts(rows)
    share = float(np.clip(sizes[1] / max(sizes.sum(), 1), 1e-9, 1 - 1e-9))
    scales = _scales(sizes, counts)
    chosen = np.flatnonzero(scales)
    if not sizes.min() or not len(chosen):
        return Model(np.zeros(BINS), float(np.log(share / (1 - share))))
    wanted = np.append(scales != 0, False)
    place = np.zeros(BINS, np.int32)
    place[chosen] = np.arange(len(chosen))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch):
                found = [place[bins].astype("<i4").tobytes() for bins in _present(*texts.utf8(part.column("text")), wanted)]
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(found, pa.binary())], ["y", "found"])

    # The rows whose hash is smallest, found by the hash alone, so that no text is sorted.
    ordered = rows.withColumn("_order", F.xxhash64("doc_id", "text"))
    bounds = [ordered.filter(F.col("y") == y).select("_order").distinct().orderBy("_order").limit(fit_rows).agg(F.max("_order")).first()[0] for y in (0, 1)]
    picked = ordered.filter(F.col("_order") <= F.when(F.col("y") == 0, F.lit(bounds[0])).otherwise(F.lit(bounds[1])))
    once = picked.groupBy("y", "_order").agg(F.first("text").alias("text")).select("y", "text")
    # At most twice ``fit_rows`` rows; they are read again at every step of the fit.
    table = materialise(once.repartition(FIT_TASKS).mapInArrow(features, "y int, found binary"), "features")
    sums = {r["y"]: r["n"] for r in table.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    coef, bias = _fit(table, scales[chosen], np.array([(1 - share) / sums.get(0, 1), share / sums.get(1, 1)]))
    weights = np.zeros(BINS)
    weights[chosen] = coef * scales[chosen]
    return Model(weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (its columns kept) with score in 0..1 and predicted; uses the text column alone."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float64), model.intercept))  # 2 MB, fixed by BINS

    def run(series: Iterator) -> Iterator:
        import pandas as pd

        weights, bias = shared.value
        for column in series:
            text = pa.array(column, pa.string(), from_pandas=True).fill_null("")
            batch = pa.RecordBatch.from_arrays([text], ["text"])
            out = []
            for part in texts.slices(batch):
                cut, offsets, firsts = _windows(*texts.utf8(part.column("text")))
                margins = [bias + float(weights[bins].sum()) for bins in _present(cut, offsets)]
                out.append(np.maximum.reduceat(margins, firsts))
            margin = np.clip(np.concatenate(out) if out else np.zeros(0), -35, 35)
            yield pd.Series(1 / (1 + np.exp(-margin)))

    one = F.pandas_udf(run, "double", functionType=F.PandasUDFType.SCALAR_ITER)
    scored = docs.withColumn("score", one(F.col("text").cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
