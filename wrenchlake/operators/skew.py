"""Building blocks that stay balanced when one key holds much of the data.

Joins and aggregates need little help: partial aggregation runs before each
shuffle and adaptive execution splits skewed join partitions. Windows are the
exception, since a window reads a whole group in one task. The helpers here
either shrink the group before the shuffle or cut it into ordered slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wrenchlake.session import materialise, materialise_bucketed

# A group above this many rows is cut into slices before it reaches a window.
HOT_ROWS = 1_000_000
# Largest derived frame that may be broadcast, in bytes of its values as text.
BROADCAST_BYTES = 32 << 20
# Least number of buckets of a join in buckets, for every core of the session.
BUCKETS_PER_CORE = 4
# In a join in buckets, a bucket of this many rows and of twice the mean is crowded.
CROWDED_ROWS = 100_000


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank limit lets Spark drop all but one row per key and map task before
    the shuffle, so a hot key costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _written(df: DataFrame) -> tuple[DataFrame, int]:
    """The frame written once, and the bytes of its values as text."""
    done = materialise(df, "bounded")
    return done, done.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Materialise a small derived frame and broadcast it if its size allows.

    Spark cannot estimate the size of an aggregate before running it and would
    shuffle the large side to meet it. Here the frame is written once, the
    bytes of its values are summed up, and it is marked for broadcast only
    within the limit; beyond it the join is left to a shuffle with adaptive
    skew handling.
    """
    done, size = _written(df)
    return F.broadcast(done) if size <= max_bytes else done


def bounded_or_dealt(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """As ``bounded`` for a lookup of ``join_in_buckets``, and whether it is too large to broadcast."""
    done, size = _written(df.withColumn("_dealt", F.lit(0)))
    return (done, True) if size > max_bytes else (F.broadcast(done.drop("_dealt")), False)


def bounded_or_hashed(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """As ``bounded``, for a lookup with one row per key that wide facts meet.

    Beyond the limit the lookup is hashed, shuffle partition by partition, and
    the facts stream past it: they are shuffled but not sorted, so none of them
    is held or spilled for the join. A task holds its share of the lookup, which
    must fit its memory; one row per key keeps the shares even.
    """
    done, size = _written(df)
    return F.broadcast(done) if size <= max_bytes else done.hint("shuffle_hash")


def join_in_buckets(
    facts: DataFrame, lookup: DataFrame, keys: list[str], tasks: int, hot_rows: int = CROWDED_ROWS
) -> tuple[DataFrame, str]:
    """Left join of wide ``facts`` with a ``lookup`` of one row per key that is too large to broadcast.

    A shuffle moves rows one by one, with little compression. Here the facts
    are written as compressed columns, in buckets of the key; the lookup alone
    is shuffled, and hashed bucket by bucket. All their columns are written, so
    this is for callers that take them all; others let Spark prune a plain join.
    A bucket is one task of what follows, so there are ``tasks`` of them at
    least: as many as keep what a task sorts within its memory.

    ``lookup`` has a written column ``_dealt`` of zeros (``bounded_or_dealt``; a
    literal would be folded and lost to the join's key). Facts without a key
    match nothing and go to all buckets alike. Keys that crowd a bucket, with
    more than ``hot_rows`` facts and half of the mean of all buckets, are two
    for each bucket at most, so their part of the lookup is broadcast to the
    facts, file by file.

    Returns the folder of the facts as well, which may go once the result is written.
    """
    spark, cells = facts.sparkSession, [*keys, "_dealt"]
    buckets = max(tasks, BUCKETS_PER_CORE * spark.sparkContext.defaultParallelism)
    no_key = F.greatest(*[F.col(k).isNull() for k in keys])
    anywhere = F.when(no_key, F.monotonically_increasing_id() % buckets).otherwise(0).cast("int")
    rows, path = materialise_bucketed(facts.withColumn("_dealt", anywhere), cells, buckets)
    files = spark.read.schema(rows.schema).parquet(path)
    theirs = lookup.repartition(buckets, *cells).hint("shuffle_hash")
    hot = _hot_in_buckets(files, cells, buckets, hot_rows)
    if hot is None:
        return rows.join(theirs, cells, "left").drop("_dealt"), path
    found = bounded(hot.join(lookup, cells, "left"))
    others = rows.join(hot, cells, "left_anti").join(theirs, cells, "left")
    return others.unionByName(files.join(found, cells)).drop("_dealt"), path


def _hot_in_buckets(files: DataFrame, cells: list[str], buckets: int, hot_rows: int) -> DataFrame | None:
    """Cells with more than ``hot_rows`` rows and half of the mean, in buckets of twice the mean, or None."""
    bucket = F.pmod(F.hash(*cells), F.lit(buckets))
    sizes = files.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")).collect()
    mean = sum(s["_n"] for s in sizes) // buckets
    crowded = [s["_bucket"] for s in sizes if s["_n"] > max(hot_rows, 2 * mean)]
    hot = hot_groups(files.filter(bucket.isin(crowded)), cells, max(hot_rows, mean // 2)) if crowded else None
    return None if hot is None else hot.drop("_n")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """A frame of ``bounded`` that has one row per key, made known as such to Spark.

    A left join with it falls away wherever none of its other columns is asked for.
    """
    return df.dropDuplicates(keys)


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their count _n, or None when there are none.

    The count is combined map-side and reads only the key columns. At most
    rows / hot_rows keys can qualify.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = bounded(counts.filter(F.col("_n") > hot_rows))
    return None if hot.isEmpty() else hot


def _mark(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with boolean ``_hot``; keys are compared null-safe."""
    renamed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"), F.col("_n").alias("_hot_n"))
    on = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    joined = df.join(renamed, on, "left").drop(*[f"_hot_{k}" for k in keys])
    return joined.withColumn("_hot", F.coalesce(F.col("_hot"), F.lit(False)))


def lag_in_group(
    df: DataFrame,
    keys: list[str],
    day: str,
    order: list[str],
    lags: dict[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Previous values per key, ordered by ``day``, then ``order``, then the remaining columns.

    ``lags`` maps new column to source column. Groups up to ``hot_rows`` rows go
    through one window. A larger group is cut into one slice per day; the last
    row of each slice is carried into the next one, so every slice is ordered on
    its own. Only rows equal in all columns tie, so the result is the same for
    any ``hot_rows``. Groups are counted on their keys before, so ``df`` should
    be a table or a frame that is cheap to read twice.
    """
    rest = [c for c in df.columns if c not in (*keys, day, *order)]
    ordering = [day, *order, *rest]
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*ordering)
        return df.withColumns({new: F.lag(src).over(window) for new, src in lags.items()})

    # Rows without a day sort first, in a slice of their own.
    slice_day = F.when(F.col("_hot"), F.coalesce(F.col(day), F.lit("0001-01-01").cast("date")))
    sliced = _mark(df, hot, keys).withColumn("_slice", slice_day).withColumn("_carried", F.lit(False))
    carried_cols = list(dict.fromkeys([*ordering, *lags.values()]))
    ends = (
        sliced.filter("_hot")
        .groupBy(*keys, "_slice")
        .agg(F.max(F.struct(*[F.col(c) for c in carried_cols])).alias("_end"))
    )
    into = F.lead("_slice").over(Window.partitionBy(*keys).orderBy("_slice"))
    carried = (
        ends.withColumn("_into", into)
        .filter(F.col("_into").isNotNull())
        .select(
            *keys,
            F.col("_into").alias("_slice"),
            *[F.col("_end")[c].alias(c) for c in carried_cols if c not in keys],
            F.lit(True).alias("_carried"),
        )
    )
    window = Window.partitionBy(*keys, "_slice").orderBy(*ordering)
    return (
        sliced.unionByName(carried, allowMissingColumns=True)
        .withColumns({new: F.lag(src).over(window) for new, src in lags.items()})
        .filter(~F.col("_carried"))
        .drop("_hot", "_hot_n", "_slice", "_carried")
    )


def all_but_first(df: DataFrame, keys: list[str], order: list[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row of a key except the first in ``order``, ties settled by the remaining columns.

    Keys are counted first, combined map-side, and only rows of a key that
    occurs more than once go on. A group above ``hot_rows`` is dealt into parts
    of about that size; the parts are ranked apart and only their leaders meet.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    by = [*order, *columns]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    listed = bounded(counts.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_n"))
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    # Equal rows are one row with a number of copies, so a group of them cannot be large either.
    rows = df.join(listed, on).groupBy(*columns, "_n").agg(F.count(F.lit(1)).alias("_copies"))
    parts = F.ceil(F.col("_n") / F.lit(max(hot_rows, 1)))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*columns), parts))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by)))
    leaders = ranked.filter("_rank = 1")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*by)) == 1
    met = leaders.withColumn("_copies", F.col("_copies") - F.when(first, 1).otherwise(0))
    later = ranked.filter("_rank > 1").unionByName(met).filter("_copies > 0")
    return later.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*columns)
