"""Row counts of partitioned tables from file footers and folder names, without reading a column."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.functions import dates
from wrenchlake.schemas import RUN_DATE
from wrenchlake.session import materialise

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
_CASE = "spark.sql.caseSensitive"  # otherwise a partition column with capitals is not known to the push-down


@contextmanager
def footer_counts(spark: SparkSession):
    """Inside, Parquet tables are read by the source that takes counts from footers; frames must run inside, too."""
    old = {name: spark.conf.get(name) for name in (_V1_SOURCES, _PUSHDOWN, _CASE)}
    spark.conf.set(_V1_SOURCES, ",".join(s for s in old[_V1_SOURCES].split(",") if s.strip() != "parquet"))
    spark.conf.set(_PUSHDOWN, "true")
    spark.conf.set(_CASE, "true")
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def counted_by(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The plan behind ``rows_by_partition``."""
    return spark.read.parquet(path).groupBy(column).agg(F.count(F.lit(1)).alias("Records"))


def rows_by_partition(spark: SparkSession, path: str, column: str = RUN_DATE) -> DataFrame:
    """The partitions of a table and their number of rows (Records)."""
    with footer_counts(spark):
        return materialise(counted_by(spark, path, column), "footer_counts")


def delta_counts_of(spark: SparkSession, paths: dict[str, str], day, run_date: str = RUN_DATE) -> DataFrame:
    """Rows each table received on ``day``: TableName, DeltaRecords; 0 where there are none."""
    out = None
    for name, path in paths.items():
        own = rows_by_partition(spark, path, run_date).filter(F.col(run_date).cast("date") == dates.day(day))
        line = own.agg(F.coalesce(F.sum("Records"), F.lit(0)).cast("bigint").alias("DeltaRecords")).select(F.lit(name).alias("TableName"), "DeltaRecords")
        out = line if out is None else out.unionByName(line)
    return out


def missing_days(spark: SparkSession, path: str, first_day, last_day, run_date: str = RUN_DATE) -> DataFrame:
    """Days of the period on which the table at ``path`` received no rows."""
    expected = spark.range(1).select(F.explode(F.sequence(dates.day(first_day), dates.day(last_day))).alias(run_date))
    loaded = rows_by_partition(spark, path, run_date).filter("Records > 0").select(F.col(run_date).cast("date").alias(run_date))
    return expected.join(loaded, run_date, "left_anti")
