"""Writers and readers for partitioned Parquet tables and report files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wrenchlake.functions import dates
from wrenchlake.schemas import RUN_DATE


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """Rows of a table; name the ``schema`` where the table may still be empty."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_partitioned(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A table partitioned by a text column, whose values stay text whatever they look like."""
    rows = spark.read.parquet(path)
    texts = [StructField(f.name, StringType() if f.name == column else f.dataType) for f in rows.schema]
    return spark.read.schema(StructType(texts)).parquet(path)


def spread_by_day(df: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    """Group rows by run day for writing a backfill of many days.

    The rebalance hint keeps files large and splits a day that is too big for
    one task.
    """
    return df.hint("rebalance", F.col(run_date))


def write_append(df: DataFrame, path: str, run_date: str = RUN_DATE) -> None:
    """Add rows to a history table."""
    df.write.mode("append").partitionBy(run_date).parquet(path)


def _files(spark: SparkSession, path: str):
    """File system of a folder, and a maker of its path objects."""
    maker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return maker(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), maker


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders (column=value) of a table, sorted; none if it does not exist."""
    fs, at = _files(spark, path)
    return sorted(f.getPath().getName() for f in fs.globStatus(at(path, "[!_.]*=*")) or [])


def run_days(spark: SparkSession, path: str, run_date: str = RUN_DATE) -> list[str]:
    """The run days a table holds, from its folder names."""
    start = f"{run_date}="
    return [name.removeprefix(start) for name in partition_folders(spark, path) if name.startswith(start)]


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Bring in the partitions that a run completed but did not live to swap in.

    A folder ``_ready-...`` holds whole partitions. Each takes the place of the
    table's own one; what is swapped in leaves the folder, so the work can be
    taken up wherever it stopped.
    """
    fs, at = _files(spark, path)
    for ready in fs.globStatus(at(path, "_ready-*")) or []:
        for new in fs.globStatus(at(ready.getPath(), "[!_.]*=*")) or []:
            live = at(path, new.getPath().getName())
            fs.delete(live, True)
            _move(fs, new.getPath(), live)
        fs.delete(ready.getPath(), True)


def _swap_in(spark: SparkSession, path: str, write, names: list[str]) -> None:
    """Let ``write`` fill a folder beside the table, then swap its partitions in.

    Until all of them are complete the table stays as it is, whatever fails.
    Readers never see the folder, as its name begins with an underscore. The
    ``names`` are partitions that end up empty where nothing was written.
    """
    finish_swaps(spark, path)
    fs, at = _files(spark, path)
    token = uuid.uuid4().hex
    staged = f"{path}/_staged-{token}"
    try:
        write(staged)
        for name in names:
            fs.mkdirs(at(staged, name))
    except BaseException:
        fs.delete(at(staged), True)
        raise
    _move(fs, at(staged), at(f"{path}/_ready-{token}"))
    finish_swaps(spark, path)


def write_day(df: DataFrame, path: str, day, run_date: str = RUN_DATE, within: tuple[str, ...] = ()) -> None:
    """Replace one run day of a table by ``df``; a repeated run does not double rows.

    A day without rows is emptied. The new day is complete beside the table
    before the old one goes, so a run that fails, for example on a row of
    another run day, leaves the old day in place; one that is killed during the
    swap is finished by the next write (or ``finish_swaps``). ``df`` may read
    the day it replaces. ``within`` names columns that partition a day further.
    """
    whole = dates.day(day)
    label = df.sparkSession.range(1).select(whole.cast("string").alias("day")).first()["day"]
    name = f"{run_date}={label}"
    # The check stands in a written column: as a filter it would move into the scan and meet rows that df leaves out.
    other = F.raise_error(F.concat(F.lit("row of another run day: "), F.coalesce(F.col(run_date).cast("string"), F.lit("none"))))
    first = next(c for c in df.columns if c != run_date)
    rows = df.withColumn(first, F.when(F.col(run_date).eqNullSafe(whole), F.col(f"`{first}`")).otherwise(other)).drop(run_date)

    def write(staged: str) -> None:
        writer = rows.write
        (writer.partitionBy(*within) if within else writer).parquet(f"{staged}/{name}")

    _swap_in(df.sparkSession, path, write, [name])


def replace_partitions(df: DataFrame, path: str, column: str, values: list) -> None:
    """Replace the partitions of ``column`` that ``values`` names by the rows of ``df``; the others are not touched.

    A row of another partition fails the write. ``df`` may read the table.
    """
    spark = df.sparkSession
    named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    names = [named.getPartitionPathString(column, None if v is None else str(v)) for v in values]
    listed = F.col(column).isin([v for v in values if v is not None])
    other = F.raise_error(F.concat(F.lit("row of another partition: "), F.coalesce(F.col(column).cast("string"), F.lit("none"))))
    checked = df.withColumn(column, F.when(F.coalesce(listed, F.lit(None in values)), F.col(column)).otherwise(other))
    together = checked.hint("rebalance", F.col(column))
    _swap_in(spark, path, lambda staged: together.write.partitionBy(column).parquet(staged), names)


def drop_days(spark: SparkSession, path: str, before: str, run_date: str = RUN_DATE) -> None:
    """Remove the run days earlier than ``before`` (ISO text)."""
    fs, at = _files(spark, path)
    for day in run_days(spark, path, run_date):
        if day < before:
            fs.delete(at(path, f"{run_date}={day}"), True)


def write_replace(df: DataFrame, path: str) -> None:
    """Replace a whole table. ``df`` must not read from ``path``; see ``rewrite``."""
    df.write.mode("overwrite").parquet(path)


def rewrite(df: DataFrame, path: str, staging: str, run_date: str | None = None) -> None:
    """Replace a table by a result computed from that same table.

    The result is complete in ``staging`` (a path on the same file system)
    before it takes the table's place, so a failure at any point leaves one
    full copy, and the rows are written once.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(run_date) if run_date else writer).parquet(staging)
    fs, at = _files(df.sparkSession, path)
    fs.delete(at(path), True)
    _move(fs, at(staging), at(path))


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a catalog table from a query, at ``path`` or in the warehouse folder."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def copy_table(spark: SparkSession, source: str, target: str, run_date: str = RUN_DATE) -> None:
    """Append one table to another."""
    write_append(spark.read.parquet(source), target, run_date)


def write_csv(df: DataFrame, path: str, **options) -> None:
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **keep_blanks, **options).csv(path)


def write_report(sheets: dict[str, DataFrame], folder: str) -> None:
    """One CSV dataset per sheet of a report."""
    for name, df in sheets.items():
        write_csv(df, f"{folder}/{name}")


def write_ordered(df: DataFrame, path: str, order: list[Column]) -> None:
    """Write a report in order: its files, by name, and the rows in each follow ``order``.

    Ranges of the sorted rows go to one task each, their bounds taken from a
    sample. The order ends with all columns, so a value that fills much of the
    report is split over several files, and equal runs give equal reports.
    """
    df.orderBy(*order, *[F.col(f"`{c}`") for c in df.columns]).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """Rows of an ordered report with their place (from 1), taken from the order of files and rows."""
    rows = spark.read.parquet(path)
    own = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row per file; the window over them stays small.
    sizes = own.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = own.join(F.broadcast(starts), "_file").withColumn(place, F.col("_before") + F.col("_row") + 1)
    return placed.select(*rows.columns, place)


def as_of(df: DataFrame, day, run_date: str = RUN_DATE) -> DataFrame:
    """An append-only table as it stood at the end of ``day``; prunes partitions."""
    return df.filter(F.col(run_date) <= dates.day(day))


def latest_delta(df: DataFrame, day, run_date: str = RUN_DATE) -> DataFrame:
    """The rows loaded on one day."""
    return df.filter(F.col(run_date) == dates.day(day))
