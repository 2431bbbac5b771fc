"""Readers for the daily feeds and the static lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.schemas import FEEDS, Feed

FALLBACK_ENCODING = "ISO-8859-1"
# Holds the text of a line with a value that could not be read.
UNREADABLE = "_unreadable"


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    feed: str | Feed,
    columns: list[str] | None = None,
    encoding: str | None = None,
    date_format: str | None = None,
    header: bool = True,
    strict_header: bool = False,
    multi_line: bool | None = None,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Read delimited files with the declared names and types of a feed.

    Names are given by position, whatever the header says, unless
    ``strict_header`` asks for them to agree. Several paths are read as one. A
    field left empty is NULL. ``columns`` is pruned in the scan.

    A value that does not fit its type fails the read. With ``keep_unreadable``
    it becomes NULL and the whole line is kept in the column ``UNREADABLE``, so
    that such lines can be counted (``unreadable_lines``) and mended.

    Feeds whose texts may hold line breaks are read one file per task, as such
    files cannot be split; pass ``multi_line=False`` where a very large file is
    known to have none.
    """
    declared = FEEDS[feed] if isinstance(feed, str) else feed
    whole_files = declared.multi_line if multi_line is None else multi_line
    ddl = f"{declared.ddl}, {UNREADABLE} string" if keep_unreadable else declared.ddl
    reader = spark.read.schema(ddl).options(
        header=header, enforceSchema=not strict_header, multiLine=whole_files, escape='"', **declared.options
    )
    if keep_unreadable:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=UNREADABLE)
    else:
        reader = reader.option("mode", "FAILFAST")
    if encoding:
        reader = reader.option("encoding", encoding)
    if date_format:
        reader = reader.options(dateFormat=date_format, timestampNTZFormat=date_format, timestampFormat=date_format)
    df = reader.csv(path)
    if not columns:
        return df
    return df.select(*[F.col(f"`{c}`") for c in [*columns, *([UNREADABLE] if keep_unreadable else [])]])


def unreadable_lines(df: DataFrame) -> DataFrame:
    """One row: lines of a feed read with ``keep_unreadable``, and how many hold an unreadable value."""
    # Spark reads only the columns that a query names, so each must take part in the count.
    values = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != UNREADABLE])
    one = F.least(F.lit(1), F.pmod(values, F.lit(2)) + 1)
    marked = F.sum(F.when(F.col(UNREADABLE).isNotNull(), one).otherwise(0))
    return df.agg(F.count(F.lit(1)).alias("Records"), F.coalesce(marked, F.lit(0)).alias("Unreadable"))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """One city per line, trailing comma removed, each name once."""
    name = F.trim(F.regexp_replace("value", r",\s*$", ""))
    return spark.read.text(path).select(name.alias("City")).filter("City <> ''").distinct()
