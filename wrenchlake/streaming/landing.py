"""Pick up the files that arrived in a landing folder since the last run."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchlake.schemas import FEEDS, RUN_DATE, Feed

# Partition column below the run day that names the batch a row came with.
BATCH = "Batch"


class ChangedFileError(ValueError):
    """A file that was loaded before has been uploaded again."""


def changed_files(spark: SparkSession, landing: str, checkpoint: str) -> DataFrame:
    """Paths of files that the stream has taken in and that have another time now.

    What was taken in is read from the stream's own checkpoint, one line for
    each file and batch.
    """
    log = f"{checkpoint}/sources/0"
    present = spark.read.format("binaryFile").load(landing).select(
        F.col("_metadata.file_path").alias("path"), F.unix_millis("_metadata.file_modification_time").alias("now")
    )
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return present.select("path").limit(0)
    entry = F.from_json("value", "path string, timestamp bigint")
    taken = spark.read.text(log).filter(F.col("value").startswith("{")).select(entry.alias("e")).select("e.path", "e.timestamp").distinct()

    def plain(path):
        return F.regexp_replace(path, "^([a-zA-Z0-9]+:)/+", "$1/")

    met = present.withColumn("_at", plain(F.col("path"))).join(taken.select(plain(F.col("path")).alias("_at"), "timestamp"), "_at")
    return met.filter(F.col("now") != F.col("timestamp")).select("path").distinct()


def load_new_files(
    spark: SparkSession,
    landing: str,
    feed: str | Feed,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    run_date: str = RUN_DATE,
) -> None:
    """Read every new file of a feed once, transform it and add it to a table partitioned by run day and batch.

    The daily job in streaming form: the checkpoint in shared storage remembers
    the files already taken, so a repeated or restarted run adds nothing twice.
    A batch overwrites its own partitions and no others, so one that is killed
    half-way and runs again replaces what it had written. Batch days go into the
    same table with ``write_day(..., within=(BATCH,))``. A file uploaded again
    under its old name raises ``ChangedFileError``; its day is then loaded anew
    from files. The call returns when all files present at its start are loaded.
    """
    declared = FEEDS[feed] if isinstance(feed, str) else feed
    changed = [r.path for r in changed_files(spark, landing, checkpoint).limit(20).collect()]
    if changed:
        raise ChangedFileError(
            f"loaded before and uploaded again: {', '.join(sorted(changed))}; load their day anew from the files (write_day replaces it)"
        )
    files = (
        spark.readStream.schema(declared.ddl)
        .options(header=True, enforceSchema=True, multiLine=declared.multi_line, escape='"', mode="FAILFAST", **declared.options)
        .csv(landing)
    )
    stream = f"landed-{zlib.crc32(checkpoint.encode()):08x}"

    def add(batch: DataFrame, number: int) -> None:
        own = batch.withColumn(BATCH, F.lit(f"{stream}-{number:08d}"))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_date, BATCH).parquet(table)

    query = transform(files).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
