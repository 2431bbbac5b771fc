"""Session settings the library is written for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that matter to the plans in this library. Adaptive execution splits
# skewed join partitions and re-sizes shuffles; the rest pins value semantics.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # Wide rows with long rule chains give generated methods beyond 8000 bytes of
    # bytecode, which the JVM interprets unless told to compile them.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "wrenchlake") -> SparkSession:
    """A single-JVM session for tests and the local bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("WRENCHLAKE_DRIVER_MEMORY", "12g"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def split_hot_joins(spark: SparkSession) -> None:
    """Let adaptive execution split a skewed join though what follows it would do without a shuffle otherwise."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def split_rule_chains(spark: SparkSession) -> None:
    """Let Spark cut long rule chains into methods that the JVM compiles, unless the session has a limit of its own.

    A generated method beyond 8000 bytes of bytecode is interpreted where the
    JVM is not told otherwise (see ``SETTINGS``).
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == "65535":
        spark.conf.set(limit, "8000")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On a cluster the setting must be there. Only a local-mode session, where
    driver and executors share one disk, falls back to a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="wrenchlake-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_CLEARED_AT_EXIT: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The one folder that holds every intermediate of this application."""
    return f"{shared_dir(spark)}/wrenchlake-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path below the application's folder, which is removed at exit."""
    root = scratch_root(spark)
    if root not in _CLEARED_AT_EXIT:
        _CLEARED_AT_EXIT.add(root)
        atexit.register(_clear_quietly, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete the application's intermediates (or one of them); frames read from them end here."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path or scratch_root(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _clear_quietly(spark: SparkSession, root: str) -> None:
    try:
        clear_scratch(spark, root)
    except Exception:  # the session may be gone by now; its folder carries the application id
        pass


# Rows of a narrow table that share a file.
ROWS_PER_FILE = 1_000_000


def materialise(df: DataFrame, name: str = "table", rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Lineage ends there, so a lost executor costs a re-read, and later scans
    still prune columns and push filters. Where a bound on the ``rows`` of a
    narrow frame is known, they are gathered into few files by one more shuffle.
    """
    path = scratch_path(df.sparkSession, name)
    gathered = df if rows is None else df.repartition(max(1, -(-rows // ROWS_PER_FILE)))
    gathered.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a file of a bucket.
BUCKET_FILE_ROWS = 32_000


def materialise_bucketed(df: DataFrame, keys: list[str], buckets: int, name: str = "buckets") -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder, dealt into ``buckets`` by the hash of ``keys``; the frame and its path.

    A join or grouping by these keys needs no shuffle of the frame. Rows go to
    their buckets where they are: each task writes a file for each bucket. As
    compressed columns wide rows take a fraction of the disk that they would
    take in a shuffle, row by row. Files are cut, so that a plain read of a
    crowded bucket makes tasks of bounded rows.
    """
    spark, path, made = df.sparkSession, scratch_path(df.sparkSession, name), f"{name}_{uuid.uuid4().hex}"
    # Buckets are known to the catalog only; the frame keeps what it was told, so the name can go at once.
    df.write.format("parquet").options(path=path, compression="zstd", maxRecordsPerFile=BUCKET_FILE_ROWS).bucketBy(buckets, *keys).saveAsTable(made)
    try:
        return spark.table(made), path
    finally:
        spark.sql(f"DROP TABLE {made}")


_SHIPPED: set[str] = set()
# Rows of long texts that go to a Python worker at once; Spark's own default is 10,000.
TEXT_ROWS = 2_000


def ready_for_python(spark: SparkSession) -> None:
    """Make a session fit for operators that run Python on texts.

    Workers get this package, once per application, unless their path has it
    already; Arrow batches shrink to TEXT_ROWS where the session has the default.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(TEXT_ROWS))
    context, parent = spark.sparkContext, Path(__file__).resolve().parents[1]
    on_path = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.applicationId in _SHIPPED or parent in on_path:
        return
    _SHIPPED.add(context.applicationId)
    folder = tempfile.mkdtemp(prefix="wrenchlake-package-")  # the driver's own; Spark sends the file from there
    context.addPyFile(shutil.make_archive(f"{folder}/wrenchlake", "zip", parent, Path(__file__).resolve().parent.name))
