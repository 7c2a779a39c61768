"""Session helpers.

The library never creates its own session inside an operator: every operator
takes the caller's ``SparkSession`` (or a DataFrame bound to one).  These
helpers are for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on.  AQE re-plans joins and shuffles at runtime
# (coalesces small partitions, splits skewed ones, turns a join into a
# broadcast only after it has measured the side), so no fixed partition count
# is baked into the code.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a wide
    # cleaning projection fused with a join exceeds that and would then run
    # in the bytecode interpreter.  Above this size Spark splits the stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a job reading about ``input_bytes``.

    Scans are split into ``partition_bytes`` pieces; shuffles start with
    enough partitions that each holds about ``partition_bytes`` of the
    input (AQE then merges small ones toward the advisory size and splits
    skewed ones).  At 100 TB and 256 MB this starts shuffles at ~400k
    partitions instead of the fixed default of 200 (500 GB each).
    """
    parts = max(1, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
    }


def input_size(spark: SparkSession, path: str) -> int:
    """Bytes of the files at a path or glob; 0 where there are none."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(hpath) or [])


def size_session(spark: SparkSession, path: str, partition_bytes: int = 256 << 20) -> dict:
    """Size a running session's scans and shuffles for a job that reads ``path``.

    Never below what the session has already, so a small input leaves it as it is.
    """
    parts = -(-input_size(spark, path) // partition_bytes)
    if parts <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return {}
    settings = scale_settings(parts * partition_bytes, partition_bytes)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings


def keep_stages_compiled(spark: SparkSession) -> None:
    """Lower a running session's ``hugeMethodLimit`` to the default of this library, so that no stage runs interpreted."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(SESSION_DEFAULTS[key]):
        spark.conf.set(key, SESSION_DEFAULTS[key])


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Lower a running session's Arrow batches to so many rows, so that neither side of the pipe to Python holds 10,000 whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def build_session(master: str = "local[*]", app_name: str = "pricelens",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``input_bytes`` (the size of the job's input) sizes scan and shuffle
    partitions with ``scale_settings``; without it the shuffle starts at
    ``shuffle_partitions`` (tests, local runs).
    """
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if input_bytes:
        for k, v in scale_settings(input_bytes).items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is named.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is used as is.  Only a local session without one (tests, the
    bench) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="pricelens-ckpt-")
    sc.setCheckpointDir(path)
    return path


@contextmanager
def no_shuffle_files_left(spark: SparkSession):
    """Inside, a write removes its shuffle files when it ends, instead of at some later garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    One pass computes and writes the rows (``Dataset.checkpoint`` would run
    the plan twice unless it were cached first); the re-read table has no
    lineage, so a lost executor re-reads files instead of re-running scans,
    joins and transforms, and later reads prune columns like any parquet scan.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    with no_shuffle_files_left(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release(df: DataFrame) -> bool:
    """Delete the checkpoint table behind a ``cut_lineage`` result.

    Only folders under ``<checkpoint dir>/tables/`` are ever deleted; any
    other DataFrame is left alone.  Call it once nothing reads ``df`` any more.
    """
    spark = df.sparkSession
    root = os.path.join(ensure_checkpoint_dir(spark), "tables")
    files = df.inputFiles()
    if not files:
        return False
    jvm = spark.sparkContext._jvm
    table = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    fs = table.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root_q = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(root)).toString().rstrip("/") + "/"
    table_q = fs.makeQualified(table).toString()
    if not table_q.startswith(root_q):
        return False
    return bool(fs.delete(table, True))


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
