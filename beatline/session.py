"""Session helpers.

The library itself never creates a session: every operator takes a
DataFrame. These helpers are for tests, the benchmark and the driver entry
point, plus the one piece of session state the library reads, the shared
checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "beatline") -> SparkSession:
    """A local session for tests and benchmarks.

    The checkpoint folder is a temporary one unless ``spark.checkpoint.dir`` is
    configured; on a cluster the operator supplies it (a shared file system path).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
        # whole-stage-codegen method beyond that runs interpreted. At 8000
        # Spark falls back to per-operator code for such stages (the value
        # the Spark configuration docs suggest for HotSpot).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised stages.

    Read from ``spark.checkpoint.dir``; only when it is unset and Spark runs in
    this one process (``local``, ``local[n]``: tests) a fresh temporary folder is
    created and registered. Elsewhere (``local-cluster`` too) an unset folder is
    an error. That the folder is one which all executors share is up to the
    cluster's configuration: a ``file:`` path can be a shared mount.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            # A machine-local folder is not visible to other executors.
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder on the shared file system")
        path = tempfile.mkdtemp(prefix="beatline-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


# Paths written by ``materialize`` in this driver process, per application.
_WRITTEN: dict[str, list[str]] = {}


def materialize(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back;
    ``options`` go to the Parquet writer.

    Cuts lineage (a lost executor re-reads files rather than recomputing the
    plan) and lets later passes prune columns and push filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def release_path(spark: SparkSession, path: str) -> bool:
    """Delete one written stage that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def release_materialized(spark: SparkSession) -> int:
    """Delete the stages this application wrote with ``materialize``.

    Call once the DataFrames that read them are no longer needed (end of a
    job); they live on the shared file system, which Spark does not clean.
    Returns the number of paths removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed


def checkpoint_small(df: DataFrame, name: str = "small") -> DataFrame:
    """``materialize`` for an intermediate that several passes read: an
    aggregate, smaller than its input, whose size no caller relies on.

    Written as Parquet to the shared checkpoint folder and read back: the
    lineage is cut, its readers do not rerun the pass over the big input,
    and a lost executor re-reads files instead of replaying the plan.
    (``DataFrame.checkpoint(eager=True)`` would run the plan twice: once
    for the eager count and once more to write the checkpoint.)
    """
    return materialize(df, name)
