"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time (exports carry naive local
# timestamps), ANSI casts (bad source values must be caught with try_* casts),
# AQE for runtime re-planning (coalescing, skew-join splitting, broadcast
# conversion when a shuffle side turns out small).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The flat projection's reject rule is one wide CASE; inferring constraints
    # from it takes the optimizer tens of seconds and finds nothing to push.
    "spark.sql.constraintPropagation.enabled": "false",
    # The JVM never compiles methods above 8,000 bytes of code: stages that would
    # generate one run as separate, compiled projections (flatten: half the time).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Groups of rows that are sorted by their key already are read off in passing.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Static: skip capturing the Python call site of every Column (plan
    # building is ~10x faster; only error messages lose the origin line).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "worklake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the project defaults.

    On a cluster leave ``master`` unset (spark-submit decides) and let AQE size
    shuffle partitions; local tests pass a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS / object
    store) and is used as is; without it this raises. Only a local master, whose
    executors are the driver's own threads, gets a fresh scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if not configured:
        configured = _dirs.get(session_key(spark))
    if not configured:
        if sc is not None and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="worklake-ckpt-",
                                      dir=os.environ.get("WORKLAKE_SCRATCH", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - core conf not settable at run time
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    _dirs[session_key(spark)] = configured
    return configured


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings that the package's plans need in a session built elsewhere."""
    ensure_checkpoint_dir(spark)
    for key in ("spark.sql.constraintPropagation.enabled", "spark.sql.codegen.hugeMethodLimit",
                "spark.sql.execution.replaceHashWithSortAgg"):
        spark.conf.set(key, SESSION_DEFAULTS[key])
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of steps that are over.

    They go when the driver collects its garbage, which a job of few steps
    may reach only when it ends. Nothing that is in use goes.
    """
    import gc

    gc.collect()
    sc = _context(spark)
    if sc is not None:
        sc._jvm.System.gc()


_dirs: dict[str, str] = {}


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-application memos)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def stage(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan once and
    stores columnar, compressed files in the shared folder, so a lost
    executor re-reads them instead of recomputing the upstream plan.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def unstage(df) -> None:
    """Delete the folder of a frame from ``stage`` once nothing reads it any more."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if root.split(":", 1)[-1].lstrip("/") in folder:  # never anything but scratch
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
