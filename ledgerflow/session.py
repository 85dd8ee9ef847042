"""Session construction and cluster-safe settings.

Every operator in this package is a lazy ``DataFrame -> DataFrame``
function; the only place that decides *how* Spark runs is here.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets.  UTC pins the meaning of timestamps so that
# bucket boundaries agree with the SQL oracle; AQE re-plans joins and
# coalesces shuffle partitions at runtime, and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MB splits keep one scan task's memory flat regardless of file size.
    # The reader option of the same name is ignored by Spark; only the
    # session setting works.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerflow", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    On a cluster leave ``master`` unset and let ``spark-submit`` decide; the
    shuffle partition count then stays whatever the cluster configured, with
    AQE coalescing it at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if spark.conf.isModifiable(k):  # the others hold from the start of the session
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem path and
    is used as is.  Only a local test session without it gets a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan is reused by several jobs or grows iteratively, so a
    lost executor recomputes from the checkpoint, not from the raw scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, tag: str):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and return a scan of it.

    Unlike a checkpoint, later reads skip the columns and row groups they do not need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerflow`` importable in Python workers (once per context).

    Pandas UDFs and grouped maps refer to functions of this package by module
    name, so executors need the code; it is zipped and added with
    ``addPyFile``, the same as ``--py-files`` on ``spark-submit``."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerflow-pyfiles-"), "ledgerflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def prepare(spark: SparkSession) -> None:
    """Apply the package's runtime settings to a session built elsewhere
    (the session time zone above all: bucket boundaries depend on it), and
    ship the package to the Python workers."""
    ship_package(spark)
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k) and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise RuntimeError("the session time zone must be UTC")


def cpu_partitions(spark: SparkSession, groups: int | None = None) -> int:
    """Partition count for CPU-heavy Python stages.

    AQE coalesces shuffle partitions by bytes, which puts small but
    compute-heavy groups (model fits, tree scoring) into one task; an explicit
    ``repartition(n, keys)`` is left alone by AQE.  ``n`` is the cluster's
    parallelism, capped by the number of groups when that is known."""
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(n, groups)) if groups else n
