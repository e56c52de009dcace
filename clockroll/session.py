"""Session helpers: UTC, sane shuffle settings, shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "clockroll",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's own builder and
    call :func:`ensure_utc`; nothing here is required for correctness except UTC."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All calendar math of the engine is defined in UTC (window starts, date keys)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        # Only reached when the deployment names no shared folder (tests, local runs).
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="clockroll-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint dir (never machine-local on a
    cluster).  Used for staged writes, stream checkpoints and stream outputs."""
    root = _checkpoint_root(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/clockroll/{purpose}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several branches read: a reliable checkpoint in the
    shared ``spark.checkpoint.dir`` (survives lost executors; computed once)."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(_checkpoint_root(spark))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make ``clockroll`` importable by the Python workers of the stateful stream operator
    whatever the driver's working directory.  Python functions carry
    ``sc.environment`` (the ``spark.executorEnv.*`` settings) as worker environment: in
    local mode the package's parent folder is added to its PYTHONPATH; on a cluster the
    package is shipped with ``addPyFile`` (like ``--py-files``)."""
    sc = spark.sparkContext
    if getattr(sc, "_clockroll_shipped", False):
        return
    parent = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.master.startswith("local"):
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if parent not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([parent] + paths)
    else:
        import zipfile

        zpath = os.path.join(tempfile.mkdtemp(prefix="clockroll-pyfiles-"), "clockroll.zip")
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _, files in os.walk(os.path.join(parent, "clockroll")):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, parent))
        sc.addPyFile(zpath)
    sc._clockroll_shipped = True
