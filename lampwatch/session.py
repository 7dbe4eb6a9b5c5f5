"""Session helpers: a local session for tests/bench, and the shared
checkpoint folder read from the session."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lampwatch") -> SparkSession:
    """Session for tests and bench.  On a cluster use the session the
    platform gives you; none of the library code calls this."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # fixtures take TIMESTAMP_NTZ as local wall time; any zone without
        # daylight saving gives the same answers, UTC keeps oracles simple
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LAMPWATCH_DRIVER_MEM", "16g"))
        .config("spark.python.unix.domain.socket.enabled", "true")
        # the episode processor has no timers: batches without data do nothing
        .config("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lampwatch`` importable in Python workers (stateful processors
    and pandas functions are pickled by module reference).  Zips the
    package once per application and hands it to ``addPyFile``, which
    distributes it with the job -- the same as ``--py-files`` at submit."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    # the stateful-processor pre-init runner gets no py-files: pickle the
    # package's classes and functions by value instead of by module name
    import lampwatch
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(lampwatch)
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="lampwatch-pkg-"), "lampwatch.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Where it is unset, a session whose driver and
    executors are one process (``local[...]``) gets a private folder; any
    other fails, because a machine-local folder is not shared."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lampwatch-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/lampwatch/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back:
    lineage is cut, and a lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
