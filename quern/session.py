"""Session construction and shared-storage locations.

Everything that must survive the loss of an executor (streaming checkpoints,
materialised intermediate tables, lineage cuts) lives below the cluster's
``spark.checkpoint.dir``.  That setting is read from the session; a local
directory is only chosen when it is unset (unit tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Defaults that matter at scale; a cluster may override any of them.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Big parquet files are split into 128 MB tasks; shuffle partitions are
    # sized by AQE from the advisory size rather than a fixed count.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_session(master: str | None = None, app: str = "quern",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the session's ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a fresh temporary folder
    created and registered, so ``DataFrame.checkpoint()`` works everywhere.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="quern-ck-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "quern", kind, uuid.uuid4().hex)


def use_utc(spark: SparkSession) -> None:
    """The data model is zone-less time (TIMESTAMP_NTZ); conversions to and
    from instants (epoch seconds, watermarks) are done in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_stateful_conf(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store provider.

    The provider can only be chosen before the first stateful query of a
    session, so this sets it only where it is still the default.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    cur = spark.conf.get(key, None)
    if cur != ROCKSDB_PROVIDER:
        try:
            spark.conf.set(key, ROCKSDB_PROVIDER)
        except Exception:  # pragma: no cover - conf locked by the cluster
            pass
    # A commit writes the changes of its micro-batch, not the whole store; a session that says otherwise keeps that.
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    if spark.conf.get(changelog, None) is None:
        spark.conf.set(changelog, "true")
    # A join of two streams keeps its four tables as column families of one store a partition, instead of in four.
    join = "spark.sql.streaming.join.stateFormatVersion"
    if spark.conf.get(key, None) == ROCKSDB_PROVIDER and spark.conf.get(join, None) is None:
        spark.conf.set(join, "3")
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quern`` importable in the Python workers (pandas UDFs, data
    sources and stateful processors refer to it by module).  The package is
    zipped once and handed to ``addPyFile``, Spark's own code distribution."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="quern-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(zpath)
    # Code that runs in Python workers outside the executors' Python path
    # (the data source planner) is pickled by value instead of by module.
    import importlib
    from pyspark import cloudpickle
    for mod in WORKER_MODULES:
        try:
            cloudpickle.register_pickle_by_value(importlib.import_module(mod))
        except ValueError:
            pass  # already registered
    _SHIPPED.add(app)


WORKER_MODULES = ("quern.sources.replay", "quern.streaming.processors", "quern.streaming.joins", "quern.streaming.windows",
                  "quern.operators.match",
                  "quern.streaming.async_io", "quern.functions.udf", "quern.sinks.parts", "quern.streaming.accumulators", "quern.streaming.groups",
                  "quern.streaming.retract")
