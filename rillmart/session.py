"""Session set-up and the one shared folder every job may write to."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

DEFAULT_TIME_ZONE = "Asia/Shanghai"

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is cut into slices by AQE, even when that costs an extra
    # shuffle further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods above 8,000 bytes of bytecode are never compiled by the JVM's
    # JIT; wide map and window expressions run faster operator by operator then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What an action has shuffled is deleted when it ends, not when the driver next collects garbage: a
    # stream's disk would otherwise hold the shuffles of many micro-batches.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "rillmart", master: str | None = None,
                  time_zone: str = DEFAULT_TIME_ZONE, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate(), time_zone)


def tune(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def ship_with_tasks(module: str) -> None:
    """Send a module's classes and functions along with the tasks that use them, so that
    Python workers need not have this package installed or on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, visible to every executor and deleted
    when the application ends.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, since a machine-local folder would be
    lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rillmart-")
        spark.conf.set("spark.checkpoint.dir", root)
        context.setCheckpointDir(root)
    where = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    return where
