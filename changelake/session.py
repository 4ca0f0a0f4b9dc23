"""Session and scratch-location helpers.

All intermediate output (lake files, streaming checkpoints, ledgers, carried
state) goes under the shared folder named by ``spark.checkpoint.dir``, so a
job keeps working when executors are lost and never writes to a
machine-local temporary folder on a cluster.  Only when the setting is
absent (a bare local or test session) do we choose a folder ourselves.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


# Runtime SQL settings the operators are designed for.  Broadcast only on
# measured sizes: no plan-time broadcast from file-size estimates; AQE
# converts a join to broadcast when the built side's materialised shuffle is
# below the adaptive threshold, and operators use checked_broadcast() for
# dimension-sized sides.
RECOMMENDED_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # streaming state (dedup horizon) off the JVM heap, committed as changelogs
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str = "local[*]", app: str = "changelake", **conf) -> SparkSession:
    """Build (or reuse) a local/test session with the settings the operators assume.

    On a cluster use :func:`apply_recommended` on the session spark-submit built.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED_SQL_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def apply_recommended(spark: SparkSession) -> SparkSession:
    """Set each recommended SQL setting the submitter did not set explicitly."""
    explicit = spark.sparkContext.getConf()
    for key, value in RECOMMENDED_SQL_CONF.items():
        if not explicit.contains(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, created on demand when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(
                "spark.checkpoint.dir is not set: set it to a folder shared by the cluster "
                "(e.g. an HDFS or object-store path); streaming checkpoints and ledgers live there"
            )
        # Bare local/test session: a folder of this process is shared by all its tasks.
        root = tempfile.mkdtemp(prefix="changelake-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/changelake/{name}-{uuid.uuid4().hex[:12]}"



def estimated_bytes(df) -> int | None:
    """Optimizer's size estimate of a DataFrame's output (None if unavailable)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()  # noqa: SLF001
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - plan stats are best effort
        return None


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (the shuffle-partition setting where the
    session exposes no SparkContext, e.g. a remote session)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext on this session type
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
