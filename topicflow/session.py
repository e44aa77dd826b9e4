"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results (not tuning knobs).
REQUIRED_CONF = {
    # Zone-less ISO text in order payloads is UTC (the writers use utcnow()).
    "spark.sql.session.timeZone": "UTC",
    # A JSON object may name a field twice; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Defaults for a fresh session; a cluster's own settings win when already present.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a changelog per micro-batch instead of a full state snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Sizing for a large cluster (about 100 TB of input on ~1000 executors). Scan splits of
# 256 MB give ~400k scan tasks; shuffles start wide (20k partitions) and adaptive execution
# merges them to ~256 MB each, so a stage's tasks fit executor memory whatever the data size.
# A shuffle partition above 512 MB and 5× the median counts as skewed and is split.
# Broadcasts stay small: AQE broadcasts only sides measured under 64 MB at run time.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, app: str = "topicflow",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    """Build (or join) a session with topicflow's required settings applied.

    ``profile="cluster"`` adds :data:`CLUSTER_CONF`; explicit ``extra`` settings win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    for k, v in conf.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


# State-store partitions of a stream over a whole log. Every task of a stateful operator reports metrics for each of its
# partitions, so what a micro-batch sends to the driver grows with the square of their number.
STATE_PARTITIONS = 48


def state_session(spark: SparkSession, partitions: int = STATE_PARTITIONS) -> SparkSession:
    """A session of the same application and settings whose stateful streams have at most so many partitions; the
    caller's own setting stays."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.shuffle.partitions", str(min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return configure(own)


_LOCAL_BASE: dict[str, str] = {}


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (used to memoise per-application outputs)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", "connect")


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    return sc is not None and sc.master.split("[")[0] == "local"


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, registered for ``checkpoint()``.

    Only a session whose master is ``local`` may leave the setting out (tests): it then gets a
    private folder. On a cluster a machine-local folder would lose data, so this raises.
    """
    sc = _context(spark)
    base = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        base = _LOCAL_BASE.get("dir")
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL_BASE["dir"] = tempfile.mkdtemp(prefix="topicflow-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory (made by its first writer)."""
    return f"{checkpoint_base(spark)}/{name or 'scratch'}-{uuid.uuid4().hex[:12]}"
