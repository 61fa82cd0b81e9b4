"""Session settings and the shared folder that streams and tables live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHARED_DIR = "spark.checkpoint.dir"
_PARTITIONS = "spark.sql.shuffle.partitions"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tillwatch", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the pipelines are written for; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **_STATE,
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session beside `spark` with the same settings, to change without the caller's noticing."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key) and session.conf.get(key, None) != value:
            session.conf.set(key, value)
    return session


def prepare(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """A session of its own with what results depend on, and the skew handling plans count on.

    Days and hours are cut in `zone`; a log that repeats a JSON key keeps the last value; a skewed join is split even
    where the rows are grouped by the same key afterwards.
    """
    session = own_session(spark)
    session.conf.set("spark.sql.session.timeZone", zone)
    session.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    session.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return session


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside `spark` for streams with state.

    A checkpoint keeps one state store per shuffle partition for good. `partitions` is their number; without it, it is
    what the session has set. State is kept in RocksDB, on disk with a bounded cache, unless another store is set.
    """
    session = prepare(spark)
    if partitions is not None:
        session.conf.set(_PARTITIONS, str(partitions))
    if not spark.sparkContext.getConf().get("spark.sql.streaming.stateStore.providerClass"):
        for key, value in _STATE.items():
            session.conf.set(key, value)
    return session


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(_SHARED_DIR, None) or spark.sparkContext.getConf().get(_SHARED_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SHARED_DIR} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tillwatch-")
        spark.conf.set(_SHARED_DIR, root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared folder the cluster names in spark.checkpoint.dir.

    Executors must all see it, so a temporary folder is only taken when everything runs in one local process.
    """
    return f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Rows computed once and stored in the shared folder, for steps that read them more than once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_root(df.sparkSession))
    return df.checkpoint()
