"""Sessions and shared folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str, cores: str = "*", conf: Mapping[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_session(spark: SparkSession, params: Mapping[str, str] | None = None) -> SparkSession:
    """A session of its own for one job: own views, functions and settings.

    SQL settings of the caller are carried over. Times are read in UTC, and state
    goes to RocksDB so that it may outgrow executor memory. ``params`` become
    ``job.<name>`` settings that functions of the job can read.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Each batch uploads its changes of state instead of whole snapshots.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000")
    # Close sessions of one map task before the shuffle, so a busy key sends few rows.
    session.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    for key, value in (params or {}).items():
        session.conf.set(f"job.{key}", str(value))
    return session


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may do without
    that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
