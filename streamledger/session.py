"""Session construction, table loading and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# State of streaming aggregations (A2) off the JVM heap, checkpointed
# incrementally: a large vocabulary does not have to fit in executor memory.
ROCKSDB_STATE = ("org.apache.spark.sql.execution.streaming.state."
                 "RocksDBStateStoreProvider")


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "streamledger") -> SparkSession:
    """Session for tests and the bench.

    On a cluster, pass the cluster's own settings instead; nothing here is
    required by the operators except a ``spark.checkpoint.dir`` for streaming.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir).  Only when neither is set and the master is local -- tests -- create
    one under the temp folder and register it on the context, so later calls
    agree.  On a cluster an unset folder is an error, never a local path.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a "
                "shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="streamledger-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the checkpoint root, unique per call."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
