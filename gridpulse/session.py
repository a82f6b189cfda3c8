"""Session helpers: local session for tests/bench, shared scratch folder,
size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dimension tables larger than this are joined by shuffle (with AQE skew-join
# splitting) instead of being broadcast.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gridpulse") -> SparkSession:
    """Session for tests and the local bench; production sessions come from the cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster setting ``spark.checkpoint.dir`` always wins.  Only a local
    session without it (tests) gets a private folder; a cluster session
    without it is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="gridpulse-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # The checkpoint folder name carries a per-application uuid; step up to the
    # configured root so data written by one run is found by the next.
    root = spark.conf.get("spark.checkpoint.dir", None) or os.path.dirname(base)
    return "/".join([root.rstrip("/"), "gridpulse", *parts])


def unique_scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # pragma: no cover - Spark Connect or plan without stats
        return None


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is proven small.

    Beyond the limit the frame is returned unchanged, so the planner uses a
    shuffle join; AQE can still switch to broadcast at run time once the
    real size is known, and splits skewed partitions of the large side.
    """
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df
