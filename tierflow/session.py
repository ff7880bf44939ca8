"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. UTC makes dates and hours independent of the machine zone.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state on the executors' disks instead of their heaps, where it holds the ids of all events; a
    # micro-batch adds what it changed to the checkpoint, not the whole state.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# What rebalanced writes and coalesced shuffles aim at, where the caller asks for nothing else.
DEFAULTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m"}

UNKNOWN_BYTES = 1 << 60


def build(app: str = "tierflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else started."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Dates and hours are taken in the session's zone; any other than UTC would shift them silently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"session time zone is {zone}; use session.build or session.pin")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    Only a session of one process without that setting falls back to the machine's temporary folder; on
    a cluster, also one of local processes, it would not survive an executor, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tierflow-")
    return f"{base.rstrip('/')}/tierflow/{label}-{uuid.uuid4().hex}"


@contextmanager
def sized_shuffles(
    spark: SparkSession, *inputs: DataFrame, target_bytes: int = 128 << 20, growth: float = 3.0
) -> Iterator[int]:
    """Raise ``spark.sql.shuffle.partitions`` so that a full shuffle of ``inputs`` stays near
    ``target_bytes`` per partition, when rows take ``growth`` times the bytes of their files. Only ever
    raises it: adaptive execution merges what turns out small."""
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs]
    # a size in exabytes is how a plan without statistics says that it does not know
    estimate = sum(size for size in sizes if size < UNKNOWN_BYTES)
    wanted = max(before, math.ceil(estimate * growth / target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query when it ends, not when the driver happens to collect its garbage: for
    jobs of many rounds, of which each is written."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)
