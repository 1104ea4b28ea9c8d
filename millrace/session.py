"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that decide results. These and the next can be changed on a running session.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Partition values such as hour=09 or batch_id=12e4 stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keys that collide after renaming keep the last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Deeply nested payloads give deeply nested expressions, which take a few rounds a level to resolve.
    "spark.sql.analyzer.maxIterations": "2000",
}

# Settings that decide speed. AQE coalesces small shuffle partitions, splits skewed ones and
# turns joins whose measured side is small into broadcast joins.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Payload fields are stored as typed Parquet columns, chosen from the data, so that a query over RAW
    # reads the fields it names and not whole payloads.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}

# Settings a session takes only when it is built. This one keeps PySpark from recording the calling line of
# every column expression, which costs more than building the expression.
BUILD_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "millrace", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with this package's settings.

    ``spark.sql.shuffle.partitions`` is left to the cluster (pass it in ``conf``): with AQE it is only
    the upper bound that partitions are coalesced from, so size it for the largest shuffle, about
    one partition per 128-256 MB of shuffled data.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_CONF, **SPEED_CONF, **BUILD_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adopt(spark: SparkSession) -> SparkSession:
    """Put this package's settings on a session somebody else built."""
    for key, value in {**RESULT_CONF, **SPEED_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def whole_payloads(spark: SparkSession) -> Iterator[None]:
    """Writes in here keep payloads whole: work folders are read back whole, where typed columns only cost."""
    key = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here drop their shuffle files when they end, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread(df: DataFrame) -> DataFrame:
    """Deal a small input out over all cores before costly per-row work.

    An input with at least as many splits as cores, as any large one has, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, under the shared ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
