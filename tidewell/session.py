"""Session settings, size-based recommendations and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library wants; all can be set at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Settings fixed at launch. Call-site capture costs more than building the expressions it describes;
# checkpoints nobody refers to any more are removed.
AT_LAUNCH = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Fixed values: (upper bound in GB, shuffle partitions, broadcast threshold, scan split size).
SIZE_CLASSES = [
    (10, 200, "100m", "128m"),
    (100, 400, "50m", "128m"),
    (500, 1000, "10m", "128m"),
    (float("inf"), 2000, "-1", "64m"),
]


def build(app: str = "tidewell", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library defaults; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | AT_LAUNCH | {name.replace("__", "."): value for name, value in extra.items()}
    return builder.config(map=settings).getOrCreate()


def recommend(size_gb: float) -> dict[str, str]:
    """Runtime settings for an input of ``size_gb``.

    The size class gives a floor; above it the shuffle gets one partition per 128 MB, so the
    number keeps growing with the data instead of stopping at the largest class.
    """
    _, floor, broadcast, split = next(c for c in SIZE_CLASSES if size_gb < c[0])
    partitions = max(floor, int(size_gb * 1024 / 128))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.files.maxPartitionBytes": split,
    }


def configure(spark: SparkSession, size_gb: float) -> dict[str, str]:
    """Apply :data:`DEFAULTS` and :func:`recommend` to a running session."""
    settings = DEFAULTS | recommend(size_gb)
    for name, value in settings.items():
        spark.conf.set(name, value)
    return settings


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` decides. A folder of our own is made only on a local master; on a
    cluster a missing setting is an error, because a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tidewell-checkpoints-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the checkpoint folder; survives the loss of executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """As :func:`durable`, but as a Parquet table: ``df`` is computed once (a checkpoint computes it twice), and later reads
    take the columns they need. The order of rows and their partitions are not kept."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder, for stream sinks and intermediate tables."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
