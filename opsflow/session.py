"""Session settings and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. They tune, they never change a result, apart
# from the zone: wall-clock text is read and written in UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # texts are long: fewer rows in a batch that goes to a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Set the shuffle partition count so that one holds ``partition_bytes``.

    Never lower than it was: AQE joins small partitions, it does not cut large
    ones outside skewed joins.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(now, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder that the cluster names.

    Written intermediate tables and streaming checkpoints live there, so they
    outlive any one executor. The session's setting is only read, never changed.
    Without it a cluster gets an error, as its machines share no other folder; on
    a single machine (``local`` masters) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _on_one_machine()
    return f"{base.rstrip('/')}/opsflow/{name}-{uuid.uuid4().hex[:12]}"


@cache
def _on_one_machine() -> str:
    return tempfile.mkdtemp(prefix="opsflow-")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts the lineage of results that several plans use, so they are computed
    once, are the same everywhere, and survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
