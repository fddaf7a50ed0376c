"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Where that setting is missing, a local session (tests) gets a temporary
    folder; on a cluster that is an error, since executors share no local disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="mnemon-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/mnemon-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled(share: float, salt: str, *columns: str) -> Column:
    """Whether a row is in the sample of that share, by a hash of ``columns``.

    The share is held against 63 bits, so no table is so large that rounding
    empties the sample or makes it grow with the table.
    """
    bound = min(max(1, int(share * (1 << 63))), (1 << 63) - 1)
    spot = F.xxhash64(F.lit(salt), *columns).bitwiseAND(F.lit((1 << 63) - 1))
    return F.lit(True) if share >= 1 else spot < F.lit(bound)
