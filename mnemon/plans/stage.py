"""Tables that several later ones read: written once to the folder that executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below ``spark.checkpoint.dir`` (in a local session without it, a temporary folder)."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="mnemon-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/mnemon-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
