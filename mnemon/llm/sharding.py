"""Jump consistent hashing of rows to shards, in DataFrame functions only.

A key's walk starts at shard 0 and, from shard ``b``, jumps to
``floor((b + 1) / u)`` where ``u`` in (0, 1] is drawn from ``xxhash64(key, b)``;
the last stop below the shard count is the key's shard.  The walk does not
depend on the shard count, so one shard more takes 1/(n+1) of the rows, all
into itself.  The draws come from xxhash64 and not from a 64-bit congruential
generator, whose wrap-around product ANSI mode rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def jump_walk(key: Column, n: int) -> Column:
    """struct(b, j): the last stop below ``n`` and the first stop from ``n`` on."""

    def step(at: Column, _: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, at["j"]), 33) + F.lit(1)) / F.lit(float(1 << 31))
        # j grows by one or more a step, so n steps are enough; beyond 2^31 it is cut, which is past any n
        to = F.least(F.floor((at["j"] + 1) / u), F.lit(1 << 40)).cast("long")
        return F.when(at["j"] >= n, at).otherwise(F.struct(at["j"].alias("b"), to.alias("j")))

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, step)


def assign_shards(df: DataFrame, n: int = 16, key: str = "doc_id", text: str = "text", buckets: int = 1024) -> DataFrame:
    """One row per input row with its shard and a gapless slot in that shard.

    Returns key, size, text_crc32, law ('key'), shard, slot and grown_shard
    (the shard if there were n+1).  ``size`` is the text's UTF-8 bytes plus 1,
    1 for a null text, whose ``text_crc32`` is null.

    Slots are dealt without one task per shard: a shard falls into ``buckets``
    by another hash of the row, rows are numbered in their bucket, and the
    buckets' starts (at most n * buckets rows, whatever the input) are
    broadcast.  Equal rows are counted before the shuffle and unfolded after
    it, so a row repeated any number of times costs one.  A null key counts as
    a key of its own.  An empty table gives no rows; other columns are ignored.
    """
    if n < 1 or buckets < 1:
        raise ValueError("n and buckets must be at least 1")
    walk = df.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text)).alias("text_crc32"),
        jump_walk(F.col(key), n).alias("walk"),
    )
    rows = walk.select(
        key,
        "size",
        "text_crc32",
        F.col("walk.b").cast("int").alias("shard"),
        F.when(F.col("walk.j") == n, F.lit(n)).otherwise(F.col("walk.b")).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(buckets)).cast("int").alias("bucket"),
    )
    equal = rows.groupBy("shard", "grown_shard", "bucket", key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("in_bucket"))
        .select("shard", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(key, "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = equal.withColumn("upto", F.sum("copies").over(inside)).join(F.broadcast(starts), ["shard", "bucket"])
    last = F.col("start") + F.col("upto")
    return placed.select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(last - F.col("copies"), last - 1)).alias("slot"),
        "grown_shard",
    )
