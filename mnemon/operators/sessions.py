"""Messages to sessions: counts, checksum, meaningful texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon import lexicon as L
from mnemon.functions import hashing, text


def last(array: Column, n: int) -> Column:
    return F.when(F.size(array) > 0, F.slice(array, -F.least(F.size(array), F.lit(n)), n)).otherwise(array)


def role_counts(messages: DataFrame) -> DataFrame:
    """(session_id, role, n)."""
    return messages.groupBy("session_id", "role").agg(F.count(F.lit(1)).alias("n"))


def summarize(messages: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """One row per session; its messages meet once, in order, in one shuffle."""
    plain = text.normalize(F.col("text"))
    rows = messages.withColumn("plain", plain)
    rows = rows.withColumns({
        "useful": (F.col("role") == "user") & (F.col("plain") != "") & ~text.is_noise(F.col("plain")),
        "strong": ~text.is_low_signal(F.col("plain")),
        "source": (F.col("role") == "user") & ~text.is_low_signal(F.col("text")),
    })
    one = F.struct("seq_no", "message_id", "role", "ts", "text", "plain", "useful", "strong", "source")
    grouped = rows.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.sum(F.length("text")).alias("char_count"),
        *(F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("user", "assistant", "system", "tool")),
        F.max_by(F.try_to_timestamp("ts"), "seq_no").alias("last_message_at"),
        F.sort_array(F.collect_list(one)).alias("m"),
    )
    useful = F.filter("m", lambda x: x["useful"])
    strong = F.filter("m", lambda x: x["useful"] & x["strong"])
    texts = F.transform(F.when(F.size(strong) > 0, strong).otherwise(useful), lambda x: x["plain"])
    roles = F.transform("m", lambda x: x["role"])
    line = lambda x: F.concat_ws("|", x["seq_no"].cast("string"), x["role"], F.coalesce(x["ts"], F.lit("")), x["text"])
    out = grouped.withColumns({
        "combined_text": F.array_join(F.transform("m", lambda x: x["text"]), "\n"),
        "meaningful": last(texts, 3),
        "roles": F.array_distinct(roles),
        "role_counts": F.map_from_entries(F.transform(F.array_distinct(roles), lambda r: F.struct(r, F.size(F.filter(roles, lambda x: x == r)).cast("long")))),
        "transcript_checksum": hashing.transcript_checksum(F.array_join(F.transform("m", line), "\n")),
        "source_message_ids": F.slice(F.transform(F.filter("m", lambda x: x["source"]), lambda x: F.coalesce(F.nullif(x["message_id"], F.lit("")), x["seq_no"].cast("string"))), 1, 20),
    }).drop("m")
    out = out.withColumn("sample_user_text", F.when(F.size("meaningful") > 0, F.left(F.array_join("meaningful", " | "), F.lit(280))).otherwise(F.lit(L.NO_USER_TEXT)))
    if headers is None:
        return out.withColumns({"file_name": F.lit(""), "cwd": F.lit(None).cast("string"), "started_at": F.lit(None).cast("timestamp")})
    return out.join(headers, "session_id", "left")
