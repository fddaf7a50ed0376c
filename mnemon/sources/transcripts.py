"""Session transcripts: line-delimited JSON files, and message tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _text(path: str, j: str = "j") -> Column:
    return F.expr(f"try_variant_get({j}, '$.{path}', 'string')")


def _truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line_no, j): the parseable lines of each ``*.jsonl`` that isn't deleted, reset or locked.

    A file is read whole, so that lines keep their order; blank lines, lines
    that aren't JSON and the values null, 0, false and "" are dropped.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.jsonl").select(F.col("_metadata.file_name").alias("file_name"), "value")
    files = files.where(~F.col("file_name").contains(".deleted.") & ~F.col("file_name").contains(".reset.") & ~F.col("file_name").endswith(".lock"))
    lines = files.select("file_name", F.posexplode(F.split("value", "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    parsed = lines.select("file_name", "line_no", F.expr("try_parse_json(line)").alias("j"))
    return parsed.where(F.col("j").isNotNull() & ~F.to_json("j").isin("null", "0", "false", '""'))


def flatten_content(j: str = "j") -> Column:
    """Of a content array, each item's text, else its content; empty ones dropped, joined by lines."""
    items = F.expr(f"try_cast(try_variant_get({j}, '$.message.content', 'array<variant>') AS array<variant>)")

    def one(x: Column) -> Column:
        # only strings count: a number in the place of a text is none
        pick = lambda path: F.when(F.expr("true") & F.schema_of_variant(F.try_variant_get(x, path, "variant")).eqNullSafe("STRING"), F.try_variant_get(x, path, "string"))
        return F.coalesce(pick("$.text"), pick("$.content"), F.lit(""))

    parts = F.filter(F.transform(F.coalesce(items, F.array().cast("array<variant>")), one), lambda t: t != "")
    return F.regexp_replace(F.array_join(parts, "\n"), r"(?U)^\s+|\s+$", "")


def parse_sessions(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headers, messages) of raw lines.

    The header is a file's first line of type ``session``, else its first line.
    Messages are numbered from 1; what lacks an id is named file:number.
    """
    head = lines.groupBy("file_name").agg(F.min_by("j", F.struct(_text("type").eqNullSafe("session").cast("int") * -1, F.col("line_no"))).alias("j"))
    bare = F.regexp_replace("file_name", r"\.jsonl$", "")
    headers = head.select(
        F.coalesce(_truthy(_text("id")), bare).alias("session_id"), "file_name", _truthy(_text("cwd")).alias("cwd"),
        F.try_to_timestamp(_text("timestamp")).alias("started_at"),
    )
    rows = lines.where(_text("type").eqNullSafe("message") & F.expr("try_variant_get(j, '$.message', 'variant') IS NOT NULL"))
    order = Window.partitionBy("file_name").orderBy("line_no")
    rows = rows.withColumn("seq_no", F.row_number().over(order)).join(headers.select("file_name", "session_id"), "file_name")
    messages = rows.select(
        "session_id", "seq_no",
        F.coalesce(_truthy(_text("id")), F.concat_ws(":", "file_name", "seq_no")).alias("message_id"),
        F.coalesce(_truthy(_text("message.role")), F.lit("unknown")).alias("role"),
        F.coalesce(_truthy(_text("timestamp")), _truthy(_text("message.timestamp"))).alias("ts"),
        _truthy(_text("message.author")).alias("author"),
        flatten_content().alias("text"),
    )
    return headers, messages


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headers, messages) of a (conv_id, turn, role, text) table; turns count from 0."""
    session = F.col("conv_id").cast("string")
    messages = conversations.select(
        session.alias("session_id"), (F.col("turn") + 1).cast("int").alias("seq_no"), F.concat_ws(":", session, (F.col("turn") + 1).cast("string")).alias("message_id"),
        F.coalesce(_truthy(F.col("role")), F.lit("unknown")).alias("role"), F.lit(None).cast("string").alias("ts"), F.lit(None).cast("string").alias("author"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    headers = messages.select("session_id").distinct().select("session_id", F.concat("session_id", F.lit(".jsonl")).alias("file_name"), F.lit(None).cast("string").alias("cwd"), F.lit(None).cast("timestamp").alias("started_at"))
    return headers, messages


def in_window(sessions: DataFrame, start: Column, end: Column, last: str = "last_message_at") -> DataFrame:
    """Sessions whose last message falls into the window, its ends included."""
    return sessions.where(F.col(last).isNotNull() & (F.col(last) >= start) & (F.col(last) <= end))


def first_files(sessions: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` sessions by file name."""
    if limit is None:
        return sessions
    return sessions.orderBy("file_name").limit(limit)


def files_scanned(headers: DataFrame, picked: DataFrame, limit: int | None) -> int:
    """How many files had to be opened to find ``picked``: up to the limit's last match by name, else all."""
    last = picked.agg(F.count(F.lit(1)).alias("n"), F.max("file_name").alias("name")).first()
    files = headers.select("file_name").distinct()
    if limit is not None and last["n"] >= limit:
        files = files.where(F.col("file_name") <= last["name"])
    return files.count()


def latest_of_each(sessions: DataFrame) -> DataFrame:
    """Of sessions with one id, that with the last message."""
    order = Window.partitionBy("session_id").orderBy(F.desc_nulls_last("last_message_at"), "file_name")
    return sessions.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
