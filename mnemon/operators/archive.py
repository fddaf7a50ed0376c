"""The archive's rows, keyed upserts, and what came of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mnemon import schemas
from mnemon.operators import projects
from mnemon.plans.stage import materialize

ROLES = ("system", "developer", "user", "assistant", "tool")


def surrogate(kind: str, *key: Column | str) -> Column:
    """A row's id: made of its key, so a rerun makes the same."""
    return F.sha2(F.concat_ws(":", F.lit(kind), *key), 256)


def band(c: Column) -> Column:
    return F.when(c == "critical", "high").when(c.isin("high", "medium", "low"), c).otherwise("low")


def channel(file: Column) -> Column:
    return F.when(F.coalesce(file, F.lit("")).contains("topic-"), "discord").otherwise("cli")


def promotion_status(decision: Column) -> Column:
    return F.when(decision == "promote", "promoted").when(decision == "defer", "review_later").when(decision == "archive_only", "archived_only").otherwise("none")


def role(c: Column) -> Column:
    return F.when(c.isin(*ROLES), c).otherwise("assistant")


def job_rows(sessions: DataFrame, date: Column) -> DataFrame:
    return sessions.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("effective_decision") == "promote").alias("p")).select(
        F.to_date(date).alias("job_date"), F.lit("archiving").alias("status"), F.col("n").alias("sessions_discovered"), F.col("n").alias("sessions_archived"),
        F.col("p").alias("sessions_promoted"), F.lit(0).cast("long").alias("sessions_failed"),
    )


def session_rows(sessions: DataFrame, date: Column) -> DataFrame:
    return sessions.select(
        surrogate("session", "session_id").alias("id"), F.col("session_id").alias("external_session_id"), surrogate("job", F.to_date(date).cast("string")).alias("job_id"),
        channel(F.col("file_name")).alias("channel"), "message_count", F.col("char_count").cast("long").alias("char_count"),
        promotion_status(F.coalesce("effective_decision", "promotion_decision")).alias("promotion_status"), F.col("importance_score").cast("long").alias("importance_score"),
        band(F.col("importance_band")).alias("importance_band"), "retention_class", "summary_short",
    )


def message_rows(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    ids = sessions.select(F.col("external_session_id").alias("session_id"), "id")
    return messages.join(ids, "session_id").select(
        F.col("id").alias("session_id"), F.col("message_id").alias("external_message_id"), "seq_no", role(F.col("role")).alias("role"), F.col("author").alias("author_name"),
        F.col("ts").alias("created_at"), F.col("text").alias("content_text"), F.length("text").cast("long").alias("char_count"), F.lit("unknown").alias("sensitivity"),
    )


def candidate_rows(candidates: DataFrame, sessions: DataFrame) -> DataFrame:
    ids = sessions.select(F.col("external_session_id").alias("session_id"), F.col("id").alias("sid"))
    return candidates.join(ids, "session_id").select(
        surrogate("candidate", "sid", "kind", "title").alias("id"), F.col("sid").alias("session_id"), "kind", "title", "summary", "confidence_score", F.col("importance_score").cast("long").alias("importance_score"),
        F.col("novelty_score").cast("long").alias("novelty_score"), F.col("actionability_score").cast("long").alias("actionability_score"), "decision", F.col("reasons").alias("reason_codes"), "source_message_ids", "content_fingerprint",
    )


def _archived_candidates(rows: DataFrame, sessions: DataFrame, candidates: DataFrame) -> DataFrame:
    """``rows`` with sid and candidate_id, by the archive's key: fingerprints have 32 bits, so candidates of a large table share some."""
    s = sessions.select(F.col("external_session_id").alias("session_id"), F.col("id").alias("sid"))
    c = candidates.groupBy(F.col("session_id").alias("sid"), "kind", "title").agg(F.min("id").alias("candidate_id"))
    return rows.join(s, "session_id").join(c, ["sid", "kind", "title"])


def promotion_rows(promotions: DataFrame, sessions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Promotions whose session and candidate are archived."""
    return _archived_candidates(promotions, sessions, candidates).select(
        "candidate_id", F.col("sid").alias("session_id"), "target_file", "target_section", "entry_slug", "promotion_mode", "content_markdown"
    )


def session_project_rows(sessions: DataFrame, archived: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Links of sessions and archived projects of enough confidence."""
    ids = archived.select(F.col("external_session_id").alias("session_id"), F.col("id").alias("sid"))
    hints = sessions.select("session_id", "primary_project", F.explode("project_hints").alias("h")).where(F.col("h.confidence") >= projects.LINK_CONFIDENCE)
    return hints.join(ids, "session_id").join(catalogue.select(F.col("slug"), F.col("id").alias("project_id")), F.col("h.slug") == F.col("slug")).select(
        F.col("sid").alias("session_id"), "project_id", F.lit("inferred").alias("link_source"), F.col("h.confidence").alias("confidence_score"), (F.col("primary_project") == F.col("h.slug")).alias("primary_project")
    )


def candidate_project_rows(candidates: DataFrame, sessions: DataFrame, archived: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Links of candidates: the primary project and the first three hints, the first of each slug that is sure enough."""
    hints = F.coalesce("project_hints", F.array().cast(candidates.schema["project_hints"].dataType))
    rows = candidates.select("session_id", "kind", "title", F.posexplode(F.concat(F.slice(hints, 1, 1), F.slice(hints, 1, 3))).alias("pos", "h")).where(F.col("h.confidence") >= projects.LINK_CONFIDENCE)
    joined = _archived_candidates(rows, sessions, archived).join(catalogue.select("slug", F.col("id").alias("project_id")), F.col("h.slug") == F.col("slug"))
    order = Window.partitionBy("candidate_id", "slug").orderBy("pos")
    return joined.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("candidate_id", "project_id", F.lit("inherited").alias("link_source"), F.col("h.confidence").alias("confidence_score"))


def upsert(old: DataFrame, batch: DataFrame, key: tuple[str, ...], order: tuple[Column, ...] = ()) -> DataFrame:
    """``old`` with the batch's rows in the place of those with their keys; of a key's rows in the batch the first by ``order`` (else by their JSON)."""
    by = Window.partitionBy(*key).orderBy(*(order or (F.to_json(F.struct(*batch.columns)),)))
    fresh = batch.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")
    return old.join(fresh.select(*key), list(key), "left_anti").unionByName(fresh, allowMissingColumns=True)


#: Parts of an archive table; an upsert rewrites those that the batch's keys fall into.
PARTS = 64


def part_of(key: tuple[str, ...], parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in key)), F.lit(parts)).cast("int")


def read_parts(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A stored table of ``schema`` and its ``part``, or None before its first batch."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema(f"{schema}, part int").parquet(path)


def put(batch: DataFrame, path: str, key: tuple[str, ...], schema: str, parts: int = PARTS) -> None:
    """Upsert ``batch`` into the table at ``path``.

    The table is partitioned by a hash of the key.  Of the parts that the batch
    touches the new rows are written to the shared folder first, and then take
    the old ones' place; other parts aren't read.  A batch that runs again
    leaves the same rows, and an empty one leaves the table as it is.
    """
    old = read_parts(batch.sparkSession, path, schema)
    if old is not None:
        touched = [r[0] for r in batch.select(part_of(key, parts).alias("part")).distinct().collect()]  # PARTS numbers at most
        old = old.where(F.col("part").isin(touched)).select(*batch.columns)
    merged = upsert(old if old is not None else batch.limit(0), batch, key).withColumn("part", part_of(key, parts))
    staged = materialize(merged, "upsert")
    staged.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_table(spark: SparkSession, name: str, folder: str) -> DataFrame | None:
    """A stored archive table, or None before its first batch."""
    return read_parts(spark, f"{folder}/{name}", schemas.ARCHIVE[name].columns)


def store(name: str, batch: DataFrame, folder: str, parts: int = PARTS) -> None:
    """Upsert ``batch`` into the archive table ``name`` below ``folder``, by its key."""
    spec = schemas.ARCHIVE[name]
    put(batch.select(*(c.split(" ", 1)[0] for c in spec.columns.split(", "))), f"{folder}/{name}", spec.key, spec.columns, parts)


def returned(name: str, batch: DataFrame, folder: str) -> DataFrame:
    """The stored rows of the batch's keys."""
    key = list(schemas.ARCHIVE[name].key)
    found = read_table(batch.sparkSession, name, folder)
    return batch.limit(0) if found is None else found.join(batch.select(*key).distinct(), key, "left_semi")


def violations(name: str, rows: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table, rule, n): rows against a table's keys, value sets and parent."""
    spec = schemas.ARCHIVE[name]
    found = rows.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("unique key").alias("rule"), "n")
    for column, values in (spec.allowed or {}).items():
        bad = rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"values of {column}").alias("rule"), "n")
        found = found.unionByName(bad)
    if spec.parent and parents and spec.parent[1] in parents:
        column, table, other = spec.parent
        lost = rows.where(F.col(column).isNotNull()).join(parents[table].select(F.col(other).alias(column)), column, "left_anti")
        found = found.unionByName(lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{column} in {table}").alias("rule"), "n"))
    return found.select(F.lit(name).alias("table"), "rule", "n").where("n > 0")


def audit(requested: dict[str, DataFrame], returned: dict[str, DataFrame]) -> DataFrame:
    """(table, rows_requested, rows_returned) of a run."""
    out = None
    for name, rows in requested.items():
        a = rows.agg(F.count(F.lit(1)).alias("rows_requested"))
        b = returned[name].agg(F.count(F.lit(1)).alias("rows_returned")) if name in returned else rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("rows_returned"))
        one = a.join(b, F.lit(True)).select(F.lit(name).alias("table"), "rows_requested", "rows_returned")  # a row and a row
        out = one if out is None else out.unionByName(one)
    return out


def overview(sessions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Sessions with their jobs, where there are any."""
    j = jobs.select(surrogate("job", F.col("job_date").cast("string")).alias("job_id"), "job_date", F.col("status").alias("job_status"))
    return sessions.join(j, "job_id", "left")
