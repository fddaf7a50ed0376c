"""What deserves an embedding, and the rows that keep texts and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon.functions import hashing, text

# fixed values: the kinds and decisions that are embedded
INCLUDE_DECISIONS = ("promote", "defer")
INCLUDE_KINDS = ("project_state", "user_preference", "operation_rule", "decision", "todo", "relationship")


def is_selected(decisions: tuple[str, ...] = INCLUDE_DECISIONS, kinds: tuple[str, ...] = INCLUDE_KINDS) -> Column:
    fits = F.col("content_fingerprint").isNotNull() & F.col("decision").isin(*decisions) & F.col("kind").isin(*kinds)
    return fits & (F.length(text.normalize(F.col("summary"))) >= 12)


def payload_text() -> Column:
    filled = lambda name: F.nullif(F.col(name), F.lit(""))
    reasons = F.nullif(F.array_join("reasons", ", "), F.lit(""))
    lines = F.concat_ws(
        "\n", filled("title"), filled("summary"), F.concat(F.lit("Project: "), filled("primary_project")), F.concat(F.lit("Session summary: "), filled("summary_short")),
        F.concat(F.lit("Reasons: "), reasons),
    )
    return text.normalize(lines)


def selected_because() -> Column:
    return F.filter(F.array(
        F.lit("candidate_memory_unit"), F.when(F.col("decision") == "promote", "promotion_candidate"), F.when(F.col("decision") == "defer", "review_later_candidate"),
        F.when(F.col("primary_project").isNotNull(), "project_linked"), F.when(F.col("kind").isin("user_preference", "operation_rule"), "stable_memory_kind"),
    ), lambda x: x.isNotNull())


def project_of_file(file: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(file, F.lit("")), r"memory/projects/([^/.]+)\.md$", 1), F.lit(""))


def payloads(candidates: DataFrame, promotions: DataFrame, decisions: tuple[str, ...] = INCLUDE_DECISIONS, kinds: tuple[str, ...] = INCLUDE_KINDS) -> DataFrame:
    """One corpus of selected candidates and promoted entries."""
    a = candidates.where(is_selected(decisions, kinds)).select(
        F.lit("candidate").alias("object_type"), F.col("content_fingerprint").alias("object_id"), "session_id", F.col("primary_project").alias("project"), "decision",
        payload_text().alias("text"), selected_because().alias("selected_because"),
    ).where("text <> ''")
    b = promotions.where((F.coalesce("entry_slug", F.lit("")) != "") & (F.coalesce("content_markdown", F.lit("")) != "")).select(
        F.lit("promotion").alias("object_type"), F.col("entry_slug").alias("object_id"), "session_id", project_of_file(F.col("target_file")).alias("project"),
        F.lit("promote").alias("decision"), text.normalize(F.col("content_markdown")).alias("text"), F.array(F.lit("promoted_memory_entry")).alias("selected_because"),
    )
    return a.unionByName(b)


def documents(rows: DataFrame, provider: str = "local", model: str = "stub-v1") -> DataFrame:
    """Payloads as document rows, with content hash and fingerprint."""
    whole = F.to_json(F.struct("object_type", "object_id", "project", "decision", "text", "session_id", "selected_because"), {"ignoreNullFields": "false"})
    key = F.trim("object_id")
    return rows.select(
        F.sha2(F.concat_ws(":", F.lit("document"), "object_type", key), 256).alias("id"), F.col("object_type").alias("source_type"), key.alias("source_key"),
        F.col("session_id").alias("external_session_id"), F.col("project").alias("project_slug"), F.lit(provider).alias("provider"), F.lit(model).alias("model"),
        F.col("text").alias("content_text"), hashing.sha256(F.col("text")).alias("content_hash"), F.sha2(whole, 256).alias("payload_fingerprint"),
        F.lit("prepared").alias("status"), F.lit(1).alias("request_count"),
    )


def embedding_rows(docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Documents with their vectors (source_key, vector), where there are any."""
    has = F.size("vector") > 0
    return docs.join(vectors, "source_key", "left").select(
        F.col("id").alias("document_id"), "source_type", "source_key", "provider", "model", "content_hash",
        F.when(has, F.size("vector")).alias("dimensions"), F.when(has, F.col("vector")).alias("vector"), F.when(has, "embedded").otherwise("pending").alias("status"),
    )
