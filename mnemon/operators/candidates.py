"""Scored sessions to memory candidates, one per kind, with gated decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon import lexicon as L
from mnemon.functions import hashing, text

# fixed values: the word that a kind's summary starts with
PREFIX = {
    "project_state": "Project state", "user_preference": "User preference", "operation_rule": "Operation rule", "decision": "Decision",
    "todo": "Todo", "relationship": "Relationship", "fact": "Fact",
}


def primary_text() -> Column:
    """The last meaningful text, else the sample, else the summary."""
    return F.coalesce(F.try_element_at("meaningful", F.lit(-1)), F.nullif("sample_user_text", F.lit("")), F.col("summary_short"))


def gate(lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """A candidate's decision: the first of these rules that applies."""
    primary, kind, base = F.col("primary_text"), F.col("kind"), F.col("promotion_decision")
    low = F.lower(F.coalesce(primary, F.lit("")))
    keep = F.lit("archive_only")
    rule = F.when(F.col("automation_session"), keep).when(F.col("user_message_ratio") < 0.2, keep)
    rule = rule.when(F.coalesce(primary, F.lit("")) == "", keep).when(text.is_low_signal(primary), keep).when(text.is_temporary(primary), keep)
    rule = rule.when(low.contains("__cron") | low.startswith("[cron:"), keep)
    for name, terms in lexicon.gates.items():
        lacks = ~text.includes_any(primary, terms)
        if name == "fact":
            lacks = lacks | F.array_contains("reasons", "automationSession")
        rule = rule.when((kind == name) & lacks, keep)
    return rule.when(base == "reject", base).when(base == "archive_only", keep).when((kind == "fact") & (base == "defer"), keep).otherwise(base)


def extract(scored: DataFrame, lexicon: L.Lexicon = L.DEFAULT) -> DataFrame:
    """One row per session and kind; none where the text is a mere acknowledgement."""
    rows = scored.withColumn("primary_text", primary_text()).select("*", F.posexplode("candidate_kinds").alias("kind_no", "kind"))
    compact = text.squeeze(F.coalesce("primary_text", F.lit("")))
    title, summary = F.left(compact, F.lit(72)), F.left(compact, F.lit(220))
    rows = rows.where((compact != "") & ~text.is_low_signal(title) & ~text.is_low_signal(compact))
    has = lambda name: F.array_contains("reasons", name)
    points = lambda condition, n: F.when(condition, F.lit(n)).otherwise(F.lit(0))
    prefix = F.create_map(*(F.lit(x) for pair in PREFIX.items() for x in pair))
    return rows.withColumns({
        "title": F.concat(F.col("kind"), F.lit(": "), title),
        "summary": F.concat(F.coalesce(F.try_element_at(prefix, F.col("kind")), F.lit("Memory")), F.lit(": "), summary),
        "confidence_score": F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("importance_score") / 100)), 2),
        "novelty_score": F.least(F.lit(100), 20 + points(F.col("kind").isin("decision", "operation_rule"), 20) + points(has("noveltySignal"), 20) + points(has("explicitMemorySignal"), 20)),
        "actionability_score": F.least(F.lit(100), 10 + points(F.col("kind").isin("project_state", "todo"), 30) + points(has("actionableFollowupSignal"), 30) + points(has("decisionMadeSignal"), 20)),
        "decision": gate(lexicon),
        "content_fingerprint": hashing.fingerprint(F.concat_ws("|", "session_id", "kind", F.coalesce("transcript_checksum", F.lit("")), F.coalesce("primary_text", F.lit("")))),
    })


def effective_decisions(scored: DataFrame, candidates: DataFrame) -> DataFrame:
    """Sessions with ``effective_decision``: the strongest of their candidates', else their own."""
    best = candidates.groupBy("session_id").agg(*(F.bool_or(F.col("decision") == d).alias(f"_{d}") for d in ("promote", "defer", "archive_only")))
    both = scored.join(best, "session_id", "left")
    found = F.when(F.col("_promote"), "promote").when(F.col("_defer"), "defer").when(F.col("_archive_only"), "archive_only")
    return both.withColumn("effective_decision", found.otherwise(F.col("promotion_decision"))).drop("_promote", "_defer", "_archive_only")
