"""The explainable heuristic, model scores, and how one stands in for the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon import lexicon as L
from mnemon.functions import numbers, text

def automation(lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """Whether nobody talks: marks of scheduled runs, a known directory, or far more answers than questions."""
    others = F.col("n_assistant") + F.col("n_system") + F.col("n_tool")
    marked = text.includes_any(F.col("combined_text"), lexicon.automation) | F.coalesce(text.includes_any(F.col("cwd"), lexicon.automation_cwd), F.lit(False))
    lopsided = ((F.col("n_user") == 0) & (others > 0)) | ((F.col("n_user") > 0) & (others >= 4 * F.col("n_user")))
    return marked | lopsided


def user_ratio() -> Column:
    return F.round(F.col("n_user") / F.greatest("message_count", F.lit(1)), 2)


def signals(lexicon: L.Lexicon = L.DEFAULT) -> dict[str, Column]:
    body = F.col("combined_text")
    return {
        "explicitMemorySignal": text.any_match(body, lexicon.strong),
        "longTermProjectSignal": text.includes_any(body, lexicon.long_term),
        "decisionMadeSignal": text.includes_any(body, lexicon.decided),
        "userPreferenceSignal": text.includes_any(body, lexicon.preference),
        "actionableFollowupSignal": text.includes_any(body, lexicon.actionable),
        "recurrenceSignal": F.col("message_count") >= 8,
        "noveltySignal": text.includes_any(body, lexicon.novel),
    }


def band(score: Column) -> Column:
    return F.when(score >= 75, "critical").when(score >= 50, "high").when(score >= 25, "medium").otherwise("low")


def decision(score: Column) -> Column:
    return F.when(score >= 60, "promote").when(score >= 35, "defer").when(score >= 15, "archive_only").otherwise("reject")


def retention(band_: Column, decision_: Column, automated: Column) -> Column:
    return (
        F.when(decision_ == "promote", "promoted").when(automated & (decision_ == "archive_only"), "ephemeral").when(band_ == "low", "ephemeral").otherwise("standard")
    )


def candidate_kinds(body: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    kinds = F.array(*(F.when(text.includes_any(body, terms), F.lit(kind)) for kind, terms in lexicon.kinds.items()))
    found = F.filter(kinds, lambda k: k.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("fact")))


def summary_line(band_: Column, count: Column, sample: Column) -> Column:
    preview = text.truncate(F.coalesce(F.nullif(sample, F.lit("")), F.lit(L.NO_USER_TEXT)), 140)
    return F.concat(F.lit("["), band_, F.lit("] "), count.cast("string"), F.lit(" messages · "), preview)


def heuristic(sessions: DataFrame, lexicon: L.Lexicon = L.DEFAULT) -> DataFrame:
    """Sessions with score, band, decision, kinds, retention, reasons and summary."""
    found = signals(lexicon)
    rows = sessions.withColumns({"automation_session": automation(lexicon), "user_message_ratio": user_ratio(), **{f"_{n}": c for n, c in found.items()}})
    raw = sum((F.col(f"_{n}").cast("int") * lexicon.weights[n] for n in found), F.lit(0)) + F.least(F.lit(10), text.count_matches(F.col("combined_text"), lexicon.medium) * 2)
    rows = rows.withColumn("raw_score", F.least(F.lit(100), raw))
    capped = (
        F.when(F.col("automation_session"), F.least("raw_score", F.lit(34)))
        .when(F.col("user_message_ratio") < 0.2, F.least("raw_score", F.lit(49)))
        .otherwise(F.col("raw_score"))
    )
    rows = rows.withColumn("importance_score", capped).withColumns({"importance_band": band(capped), "promotion_decision": decision(capped)})
    true = {**{n: F.col(f"_{n}") for n in found}, "automationSession": F.col("automation_session"), "userLedSession": F.col("user_message_ratio") >= 0.2}
    return rows.withColumns({
        "candidate_kinds": candidate_kinds(F.col("combined_text"), lexicon),
        "retention_class": retention(F.col("importance_band"), F.col("promotion_decision"), F.col("automation_session")),
        "reasons": F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in true.items())), lambda x: x.isNotNull()),
        "summary_short": summary_line(F.col("importance_band"), F.col("message_count"), F.col("sample_user_text")),
        "sample_user_text": text.truncate(F.col("sample_user_text"), 240),
        "scorer_type": F.lit("heuristic"),
    }).drop(*(f"_{n}" for n in found))


# fixed values: a model's signals, in order, and the reasons that they stand for
MODEL_SIGNALS = {
    "explicitMemoryRequest": ("explicitMemorySignal",), "longTermDecision": ("longTermProjectSignal", "decisionMadeSignal"), "userPreference": ("userPreferenceSignal",),
    "operationRule": ("operationRuleSignal",), "actionableFollowup": ("actionableFollowupSignal",), "automationSession": ("automationSession",),
    "temporaryContext": ("temporaryContextSignal",), "novelContent": ("noveltySignal",),
}

_ANSWER = (
    "importanceScore double, importanceBand string, promotionDecision string, candidateKinds array<string>, summary string, reasoning string, signals struct<"
    + ", ".join(f"{s}: boolean" for s in MODEL_SIGNALS) + ">"
)


def check_answers(answers: DataFrame) -> DataFrame:
    """(session_id, answer) in JSON to checked fields; ``error`` where there is no valid score (the call's own, if ``answers`` has one)."""
    a = F.from_json("answer", _ANSWER)
    said = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    rows = answers.select("session_id", a.alias("a"), said.alias("said"))
    score = F.col("a.importanceScore")
    fits = score.isNotNull() & (score >= 0) & (score <= 100)
    kinds = F.filter("a.candidateKinds", lambda k: k.isin(*L.KINDS))
    reasons = F.array_distinct(F.flatten(F.array(*(
        F.when(F.coalesce(F.col(f"a.signals.{s}"), F.lit(False)), F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>")) for s, names in MODEL_SIGNALS.items()
    ))))
    return rows.select(
        "session_id",
        F.when(fits, numbers.half_up(score).cast("long")).alias("importance_score"),
        F.when(fits, F.when(F.col("a.importanceBand").isin(*L.BANDS), F.col("a.importanceBand")).otherwise(band(score))).alias("importance_band"),
        F.when(fits, F.when(F.col("a.promotionDecision").isin(*L.DECISIONS), F.col("a.promotionDecision")).otherwise(decision(score))).alias("promotion_decision"),
        F.when(fits, F.when(F.size(F.coalesce(kinds, F.array().cast("array<string>"))) > 0, kinds).otherwise(F.array(F.lit("fact")))).alias("candidate_kinds"),
        F.when(fits, F.left(F.coalesce("a.summary", F.lit("")), F.lit(280))).alias("summary"),
        F.when(fits, F.left(F.coalesce("a.reasoning", F.lit("")), F.lit(500))).alias("reasoning"),
        F.when(fits, reasons).alias("reasons"),
        F.when(~F.coalesce(fits, F.lit(False)), F.coalesce("said", F.lit("invalid importance score"))).alias("error"),
    )


def with_model(scored: DataFrame, checked: DataFrame) -> DataFrame:
    """Model scores where they are valid, the heuristic's elsewhere."""
    names = ("importance_score", "importance_band", "promotion_decision", "candidate_kinds", "reasons")
    model = checked.select("session_id", F.col("error").alias("_error"), F.col("summary").alias("_summary"), F.col("reasoning").alias("llm_reasoning"), *(F.col(n).alias(f"_{n}") for n in names))
    both = scored.join(model, "session_id", "left")
    ok = F.col("_importance_score").isNotNull() & F.col("_error").isNull()
    both = both.withColumns({n: F.when(ok, F.col(f"_{n}").cast(scored.schema[n].dataType)).otherwise(F.col(n)) for n in names})
    return both.withColumns({
        "retention_class": retention(F.col("importance_band"), F.col("promotion_decision"), F.col("automation_session")),
        "summary_short": F.when(ok, F.coalesce(F.nullif("_summary", F.lit("")), summary_line(F.col("importance_band"), F.col("message_count"), F.col("sample_user_text")))).otherwise(F.col("summary_short")),
        "scorer_type": F.when(ok, F.lit("llm")).otherwise(F.lit("heuristic-fallback")),
        "llm_error": F.when(~ok, text.redact_key(F.coalesce("_error", F.lit("unknown")))),
    }).drop("_error", "_summary", *(f"_{n}" for n in names))
