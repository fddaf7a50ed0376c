"""What may be purged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Extension: days after which a class may go; nothing uses it unless asked.
DAYS = {"ephemeral": 14, "standard": 60, "promoted": 180}


def purge_plan(sessions: DataFrame, enabled: bool = True) -> DataFrame:
    """One action per session; nothing is ever safe to delete now."""
    decision = F.coalesce("effective_decision", "promotion_decision")
    kind = F.coalesce("retention_class", F.lit("standard"))
    cases = (
        (kind == "promoted", "keep", "promoted memory source"), (kind == "standard", "keep", "standard retention window"),
        (kind == "ephemeral", "purge_candidate", "low-importance ephemeral session"), (decision == "archive_only", "purge_candidate", "archive preserved; promotion skipped"),
    )
    action, reason = F.lit("review"), F.lit("no explicit purge rule matched")
    for when, a, r in reversed(cases):
        action, reason = F.when(when, a).otherwise(action), F.when(when, r).otherwise(reason)
    return sessions.where(F.lit(enabled)).select(
        "session_id", kind.alias("retention_class"), decision.alias("promotion_decision"), action.alias("action"), reason.alias("reason"), F.lit(False).alias("safe_to_delete_now")
    )


def histogram(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def purge_after(last: Column, kind: Column, days: dict[str, int] | None = None) -> Column:
    """Extension: the time from which a session of a class may go."""
    table = F.create_map(*(F.lit(x) for pair in (days or DAYS).items() for x in pair))
    return last + F.make_interval(days=F.try_element_at(table, kind))
