"""Schemas of the tables that the engine reads and writes, and their keys."""

from __future__ import annotations

from dataclasses import dataclass

MESSAGES = "session_id string, seq_no int, message_id string, role string, ts string, author string, text string"
HEADERS = "session_id string, file_name string, cwd string, started_at timestamp"


@dataclass(frozen=True)
class Table:
    """An archive table: its key, its columns and the values that a column may have."""

    key: tuple[str, ...]
    columns: str
    allowed: dict[str, tuple[str, ...]] = None  # type: ignore[assignment]
    parent: tuple[str, str, str] | None = None  # (column, table, its column)


# fixed values: tables, keys and value sets of the archive
ARCHIVE = {
    "jobs": Table(("job_date",), "job_date date, status string, sessions_discovered long, sessions_archived long, sessions_promoted long, sessions_failed long",
                  {"status": ("pending", "discovering", "archiving", "analyzing", "promoting", "completed", "partial", "failed")}),
    "sessions": Table(("external_session_id",), "id string, external_session_id string, job_id string, channel string, message_count long, char_count long, promotion_status string, importance_score long, importance_band string, retention_class string, summary_short string",
                      {"importance_band": ("low", "medium", "high"), "promotion_status": ("none", "review_later", "promoted", "archived_only"), "retention_class": ("ephemeral", "standard", "promoted")}),
    "messages": Table(("session_id", "seq_no"), "session_id string, external_message_id string, seq_no int, role string, author_name string, created_at string, content_text string, char_count long, sensitivity string",
                      {"role": ("system", "developer", "user", "assistant", "tool")}, ("session_id", "sessions", "id")),
    "candidates": Table(("session_id", "kind", "title"), "id string, session_id string, kind string, title string, summary string, confidence_score double, importance_score long, novelty_score long, actionability_score long, decision string, reason_codes array<string>, source_message_ids array<string>, content_fingerprint string",
                        {"kind": ("project_state", "user_preference", "decision", "operation_rule", "fact", "relationship", "todo"), "decision": ("reject", "archive_only", "defer", "promote")}, ("session_id", "sessions", "id")),
    "promotions": Table(("session_id", "entry_slug"), "candidate_id string, session_id string, target_file string, target_section string, entry_slug string, promotion_mode string, content_markdown string",
                        {"promotion_mode": ("append", "replace", "merge")}, ("session_id", "sessions", "id")),
    "projects": Table(("slug",), "id string, slug string, name string, kind string, aliases array<string>, status string",
                      {"kind": ("app", "infra", "library", "research", "personal"), "status": ("active", "paused", "archived")}),
    "session_projects": Table(("session_id", "project_id"), "session_id string, project_id string, link_source string, confidence_score double, primary_project boolean", None, ("project_id", "projects", "id")),
    "candidate_projects": Table(("candidate_id", "project_id"), "candidate_id string, project_id string, link_source string, confidence_score double", None, ("project_id", "projects", "id")),
    "embedding_documents": Table(("source_type", "source_key"), "id string, source_type string, source_key string, external_session_id string, project_slug string, provider string, model string, content_text string, content_hash string, payload_fingerprint string, status string, request_count int"),
    "embeddings": Table(("source_type", "source_key", "provider", "model"), "document_id string, source_type string, source_key string, provider string, model string, content_hash string, dimensions int, vector array<float>, status string",
                        {"status": ("pending", "embedded", "failed")}),
}
