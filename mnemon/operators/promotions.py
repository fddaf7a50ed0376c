"""Where promoted candidates go, what is written, and what that does to a file."""

from __future__ import annotations

import os
import re
import shutil
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon.functions import text


@dataclass(frozen=True)
class Route:
    kind: str
    file: str
    section: str
    mode: str
    project_file: str | None = None
    project_section: str | None = None


_PROJECT = "memory/projects/{}.md"
# fixed values: where each kind goes, with and without a project
ROUTES = (
    Route("project_state", "MEMORY.md", "## Active Projects", "merge", _PROJECT, "## Snapshot"),
    Route("user_preference", "MEMORY.md", "## Stable Preferences", "merge"),
    Route("operation_rule", "MEMORY.md", "## Operational Rules", "merge"),
    Route("decision", "memory/decisions/log.md", "## Decisions", "merge", _PROJECT, "## Important Decisions"),
    Route("relationship", "memory/people/relationships.md", "## Relationships", "merge"),
    Route("todo", "memory/projects/todos.md", "## Pending todos", "merge", _PROJECT, "## Active Todos"),
    Route("fact", "memory/inbox.md", "## Pending review", "append"),
)
#: The comment marks round an entry; set these to those of existing files.
MARK = "memory:entry"


def marks(slug: Column, mark: str = MARK) -> tuple[Column, Column]:
    return F.concat(F.lit(f"<!-- {mark} "), slug, F.lit(" -->")), F.concat(F.lit(f"<!-- /{mark} "), slug, F.lit(" -->"))


def route(candidates: DataFrame, root: str = "") -> DataFrame:
    """Candidates with target_file, target_section, promotion_mode and entry_slug."""
    slug = F.nullif(text.file_slug(F.coalesce("primary_project", F.lit(""))), F.lit(""))
    file, section, mode = None, None, None
    for r in ROUTES:
        here = F.col("kind") == r.kind if r.kind != "fact" else F.lit(True)  # unknown kinds go where facts go
        to = F.when(slug.isNotNull(), F.format_string(r.project_file.replace("{}", "%s"), slug)).otherwise(F.lit(r.file)) if r.project_file else F.lit(r.file)
        under = F.when(slug.isNotNull(), F.lit(r.project_section)).otherwise(F.lit(r.section)) if r.project_file else F.lit(r.section)
        file = F.when(here, to) if file is None else file.when(here, to)
        section = F.when(here, under) if section is None else section.when(here, under)
        mode = F.when(here, F.lit(r.mode)) if mode is None else mode.when(here, F.lit(r.mode))
    scope = F.coalesce(slug, F.nullif("primary_project_label", F.lit("")), F.lit("global"))
    prefix = F.lit(root.rstrip("/") + "/" if root else "")
    return candidates.withColumns({
        "target_file": F.concat(prefix, file), "target_section": section, "promotion_mode": mode,
        "entry_slug": text.entry_slug(F.col("kind"), F.col("title"), scope),
    })


def stable_date(clock: Column) -> Column:
    """The target date, else the last message's, else the start's, else ``clock``'s day."""
    seen = F.coalesce(F.try_to_timestamp(F.col("target_date").cast("string")), F.col("last_message_at"), F.col("started_at"), clock)
    return F.date_format(seen, "yyyy-MM-dd")


def short(number: Column) -> Column:
    """A number without trailing zeros."""
    return F.regexp_replace(number.cast("string"), r"\.0+$|(\.\d*[1-9])0+$", "$1")


def render(routed: DataFrame, clock: Column, mark: str = MARK) -> DataFrame:
    """Routed candidates with ``content_markdown``, an entry between its marks; untitled ones are left out."""
    title, summary = F.trim("title"), F.trim("summary")
    start, end = marks(F.col("entry_slug"), mark)
    listed = lambda c: F.coalesce(F.nullif(F.array_join(c, ", "), F.lit("")), F.lit("n/a"))
    project = F.coalesce(F.nullif("primary_project", F.lit("")), F.nullif("primary_project_label", F.lit("")))
    lines = [
        start, F.concat(F.lit("### "), title), F.concat(F.lit("- Summary: "), summary), F.concat(F.lit("- Confidence: "), short(F.col("confidence_score"))),
        F.concat(F.lit("- Importance: "), F.col("importance_score").cast("string")), F.concat(F.lit("- Project: "), project), F.concat(F.lit("- Last updated: "), stable_date(clock)),
        F.concat(F.lit("- Session: "), F.col("session_id")), F.concat(F.lit("- Sources: "), listed(F.slice("source_message_ids", 1, 5))), F.concat(F.lit("- Reasons: "), listed(F.col("reasons"))), end,
    ]
    return routed.where((title != "") & (summary != "")).withColumn("content_markdown", F.concat_ws("\n", *lines))


def promote(candidates: DataFrame, clock: Column, root: str = "", mark: str = MARK) -> DataFrame:
    """The promotions of candidates whose decision is to promote."""
    return render(route(candidates.where("decision = 'promote'"), root), clock, mark).select(
        "session_id", "kind", "title", "content_fingerprint", "target_file", "target_section", "entry_slug", "promotion_mode", "content_markdown"
    )


def entry_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What a batch does, entry by entry: append (new file), merge (new entry), replace or noop.

    Both have (target_file, entry_slug, content_markdown); entries of ``old``
    that the batch doesn't have are kept.  Of a batch's rows for one entry the
    greatest content counts.
    """
    files = old.select("target_file").distinct().withColumn("known_file", F.lit(True))
    a = old.select("target_file", "entry_slug", F.col("content_markdown").alias("before"))
    b = new.select("target_file", "entry_slug", "content_markdown").groupBy("target_file", "entry_slug").agg(F.max("content_markdown").alias("after"))
    both = a.join(b, ["target_file", "entry_slug"], "full_outer").join(files, "target_file", "left")
    same = F.rtrim("before") == F.rtrim("after")
    action = (
        F.when(F.col("after").isNull(), "keep").when(F.col("known_file").isNull(), "append").when(F.col("before").isNull(), "merge").when(same, "noop").otherwise("replace")
    )
    return both.select("target_file", "entry_slug", action.alias("action"), F.coalesce("after", "before").alias("content_markdown"))


# --- the Markdown files themselves: few and order-dependent, so plain Python -------

LEGACY_NOISE = ("[Thread starter - for context]", "Conversation info (untrusted metadata):", "Sender (untrusted metadata):")


def _even(content: str) -> str:
    return content.rstrip() + "\n"


def without_noise(content: str) -> str:
    return "\n\n".join(p for p in re.split(r"\n{2,}", content) if not any(n in p for n in LEGACY_NOISE)).rstrip()


def with_section(content: str, file: str, section: str) -> str:
    body = content.rstrip()
    if section in body:
        return body
    if body:
        return f"{body}\n\n{section}\n"
    head = "# MEMORY\n\n" if os.path.basename(file) == "MEMORY.md" else ""
    if m := re.search(r"memory/projects/([^/]+)\.md$", file):
        head = f"# {m[1]}\n\n"
    return f"{head}{section}\n"


def put_entry(content: str, section: str, slug: str, entry: str, mark: str = MARK) -> str:
    """``content`` with the entry in the place of its former self, else at its section's end."""
    start, stop = f"<!-- {mark} {slug} -->", f"<!-- /{mark} {slug} -->"
    a = content.find(start)
    b = content.find(stop, a) if a >= 0 else -1
    if b >= 0:
        b += len(stop)
        return content if _even(content[a:b]) == _even(entry) else content[:a] + entry + content[b:]
    at = content.find(section)
    if at < 0:
        return f"{content.rstrip()}\n\n{section}\n\n{entry}\n"
    at += len(section)
    at += content[at : at + 1] == "\n"
    following = re.search(r"\n##\s+", content[at:])
    end = at + following.start() + 1 if following else len(content)
    body = content[at:end].strip()
    return content[:at] + body + ("\n\n" if body else "") + entry + content[end:]


def write_entry(file: str, section: str, slug: str, entry: str, root: str, clock_ms: int, mark: str = MARK) -> tuple[bool, str]:
    """(changed, mode) after putting one entry into a file; the former file is kept as a snapshot."""
    exists = os.path.exists(file)
    current = ""
    if exists:
        with open(file, encoding="utf-8") as f:
            current = f.read()
    cleaned = without_noise(current)
    ready = with_section(cleaned, file, section)
    after = put_entry(ready, section, slug, entry, mark)

    def save(content: str) -> None:
        os.makedirs(os.path.dirname(file) or ".", exist_ok=True)
        if exists:
            kept = os.path.join(root, "memory", ".snapshots")
            os.makedirs(kept, exist_ok=True)
            shutil.copyfile(file, os.path.join(kept, f"{os.path.basename(file)}.{clock_ms}.bak"))
        with open(file, "w", encoding="utf-8") as f:
            f.write(_even(content))

    if _even(after) == _even(current):
        if _even(cleaned) != _even(current):
            save(cleaned)
            return True, "replace"
        return False, "replace" if exists else "append"
    save(after)
    if not current.strip():
        return True, "append"
    return True, "replace" if f"<!-- {mark} {slug} -->" in ready else "merge"


FOLDERS = ("memory", "memory/projects", "memory/preferences", "memory/people", "memory/operations", "memory/decisions")
TEMPLATES = {
    "MEMORY.md": "# MEMORY\n\n## Active Projects\n\n## Stable Preferences\n\n## Current Priorities\n\n## Operational Rules\n\n## Recent Promoted Memories\n",
    "memory/README.md": "# Memory\n\n## Rules\n- Promote facts, preferences and decisions, never whole transcripts.\n- Give each entry its sources and last update.\n- What is uncertain goes to memory/inbox.md.\n",
    "memory/inbox.md": "# Inbox\n\n## Pending review\n",
    **{f"memory/{d}/README.md": f"# {t} memories\n" for d, t in (("projects", "Project"), ("preferences", "Preference"), ("people", "People"), ("operations", "Operations"), ("decisions", "Decision"))},
}


def bootstrap(root: str, dry_run: bool = True) -> list[str]:
    """Create missing folders and template files below ``root``; the files that were made."""
    made: list[str] = []
    if dry_run:
        return made
    for d in FOLDERS:
        os.makedirs(os.path.join(root, d), exist_ok=True)
    for name, content in TEMPLATES.items():
        path = os.path.join(root, name)
        if not os.path.exists(path):
            with open(path, "w", encoding="utf-8") as f:
                f.write(content)
            made.append(name)
    return made
