"""Project hints of sessions from directories and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mnemon.functions import text

# fixed values: names that are no project
GENERIC_SEGMENTS = (
    "users", "workspace", "apps", "sessions", "agents", "tmp", "src", "dist", "build", "node_modules", "scripts", "script", "test", "tests", "docs", "doc", "lib",
)
GENERIC_SLUGS = ("unknown", "project", "projects", "app", "repo", "dream")
# fixed values: words near which an unknown slug counts as a project
CONTEXT_WORDS = ("project", "projects", "repo", "repository", "workspace", "app", "service", "memory/projects", "worktree", "cwd", "dir", "directory")
# fixed values: words of which operational slugs are made
OPERATIONAL = (
    "topic", "sample", "samples", "test", "tests", "spec", "specs", "noop", "no", "op", "archive", "summary", "promotion", "promote", "inserted", "updated",
    "writer", "runner", "script", "task",
)
NUMBERED = r"(?i)^\d{2}_[a-z0-9][a-z0-9_-]*$"
#: Links below this confidence aren't archived.
LINK_CONFIDENCE = 0.85

CATALOGUE = "slug string, name string, aliases array<string>"


def aliases(catalogue: DataFrame) -> DataFrame:
    """(alias, known, name): what names a catalogue entry; an entry's own slug wins, then the first entry."""
    rows = catalogue.withColumn("known", text.project_slug(F.coalesce(F.nullif("slug", F.lit("")), "name"))).where("known <> ''")
    names = F.array_distinct(F.concat(F.array("known", F.lower(F.trim("name"))), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.lower(F.trim(a)))))
    rows = rows.withColumn("name", F.coalesce("name", "known")).select("known", "name", F.explode(names).alias("alias")).where("alias <> ''")
    order = Window.partitionBy("alias").orderBy((F.col("alias") != F.col("known")).cast("int"), "known")
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("alias", "known", "name")


def empty_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOGUE)


def observed_texts(sessions: DataFrame, messages: DataFrame) -> DataFrame:
    """(session_id, body, ord): the distinct texts to look at, in order of first sight."""
    first = sessions.select("session_id", F.explode(F.array(
        F.struct(F.lit(-2).alias("ord"), F.col("sample_user_text").alias("body")), F.struct(F.lit(-1).alias("ord"), F.col("file_name").alias("body")),
    )).alias("x")).select("session_id", "x.ord", "x.body")
    said = messages.where(F.col("role").isin("user", "system", "developer")).select("session_id", F.col("seq_no").alias("ord"), F.col("text").alias("body"))
    return first.unionByName(said).where(F.coalesce("body", F.lit("")) != "").groupBy("session_id", "body").agg(F.min("ord").alias("ord"))


def is_project_slug(slug: Column) -> Column:
    return slug.rlike(NUMBERED) | (slug.rlike("(?i)^[a-z0-9][a-z0-9_-]{2,}$") & slug.rlike("[_-]"))


def is_operational(slug: Column) -> Column:
    parts = F.filter(F.split(slug, "[-_]"), lambda p: F.trim(p) != "")
    known = F.size(F.filter(parts, lambda p: F.trim(p).isin(*OPERATIONAL)))
    return (F.size(parts) >= 2) & (known >= F.greatest(F.lit(2), F.size(parts) - 1))


def has_context(body: Column, token: Column) -> Column:
    """Whether a token stands like a project's name.

    Either it starts the text or follows white space or a quote, and ``.git``,
    a slash or a word boundary comes after it; or a context word is within 40
    characters on its line.
    """
    escaped = F.regexp_replace(token, r"([.*+?^${}()|\[\]\\])", r"\\$1")
    at_start = F.concat(F.lit("(?:^|[\\s'\"])"), escaped, F.lit("(?:\\.git|/|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"))
    words = "|".join(CONTEXT_WORDS)
    near = F.concat(F.lit(f"(?:{words})[^\\n]{{0,40}}"), escaped, F.lit("|"), escaped, F.lit(f"[^\\n]{{0,40}}(?:{words})"))
    return F.rlike(body, at_start) | F.rlike(body, near)


def text_signals(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Signals of each text: catalogue names at 0.88, likely new slugs at 0.64."""
    tokens = texts.withColumn("low", F.lower("body")).select("session_id", "ord", "low", F.posexplode(text.project_tokens(F.col("body"))).alias("pos", "token"))
    tokens = tokens.withColumn("slug", text.project_slug(F.col("token"))).where((F.col("slug") != "") & ~F.col("slug").isin(*GENERIC_SLUGS))
    matched = tokens.join(known, tokens["slug"] == known["alias"], "left")
    times = F.count(F.lit(1)).over(Window.partitionBy("session_id", "ord", "slug"))
    matched = matched.withColumn("times", times)
    fresh = is_project_slug(F.col("slug")) & ~is_operational(F.col("slug")) & (F.col("token").rlike(NUMBERED) | (F.col("times") >= 2) | has_context(F.col("low"), F.col("token")))
    rows = matched.where(F.col("known").isNotNull() | fresh)
    is_known = F.col("known").isNotNull()
    return rows.groupBy(
        "session_id", "ord", F.coalesce("known", "slug").alias("slug"), F.lit("text").alias("source"),
        F.when(is_known, "known_alias").otherwise("contextual_slug_pattern").alias("signal_type"), F.col("token").alias("matched_text"),
    ).agg(F.min("pos").alias("pos"), F.min_by(F.coalesce("name", "token"), "pos").alias("label"), F.max(F.when(is_known, 0.88).otherwise(0.64)).alias("confidence"))


def cwd_signals(sessions: DataFrame, known: DataFrame) -> DataFrame:
    """Signals of a session's directory: catalogue names at 0.97, numbered segments at 0.90.

    A generic segment counts only as the last one, and where no other segment is
    a project's, be it that it is known, numbered or a child of ``workspace`` or
    ``apps``.
    """
    parts = F.filter(F.transform(F.split(F.coalesce("cwd", F.lit("")), "/"), lambda p: F.trim(p)), lambda p: p != "")
    rows = sessions.select("session_id", F.posexplode(parts).alias("pos", "segment"), F.size(parts).alias("n"), parts.alias("parts"))
    rows = rows.withColumn("under", F.lower(F.try_element_at("parts", F.greatest(F.col("pos"), F.lit(1)))).isin("workspace", "apps") & (F.col("pos") > 0)).drop("parts")
    rows = rows.withColumns({"slug": text.project_slug(F.col("segment")), "numbered": F.col("segment").rlike(NUMBERED)})
    rows = rows.join(known, rows["slug"] == known["alias"], "left")
    usable = (F.col("slug") != "") & ~F.col("slug").isin(*GENERIC_SLUGS) & (F.col("known").isNotNull() | F.col("numbered"))
    rows = rows.withColumn("generic", F.lower("segment").isin(*GENERIC_SEGMENTS))
    stops = ~F.col("generic") & (F.col("known").isNotNull() | F.col("numbered") | F.coalesce(F.col("under"), F.lit(False)))
    rows = rows.withColumn("other", F.max(stops.cast("int")).over(Window.partitionBy("session_id")))
    rows = rows.where(usable & (~F.col("generic") | ((F.col("other") == 0) & (F.col("pos") == F.col("n") - 1))))
    is_known = F.col("known").isNotNull()
    return rows.groupBy(
        "session_id", F.lit(-3).alias("ord"), F.coalesce("known", "slug").alias("slug"), F.lit("cwd").alias("source"),
        F.when(is_known, "project_root_segment").otherwise("numbered_project_segment").alias("signal_type"), F.col("segment").alias("matched_text"),
    ).agg(F.min("pos").alias("pos"), F.min_by(F.coalesce("name", "segment"), "pos").alias("label"), F.max(F.when(is_known, 0.97).otherwise(0.9)).alias("confidence"))


def rank(signals: DataFrame) -> DataFrame:
    """(session_id, slug, label, confidence, sources, signal_types, matched_texts, evidence, rank)."""
    in_order = F.sort_array(F.collect_list(F.struct("ord", "pos", "label", "source", "signal_type", "matched_text")))
    rows = signals.groupBy("session_id", "slug").agg(in_order.alias("x"), F.avg("confidence").alias("mean"), F.count(F.lit(1)).alias("evidence"), F.count_distinct("source").alias("n_sources"))
    bonus = F.when(F.col("n_sources") >= 2, 0.08).otherwise(0.0)
    pick = lambda f: F.array_distinct(F.transform("x", lambda s: s[f]))
    rows = rows.select(
        "session_id", "slug", F.col("x")[0]["label"].alias("label"), F.least(F.lit(1.0), F.round(F.least(F.lit(1.0), F.round("mean", 2)) + bonus, 2)).alias("confidence"),
        pick("source").alias("sources"), pick("signal_type").alias("signal_types"), F.slice(pick("matched_text"), 1, 8).alias("matched_texts"), "evidence",
    )
    order = Window.partitionBy("session_id").orderBy(F.desc("confidence"), F.desc("evidence"), F.collate("slug", "UNICODE"))
    return rows.withColumn("rank", F.row_number().over(order))


def infer(sessions: DataFrame, messages: DataFrame, catalogue: DataFrame) -> DataFrame:
    known = aliases(catalogue)
    return rank(cwd_signals(sessions, known).unionByName(text_signals(observed_texts(sessions, messages), known)))


def attach(sessions: DataFrame, hints: DataFrame) -> DataFrame:
    """Sessions with ``project_hints`` in rank order and the ``primary_project``'s slug and label."""
    one = F.struct("rank", "slug", "label", "confidence", "sources", "signal_types", "matched_texts", "evidence")
    lists = hints.groupBy("session_id").agg(F.sort_array(F.collect_list(one)).alias("project_hints"))
    joined = sessions.join(lists, "session_id", "left")
    first = F.try_element_at("project_hints", F.lit(1))
    return joined.withColumns({"primary_project": first["slug"], "primary_project_label": first["label"]})


def project_rows(sessions: DataFrame) -> DataFrame:
    """The archive's projects: linked slugs with the first session's label and aliases."""
    rows = sessions.select("session_id", F.explode("project_hints").alias("h")).where(F.col("h.confidence") >= LINK_CONFIDENCE)
    # a partial aggregate, as a popular slug has very many sessions
    rows = rows.groupBy(F.col("h.slug").alias("_slug")).agg(F.min_by("h", F.struct("session_id", "h.rank")).alias("h"))
    names = F.concat(F.array("h.slug", "h.label"), F.col("h.matched_texts"))
    slug = F.lower("h.slug")
    kind = F.when(slug.contains("supabase") | slug.contains("infra"), "infra").when(slug.contains("research"), "research").when(slug.contains("personal"), "personal")
    kind = kind.when(slug.contains("lib") | slug.contains("sdk"), "library").otherwise("app")
    return rows.select(
        F.sha2(F.concat(F.lit("project:"), F.col("h.slug")), 256).alias("id"), "h.slug", F.coalesce("h.label", "h.slug").alias("name"), kind.alias("kind"),
        F.slice(F.array_distinct(F.filter(F.transform(names, lambda a: F.lower(F.trim(a))), lambda a: a != "")), 1, 12).alias("aliases"), F.lit("active").alias("status"),
    )
