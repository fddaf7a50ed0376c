"""The registered queries of the engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mnemon import lexicon as L
from mnemon import providers
from mnemon.functions import hashing, numbers, text
from mnemon.operators import archive, candidates, embeddings, projects, promotions, recall, retention, scoring, sessions
from mnemon.plans.stage import materialize
from mnemon.sources import transcripts

Query = Callable[[SparkSession, str], DataFrame]
LEX = L.PROSE
ZONE, DAY = "Asia/Seoul", "2024-01-10"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.from_conversations(_table(spark, sf_dir, "conversations"))[1]


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.from_conversations(_table(spark, sf_dir, "conversations"))[0]


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.summarize(_messages(spark, sf_dir)).withColumn("file_name", F.concat("session_id", F.lit(".jsonl")))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.heuristic(_sessions(spark, sf_dir), LEX)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    scored = _scored(spark, sf_dir).withColumns({"primary_project": none, "primary_project_label": none, "target_date": F.lit(DAY)})
    return candidates.extract(materialize(scored, "scored"), LEX)


# --- sources and text ------------------------------------------------------------


def session_stats(spark: SparkSession, d: str) -> DataFrame:
    s = _sessions(spark, d)
    return s.select("session_id", "message_count", F.col("char_count").cast("long").alias("char_count"), F.size("roles").alias("n_roles"), F.array_join("roles", ",").alias("roles"))


def role_counts(spark: SparkSession, d: str) -> DataFrame:
    return sessions.role_counts(_messages(spark, d))


def transcript_checksum(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d).select("session_id", "transcript_checksum")


def normalized_messages(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    plain = text.normalize(F.col("text"))
    return m.select("session_id", "seq_no", plain.alias("plain"), text.is_low_signal(F.col("text")).alias("low_signal"), text.is_temporary(F.col("text")).alias("temporary"))


def normalized_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select("doc_id", text.normalize(F.col("text")).alias("plain"))
    return docs.select("doc_id", F.md5("plain").alias("plain_md5"), F.length("plain").cast("long").alias("plain_length"))


def meaningful_text(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d).select("session_id", F.array_join("meaningful", " ## ").alias("meaningful"), "sample_user_text")


def truncated_text(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "benchmark").select("item_id", text.truncate(F.col("text"), 100).alias("short"), text.redact_key(F.concat(F.lit("see?key="), F.left("text", F.lit(6)), F.lit(" end"))).alias("redacted"))


def recall_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "benchmark").select("item_id", F.array_join(text.recall_tokens(F.col("text")), " ").alias("tokens"))


def project_slugs(spark: SparkSession, d: str) -> DataFrame:
    p = _table(spark, d, "pages")
    return p.select("page_id", text.project_slug(F.col("url")).alias("slug"), text.file_slug(F.col("url")).alias("file_slug"), F.array_join(text.project_tokens(F.col("url")), " ").alias("tokens"))


# --- scoring -----------------------------------------------------------------------


def automation_flag(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return s.select("session_id", "automation_session", "user_message_ratio")


def heuristic_score(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return s.select("session_id", "raw_score", "importance_score", "importance_band", "promotion_decision", F.array_join("reasons", ",").alias("reasons"), F.array_join("candidate_kinds", ",").alias("kinds"), "retention_class", "summary_short")


def default_lexicon_score(spark: SparkSession, d: str) -> DataFrame:
    """The default lexicon: first messages get one of six endings in its language."""
    endings = ("앞으로 이 규칙을 기억해 memory.md", "supabase 아키텍처 확정", "선호 좋아 다음 단계 runner", "Dream memory 자아", "프로젝트 구현 설계 정리 삭제 보존 archive", "")
    ending = F.element_at(F.array(*map(F.lit, endings)), (F.col("session_id").cast("long") % 6 + 1).cast("int"))
    m = _messages(spark, d).withColumn("text", F.when(F.col("seq_no") == 1, F.concat("text", F.lit(" "), ending)).otherwise(F.col("text")))
    s = scoring.heuristic(sessions.summarize(m).withColumn("file_name", F.lit("f")), L.DEFAULT)
    return s.select("session_id", "raw_score", "importance_score", "importance_band", "promotion_decision", F.array_join("reasons", ",").alias("reasons"), F.array_join("candidate_kinds", ",").alias("kinds"))


def band_decision_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("importance_band", "promotion_decision", "scorer_type").agg(F.count(F.lit(1)).alias("n"))


def retention_plan(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("retention_class").agg(F.count(F.lit(1)).alias("n"), F.sum("importance_score").alias("total_score"))


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Model answers made of each session's id: some broken, some out of range, some incomplete."""
    n = F.col("conv_id")
    body = F.when(n % 7 == 0, F.lit("not json")).when(n % 7 == 1, F.lit('{"importanceScore": 140}')).otherwise(
        F.concat(F.lit('{"importanceScore": '), (n * 13 % 101).cast("string"), F.lit(', "importanceBand": "'), F.when(n % 3 == 0, "high").otherwise("odd"),
                 F.lit('", "candidateKinds": ["'), F.when(n % 2 == 0, "todo").otherwise("thing"), F.lit('"], "summary": "s'), n.cast("string"), F.lit('", "signals": {"userPreference": '), F.when(n % 4 == 0, "true").otherwise("false"), F.lit("}}"))
    )
    return _table(spark, d, "conversations").select("conv_id").distinct().select(F.col("conv_id").cast("string").alias("session_id"), body.alias("answer"))


def llm_answers(spark: SparkSession, d: str) -> DataFrame:
    c = scoring.check_answers(_answers(spark, d))
    return c.select("session_id", "importance_score", "importance_band", "promotion_decision", F.array_join("candidate_kinds", ",").alias("kinds"), F.array_join("reasons", ",").alias("reasons"), "summary", F.col("error").isNotNull().alias("failed"))


def llm_fallback(spark: SparkSession, d: str) -> DataFrame:
    s = scoring.with_model(_scored(spark, d), scoring.check_answers(_answers(spark, d)))
    return s.groupBy("scorer_type", "promotion_decision").agg(F.count(F.lit(1)).alias("n"), F.sum("importance_score").cast("long").alias("total_score"))


# --- candidates and decisions --------------------------------------------------------


def candidate_explode(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("session_id", "kind", "title", "summary", "confidence_score", "novelty_score", "actionability_score")


def candidate_gate(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("session_id", "kind", "promotion_decision", "decision")


def effective_decision(spark: SparkSession, d: str) -> DataFrame:
    s = materialize(_scored(spark, d), "scored")
    none = F.lit(None).cast("string")
    made = candidates.extract(s.withColumns({"primary_project": none, "primary_project_label": none}), LEX)
    return candidates.effective_decisions(s, made).select("session_id", "promotion_decision", "effective_decision")


def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("session_id", "kind", "content_fingerprint")


def source_message_ids(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d).select("session_id", F.array_join("source_message_ids", ",").alias("ids"))


def purge_plan(spark: SparkSession, d: str) -> DataFrame:
    return retention.purge_plan(_scored(spark, d).withColumn("effective_decision", F.col("promotion_decision"))).select("session_id", "retention_class", "action", "reason")


def purge_histogram(spark: SparkSession, d: str) -> DataFrame:
    return retention.histogram(retention.purge_plan(_scored(spark, d).withColumn("effective_decision", F.col("promotion_decision"))))


# --- promotions ----------------------------------------------------------------------


def _promotions(spark: SparkSession, d: str) -> DataFrame:
    return promotions.promote(_candidates(spark, d).withColumn("decision", F.lit("promote")), F.lit(DAY).cast("timestamp"))


def promotion_route(spark: SparkSession, d: str) -> DataFrame:
    return _promotions(spark, d).select("session_id", "kind", "target_file", "target_section", "promotion_mode")


def promotion_route_projects(spark: SparkSession, d: str) -> DataFrame:
    """Items as candidates of every kind (and one unknown), half of them with a project."""
    n = F.col("item_id")
    kind = F.element_at(F.array(*map(F.lit, (*L.KINDS, "other"))), (n % 8 + 1).cast("int"))
    c = _table(spark, d, "benchmark").select("item_id", kind.alias("kind"), F.lit("t").alias("title"), F.when(F.floor(n / 8) % 2 == 0, F.concat(F.lit("Proj "), (n % 3).cast("string"))).alias("primary_project"), F.lit(None).cast("string").alias("primary_project_label"))
    return promotions.route(c, "/m/").select("item_id", "kind", "target_file", "target_section", "promotion_mode")


def entry_slug(spark: SparkSession, d: str) -> DataFrame:
    return _promotions(spark, d).select("session_id", "kind", "entry_slug")


def promotion_block(spark: SparkSession, d: str) -> DataFrame:
    return _promotions(spark, d).select("session_id", "kind", "content_markdown")


def entry_changes(spark: SparkSession, d: str) -> DataFrame:
    """Items as entries, by first letter: old files have those with an "er", a batch brings those with a "th", changed where they have a "st"."""
    b = _table(spark, d, "benchmark").select(F.lower(F.left("text", F.lit(1))).alias("target_file"), F.col("item_id").cast("string").alias("entry_slug"), F.col("text").alias("content_markdown"))
    old = b.where("content_markdown like '%er%'")
    new = b.where("content_markdown like '%th%'").withColumn("content_markdown", F.when(F.col("content_markdown").like("%st%"), F.concat("content_markdown", F.lit("!"))).otherwise(F.col("content_markdown")))
    return promotions.entry_changes(old, new).select("target_file", "entry_slug", "action")


# --- embeddings and recall ---------------------------------------------------------------


def embedding_select(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d)
    return c.where(embeddings.is_selected(decisions=("promote", "defer", "archive_only"))).select("session_id", "kind", embeddings.payload_text().alias("payload"), F.array_join(embeddings.selected_because(), ",").alias("because"))


def embedding_hash(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select("doc_id", hashing.sha256(F.col("text")).alias("content_hash"))


def embedding_rows(spark: SparkSession, d: str) -> DataFrame:
    """Items as documents; embeddings of the same number as vectors, but for those of label 0."""
    rows = _table(spark, d, "benchmark").select(
        F.lit("candidate").alias("object_type"), F.col("item_id").cast("string").alias("object_id"), F.lit("s").alias("session_id"), F.lit(None).cast("string").alias("project"),
        F.lit("promote").alias("decision"), "text", F.array(F.lit("candidate_memory_unit")).alias("selected_because"),
    )
    vectors = _table(spark, d, "embeddings").where("label <> 0").select(F.col("vec_id").cast("string").alias("source_key"), F.col("embedding").alias("vector"))
    return embeddings.embedding_rows(embeddings.documents(rows), vectors).select("source_type", "source_key", "content_hash", "dimensions", "status")


def recall_lexical_topk(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select(F.format_string("%012d", "doc_id").alias("ref"), F.col("text").alias("content"))
    asked = _table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return recall.batch_overlap(docs, asked, 5)


def recall_corpus(spark: SparkSession, d: str) -> DataFrame:
    """Documents as candidates (German ones rejected) and items as promotions."""
    n = F.col("doc_id")
    c = _table(spark, d, "documents").select(
        F.format_string("%012d", n).alias("content_fingerprint"), F.when(F.col("lang") == "de", "reject").otherwise("defer").alias("decision"), F.concat(F.lit("t"), n).alias("title"), F.left("text", F.lit(80)).alias("summary"),
        F.lit(None).cast("string").alias("summary_short"), F.when(n % 2 == 0, F.col("source")).alias("primary_project"), F.lit("fact").alias("kind"), (F.col("n_chars") % 11 / 10).alias("confidence_score"),
        (F.col("n_chars") % 101).alias("importance_score"), F.lit("s").alias("session_id"),
    )
    p = _table(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("entry_slug"), F.lit("entry").alias("title"), F.col("text").alias("content_markdown"), F.concat(F.lit("/m/memory/projects/p"), "item_id", F.lit(".md")).alias("target_file"),
        F.lit("decision").alias("kind"), F.lit("s").alias("session_id"),
    )
    return recall.corpus(c, p).select("ref", "source_type", "title", "content", "project", "kind", "confidence", "importance")


def recall_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select(
        F.format_string("document:%012d", "doc_id").alias("ref"), F.when(F.col("lang") == "fr", "promotion").otherwise("candidate").alias("source_type"), F.lit("t").alias("title"),
        F.col("text").alias("content"), F.when(F.col("lang") == "en", F.col("source")).alias("project"), F.when(F.col("lang") == "de", "operation_rule").otherwise("fact").alias("kind"),
        (F.col("n_chars") % 11 / 10).alias("confidence"),
    )
    tokens = text.recall_tokens(F.lit("That and the thing with erthe oned from tion"))
    return recall.score(docs, tokens, F.array(F.lit("src1"), F.lit("src3"))).select("ref", "metadata_score", "keyword_score", "total_score", F.array_join("why", ";").alias("why"))


def _near(spark: SparkSession, d: str, k: int) -> DataFrame:
    v = _table(spark, d, "embeddings").select(F.format_string("document:%012d", "vec_id").alias("ref"), F.col("embedding").alias("vector"))
    query = v.where("ref = 'document:000000000000'").select("vector").first()  # one vector
    return recall.vector_top_k(v, F.array(*(F.lit(float(x)) for x in query[0])), k)


def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d, 20)


def recall_merge(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select(
        F.format_string("document:%012d", "doc_id").alias("ref"), F.lit("candidate").alias("source_type"), F.lit("t").alias("title"), F.col("text").alias("content"),
        F.lit(None).cast("string").alias("project"), F.lit("fact").alias("kind"), F.lit(0.0).alias("confidence"),
    )
    keyword = recall.score(docs, text.recall_tokens(F.lit("That and the thing with erthe oned from tion")), F.array().cast("array<string>"))
    return recall.merge(keyword, _near(spark, d, 20), None).select("ref", "source_type", "metadata_score", "keyword_score", "semantic_score", "total_score")


# --- projects, archive, windows ------------------------------------------------------------


def project_hints(spark: SparkSession, d: str) -> DataFrame:
    """Pages as sessions: the URL's parts as a directory, the page's number as a file name."""
    p = _table(spark, d, "pages")
    cwd = F.concat(F.lit("/data/workspace/"), F.format_string("%02d_", F.pmod("page_id", F.lit(100))), F.regexp_replace(F.split("url", "/")[2], r"[^a-z0-9-]+", "-"))
    s = p.select(F.col("page_id").cast("string").alias("session_id"), F.lit("").alias("sample_user_text"), F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("file_name"), cwd.alias("cwd"))
    said = p.select(F.col("page_id").cast("string").alias("session_id"), F.lit(1).alias("seq_no"), F.lit("user").alias("role"), F.col("url").alias("text"))
    known = p.sparkSession.createDataFrame([("spam-farm", "Spam Farm", ["spam", "farm"]), ("cheap-pills", "Pills", [])], projects.CATALOGUE)
    return projects.infer(s, said, known).select("session_id", "slug", "label", "confidence", "evidence", "rank")


def projects_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Documents as sessions whose hint is their source; of each project the first session's label and texts count."""
    hint = F.struct(F.lit(1).alias("rank"), F.col("source").alias("slug"), F.col("lang").alias("label"), F.lit(0.9).alias("confidence"), F.array(F.upper("lang"), F.concat("source", F.lit("-x"))).alias("matched_texts"))
    s = _table(spark, d, "documents").select(F.format_string("%012d", "doc_id").alias("session_id"), F.array(hint).alias("project_hints"))
    return projects.project_rows(s).select("slug", "name", "kind", F.array_join("aliases", ",").alias("aliases"), "status")


def candidate_project_link(spark: SparkSession, d: str) -> DataFrame:
    """Documents as candidates of three hints; of one slug the first that is sure enough counts."""
    hints = F.array(*(F.struct(slug.alias("slug"), c.cast("double").alias("confidence")) for slug, c in ((F.col("source"), F.col("n_chars") % 10 / 10), (F.col("lang"), F.lit(0.9)), (F.col("source"), F.lit(0.95)))))
    docs = _table(spark, d, "documents")
    one, sid = (F.lit("fact").alias("kind"), F.lit("t").alias("title")), F.concat(F.lit("s"), "doc_id")
    made = docs.select(F.col("doc_id").cast("string").alias("session_id"), *one, hints.alias("project_hints"))
    kept = docs.select(F.col("doc_id").cast("string").alias("external_session_id"), sid.alias("id"))
    archived = docs.select(sid.alias("session_id"), *one, F.concat(F.lit("k"), "doc_id").alias("id"))
    slugs = docs.select(F.col("source").alias("slug")).union(docs.select("lang")).distinct()
    return archive.candidate_project_rows(made, kept, archived, slugs.withColumn("id", F.concat(F.lit("p"), "slug")))


def session_project_link(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("session_id"), F.col("source").alias("primary_project"), F.array(
        F.struct(F.lit(1).alias("rank"), F.col("source").alias("slug"), (F.col("n_chars") % 10 / 10).alias("confidence")), F.struct(F.lit(2).alias("rank"), F.col("lang").alias("slug"), F.lit(0.9).alias("confidence")),
    ).alias("project_hints"))
    archived = docs.select(F.col("session_id").alias("external_session_id"), F.concat(F.lit("s"), "session_id").alias("id"))
    catalogue = _table(spark, d, "documents").select(F.col("source").alias("slug")).distinct().withColumn("id", F.concat(F.lit("p"), "slug"))
    return archive.session_project_rows(docs, archived, catalogue)


def archive_upsert(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders")
    old = o.where("o_orderstatus <> 'F'").select("o_orderkey", F.lit("old").alias("version"), "o_totalprice")
    batch = o.where("o_orderpriority like '1%'").select("o_orderkey", F.lit("new").alias("version"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return archive.upsert(old, batch.unionByName(batch), ("o_orderkey",))


def archive_constraints(spark: SparkSession, d: str) -> DataFrame:
    c = _table(spark, d, "conversations")
    rows = c.select(F.col("conv_id").cast("string").alias("session_id"), F.lit(None).cast("string").alias("external_message_id"), (F.floor(F.col("turn") / 2)).cast("int").alias("seq_no"), F.concat("role", F.when(F.col("turn") >= 6, "x").otherwise("")).alias("role"))
    parents = {"sessions": c.where("turn >= 3").select(F.col("conv_id").cast("string").alias("id")).distinct()}
    return archive.violations("messages", rows, parents)


def _archived(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(decided sessions, candidates), each kept."""
    none = F.lit(None).cast("string")
    scored = materialize(_scored(spark, d).withColumns({"primary_project": none, "primary_project_label": none, "target_date": F.lit(DAY)}), "scored")
    made = materialize(candidates.extract(scored, LEX), "candidates")
    return candidates.effective_decisions(scored, made), made


def archive_jobs(spark: SparkSession, d: str) -> DataFrame:
    return archive.job_rows(_archived(spark, d)[0], F.lit(DAY)).withColumn("job_date", F.col("job_date").cast("string"))


def archive_sessions(spark: SparkSession, d: str) -> DataFrame:
    return archive.session_rows(_archived(spark, d)[0], F.lit(DAY))


def archive_candidates(spark: SparkSession, d: str) -> DataFrame:
    final, made = _archived(spark, d)
    rows = archive.candidate_rows(made, archive.session_rows(final, F.lit(DAY)))
    return rows.withColumns({"reason_codes": F.array_join("reason_codes", ","), "source_message_ids": F.array_join("source_message_ids", ",")})


def archive_promotions(spark: SparkSession, d: str) -> DataFrame:
    final, made = _archived(spark, d)
    kept = archive.session_rows(final, F.lit(DAY))
    promoted = promotions.promote(made.withColumn("decision", F.lit("promote")), F.lit(DAY).cast("timestamp"))
    return archive.promotion_rows(promoted, kept, archive.candidate_rows(made, kept)).drop("content_markdown")


def cwd_signals(spark: SparkSession, d: str) -> DataFrame:
    """Numbered segments of directories made of URLs."""
    p = _table(spark, d, "pages")
    parts = F.split("url", "/")
    cwd = F.concat(F.lit("/data/workspace/"), F.format_string("%02d_", F.pmod("page_id", F.lit(100))), F.regexp_replace(parts[2], "[^a-z0-9-]+", "-"), F.lit("/"), parts[3])
    s = p.select(F.col("page_id").cast("string").alias("session_id"), cwd.alias("cwd"))
    known = projects.aliases(projects.empty_catalogue(spark))
    return projects.cwd_signals(s, known).select("session_id", "slug", "label", "signal_type", "matched_text", "confidence")


def promotion_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The promoted entries of the embedding corpus."""
    made = _candidates(spark, d)
    promoted = promotions.promote(made.withColumn("decision", F.lit("promote")), F.lit(DAY).cast("timestamp"))
    return embeddings.payloads(made.where("decision = 'none'"), promoted).select("object_type", "object_id", "session_id", "project", "decision")


def archive_maps(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return s.select("session_id", archive.band(F.col("importance_band")).alias("band"), archive.channel(F.concat(F.when(F.length("session_id") % 2 == 0, "topic-").otherwise(""), "session_id")).alias("channel"),
                    archive.promotion_status(F.col("promotion_decision")).alias("status"))


def archive_messages(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    ids = m.select(F.col("session_id").alias("external_session_id")).distinct().withColumn("id", F.concat(F.lit("s"), "external_session_id"))
    return archive.message_rows(m, ids).select("session_id", "seq_no", "role", "char_count", "sensitivity")


def row_count_audit(spark: SparkSession, d: str) -> DataFrame:
    t = {n: _table(spark, d, n) for n in ("documents", "benchmark", "conversations")}
    return archive.audit(t, {"documents": t["documents"].where("lang = 'en'"), "benchmark": t["benchmark"]})


def session_overview(spark: SparkSession, d: str) -> DataFrame:
    o = _table(spark, d, "orders")
    s = o.select(F.col("o_orderkey").cast("string").alias("id"), archive.surrogate("job", F.to_date("o_orderdate").cast("string")).alias("job_id"))
    jobs = o.select(F.to_date("o_orderdate").alias("job_date")).distinct().where("dayofmonth(job_date) <= 20").withColumn("status", F.lit("archiving"))
    return archive.overview(s, jobs).select("id", F.col("job_date").cast("string").alias("job_date"), "job_status")


def day_window_events(spark: SparkSession, d: str) -> DataFrame:
    start, end = numbers.day_window(F.lit(DAY), ZONE)
    e = _table(spark, d, "events").withColumn("last_message_at", F.col("ts"))
    return transcripts.in_window(e, start, end).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.min("event_id").alias("first_event"))


def purge_after_events(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events")
    kind = F.when(F.col("event_type") == "click", "ephemeral").otherwise("standard")
    due = retention.purge_after(F.col("ts"), kind)
    return e.groupBy(kind.alias("kind"), F.to_date(due).cast("string").alias("due")).agg(F.count(F.lit(1)).alias("n"))


def report_counts(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return s.agg(F.count(F.lit(1)).alias("sessions"), *(F.count_if(F.col("promotion_decision") == x).alias(x) for x in L.DECISIONS), F.sum(F.size("candidate_kinds")).cast("long").alias("kinds"))


def local_vectors(spark: SparkSession, d: str) -> DataFrame:
    b = _table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("object_id"), "text")
    return providers.embed(b).select("source_key", F.size("vector").alias("dimensions"))


QUERIES: tuple[Query, ...] = (
    session_stats, role_counts, transcript_checksum, normalized_messages, normalized_documents, meaningful_text, truncated_text, recall_tokens, project_slugs, automation_flag, heuristic_score,
    band_decision_histogram, retention_plan, llm_answers, llm_fallback, candidate_explode, candidate_gate, effective_decision, fingerprint, source_message_ids, purge_plan, purge_histogram,
    promotion_route, entry_slug, promotion_block, entry_changes, embedding_select, embedding_hash, embedding_rows, recall_lexical_topk, recall_scores, cosine_topk, recall_merge, project_hints,
    projects_first_wins, session_project_link, archive_upsert, archive_constraints, archive_maps, archive_messages, row_count_audit, session_overview, day_window_events, purge_after_events,
    default_lexicon_score, promotion_route_projects, recall_corpus, candidate_project_link, report_counts, local_vectors, archive_jobs, archive_sessions, archive_candidates, archive_promotions, cwd_signals, promotion_payloads,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}
