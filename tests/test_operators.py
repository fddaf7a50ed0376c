import collections
import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from mnemon import lexicon as L
from mnemon import providers, schemas
from mnemon.functions import hashing, text
from mnemon.operators import archive, candidates, embeddings, projects, promotions, recall, retention, scoring
from mnemon.plans import nightly
from mnemon.sources import transcripts


@pytest.fixture(scope="module")
def night(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sessions")
    lines = [
        {"type": "session", "id": "s-1", "timestamp": "2026-03-13T01:00:00.000Z", "cwd": "/x/workspace/05_thing"},
        {"type": "message", "id": "u1", "timestamp": "2026-03-13T01:01:00.000Z", "message": {"role": "user", "content": [{"text": "앞으로 프로젝트 구현 runner 정리하자 진행"}]}},
        {"type": "message", "timestamp": "", "message": {"role": "", "timestamp": "2026-03-13T01:02:00.000Z", "content": [{"content": "좋아"}, {"text": 5}, {"text": ""}]}},
    ]
    (folder / "nightly-run.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\nnull\n0\n\n", encoding="utf-8")
    (folder / "a.deleted.jsonl").write_text(json.dumps(lines[0]))
    late = [{"type": "message", "id": "x", "timestamp": "2026-03-20T00:00:00Z", "message": {"role": "user", "content": "no array"}}]
    (folder / "late.jsonl").write_text(json.dumps(late[0]))
    headers, messages = transcripts.parse_sessions(transcripts.read_lines(spark, str(folder)))
    return headers, messages, nightly.build(headers, messages, dt.date(2026, 3, 13), "Asia/Seoul", root="/mem", embed=providers.local_embed)


def test_transcripts(night):
    headers, messages, _ = night
    assert sorted(r["session_id"] for r in headers.collect()) == ["s-1", "x"]  # without a header the first line names the session
    rows = [tuple(r) for r in messages.where("session_id = 's-1'").orderBy("seq_no").select("seq_no", "message_id", "role", "ts", "text").collect()]
    assert rows[0][:3] == (1, "u1", "user")
    assert rows[1] == (2, "nightly-run.jsonl:2", "unknown", "2026-03-13T01:02:00.000Z", "좋아")
    assert messages.where("session_id = 'x'").first()["text"] == ""


def test_night(night):
    report = night[2]
    s = report.sessions.first()
    # explicit 25, decided 15, preference 15, actionable 10, three medium patterns 6
    assert (s["session_id"], s["importance_score"], s["importance_band"], s["promotion_decision"]) == ("s-1", 71, "high", "promote")
    assert s["candidate_kinds"] == ["project_state", "decision"] and s["retention_class"] == "promoted"
    hints = {h["slug"]: h["confidence"] for h in s["project_hints"]}
    assert hints == {"05_thing": 0.9, "nightly-run": 0.64}
    kinds = {c["kind"]: c for c in report.candidates.collect()}
    assert kinds["decision"]["novelty_score"] == 60 and kinds["project_state"]["actionability_score"] == 90 and kinds["decision"]["decision"] == "promote"
    assert report.counts().first()["vectors"] == 4
    assert {n: t.count() for n, t in report.archive.items()} == {"jobs": 1, "sessions": 1, "projects": 1, "session_projects": 1, "messages": 2, "candidates": 2, "candidate_projects": 2, "promotions": 2}
    for name, table in report.archive.items():
        assert archive.violations(name, table, report.archive).count() == 0
    assert report.promotions.where("kind = 'decision'").first()["target_file"] == "/mem/memory/projects/05_thing.md"


def _scored(spark, text, users=1, others=1, cwd=None):
    row = [("s", text, users + others, users, others, 0, 0, cwd, "sample text")]
    return scoring.heuristic(spark.createDataFrame(row, "session_id string, combined_text string, message_count long, n_user long, n_assistant long, n_system long, n_tool long, cwd string, sample_user_text string")).first()


@pytest.mark.parametrize("text,users,others,score,decision", [
    ("앞으로 supabase 하자 선호 sql 자아 archive promote retention 프로젝트 구현 설계", 4, 4, 100, "promote"),
    ("앞으로 supabase 하자 선호", 1, 9, 34, "archive_only"), ("앞으로 supabase 하자 선호 sql", 3, 17, 34, "archive_only"),
    ("nothing here", 1, 1, 0, "reject"), ("기억해 archive", 1, 1, 27, "archive_only"), ("기억해 sql", 1, 1, 35, "defer"), ("앞으로 supabase 하자", 1, 1, 60, "promote"),
])
def test_scores(spark, text, users, others, score, decision):
    row = _scored(spark, text, users, others)
    assert (row["importance_score"], row["promotion_decision"]) == (score, decision)


def test_low_ratio_cap(spark):
    # one in six speaks, but not four times as many answers of known roles
    row = [("s", "앞으로 supabase 하자 선호 sql", 12, 2, 3, 0, 0, None, "x")]
    got = scoring.heuristic(spark.createDataFrame(row, "session_id string, combined_text string, message_count long, n_user long, n_assistant long, n_system long, n_tool long, cwd string, sample_user_text string")).first()
    assert (got["user_message_ratio"], got["importance_score"], got["importance_band"]) == (0.17, 49, "medium")


@pytest.mark.parametrize("kind,text,base,automated,ratio,expected", [
    ("decision", "이대로 확정 하자 정말로", "promote", False, 0.5, "promote"), ("decision", "이대로 확정 하자", "promote", True, 0.5, "archive_only"), ("decision", "이대로 확정 하자", "promote", False, 0.1, "archive_only"),
    ("decision", "응응", "promote", False, 0.5, "archive_only"), ("decision", "the path here 확정", "promote", False, 0.5, "archive_only"), ("decision", "__cron 확정", "promote", False, 0.5, "archive_only"),
    ("operation_rule", "no such sign", "promote", False, 0.5, "archive_only"), ("operation_rule", "반드시 지켜", "reject", False, 0.5, "reject"), ("project_state", "연결 상태 확인", "archive_only", False, 0.5, "archive_only"),
    ("fact", "항상 중요한 기록", "defer", False, 0.5, "archive_only"), ("fact", "항상 중요한 기록", "promote", False, 0.5, "promote"), ("user_preference", "anything at all", "defer", False, 0.5, "defer"),
])
def test_gates(spark, kind, text, base, automated, ratio, expected):
    row = spark.createDataFrame([(kind, text, base, automated, ratio, ["x"])], "kind string, primary_text string, promotion_decision string, automation_session boolean, user_message_ratio double, reasons array<string>")
    assert row.select(candidates.gate()).first()[0] == expected


@pytest.mark.parametrize("answer,score,band,decision,kinds,failed", [
    ('{"importanceScore": 80}', 80, "critical", "promote", ["fact"], False), ('{"importanceScore": 40.5, "importanceBand": "low", "candidateKinds": ["todo", "odd"]}', 41, "low", "defer", ["todo"], False),
    ('{"importanceScore": 101}', None, None, None, None, True), ("{}", None, None, None, None, True), ("oops", None, None, None, None, True),
])
def test_model_answers(spark, answer, score, band, decision, kinds, failed):
    got = scoring.check_answers(spark.createDataFrame([("s", answer)], "session_id string, answer string")).first()
    assert (got["importance_score"], got["importance_band"], got["promotion_decision"], got["candidate_kinds"], got["error"] is not None) == (score, band, decision, kinds, failed)


def _hints(spark, cwd, texts, file_name="", known=()):
    s = spark.createDataFrame([("s", texts[0] if texts else "", file_name, cwd)], "session_id string, sample_user_text string, file_name string, cwd string")
    m = spark.createDataFrame([("s", i + 1, "user", t) for i, t in enumerate(texts)], "session_id string, seq_no int, role string, text string")
    catalogue = spark.createDataFrame(list(known), projects.CATALOGUE)
    return {r["slug"]: (r["confidence"], r["rank"]) for r in projects.infer(s, m, catalogue).collect()}


def test_projects(spark):
    got = _hints(spark, "/home/apps/07_shop/scripts/tests", ["work on shop now"], known=[("07_shop", "07_shop", ["shop"])])
    assert got == {"07_shop": (1.0, 1)}
    assert _hints(spark, None, ["did a no-op and a topic-sample-promotion"]) == {}
    assert _hints(spark, None, ["(aurora-kit) then (aurora-kit)"]) == {"aurora-kit": (0.64, 1)}
    assert _hints(spark, None, ["(lone-kit)"]) == {} and _hints(spark, None, ["the repo (lone-kit)"]) == {"lone-kit": (0.64, 1)}


def test_markdown(tmp_path):
    root = str(tmp_path)
    assert "MEMORY.md" in promotions.bootstrap(root, dry_run=False) and promotions.bootstrap(root, dry_run=False) == []
    file = str(tmp_path / "memory/projects/x.md")
    entry = lambda s: f"<!-- {promotions.MARK} e -->\n### t\n- Summary: {s}\n<!-- /{promotions.MARK} e -->"
    assert promotions.write_entry(file, "## Snapshot", "e", entry("one"), root, 1) == (True, "append")
    first = open(file).read()
    assert first.startswith("# x\n\n## Snapshot\n") and promotions.write_entry(file, "## Snapshot", "e", entry("one"), root, 2) == (False, "replace") and open(file).read() == first
    assert promotions.write_entry(file, "## Snapshot", "e", entry("two"), root, 3) == (True, "replace")
    assert open(file).read().count(f"<!-- {promotions.MARK} e -->") == 1 and "two" in open(file).read()
    other = entry("three").replace(" e -->", " f -->")
    assert promotions.write_entry(file, "## Important Decisions", "f", other, root, 4) == (True, "merge")
    assert len(list((tmp_path / "memory/.snapshots").iterdir())) == 2


def test_recall_and_embeddings(spark):
    c = spark.createDataFrame([
        ("s1", "c1", "operation_rule", "operation_rule: embed path", "Operation rule: keep embedding path stable", "promote", 0.9, 90, "kit", ["explicitMemorySignal"], "[high] summary"),
        ("s1", "c2", "fact", "fact: other", "Fact: other things altogether", "defer", 0.4, 40, "zoo", [], "[low] summary"),
        ("s1", "c3", "decision", "decision: embed", "Decision: embed all the texts", "reject", 0.1, 10, None, [], ""),
    ], "session_id string, content_fingerprint string, kind string, title string, summary string, decision string, confidence_score double, importance_score long, primary_project string, reasons array<string>, summary_short string")
    p = spark.createDataFrame([("s1", "kit-rule", "operation_rule", "rule", "memory/projects/kit.md", "## Snapshot", "merge", "embed path entry")], "session_id string, entry_slug string, kind string, title string, target_file string, target_section string, promotion_mode string, content_markdown string")
    known = spark.createDataFrame([("kit", "kit", [])], projects.CATALOGUE)
    got = recall.recall("the kit embed path", c, p, 5, known)
    rows = {r["ref"]: r.asDict() for r in got.items.collect()}
    # 40 project + 20 promotion + 10 kind + 10 confidence, two words
    assert rows["promotion:kit-rule"]["total_score"] == 80 + 24 and rows["candidate:c1"]["metadata_score"] == 59 and "candidate:c3" not in rows
    assert "candidate:c2" not in rows  # -10 for another project and +4 of confidence leave nothing
    other = {r["ref"]: r for r in recall.recall("the kit other things", c, p, 5, known).items.collect()}["candidate:c2"]
    assert other["why"][0] == "project_mismatch:zoo" and other["total_score"] == -10 + 4 + 24 and other["kind"] == "fact" and sorted(other["audit"]["matched_tokens"]) == ["other", "things"]
    assert got.status == "stub" and {r["ref"] for r in got.seeds.collect()} == {"candidate:c1", "promotion:kit-rule"} and got.project_hints == ["kit"]
    assert recall.recall("  ", c, p).steps == ["empty_query"] and recall.recall("x", c, p, provider=recall.Provider("odd")).status == "unavailable"
    assert recall.recall("x", c, p, provider=recall.Provider("vectors")).status == "error"
    vectors = spark.createDataFrame([("candidate:c1", [1.0, 0.0]), ("promotion:kit-rule", [0.6, 0.8]), ("candidate:c2", [1.0, 0.0])], "ref string, vector array<float>")
    near = recall.recall("zebra", c, p, 3, provider=recall.Provider("vectors", vectors, [1.0, 0.0]))
    alone = {r["ref"]: r for r in near.items.collect()}["promotion:kit-rule"]
    assert near.trace()["filters"]["least_similarity"] == 0.1 and len(near.trace()["scoring"]) == 4 and (alone["project"], alone["kind"]) == ("kit", "operation_rule")
    assert near.status == "ok" and [(r["ref"], r["semantic_score"]) for r in near.items.where("semantic_score > 0").collect()] == [("candidate:c1", 100), ("promotion:kit-rule", 60)]
    pay = embeddings.payloads(c, p)
    assert [(r["object_type"], r["object_id"], r["project"]) for r in pay.collect()] == [("candidate", "c1", "kit"), ("promotion", "kit-rule", "kit")]
    docs = embeddings.documents(pay)
    assert docs.select("payload_fingerprint").collect() == embeddings.documents(pay).select("payload_fingerprint").collect()
    rows = embeddings.embedding_rows(docs, spark.createDataFrame([("c1", [1.0])], "source_key string, vector array<float>")).collect()
    assert sorted((r["source_key"], r["status"], r["dimensions"]) for r in rows) == [("c1", "embedded", 1), ("kit-rule", "pending", None)]


def test_upsert_and_purge(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k int, v string")
    once = archive.upsert(old, batch, ("k",))
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, archive.upsert(once, batch, ("k",)).collect()))
    s = spark.createDataFrame([("a", "promoted", "promote"), ("b", "ephemeral", "reject"), ("c", "other", "archive_only"), ("d", "other", "defer")], "session_id string, retention_class string, promotion_decision string").withColumn("effective_decision", F.lit(None).cast("string"))
    assert {r["session_id"]: r["action"] for r in retention.purge_plan(s).collect()} == {"a": "keep", "b": "purge_candidate", "c": "purge_candidate", "d": "review"}
    assert retention.purge_plan(s, False).count() == 0


def test_fingerprints_that_meet(spark):
    """The rolling hash takes Bb and CA for one: two sessions of one text share a fingerprint, and keep candidates of their own."""
    made = spark.createDataFrame([("xBb", "fact", "fact: t"), ("xCA", "fact", "fact: t")], "session_id string, kind string, title string")
    made = made.withColumns({"content_fingerprint": hashing.fingerprint(F.concat_ws("|", "session_id", "kind", "title")), "project_hints": F.array(F.struct(F.lit("p").alias("slug"), F.lit(0.9).alias("confidence")))})
    assert made.select("content_fingerprint").distinct().count() == 1
    kept = made.select(F.col("session_id").alias("external_session_id"), F.concat(F.lit("s-"), "session_id").alias("id"))
    rows = made.select(F.concat(F.lit("c-"), "session_id").alias("id"), F.concat(F.lit("s-"), "session_id").alias("session_id"), "kind", "title", "content_fingerprint")
    promoted = made.withColumns({c: F.lit("x") for c in ("target_file", "target_section", "entry_slug", "promotion_mode", "content_markdown")})
    assert sorted((r["session_id"], r["candidate_id"]) for r in archive.promotion_rows(promoted, kept, rows).collect()) == [("s-xBb", "c-xBb"), ("s-xCA", "c-xCA")]
    links = archive.candidate_project_rows(made, kept, rows, spark.createDataFrame([("p", "1")], "slug string, id string"))
    assert sorted(r["candidate_id"] for r in links.collect()) == ["c-xBb", "c-xCA"]


def test_texts_are_split_once(spark):
    """Scores filter on a sum that needs the words: the words are found once a row, in generated code, as before by splitting and filtering."""
    odd = ["", None, "a", "a b", "that-and THE/_thing", "K İx ẞß the\u0301 with", "가 나다 한글x 힣힣 ㄱㄴ", "😀the😀and😀", "--", "from\tthe\nfrom\u00a0tion", "x" * 300, "éthe theé"]
    items = spark.createDataFrame([(str(i), "candidate", "t", c, None, "fact", 0.0) for i, c in enumerate(odd)], "ref string, source_type string, title string, content string, project string, kind string, confidence double")
    split = F.filter(F.split(F.lower(F.coalesce("content", F.lit(""))), "[^a-z0-9가-힣_/-]+"), lambda t: F.length(t) >= 2)
    assert items.where(~text.recall_tokens(F.col("content")).eqNullSafe(split)).count() == 0
    scored = recall.score(items, text.recall_tokens(F.lit("That and the thing with from")), F.array().cast("array<string>"))
    assert {r["ref"]: r["keyword_score"] for r in scored.collect()} == {r: 12 * n for r, n in _brute(odd, ("that", "and", "the", "thing", "with", "from")).items()}
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_batch_overlap(spark, monkeypatch):
    """Repeated refs and query ids count together, over the borders of slices; pairs of queries and refs are never aggregated in Spark."""
    monkeypatch.setattr(recall, "COUNTS", 12)
    words, draw = [f"w{i}" for i in range(12)], random.Random(3)
    say = lambda n: " ".join(draw.choices(words, k=n))
    docs = [(f"r{draw.randrange(60):02d}" if i % 3 else "same", say(draw.randrange(9))) for i in range(200)] + [("none", None), ("zz", "other words")]
    asked = [(7, say(5)), (None, say(3)), (7, say(4)), (2, "w1"), (3, "nobody says this"), (9, None), (4, say(12))]
    want = {}
    for q in {q for q, _ in asked}:
        sums = collections.Counter()
        for ref, content in docs:
            sums[ref] += sum(len(set((content or "").split()) & set((t or "").split())) for i, t in asked if i == q)
        ranked = sorted((-n, ref) for ref, n in sums.items() if n)[:4]
        want |= {(q, ref): (-n, i + 1) for i, (n, ref) in enumerate(ranked)}
    a, b = spark.createDataFrame(docs, "ref string, content string").repartition(5), spark.createDataFrame(asked, "query_id long, text string")
    top = recall.batch_overlap(a, b, 4)
    assert {(r["query_id"], r["ref"]): (r["overlap"], r["rank"]) for r in top.collect()} == want
    assert top.dtypes == [("query_id", "bigint"), ("ref", "string"), ("overlap", "bigint"), ("rank", "int")]
    assert "Aggregate" not in top._jdf.queryExecution().optimizedPlan().toString()
    assert recall.batch_overlap(a, b.limit(0), 4).count() == recall.batch_overlap(a.limit(0), b, 4).count() == 0


def _brute(contents, words):
    """Words in common by item, of those that have any."""
    found = {str(i): len({w for w in re.findall("[a-z0-9가-힣_/-]+", (c or "").lower()) if w in words}) for i, c in enumerate(contents)}
    return {i: n for i, n in found.items() if n}


def test_lexicon_matches_schema():
    assert schemas.ARCHIVE["candidates"].allowed["kind"] == L.KINDS and set(schemas.ARCHIVE["candidates"].allowed["decision"]) == set(L.DECISIONS)


def test_stream(spark, tmp_path):
    from mnemon.streaming import ingest

    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").coalesce(1).write.parquet(source)
    spark.createDataFrame([(2, "c")], "k int, v string").coalesce(1).write.mode("append").parquet(source)
    query = ingest.upsert_batches(ingest.message_stream(spark, source, "k int, v string", 1), table, ("k",), str(tmp_path / "check"))
    query.awaitTermination(120)
    stored = spark.read.parquet(table)
    assert sorted(r["k"] for r in stored.collect()) == [1, 2] and stored.where("k = 1").first()["v"] == "a"
    archive.put(spark.createDataFrame([(1, "z")], "k int, v string"), table, ("k",), "k int, v string")
    assert {r["k"]: r["v"] for r in spark.read.parquet(table).collect()}[1] == "z" and spark.read.parquet(table).count() == 2
