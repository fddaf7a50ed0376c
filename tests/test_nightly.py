"""Nights, the keyed archive, questions to a report, and models behind HTTP."""

import contextlib
import io
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from mnemon import providers
from mnemon.operators import archive, projects
from mnemon.plans import ask, nightly
from mnemon.sources import settings, transcripts

RULES = "앞으로 이 규칙을 기억해줘: 배포 전에는 반드시 체크리스트를 확인하자. 프로젝트 정책으로 확정"


def _session(folder, name, said, day="2026-03-13", cwd="/x/workspace/07_kit"):
    lines = [{"type": "session", "id": name, "timestamp": f"{day}T01:00:00Z", "cwd": cwd}]
    for i, (role, body) in enumerate(said):
        lines.append({"type": "message", "id": f"{name}-{i}", "timestamp": f"{day}T01:0{i}:00Z", "message": {"role": role, "content": [{"text": body}]}})
    (folder / f"{name}.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("sessions")
    _session(d, "a", [("user", RULES), ("assistant", "알겠습니다 supabase runner"), ("user", RULES + " 하자")])
    _session(d, "b", [("user", "ordinary words about nothing in particular today"), ("assistant", "fine then")])
    return d


def _run(folder, out, *more):
    args = ["--sessions", str(folder), "--out", str(out), "--memory-root", str(out / "memory-root"), "--date", "2026-03-13", "--time-zone", "UTC", "--dry-run=false", *more]
    with contextlib.redirect_stdout(io.StringIO()) as said:
        assert nightly.main(args) == 0
    return json.loads(said.getvalue().strip().splitlines()[-1])


@pytest.fixture(scope="module")
def night(spark, folder, tmp_path_factory):
    """(folder of the output, summary) of a first night."""
    out = tmp_path_factory.mktemp("out")
    return out, _run(folder, out)


def test_questions_to_a_report(night, capsys):
    out, first = night
    assert first["counts"]["sessions"] == 2 and first["counts"]["files_scanned"] == 2 and first["scorers"] == {"heuristic": 2} and first["window"]["start"].startswith("2026-03-13T00:00")
    assert first["violations"] == [] and all(x["requested"] == x["returned"] for x in first["archive"].values())
    assert first["counts"]["promotions_planned"] >= 1 and first["counts"]["embedding_payloads_planned"] >= 1
    base = ["--out", str(out), "--date", "2026-03-13"]
    assert ask.main([*base, "--query", "체크리스트 규칙 배포"]) == 0
    got = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert got["items"] and got["items"][0]["total_score"] >= got["items"][-1]["total_score"] and got["semantic"]["status"] == "stub" and got["trace"]["steps"][-1] == "semantic_slot_reserved"
    assert got["items"][0]["content"] and got["items"][0]["kind"] and got["items"][0]["audit"]["matched_tokens"]
    assert ask.main([*base, "--query", "체크리스트", "--semantic-provider", "local"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["semantic"]["status"] == "ok"
    assert ask.main([*base, "--mode", "embedding-preview"]) == 0
    preview = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert preview["count"] == len(preview["payloads"]) > 0
    assert ask.main(base) == 1 and "query" in json.loads(capsys.readouterr().err.strip().splitlines()[-1])["error"]


def test_two_nights_leave_one_row_a_key(spark, folder, night, tmp_path):
    out, first = night
    table = lambda name: archive.read_table(spark, name, f"{out}/archive")
    before = {n: table(n).count() for n in ("sessions", "projects", "messages")}
    later = tmp_path / "sessions"
    later.mkdir()
    (later / "a.jsonl").write_text((folder / "a.jsonl").read_text())
    _session(later, "b", [("user", "other words about something else on that day"), ("assistant", "fine then"), ("user", "and some more of these words")])
    _session(later, "c", [("user", "a third session with words of its own"), ("assistant", "yes")])
    second = _run(later, out)
    assert second["violations"] == [] and all(x["requested"] == x["returned"] for x in second["archive"].values())
    assert table("sessions").count() == before["sessions"] + 1 and {r["external_session_id"]: r["message_count"] for r in table("sessions").collect()} == {"a": 3, "b": 3, "c": 2}
    assert table("projects").count() == before["projects"] == 1 and table("messages").count() == 8 == before["messages"] + 3


def test_files_scanned_stops_at_the_limit(spark, folder):
    headers, messages = transcripts.parse_sessions(transcripts.read_lines(spark, str(folder)))
    picked = lambda limit: transcripts.first_files(headers, limit)
    assert [transcripts.files_scanned(headers, picked(n), n) for n in (1, 2, 5, None)] == [1, 2, 2, 2]
    # the first file doesn't match, so the limit's match is the second
    assert transcripts.files_scanned(headers, headers.where("file_name = 'b.jsonl'"), 1) == 2


class _Model(BaseHTTPRequestHandler):
    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if "key=bad" in self.path:
            self.send_response(403)
            self.end_headers()
            self.wfile.write(b"denied for key=bad")
            return
        if "requests" in body:
            out = {"embeddings": [{"values": [float(len(r["content"]["parts"][0]["text"])), 1.0]} for r in body["requests"]]}
        else:
            text = json.dumps({"importanceScore": 80, "candidateKinds": ["todo"], "summary": "said by a model"}) if "ordinary" not in body["contents"][0]["parts"][0]["text"] else None
            out = {"candidates": [{"content": {"parts": [{"text": text}] if text else []}}]}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(out).encode())

    def log_message(self, *a):
        pass


@pytest.fixture()
def model():
    server = HTTPServer(("127.0.0.1", 0), _Model)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/model"
    server.shutdown()


def test_model_scores(spark, folder, tmp_path, capsys, model):
    env = tmp_path / "env"
    env.write_text(f"# settings\nMNEMON_SCORER_KEY=good\nMNEMON_SCORER_URL={model}\n")
    got = _run(folder, tmp_path / "out", "--scorer", "llm", "--env-file", str(env))
    assert got["scorers"] == {"llm": 1, "heuristic-fallback": 1}
    stored = {r["session_id"]: r for r in nightly.read_report(spark, str(tmp_path / "out"), "2026-03-13")["sessions"].collect()}
    assert stored["a"]["importance_score"] == 80 and list(stored["a"]["candidate_kinds"]) == ["todo"] and stored["b"]["llm_error"] == "empty answer"
    with pytest.raises(RuntimeError, match="403.*REDACTED"):
        providers.HttpScorer(model, "bad")(["x"])
    assert providers.HttpEmbedder(model, "good")(["ab", "c"]) == [[2.0, 1.0], [1.0, 1.0]]
    assert nightly.pick_scorer(settings.Settings(scorer="llm")) is None and "heuristic" in capsys.readouterr().err


@pytest.mark.parametrize("text,hints", [
    ("see foo-bar- now", []), ("see foo-bar now", [("foo-bar", 0.64)]), ('"foo-bar.git" it', [("foo-bar", 0.64)]), ("xfoo (foo-bar- and the repo", [("foo-bar", 0.64)]),
])
def test_context_of_a_token(spark, text, hints):
    s = spark.createDataFrame([("s", "", "", None)], "session_id string, sample_user_text string, file_name string, cwd string")
    m = spark.createDataFrame([("s", 1, "user", text)], "session_id string, seq_no int, role string, text string")
    assert [(r["slug"], r["confidence"]) for r in projects.infer(s, m, projects.empty_catalogue(spark)).collect()] == hints


@pytest.mark.parametrize("cwd,slugs", [
    ("/x/workspace/foo/tests", []), ("/x/foo/tests", ["tests"]), ("/x/workspace/07_kit/src/tests", ["07_kit"]), ("/x/tests/foo", []), ("/apps/tests", ["tests"]), ("", []),
])
def test_directories(spark, cwd, slugs):
    known = projects.aliases(spark.createDataFrame([("tests", "tests", [])], projects.CATALOGUE))
    s = spark.createDataFrame([("s", cwd)], "session_id string, cwd string")
    assert [r["slug"] for r in projects.cwd_signals(s, known).collect()] == slugs

