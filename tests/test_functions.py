import datetime as dt

import pytest
from pyspark.sql import functions as F

from mnemon.functions import hashing, numbers, text
from mnemon.sources import settings


def _one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


@pytest.mark.parametrize("raw,plain", [
    ("  a  \n\n b　c ", "a b c"), ("Sender (untrusted metadata):\nhello", "hello"), ('"name": x\nkeep', "keep"), ("a [cron: x y] go", "a go"), ("[cron: x] gone", ""),
    ("dream\nthe dream now old_dream 꿈dream한", "the now old_dream 꿈 한"), ("", ""), (None, ""), ("```json\n{\n}\nok", "ok"), ("[Fri 1 GMT+9] gone\nok", "ok"),
])
def test_normalize(spark, raw, plain):
    assert _one(spark, raw, text.normalize(F.col("t")))[0] == plain


@pytest.mark.parametrize("raw,low,temporary,noise", [
    ("응응", True, False, True), ("좋아요", True, False, False), ("ok", True, False, True), ("a real sentence here", False, False, False), ("look at path now", False, True, True),
    ("see /Users/x", False, True, True), ("", True, True, True), ("이거 맞아?", True, False, False),
])
def test_signals(spark, raw, low, temporary, noise):
    assert tuple(_one(spark, raw, text.is_low_signal(F.col("t")), text.is_temporary(F.col("t")), text.is_noise(F.col("t")))) == (low, temporary, noise)


def test_slugs_and_tokens(spark):
    row = _one(spark, "My Repo.git", text.project_slug(F.col("t")), text.file_slug(F.col("t")), text.truncate(F.col("t"), 5), text.recall_tokens(F.lit("A file/x 규칙 b-c")))
    assert tuple(row) == ("my-repo", "my-repo-git", "My R…", ["file/x", "규칙", "b-c"])
    assert _one(spark, "decision:  Use  X!", text.entry_slug(F.lit("decision"), F.col("t"), F.lit("global")))[0] == "global-decision-use-x"


def _rolling(s, factor):
    h = 0
    raw = s.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (h * factor + raw[i] * 256 + raw[i + 1]) % 2**32
    return format(h, "x")


@pytest.mark.parametrize("s", ["", "a", "규칙 앞으로", "😀 emoji", "x" * 3000])
def test_rolling_hashes(spark, s):
    row = _one(spark, s, hashing.fingerprint(F.col("t")), hashing.transcript_checksum(F.col("t")))
    assert tuple(row) == ("cand-" + _rolling(s, 33), "v0-" + _rolling(s, 31))


@pytest.mark.parametrize("date,zone,start,end", [
    ("2026-03-13", "Asia/Seoul", "2026-03-12 15:00:00", "2026-03-13 14:59:59.999"), ("2024-03-10", "America/New_York", "2024-03-10 05:00:00", "2024-03-11 03:59:59.999"),
])
def test_day_window(spark, date, zone, start, end):
    a, b = numbers.day_window(F.col("t"), zone)
    assert tuple(_one(spark, date, a.cast("string"), b.cast("string"))) == (start, end)


def test_target_day():
    today = dt.date(2026, 1, 1)
    assert numbers.target_day("yesterday", today) == dt.date(2025, 12, 31) and numbers.target_day("2025-02-03", today) == dt.date(2025, 2, 3)
    with pytest.raises(ValueError):
        numbers.target_day("soon", today)


def test_cosine(spark):
    d = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0]), (None, [1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in d.select(numbers.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.5**0.5, 0, 0, 0])


def test_settings(tmp_path):
    assert settings.parse_args(["--a=b=c", "--d", "e", "--f"]) == {"a": "b", "d": "e", "f": True}
    env = tmp_path / ".env"
    env.write_text("# c\n\nMNEMON_LIMIT=7\nnothing\nMNEMON_DATE=today\n")
    got = settings.Settings.load(["--date", "2024-01-02", "--purge-plan", "off"], {}, str(env))
    assert (got.date, got.limit, got.purge_plan, got.scorer) == ("2024-01-02", 7, False, "heuristic")
    assert settings.read_env_file(str(tmp_path / "none")) == {}
    (tmp_path / "07_my_app").mkdir()
    assert settings.known_projects(str(tmp_path)) == [{"slug": "07_my_app", "name": "07_my_app", "aliases": ["07_my_app", "07-my-app", "my_app", "my-app"]}]
