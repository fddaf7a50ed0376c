"""The registered queries on the small tables, against brute force."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n not in ("op5_decontamination",)])
def test_a_row_each(spark, name):
    table, key = ("pages", "page_id") if name in ("op2_url_filters", "op10_warc") else ("embeddings", "vec_id") if name.startswith("op7") else ("documents", "doc_id")
    rows = entry.queries()[name](spark, DATA)
    want = spark.read.parquet(f"{DATA}/{table}.parquet")
    assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in want.select(key).collect())


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_sql(spark, name):
    """The whole result is what DuckDB makes of the query's SQL."""
    import duckdb

    base = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    want = base.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, DATA).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_language_held_out(spark):
    rows = entry.queries()["op3_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) > 100


def test_pipeline(spark):
    """The stages' decisions, told again from the raw rows."""
    import corpus_pipeline
    from mnemon.llm import decontam, jaccard_join, langid, pii

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, DATA).collect()}
    sure = {r.doc_id for r in langid.identify(docs, langid.learn(docs)).where("lang_pred <> 'und' and score > 0.2625").collect()}
    left = docs.where(docs.doc_id.isin(list(sure)))
    first = {r.doc_id for r in jaccard_join.jaccard_classes(left).where("doc_id = component_id").collect()}
    held = {r.doc_id for r in decontam.find_passages(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
    assert set(got) == first - held and len(got) > 100
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.round_trip for r in got.values())
    spotless = [i for i in got if not pii.base_spans(text[i]) and "token" not in text[i]]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    assert spotless and all(got[i].ids == library.encode(text[i]) for i in spotless)


def test_pipeline_odd(spark):
    import corpus_pipeline

    rows = [(1, "the same words in a row of eight words", "en", "a", 1), (1, "the same words in a row of eight words", "en", "a", 1), (None, "the same words in a row of eight words", "en", "a", 1), (None, "another text that has no id whatever it says", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each(spark, docs, DATA)
    again = spark.createDataFrame([(3, "a b c d e f g h", "en", "a", 1), (5, "a b c d e f g h", "en", "a", 1), (5, "other words of another text here", "en", "a", 1), (9, "p q r s t u v w x y z 1 2 3 4 5 6 7 8 9", "en", "b", 2), (9, "p q r s t u v w x y z 1 2 3 4 5 6 7 8 0", "en", "b", 2), (9, "p q r s t u v w x y z 1 2 3 4 5 6 7 8 0", "en", "b", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted((r.doc_id, r.text[:5]) for r in corpus_pipeline.one_of_each(spark, again, DATA).collect())
    assert left == [(3, "a b c"), (5, "other"), (9, "p q r")]
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "another text that has no id whatever it says"), (1, "the same words in a row of eight words"), (2, ""), (3, "")]


def test_stages_odd(spark):
    """All stages, one after another, on an empty table and on odd rows with columns of clashing names."""
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long, pipeline_key string, again string, row int, n int, lettered int, c0 string, least int"
    more = ("k", "a", 1, 2, 3, "c", 4)
    words = "an ordinary text of more than five words for the first of these rows"
    rows = [(1, words, "en", "a", 1, *more), (1, words, "en", "a", 1, *more), (2, words + " and more", "en", "a", 1, *more), (None, "no id but a text that nothing else is like", "en", "a", 1, *more), (3, None, None, None, None, *more), (4, "", "en", "a", 1, *more), (5, "12 34", "de", "a", 1, *more)]
    rows += [(6, "long " * 40_000, "en", "b", 1, *more), (7, "mail me at a@b.org about these few things here", "en", "b", 1, *more)] + [(100 + i, f"der {i} und die {i * 7} nicht mit einem {i * 13}", "de", "b", 1, *more) for i in range(40)]
    for table, left in (([], 0), (rows, None)):
        docs = spark.createDataFrame(table, kind)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, DATA)
            assert after.columns == docs.columns, name
            docs = spark.createDataFrame(after.collect(), after.schema)
        got = {r.doc_id: r for r in docs.collect()}
        encoded = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
        assert encoded.count() == len(docs.collect()) == (left if left is not None else docs.count())
        if table:
            # id 1 repeats, so its near copy 2 comes first
            assert {2, 7, None} <= set(got) and 1 not in got and not {3, 4, 5} & set(got) and got[7].text == "mail me at [EMAIL] about these few things here"
            assert all((r.pipeline_key, r.again, r.row, r.n, r.lettered, r.c0, r.least) == more for r in docs.collect())


def test_pipeline_long_passages(spark, tmp_path):
    """Documents with a long passage go, also when a run of it comes shortly before; those with half of it stay."""
    import random

    import corpus_pipeline

    rng = random.Random(4)
    item = [f"w{rng.randrange(3000)}" for _ in range(2200)]
    other = [f"f{i}" for i in range(400)]
    edited = [w if rng.random() > 0.2 else "new" for w in item]
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [item, item[:3] + other + item, other + item, item[:3] + other + edited + other, other, item[:1100], item[1100:] + other]
    docs = spark.createDataFrame([(i, " ".join(t), "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()) == [4, 5, 6]


def test_pipeline_every_position(spark, tmp_path):
    """Passages whose keys all miss go too; rejected candidates and mixed case hide no personal data."""
    import random

    import corpus_pipeline

    rng = random.Random(7)
    items = [[f"w{rng.randrange(5000)}" for _ in range(150)] for _ in range(40)]
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held = [[w for i, w in enumerate(t) if i % 4 != 2 or i > 147] for t in items]  # 37 words less, the most there may be
    less = [[w for i, w in enumerate(t) if i % 4 != 2 or i > 147][2:] for t in items]
    texts = [["before", *t, "after"] for t in held] + [["before", *t, "after"] for t in less]
    docs = spark.createDataFrame([(i, " ".join(t), "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()) == list(range(40, 80))

    texts = ["the token AB12CDEF3456GHIJ7890KLMN here", "write to joe aT example dOt com please"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, str(tmp_path)).collect()}
    assert got == {0: "the token [SECRET] here", 1: "write to [HIDDEN_EMAIL] please"}
