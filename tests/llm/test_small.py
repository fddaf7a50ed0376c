"""Each operator on nulls, empty and long texts, repeated rows, empty tables and columns of clashing names."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mnemon.llm import components, decontam, embed_dedup, jaccard_join, langid, pieceset, pii, shared, sharding, textscan, toxicity, url_filter, warc
from mnemon.llm.queries import PIECE_MODEL
from mnemon.llm.textscan import text_bytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, cls long, tok string, bucket int, spot int, c0 string, label string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, 3, "x", 4, 5, "y", "z") for i, t, lang in rows], DOCS)


def _text(rng, n, words="the of and that ein der und sich que los una por".split()):
    return " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    rows = [(1, "Hello world, this is a text with words", "en"), (2, None, "en"), (3, "", None), (4, " \n\t ", "en"), (5, "12345 !!", "de"), (None, "no id here at all my friend", "en")]
    rows += [(6, "Hello world, this is a text with words", "en"), (6, "Hello world, this is a text with words", "en"), (7, _text(rng, 30_000), "en"), (8, "x" * 50_000, "fr"), (9, "naïve Ünïcode ▁ 漢字 😀", "de")]
    return _docs(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- sharding ----------------------------------------------------------------------------


def _jump(key, n):
    import xxhash

    def h(*longs):
        seed = 42
        for v in longs:
            seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed)
        return seed

    b, j = -1, 0
    while j < n:
        b = j
        j = int((b + 1) / (((h(key, j) >> 33) + 1) / 2**31))
    return b, (n if j == n else b)


def test_sharding_brute(spark):
    rows = [(i, "t" * (i % 7) + "é", "en") for i in range(500)]
    got = sharding.assign_shards(_docs(spark, rows), 16, buckets=8).collect()
    assert {(r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode()), *_jump(i, 16)) for i, t, _ in rows}
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    grown = {r.doc_id: r.shard for r in sharding.assign_shards(_docs(spark, rows), 17).collect()}
    assert all(r.grown_shard == grown[r.doc_id] for r in got)


def test_sharding_odd(odd, empty):
    got = sharding.assign_shards(odd).collect()
    assert len(got) == odd.count() and sharding.assign_shards(empty).count() == 0
    by = {r.doc_id: r for r in got}
    assert (by[2]["size"], by[2].text_crc32, by[3]["size"], by[3].text_crc32) == (1, None, 1, 0)
    assert len({r.slot for r in got if r.doc_id == 6}) == 2


# --- URL filter ------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = [("https://A.Example.com/en/7x?q", "example.com/en/7", "allow"), ("http://x.com/en/1", "com/en/", "block"), ("http://com/en/", "com/en/", "block"), ("http://xcom/en/1", None, "allow"),
            ("http://example.net/de/81", "example.net/de/8", "block"), ("http://net.org/es/1#a", "org/es/", "block"), ("http://a.net/de/", "net/de/", "allow"), (None, None, "allow"), ("nothing", None, "allow"), ("", None, "allow"), ("a://b?c://d/e", None, "allow")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert [(got[i].rule, got[i].verdict) for i in range(len(urls))] == [(r, v) for _, r, v in urls]
    assert (got[0].host, got[0].path, got[7].host, got[10].host, got[10].path) == ("a.example.com", "/en/7x", "", "b", "")
    assert url_filter.judge(pages.limit(0)).count() == 0


def _brute_tree(urls, rules, o):
    """(template, purity) of each url, by plain dictionaries."""
    rows = []
    for url in urls:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.pattern), default=None)
        rows.append([host, [x for x in re.sub("[0-9]+", "#", path).split("/") if x], "", best and best.verdict])
    for level in range(o.depth + 1):
        here = [(r[1][level] if level < o.depth else "**") if len(r[1]) > level else None for r in rows]
        below = {}
        for (host, _, template, verdict), seg in zip(rows, here):
            if seg is not None:
                c = below.setdefault((host, template), {}).setdefault(seg, [0, 0, 0])
                c[0] += 1
                c[1] += verdict is not None
                c[2] += verdict == "block"
        branch = {}
        for at, kinds in below.items():
            total = sum(c[0] for c in kinds.values())
            named = {s: c for s, c in kinds.items() if not (len(kinds) > o.fan_out and c[0] < total * o.common)}
            groups = []
            for seg, (_, labels, blocked) in sorted(named.items(), key=lambda x: (-x[1][1], x[0])):
                if labels < o.fewest:
                    continue
                for g in groups:
                    bound = np.sqrt(np.log(2 / o.delta) / 2) * (g[1] ** -0.5 + labels**-0.5)
                    if (g[2] / g[1] >= o.limit) == (blocked / labels >= o.limit) and abs(g[2] / g[1] - blocked / labels) <= bound:
                        g[:] = [g[0] + [seg], g[1] + labels, g[2] + blocked]
                        break
                else:
                    groups.append([[seg], labels, blocked])
            joined = {s: "|".join(sorted(g[0])) for g in groups for s in g[0]}
            branch |= {(*at, s): joined.get(s, s) if s in named else "*" for s in kinds}
        for r, seg in zip(rows, here):
            if seg is not None:
                r[2] += "/" + branch[r[0], r[2], seg]
    sums = {}
    for host, _, template, verdict in rows:
        c = sums.setdefault((host, template), [0, 0])
        c[0] += verdict is not None
        c[1] += verdict == "block"
    return [(t, (sums[h, t][1] + o.smoothing * o.prior) / (sums[h, t][0] + o.smoothing)) for h, _, t, _ in rows]


def test_url_tree_brute(spark):
    rng = random.Random(12)
    rules = (url_filter.Rule("block", "a.org/ads/x1"), url_filter.Rule("block", "a.org/buy/"), url_filter.Rule("allow", "a.org/news/2"), url_filter.Rule("allow", "b.org/p"))
    urls = [f"http://{rng.choice(['a.org', 'w.a.org', 'b.org'])}/{rng.choice(['ads', 'buy', 'news', 'new', 'p', 'q'])}/{rng.choice(['x1', 'x', f'{rng.randrange(90)}', f'w{chr(97 + rng.randrange(26))}'])}" + "/t" * rng.randrange(12) for _ in range(1500)]
    urls += urls[:40] + ["http://a.org/" + "long/" * 3000, None, "", "no url", "http://a.org", "HTTP://A.ORG/buy/1?x"]
    o = url_filter.TreeOptions(fan_out=6, common=0.08)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.template, r.purity) for r in url_filter.judge(pages, rules, o).collect()}
    want = _brute_tree(urls, rules, o)
    assert len({t for t, _ in want}) > 20 and any("*" in t for t, _ in want) and any("|" in t for t, _ in want)
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in range(len(urls)))


def test_url_templates(spark):
    rules = (url_filter.Rule("block", "host.com/ads/1"), url_filter.Rule("allow", "host.com/news/1"))
    urls = [f"http://host.com/{s}/{i}/page" for s in ("ads", "news") for i in range(100, 140)] + [f"http://host.com/{s}/{i}/page" for s in ("ads", "news", "new") for i in (20, 21)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
    assert [got[i].verdict for i in range(80, 86)] == ["block", "block", "allow", "allow", "allow", "allow"]
    assert got[80].rule is None and got[80].template == "/ads/#/page" and got[80].purity == pytest.approx(42 / 44)


def test_branches_merge():
    o = url_filter.TreeOptions(fewest=5)
    assert url_filter.merge_branches([("a", 100, 95), ("b", 80, 77), ("c", 50, 0), ("d", 2, 2)], o) == {"a": "a|b", "b": "a|b", "c": "c"}


# --- language ------------------------------------------------------------------------------------


def _prose(lang, rng, n=60):
    parts = {"en": ["the", "ing", "tion", "ou", "and"], "de": ["sch", "ung", "ä", "der", "ich"], "fr": ["é", "eux", "que", "ç", "oi"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language(spark, odd, empty):
    rng = random.Random(2)
    langs = ["en", "de", "fr"]
    docs = _docs(spark, [(i, _prose(langs[i % 3], rng), langs[i % 3] if i % 10 else None) for i in range(300)])
    model = langid.learn(docs)
    got = langid.identify(docs, model).collect()
    assert all(r.lang_pred == langs[r.doc_id % 3] and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    seen = [(r.doc_id, r.lang_pred) for r in langid.identify(odd, model).collect()]
    assert dict(seen)[2] == dict(seen)[3] == dict(seen)[4] == dict(seen)[5] == "und" and len(seen) == odd.count()
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and {2, 3, 4, 5}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() >= 4
    none = langid.learn(empty)
    assert none.languages == [] and {r.lang_pred for r in langid.identify(odd, none).collect()} == {"und"} and langid.identify(empty, model).count() == 0


def test_codewords():
    assert langid.codewords(4).shape == (4, 7) and langid.codewords(1).shape == (1, 1)
    m = langid.codewords(20)
    apart = ((m.shape[1] - m @ m.T) / 2 + m.shape[1] * np.eye(20)).min()
    assert apart > m.shape[1] / 5


# --- pieces -----------------------------------------------------------------------------------------


def test_pieces_match_library(spark, odd, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rng = random.Random(3)
    texts = ["", " ", "a  b\n c ", "\n\n", "naïve façade über", "漢字 😀 mix", "tab\tand\x00nul", "x" * 700, "don't stop 12,345.67 -- ok", *("".join(rng.choice("abcdeé ßz\n.") for _ in range(rng.randint(1, 80))) for _ in range(200))]
    docs = _docs(spark, [(i, t, "en") for i, t in enumerate(texts)])
    out = pieceset.encode(docs, PIECE_MODEL)
    rows = {r.doc_id: r for r in out.collect()}
    assert all(rows[i].ids == library.encode(t) and rows[i].round_trip and rows[i].n_pieces == len(rows[i].ids) for i, t in enumerate(texts))
    assert {r.doc_id: r.text for r in pieceset.decode(out, PIECE_MODEL).collect()} == dict(enumerate(texts))
    got = {r.doc_id: r for r in pieceset.encode(odd, PIECE_MODEL).collect()}
    assert got[2].ids is None and got[3].ids == [] and got[8].round_trip and not got[9].round_trip and pieceset.encode(empty, PIECE_MODEL).count() == 0


def test_encoding_takes_little_memory(spark):
    """A worker's arrays don't grow with the batch: 15 MB of texts are encoded in some 32 MB."""
    import tracemalloc

    class Docs:
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            return work

    rng = random.Random(6)
    texts = [_text(rng, 4000) for _ in range(550)]
    work, batch = pieceset.encode(Docs(), PIECE_MODEL), pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    assert batch.column(1).nbytes > 14e6
    list(work(iter([batch.slice(0, 1)])))  # the vocabulary and tables that stay
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in work(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 50e6


def test_relational_fold(spark):
    rng = random.Random(4)
    pieces = {"a": -2.0, "b": -3.0, "ab": -4.0, "ba": -3.5, "aba": -6.0, "c": -1.0, "cab": -4.5}
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(60)}

    def best(w):
        at = [0.0] + [-1e9] * len(w)
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + 3) + 1):
                s = pieces.get(w[i:j], -20.0 if j == i + 1 else None)
                if s is not None:
                    at[j] = max(at[j], at[i] + s)
        return at[-1]

    vocabulary = spark.createDataFrame(list(pieces.items()), "piece string, score double")
    got = pieceset.segment_words(spark.createDataFrame([(w,) for w in words] * 2 + [("",), (None,)], "word string"), vocabulary, 3, -20.0).collect()
    assert {r.word: r.score for r in got} == pytest.approx({w: best(w) for w in words})
    assert all("".join(r.pieces) == r.word for r in got)
    small = pieceset.PieceSet({p: i for i, p in enumerate(pieces)}, np.array(list(pieces.values())), list(range(256)), merges=False)
    assert all("".join(small.segment(w)) == w for w in words)


# --- decontamination ----------------------------------------------------------------------------------


def _edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_passages_brute(spark, odd, empty):
    rng = random.Random(6)
    vocabulary = ["w%d" % i for i in range(300)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(10, 40))) for _ in range(12)]
    docs = []
    for i in range(150):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            words = items[i % 12].split()
            for _ in range(rng.randint(0, len(words) // 3)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["new"], ["new", words[at]]])
            at = rng.randint(0, len(body))
            body[at:at] = words
        docs.append((i, " ".join(w.upper() if i % 2 else w + "," for w in body), "en"))
    table = spark.createDataFrame([(j, t, "e") for j, t in enumerate(items)] + [(98, None, "e"), (99, "", "e")], "item_id long, text string, doc_id string")
    want = {}
    for i, t, _ in docs:
        words = re.findall("[a-z0-9]+", t.lower())
        for j, item in enumerate(items):
            d = _edits(item.split(), words)
            if d <= len(item.split()) // 4:
                want[i, j] = d
    found = decontam.find_passages(_docs(spark, docs), table).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in found}
    assert len(want) > 30 and set(got) <= set(want) and all(got[x] == want[x] for x in got)
    assert len(got) >= 0.97 * len(want)
    exact = next(r for r in found if r.distance == 0)
    text = docs[exact.doc_id][1][exact.start : exact.end]
    assert re.findall("[a-z0-9]+", text.lower()) == items[exact.item_id].split()
    clean = decontam.drop_contaminated(_docs(spark, docs), table)
    assert {r.doc_id for r in clean.collect()} == {i for i, _, _ in docs} - {i for i, _ in got} and clean.columns == odd.columns
    assert decontam.find_passages(odd, table).count() == 0 and decontam.find_passages(empty, table).count() == 0 and decontam.drop_contaminated(odd, table.limit(0)).count() == odd.count()


@pytest.mark.parametrize("n", [4, 5, 8, 20, 60, 150])
def test_keys_recall_by_size(n):
    """Windows with the most edits allowed share a key with their item; most others don't."""
    rng, search = np.random.default_rng(n), decontam.Search()
    words = textscan.mix(np.arange(1, 20_001, dtype=np.uint64))
    share = 1 / np.arange(1, 20_001)
    draw = lambda: words[rng.choice(20_000, n, p=share / share.sum())]
    items, near, other = [draw() for _ in range(400)], [], [draw() for _ in range(400)]
    for item in items:
        x = list(item)
        for _ in range(search.edits(n)):
            at = rng.integers(len(x))
            x[at : at + 1] = [[], [words[rng.integers(20_000)]], [x[at], words[rng.integers(20_000)]]][rng.integers(3)]
        near.append((x + list(draw()))[:n])
    keys = [decontam.cgk_keys(np.array(x, dtype=np.uint64), np.full(400, n), search) for x in (items, near, other)]
    assert (keys[0] == keys[1]).any(1).mean() >= 0.97 and (keys[0] == keys[2]).any(1).mean() <= 0.3


def test_very_long_item(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(5000)]
    long = [rng.choice(vocabulary) for _ in range(12_000)]
    copy = list(long)
    for _ in range(200):
        copy[rng.randrange(len(copy))] = "changed"
    short = [" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(300)]
    table = spark.createDataFrame([(0, " ".join(long))] + [(1 + i, t) for i, t in enumerate(short)] + [(5, short[4])], "item_id long, text string")
    docs = [(1, "before " + " ".join(copy) + " after", "en"), (2, " ".join(long[:6000]), "en"), (3, "a b " + short[4] + " c", "en"), (4, " ".join(rng.choice(vocabulary) for _ in range(15_000)), "en")]
    got = sorted((r.doc_id, r.item_id, r.distance) for r in decontam.find_passages(_docs(spark, docs), table).collect())
    assert [x[:2] for x in got] == [(1, 0), (3, 5), (3, 5)] and 150 < got[0][2] <= 200
    # one item of 100,000 words among many short ones asks for little memory
    big = decontam.Items(list(range(2001)), [" ".join(f"x{i}" for i in range(100_000)), *(short * 7)[:2000]])
    assert big.keys.shape[0] == 2001 and big.keys.nbytes < 4 << 20


def test_long_items_by_every_window(spark):
    """A run of a long item shortly before its copy hides nothing, nor do the most edits allowed."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(n)] for n in (151, 700, 2400)]
    table = spark.createDataFrame([(j, " ".join(item)) for j, item in enumerate(items)], "item_id long, text string")
    docs, want = [], {}
    for j, item in enumerate(items):
        for edits in (0, len(item) // 12, len(item) // 4 - 3):
            for _ in range(3):
                copy = list(item)
                for at in sorted(rng.sample(range(len(item)), edits), reverse=True):
                    copy[at : at + 1] = rng.choice([[], ["new"], ["new", copy[at]]])
                body = item[:3] + [f"f{x}" for x in range(len(item) // 5)] + copy + ["end"] * 40
                want[len(docs), j] = _edits(item, body)
                docs.append((len(docs), " ".join(body), "en"))
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.find_passages(_docs(spark, docs), table).collect()}
    assert got == want and max(want.values()) > 500
    # a copy that is the item's second half twice has a half too many edits
    half = items[2][1200:] * 2
    assert decontam.find_passages(_docs(spark, [(1, " ".join(half), "en")]), table).count() == 0


# --- language, told again -----------------------------------------------------------------------------


def test_language_brute(spark):
    """Counting, codewords and decoding by plain loops over bytes."""
    rng = random.Random(3)
    texts = {"aa": "lorem ipsum dolor sit amet", "bb": "zwölf Boxkämpfer jagen Viktor", "cc": "être ou ne pas être Ça"}
    rows = [(i, " ".join(rng.choice(texts[x].split()) for _ in range(12)), x) for i, x in enumerate(rng.choice(list(texts)) for _ in range(200))]
    model = langid.learn(_docs(spark, rows))
    code = langid._CODES

    def bins(text):
        b = text.encode()
        x = [32 if not (chr(c).isalpha() or c >= 128) or c < 128 and not chr(c).isalpha() else c + 32 if 65 <= c <= 90 else c for c in b]
        for i in range(1, len(b)):
            if b[i - 1] == 0xC3 and 0x80 <= b[i] <= 0x9E:
                x[i] += 32
        padded = [32, *x, 32]
        return [int(code[0][padded[i]] ^ code[1][padded[i + 1]] ^ code[2][padded[i + 2]]) for i in range(len(x)) if x[i] != 32]

    counts = {x: np.zeros(langid.BINS) for x in texts}
    for i, t, x in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            for at in bins(t):
                counts[x][at] += 1
    share = {x: counts[x] / counts[x].sum() for x in texts}
    floor = 1 / max(sum(c.sum() for c in counts.values()), langid.BINS)
    halves = [({"aa"}, {"bb", "cc"}), ({"bb"}, {"aa", "cc"}), ({"cc"}, {"aa", "bb"})]
    tables = []
    for yes, no in halves:
        p, q = (sum(share[x] for x in side) / len(side) for side in (yes, no))
        t = np.log((p + floor) / (q + floor))
        tables.append((t, float(((p - q) * t).sum())))
    weigh = [w / sum(w for _, w in tables) * 3 for _, w in tables]
    held = [r for r in langid.identify(_docs(spark, rows), model).collect() if r.held_out]
    assert len(held) > 20 and model.languages == sorted(texts)
    for r in held:
        found = bins(rows[r.doc_id][1])
        loss = {}
        for x in texts:
            loss[x] = sum(w * np.log1p(np.exp(-(1 if x in yes else -1) * 3 * t[found].sum() / len(found) * np.sqrt(min(len(found), 100) / 100))) for (t, _), w, (yes, _) in zip(tables, weigh, halves))
        best = min(loss, key=lambda x: (loss[x], x))
        assert r.lang_pred == best == rows[r.doc_id][2] and r.score == pytest.approx(1 / sum(np.exp(loss[best] - v) for v in loss.values()), abs=1e-3)


# --- toxicity --------------------------------------------------------------------------------------------


def test_toxicity(spark, odd, empty):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 1
        words = _text(rng, 40).split()
        if toxic:
            for _ in range(4):
                words[rng.randrange(40)] = rng.choice(["scum", "moron", "trash"])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    labels += [(0, 1, None), (None, 1, 1), (77777, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(_docs(spark, rows), marks).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1500 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 5 == 1) for r in held]) > 0.97 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score(odd, marks).count() == odd.count() and toxicity.score(empty, marks).count() == 0
    assert {r.score for r in toxicity.score(odd, marks.limit(0)).collect()} == {0.5}


def _ratios(model, text):
    return model.ratios(toxicity.Grams.of(*text_bytes(pa.array([text]))))


def _brute_ratio(rows, word):
    """A word's log-likelihood ratio from plain sets of (word before, word) by class."""
    kinds = [set(), set()]
    for text, toxic in rows:
        words = text.split()
        kinds[toxic] |= set(zip(["", *words], words))
    small = min(len(k) for k in kinds)

    def level(name):
        counts = [{}, {}]
        for c in (0, 1):
            for _, w in kinds[c]:
                counts[c][name(w)] = counts[c].get(name(w), 0) + small / len(kinds[c])
        mine = [counts[c].get(name(word), 0) for c in (0, 1)]
        own = [2 * max(mine[c] - toxicity.DISCOUNT, 0) / max(sum(mine), 1e-9) for c in (0, 1)]
        return own, [1 - sum(max(n - toxicity.DISCOUNT, 0) for n in counts[c].values()) / small for c in (0, 1)]

    p = [1.0, 1.0]
    for size in (4, 5, 6, None):
        own, rest = level(lambda w: w.encode()[:size].ljust(size or 0, b"\0"))
        p = [own[c] + rest[c] * p[c] for c in (0, 1)]
    return np.log(p[1] / p[0])


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(3)
    rows = []
    for i in range(600):
        words = [f"{rng.choice(['amber', 'birchen', 'cedar', 'é'])}{rng.randrange(30)}" for _ in range(20)]
        if i % 3 == 0:
            words[rng.randrange(20)] = "scum"
            words[rng.randrange(20)] = f"vile{rng.randrange(60)}"
        rows.append((i, " ".join(words), "en"))
    return rows, [(i, int(i % 3 == 0)) for i, _, _ in rows]


def _in_tasks(spark, tasks, call):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return call()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("tasks", [2, 16])
def test_toxicity_brute(spark, toxic_rows, tasks):
    rows, labels = toxic_rows
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model, without, sample = _in_tasks(spark, tasks, lambda: toxicity.learn(_docs(spark, rows).repartition(tasks), marks))
    use = [(t, i % 3 == 0) for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5 != 0]
    aside = {r.text for r in sample.collect()}
    assert 0.1 * len(use) < len(aside) < 0.3 * len(use)
    for word in ("scum", "vile7", "vilenew", "amber3", "é5", "nowhere"):
        assert _ratios(model, word)[0] == pytest.approx(_brute_ratio(use, word), abs=1e-4)
        assert _ratios(without, word)[0] == pytest.approx(_brute_ratio([r for r in use if r[0] not in aside], word), abs=1e-4)
    assert _ratios(model, "vilenew")[0] > 2 > 0.5 > abs(_ratios(model, "amber3")[0])


def test_toxicity_whatever_the_partitions(spark, toxic_rows, monkeypatch):
    rows, labels = toxic_rows
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")

    def run(tasks):
        return _in_tasks(spark, tasks, lambda: {r.doc_id: (r.score, r.llr_per_word) for r in toxicity.score(_docs(spark, rows).repartition(tasks), marks).collect()})

    few, many = run(2), run(16)
    monkeypatch.setattr(toxicity, "SLICE", 5)
    sliced = run(3)
    # sums in another order differ in the last digits only
    assert all(few[k] == pytest.approx(other[k], abs=1e-9) for other in (many, sliced) for k in few)


@pytest.mark.parametrize("total", [100, 5_000_000, 50_000_000_000, 50_000_000_000_000])
def test_samples_of_any_size(spark, total):
    """Of a table of ``total`` rows the sample is about as large as asked for: told from the bound on the hash, as no such table fits here."""
    said = str(shared.sampled(20_000 / total, "lang", "doc_id"))
    if total <= 20_000:
        assert spark.range(total).withColumnRenamed("id", "doc_id").where(shared.sampled(20_000 / total, "lang", "doc_id")).count() == total
    else:
        bound = int(re.findall(r"\d{10,}", said)[-1])
        assert bound / 2**63 * total == pytest.approx(20_000, rel=1e-3)
    assert 150 < spark.range(20_000).where(shared.sampled(0.01, "fit", "id")).count() < 250


# --- embeddings ---------------------------------------------------------------------------------------------


def test_embeddings_brute(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 24))
    x = np.concatenate([base[rng.integers(0, 40, 260)] + rng.normal(size=(260, 24)) * 0.12, rng.normal(size=(60, 24))]).astype(np.float32)
    x[5], x[6] = x[4], x[4]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(900, None, 0), (901, [0.0] * 24, 0), (902, [float("nan")] * 24, 0), (903, [1.0, None] * 12, 0), (904, [1.0] * 5, 0), (905, [], 0), (None, [9.0] * 24, 0)]
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    degree = linked.sum(1)
    assert all(got[i].n_links <= degree[i] for i in range(320)) and sum(got[i].n_links for i in range(320)) >= 0.9 * degree.sum() > 100
    root = embed_dedup.forest(linked)
    assert np.mean([got[i].component_id == root[i] for i in range(320)]) > 0.97
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906)) and got[None].n_links == 0 and not got[None].kept
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_duplicates(none).count() == 0


def test_embedding_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1, 16)) + rng.normal(size=(90, 16)) * 0.02
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = embed_dedup.near_duplicates(frame).collect()
    assert np.mean([r.n_links for r in got]) > 0.97 * 89 and max(r.n_links for r in got) <= 89 and {r.component_id for r in got} == {0}


def test_embedding_copies(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "HOT_COPIES", 5)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6, 16)).tolist()
    rows = [(i, x[0]) for i in range(30)] + [(40, x[1]), (41, x[1])] + [(50 + i, x[2 + i]) for i in range(4)] + [(None, x[0]), (60, None)]
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()))
    want = [(i or -1, 30, 0, i == 0) for i in range(30)] + [(-1, 30, 0, False), (40, 1, 40, True), (41, 1, 40, False)] + [(50 + i, 0, 50 + i, True) for i in range(4)] + [(60, 0, 60, True)]
    assert got == sorted(want)


def test_embedding_doubles(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=12)
    w = rng.normal(size=12)
    w -= (w @ v) / (v @ v) * v
    at = lambda c: (v / np.linalg.norm(v) * c + w / np.linalg.norm(w) * np.sqrt(1 - c * c)).tolist()
    # the cosine to the first is 0.95 but for what floats can't tell
    rows = [(1, v.tolist()), (2, at(0.95 + 1e-9)), (3, (1e39 * v).tolist()), (4, (1e-300 * v).tolist()), (5, at(0.95 - 1e-9)), (6, [1e39] * 12), (7, [1e39] * 11 + [1e39 * (1 + 1e-9)]), (7, [1e39] * 12)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=0.9999).collect())
    assert got == [(1, 3, 1), (2, 4, 1), (3, 3, 1), (4, 3, 1), (5, 1, 1), (6, 2, 6), (7, 2, 6), (7, 2, 6)]


# --- personal data ----------------------------------------------------------------------------------------------

E_, I_, C_, P_ = (re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))


def _base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in E_.finditer(t)]
    out += [("ip", *m.span()) for m in I_.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in C_.finditer(t) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in P_.finditer(t) if 8 <= len(digits(m[0])) <= 15]


def test_pii_brute(spark):
    rng = random.Random(10)
    bits = ["a@b.c", "@", ".", "é", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+", "12", " ", "-", "x%y@z-1.co.uk", "😀", "1.2.3.4.5.6.7.8", "00.00.00.000255", "a@b@c.de", "(", ")"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    assert all(sorted(pii.base_spans(t)) == sorted(_base(t)) for t in texts)
    got = {r.doc_id: r for r in pii.find(_docs(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in _base(t))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest() and set(filter(None, want.split(","))) <= set(filter(None, got[i].spans.split(",")))
        assert got[i].n_email == sum(s[0] == "email" for s in _base(t))


def test_pii_added(spark, odd, empty):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [(i, f"some words token = \"{key[i:] + key[:i]}\" here", "en") for i in range(20)] + [(i, "plain words only, version 1.2", "en") for i in range(20, 60)] + [(i, f"mail a{i}@b.com or call +1 555 010 {1000 + i}", "en") for i in range(60, 90)]
    got = {r.doc_id: r for r in pii.find(_docs(spark, rows)).collect()}
    assert all(got[i].n_added == 1 and got[i].spans.startswith("secret:") for i in range(20)) and all(got[i].spans == "" for i in range(20, 60))
    clean = {r.doc_id: r.text for r in pii.redact(_docs(spark, rows)).collect()}
    assert clean[0] == 'some words token = "[SECRET]" here' and clean[70] == "mail [EMAIL] or call [PHONE]" and clean[30] == rows[30][1]
    assert pii.find(odd).count() == odd.count() == pii.redact(odd).count() and pii.find(empty).count() == 0 and pii.redact(empty).columns == empty.columns
    assert {r.doc_id: r.base_sha256 for r in pii.find(odd).collect()}[2] == hashlib.sha256(b"").hexdigest()


def test_pii_added_kinds_precision_and_recall(spark):
    """Of planted spans and look-alikes, the classifier takes the former and leaves the latter."""
    rng = random.Random(1)
    digits = lambda n, of="0123456789abcdef": "".join(rng.choice(of) for _ in range(n))
    true = [
        lambda: f"token: {digits(40)} x", lambda: f"call 212 {rng.randrange(200, 999)} {rng.randrange(1000, 9999)} now", lambda: "my ssn 123-45-6789 ok", lambda: "mail jane at site dot com please",
        lambda: "IBAN DE89370400440532013000 end", lambda: f"key AKIA{digits(16, 'ABCDEFGHIJKLMNOP234567')} ok", lambda: f"sha {digits(40)} x",
    ]
    false = [
        lambda: "see /blog/2024/01/some-long-article-title-here for it", lambda: "my-kebab-case-identifier-2024 ok", lambda: f"version_{rng.randrange(10**9)}_of_the_module here", lambda: f"figures 111 222 {rng.randrange(1000, 9999)} a",
        lambda: "part 000-12-3456 no", lambda: "meet at noon dot again then", lambda: "CODE AB12 ABCD EFGH IJKL end",
    ]
    filler = "ordinary language without anything particular in between here"
    rows = []
    for i in range(900):
        inside = rng.choice(true)() if i % 3 == 0 else rng.choice(false)() if i % 3 == 1 else rng.choice([f"write to a{i}@site.org", f"host 10.0.{i % 250}.7", "+1 555 010 9999"])
        rows.append((i, f"{filler} {inside} {filler}", "en"))
    got = {r.doc_id: r.n_added for r in pii.find(_docs(spark, rows)).collect()}
    assert np.mean([got[i] == 1 for i in range(0, 900, 3)]) > 0.97 and np.mean([got[i] == 0 for i in range(1, 900, 3)]) > 0.97 and not any(got[i] for i in range(2, 900, 3))


def test_pii_long_secrets_and_many_numbers():
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghij0123456789") for _ in range(900))
    assert [(k, b - a) for k, a, b in pii.loose_spans(f"the token {long} here", [])] == [("secret", 900)]
    rng = random.Random(4)
    text = " ".join(rng.choice(["555-123-4567", "a@b.com", "123-45-6789", "+1 555 123 4567", "x1" * 14, "word", "212 555 1234", "jane at site dot com"]) for _ in range(400))
    base = pii.base_spans(text)
    found = [(k, m.start(), m.end()) for k in ("local_phone", "ssn", "iban", "secret") for m in pii._LOOSE[k].finditer(text)] + [("hidden_email", m.start(), m.end()) for m in pii._AT.finditer(text)]
    want, busy = [], [(a, b) for _, a, b in base]
    for k, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if all(b <= x or y <= a for x, y in busy):
            want.append((k, a, b))
            busy.append((a, b))
    assert pii.loose_spans(text, base) == want and len(want) > 50
    start = time.monotonic()
    pii.loose_spans("123-45-6789 " * 100_000, [])
    assert time.monotonic() - start < 20


def test_pii_long_runs():
    assert pii.base_spans("a" * 200_000) == [] and pii.base_spans("1" * 100_000) == [] and pii.base_spans("@" * 50_000) == []


# --- Jaccard join -----------------------------------------------------------------------------------------------------


def _shingles(t):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def _classes(rows):
    sets = [_shingles(t) for _, t, _ in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return sets, root


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "new%d" % rng.randrange(50)
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_brute(spark, seed, monkeypatch):
    rng = random.Random(seed)
    rows = []
    passage = _text(rng, 60)
    for g in range(25):
        words = _text(rng, rng.choice([1, 3, 5, 7, 12, 20, 40, 90, 200])).split()
        rows += [_edited(rng, words, rng.randint(0, max(1, len(words) // 14))) for _ in range(rng.randint(1, 9))]
    if seed == 2:
        monkeypatch.setattr(jaccard_join, "HOT_COPIES", 3)
        monkeypatch.setattr(jaccard_join, "BLOCK", 4)
        rows += [rows[3]] * 12 + [rows[8]] * 7 + [rows[15]] * 3
    near = _text(rng, 120).split()
    rows += [_edited(rng, near, rng.randint(0, 9)) for _ in range(60)]  # a large group of near copies, some too far
    rows += [passage + " " + _text(rng, rng.randint(3, 60)) for _ in range(40)] + ["  ", "", "Same Few", "same\tfew"]
    rows = [(1000 - i, t, "en") for i, t in enumerate(rows)]
    sets, root = _classes(rows)
    least = {}
    for (i, _, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    got = {r.doc_id: r for r in jaccard_join.jaccard_classes(_docs(spark, rows)).collect()}
    assert [(got[i].n_shingles, got[i].component_id) for i, _, _ in rows] == [(len(s), least[r]) for s, r in zip(sets, root)]


def test_jaccard_family_meets_once(spark, monkeypatch):
    """Near copies that share many buckets meet pair by pair once, not in each bucket."""
    rng = random.Random(11)
    base = _text(rng, 400).split()
    changes = {i: f"new{i}" for i in range(7, 400, 10)}
    rows = []
    for i in range(60):
        mine = set(rng.sample(sorted(changes), 10))
        rows.append((i, " ".join(changes[at] if at in mine else w for at, w in enumerate(base)), "en"))
    sets, root = _classes(rows)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    kept = []

    def stored(df, name):
        out = shared.stored(df, name)
        if {"bucket", "root"} <= set(out.columns):
            kept.append(out)
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(_docs(spark, rows)).collect()}
    assert [got[i] for i in range(60)] == [least[r] for r in root] and 1 < len(least) < 60
    last = kept[-1].groupBy("bucket").agg(F.countDistinct("cls").alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("pairs"), F.max("n").alias("most")).first()
    assert last.most > 30 and last.pairs <= 6 * 60 * 60


def test_jaccard_index_weighs_little(spark, monkeypatch):
    """A signature alone in its task is sent with 4 bytes of its own and 4 of its set's name."""
    rng = random.Random(5)
    rows = [(i, _text(rng, 300), "en") for i in range(40)]
    monkeypatch.setattr(jaccard_join, "SIGNATURES_A_TASK", 10)
    weights, buckets = [], jaccard_join._buckets

    def weighed(packed, *more):
        weights.append(packed.agg(F.sum(F.length("sigs") + F.length("owners"))).first()[0])
        return buckets(packed.limit(0), *more)

    monkeypatch.setattr(jaccard_join, "_buckets", weighed)
    jaccard_join.jaccard_classes(_docs(spark, rows))
    values, offsets = jaccard_join.token_sets(pa.array([t for _, t, _ in rows]), 5)
    n = len(jaccard_join.signatures(values, offsets, np.array([], np.uint64), jaccard_join.Threshold()).signature)
    assert 0 < weights[0] <= 8 * n


def test_jaccard_hub_is_sent_once_a_deal(spark, monkeypatch):
    """A set that many meet isn't sent to each of its pairs."""
    rng = random.Random(6)
    base = _text(rng, 200).split()
    rows = [(i, _edited(rng, base, 2), "en") for i in range(70)]
    sets, root = _classes(rows)
    kept = {}

    def stored(df, name):
        return kept.setdefault(name, []).append(shared.stored(df, name)) or kept[name][-1]

    monkeypatch.setattr(jaccard_join, "stored", stored)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(_docs(spark, rows)).collect()}
    assert [got[i] for i in range(70)] == [min(j for j in range(70) if root[j] == root[i]) for i in range(70)]
    pairs = kept["first"][0].count()
    assert pairs > 50 and kept["tried"][0].count() == pairs and kept["asks"][0].count() <= 1.2 * pairs


@pytest.mark.parametrize("bits", [24, 40])
def test_jaccard_names_that_are_alike(spark, monkeypatch, bits):
    """Sets whose keys are alike in their low bytes are told apart, and signatures that are alike in a task lose no link."""
    rng = random.Random(8)
    base = _text(rng, 90).split()
    rows = [(i, _edited(rng, base if i % 2 else _text(rng, 40).split(), i % 12), "en") for i in range(90)]
    sets, root = _classes(rows)
    plain_keys, plain_signatures = jaccard_join.set_keys, jaccard_join.signatures

    def keys(values, offsets):
        return plain_keys(values, offsets) >> bits << bits

    def signatures(*about):
        out = plain_signatures(*about)
        out.signature &= np.uint64(0xFFFFFF00000003FF)
        return out

    monkeypatch.setattr(jaccard_join, "set_keys", keys)
    monkeypatch.setattr(jaccard_join, "signatures", signatures)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(_docs(spark, rows)).collect()}
    assert [got[i] for i in range(90)] == [min(j for j in range(90) if root[j] == root[i]) for i in range(90)]


def test_jaccard_reads_only_asked_texts():
    """What the filter of keys doesn't let pass isn't cut into slices."""
    batch = pa.RecordBatch.from_pydict({"least": [1, 2, 3], "text": ["a", "b", None], "spot": pa.array([5, 6, 7], pa.int64())})
    bits = np.zeros(jaccard_join.FILTER_BITS, bool)
    bits[[5, 7]] = True
    assert [x for part in jaccard_join._asked(iter([batch]), np.packbits(bits)) for x in part.column(0).to_pylist()] == [1, 3]


def test_every_level_finds_its_pairs():
    """Linked sets share a signature, whatever tokens count as common."""
    rng = np.random.default_rng(7)
    t = jaccard_join.Threshold()
    for common_share in (0.0, 0.3, 0.8, 1.0):
        for size in (1, 2, 3, 5, 8, 13, 30, 77, 200):
            for _ in range(12):
                a = np.unique(rng.integers(1, 2**63, size).astype(np.uint64))
                b = a.copy()
                while True:  # as far from a as a link allows
                    c = np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 and len(b) > 1 else np.unique(np.append(b, rng.integers(1, 2**63, 1).astype(np.uint64)))
                    both = len(np.intersect1d(a, c))
                    if 100 * both < 75 * (len(a) + len(c) - both):
                        break
                    b = c
                common = np.sort(rng.choice(a, int(len(a) * common_share), replace=False))
                x = jaccard_join.signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), common, t)
                of = x.row[x.entry]
                shared = set(x.signature[of == 0].tolist()) & set(x.signature[of == 1].tolist())
                assert shared
                # and some entry of each has as many shared signatures as it needs
                hit = np.isin(x.signature, list(shared))
                count = np.bincount(x.entry[hit], minlength=len(x.row))
                assert all((count[x.row == r] >= x.need[x.row == r]).any() for r in (0, 1))


def test_jaccard_odd(odd, empty):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(odd).collect()]
    by = {i: (n, c) for i, n, c in got}
    assert len(got) == odd.count() and by[6] == (4, 1) == by[1] and by[2] == (0, 2) and by[4] == (0, 4) and by[8] == (1, 8) and by[None] == (3, None)
    assert jaccard_join.jaccard_classes(empty).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        if a is not None and a != b:
            parent[find(a)] = find(b)
    assert set(got) == set(parent)
    for v in parent:
        assert (got[v] == got[find(v)]) and len({got[w] for w in parent if find(w) == find(v)}) == 1
    assert len(set(got.values())) == len({find(v) for v in parent})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- WARC ------------------------------------------------------------------------------------------------------------


def test_warc(spark, tmp_path):
    import zstandard

    big = "ü<p>" * 400
    pages = [(i, f"http://x/{i}", f"page {i} " * (i * 40)) for i in range(30)] + [(40, "u\r\nv%0A", big), (41, "u", big), (42, None, big), (43, "u", None), (44, "u", ""), (45, "u", "small"), (46, "u", "small"), (None, "u", big)]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, size int")
    path = "file://" + str(tmp_path / "b")
    got = warc.archive(frame, path, frame_bytes=4000, bundle_bytes=20_000).collect()
    assert len(got) == len(pages)
    best = 42
    for page_id, url, html in pages:
        row = next(r for r in got if r.page_id == page_id)
        data = (html or "").encode()
        assert (row.payload_bytes, row.payload_digest, row.url) == (len(data), hashlib.sha1(data).hexdigest(), url)
        revisit = html == big and page_id not in (best, None)
        assert (row.record_type, row.refers_to) == (("revisit", best) if revisit else ("response", None))
    bundles = spark.read.parquet(path)
    content = {r.bundle: bytes(r.content) for r in bundles.collect()}
    assert max(len(warc.seek_table(c)) for c in content.values()) > 1
    for r in warc.record_index(bundles).collect():
        fields, body = warc.read_at(content[r.bundle], r.frame, r.offset, r.length)
        assert fields.get("X-Page-ID") == (None if r.page_id is None else str(r.page_id))
    one = next(iter(content.values()))
    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(one).startswith(b"WARC/1.1\r\n")
    broken = one[:-1] + b"\0"
    with pytest.raises(ValueError):
        warc.seek_table(broken)
    some = warc.read_pages(bundles, spark.createDataFrame([(r.page_id,) for r in got[:5] if r.page_id is not None], "page_id long")).collect()
    assert {r.page_id for r in some} == {r.page_id for r in got[:5] if r.page_id is not None}
    assert warc.export_bundles(bundles, str(tmp_path / "files")) == len(content) == len(list((tmp_path / "files").glob("*.warc.zst")))
    assert warc.archive(frame.limit(0)).count() == 0


def test_warc_fields(spark, tmp_path):
    """What WARC/1.1 asks of each type of record."""
    pages = spark.createDataFrame([(1, "http://a.org/x?q=%20y", "z" * 1500), (2, "http://a.org/2", "z" * 1500), (3, None, "short"), (4, "http://a.org/new\nline", None), (5, "", "é")], "page_id long, url string, html string")
    path = "file://" + str(tmp_path / "w")
    back = {r.page_id: r for r in warc.archive(pages.coalesce(1), path).collect()}
    assert {i: r.url for i, r in back.items()} == {r.page_id: r.url for r in pages.collect()}
    seen = {}
    for r in spark.read.schema(warc.BUNDLE_SCHEMA).parquet(path).collect():
        for frame in warc.seek_table(bytes(r.content)):
            data, at = warc.read_frame(bytes(r.content), frame), 0
            while at < len(data):
                fields, block, at = warc.parse_record(data, at)
                kind = fields["WARC-Type"]
                assert {"WARC-Record-ID", "WARC-Date", "Content-Length", "Content-Type"} <= set(fields)
                assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", fields["WARC-Record-ID"]) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
                seen.setdefault(kind, []).append(fields)
                if kind == "warcinfo":
                    assert fields["Content-Type"] == "application/warc-fields" and block.startswith(b"software: ")
                else:
                    assert fields["WARC-Target-URI"] and fields["WARC-Payload-Digest"] and fields["Content-Type"] == "application/http;msgtype=response" and block.startswith(b"HTTP/1.1 200 OK\r\n")
    by_id = {f["WARC-Record-ID"]: f for found in seen.values() for f in found}
    (revisit,) = seen["revisit"]
    assert revisit["WARC-Profile"].endswith("/revisit/identical-payload-digest") and by_id[revisit["WARC-Refers-To"]]["X-Page-ID"] == "2" and revisit["WARC-Target-URI"] == "http://a.org/x?q=%20y"
    assert len(by_id) == sum(map(len, seen.values())) == 6 and back[1].refers_to == 2
