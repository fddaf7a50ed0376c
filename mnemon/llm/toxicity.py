"""Toxicity by two class-conditional Kneser-Ney models.

The counts are Kneser-Ney's: of a word, in how many ways it follows another
word, by class, over all labelled training rows; a copied text adds nothing to
them.  Each class's model discounts them and hands the freed mass down, from the
word to its stems of 6, 5 and 4 bytes (whose counts are those of their words)
and from there to counts that both classes share, so an expression that
neither class knows says nothing.  Counts of the larger class are scaled to the
smaller one's total before the discount, else rare words would look ordinary.

A toxic text is mostly ordinary words: it is one that takes a word from the
toxic model with probability MIX and else from the ordinary one.  The score is
a logistic function of the log-likelihood ratio of these two readings, a word
and a root of words.  Ratios are taken against the text's own median, which
tells its language and subject, not its tone.

The logistic function is fitted on a bounded sample of the training rows, which
are scored by counts without them; the final counts have all training rows, those
whose crc32(key) mod 5 is not 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon.llm.shared import sampled, stored
from mnemon.llm.textscan import PLAIN, U64, mix, pieces, text_bytes, words

#: Rows of the model that are sent to the tasks, and held by one, at once; it has as many slices as it needs.
SLICE = 1 << 20
#: Labelled rows, about, that the logistic fit uses, and the share of them that it uses at most.
FIT_ROWS, FIT_SHARE = 50_000, 0.2
#: Labelled rows, about, that tell which words are frequent; it decides where rows are counted, not what comes out.
LAYOUT_ROWS = 2_000
FILTER_BITS = 1 << 23
#: Bytes of a word that its stems have.
STEMS = (6, 5, 4)
#: Kneser-Ney's absolute discount, in contexts of the smaller class.
DISCOUNT = 3.0
#: Share of toxic words in a toxic text.
MIX = 0.01
FEATURES = ("llr_per_word", "llr_per_root", "mean_ratio")
#: In a pair's ``tail``: bits 0 to 3 tell in which kinds of rows it occurs (1 for toxic, 2 more for the fit's sample), the rest is the word's first bytes.
TAIL = 8
ENTRY = "hash long, v0 float, v1 float"


@dataclass
class Grams:
    """Of each word of a batch: the hashes of word and word before (0 for none), its first six bytes, and its document."""

    word: np.ndarray
    before: np.ndarray
    head: np.ndarray
    doc: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Grams:
        h, doc, starts, ends = words(data, offsets, PLAIN)
        before = np.zeros(len(h), dtype=U64)
        head = np.zeros(len(h), dtype=U64)
        if len(h):
            before[1:] = np.where(doc[1:] == doc[:-1], h[:-1], U64(0))
            text = np.append(PLAIN.folded(data), np.zeros(STEMS[0], np.uint8))
            for k in range(STEMS[0]):
                head |= np.where(ends - starts > k, text[starts + k], 0).astype(U64) << U64(8 * k)
        return cls(h, before, head, doc)


def stem_hash(head: np.ndarray, size: int) -> np.ndarray:
    """The hash of a word's first ``size`` bytes, apart from that of any word."""
    return mix((head & U64((1 << 8 * size) - 1)) ^ U64(size << 56))


def own_part(counts: np.ndarray) -> np.ndarray:
    """What each class's own counts give, over what the classes share; counts are scaled to one total."""
    return 2 * np.maximum(counts - DISCOUNT, 0) / np.maximum(counts.sum(1, keepdims=True), 1e-9)


@dataclass
class ToxicModel:
    """The classes' models (0 ordinary, 1 toxic) relative to what they share.

    ``slices`` hold (sorted hashes, own parts of both classes) of words and
    stems; one whose own parts are zero is left out, which changes nothing.
    ``rest`` is, for words and each kind of stem, the mass that each class hands
    down.
    """

    rest: np.ndarray
    slices: list[Broadcast] = field(default_factory=list)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The own parts of each hash; zeros for one that the model lacks."""
        asked, back = np.unique(hashes.view(np.int64), return_inverse=True)
        found = np.zeros((len(asked), 2), np.float32)
        for part in self.slices:
            known, parts = part.value
            low, high = np.searchsorted(asked, known[0]), np.searchsorted(asked, known[-1], side="right")
            at = np.searchsorted(known, asked[low:high])
            hit = np.flatnonzero(known[at] == asked[low:high])
            found[low + hit] = parts[at[hit]]
            if len(self.slices) > 1 and part._path:  # a worker holds one slice at a time
                del part._value
        return found[back].astype(float)

    def ratios(self, g: Grams) -> np.ndarray:
        """Each word's log-likelihood ratio, toxic against ordinary."""
        if not len(g.word) or not self.slices:
            return np.zeros(len(g.word))
        p = np.ones((len(g.word), 2))
        for k in reversed(range(len(STEMS))):
            p = self.find(stem_hash(g.head, STEMS[k])) + self.rest[k + 1] * p
        p = self.find(g.word) + self.rest[0] * p
        return np.log(p[:, 1] / p[:, 0])

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each text's log-likelihood ratio a word and a root of words, and the mean ratio of its words."""
        n = len(offsets) - 1
        g = Grams.of(data, offsets)
        out = np.zeros((n, len(FEATURES)))
        if len(g.word):
            r = self.ratios(g)
            count = np.bincount(g.doc, minlength=n)
            some = np.maximum(count, 1)
            order = np.lexsort((r, g.doc))
            middle = np.cumsum(count) - count + (some - 1) // 2
            level = np.where(count > 0, r[order[np.minimum(middle, len(r) - 1)]], 0)
            total = np.bincount(g.doc, np.log1p(MIX * np.expm1(r - level[g.doc])), minlength=n)
            out[:, 0], out[:, 1], out[:, 2] = total / some, total / np.sqrt(some), np.bincount(g.doc, r, minlength=n) / some
        return out


def training_labels(labels: DataFrame, key: str, label: str, fit_rows: int) -> DataFrame:
    """(key, label, fit) of the rows to learn from; ``fit`` marks the fit's sample."""
    mine = labels.where(F.col(label).isin(0, 1) & (F.crc32(F.col(key).cast("string")) % 5 != 0)).groupBy(F.col(key).cast("long").alias(key)).agg(F.max(label).alias("label"))
    share = min(FIT_SHARE, fit_rows / max(1, mine.count()))
    return mine.withColumn("fit", sampled(share, "fit", key).cast("int"))


def labelled(docs: DataFrame, mine: DataFrame, key: str, text: str) -> DataFrame:
    """(text, kind) of the rows to count, kind being label + 2 * fit; only these texts are shuffled.

    A filter of fixed size over the labelled keys drops most other rows before
    the join; where it fills up, the join still decides.
    """
    spot = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(FILTER_BITS))
    rows = mine.groupBy(F.bitmap_bucket_number(spot).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS, dtype=bool)  # FILTER_BITS / 32768 rows of 4 KB, whatever the input
    for n, raw in rows:
        part = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(raw), np.uint8), bitorder="little"))
        bits[(part + ((n - 1) * 32768 + 1 if n else 0)) % FILTER_BITS] = True
    asked = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(asked.value).astype(bool)
        for batch in batches:
            keep = pa.array(on[batch.column(2).to_numpy()])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], [key, text])

    some = docs.select(F.col(key).cast("long").alias(key), text, spot.alias("spot")).where(F.col(key).isNotNull()).mapInArrow(maybe, f"`{key}` long, `{text}` string")
    # a shuffle at every size: labels grow with the documents
    return some.join(mine.hint("merge"), key).select(text, (F.col("label") + 2 * F.col("fit")).cast("int").alias("kind"))


def _sample(docs: DataFrame, mine: DataFrame, key: str, text: str) -> DataFrame:
    """(text, label) of a bounded sample's documents."""
    return docs.select(F.col(key).cast("long").alias(key), text).join(F.broadcast(mine), key).select(text, "label")


def frequent_words(rows: DataFrame, text: str) -> np.ndarray:
    """The hashes of words that are a thousandth of all in ``rows``, sorted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                h, n = np.unique(words(*text_bytes(part.column(0)), PLAIN)[0], return_counts=True)
                h, n = h[n * 2000 >= n.sum()], n[n * 2000 >= n.sum()]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["word", "n"])

    got = rows.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()  # LAYOUT_ROWS texts at most
    return np.sort(got["word"].to_numpy(np.int64)[(got["n"] * 1000 >= got["n"].sum()).to_numpy(bool)])


def count_contexts(rows: DataFrame, text: str, frequent: np.ndarray) -> DataFrame:
    """(word, head, a0, a1, b0, b1): in how many ways each word follows another, by class, in all rows and without the fit's sample.

    Each different (word before, word) is counted once in a class, wherever it
    lies.  Rows meet by their word; a frequent one's are dealt out by the word
    before.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, 8 << 20):
                g = Grams.of(*text_bytes(part.column(0)))
                if not len(g.word):
                    continue
                flag = (1 << part.column(1).to_numpy())[g.doc]
                order = np.lexsort((g.before, g.word))
                word, before, flag, head = g.word[order], g.before[order], flag[order], g.head[order]
                fresh = np.append(True, word[1:] != word[:-1])
                new = fresh | np.append(True, before[1:] != before[:-1])
                at = np.flatnonzero(new)
                flag = np.bitwise_or.reduceat(flag, at)
                word, before = word[at].view(np.int64), before[at]
                # one row of a word has its first bytes; those of rows that meet are joined by or
                tail = np.where(fresh[at], (head[at] << U64(TAIL)).astype(np.int64), 0) | flag
                spread = np.where(frequent[np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)] == word, (before >> U64(56)).astype(np.int16), 0) if len(frequent) else np.zeros(len(word))
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(before.view(np.int64)), pa.array(tail), pa.array(spread.astype(np.int16))], ["word", "before", "tail", "spread"])

    met = rows.select(text, "kind").mapInArrow(pairs, "word long, before long, tail long, spread short").repartition("word", "spread")
    each = met.groupBy("word", "spread", "before").agg(F.bit_or("tail").alias("tail"))

    def having(mask: int) -> Column:
        return F.count_if(F.col("tail").bitwiseAND(F.lit(mask)) != 0)

    names = ["a0", "a1", "b0", "b1"]
    by_part = each.groupBy("word", "spread").agg(F.bit_or(F.shiftrightunsigned("tail", TAIL)).alias("head"), *(having(m).alias(n) for m, n in zip((0b0101, 0b1010, 0b0001, 0b0010), names)))
    return by_part.groupBy("word").agg(F.bit_or("head").alias("head"), *(F.sum(n).alias(n) for n in names))


def _model(spark, known: DataFrame, stems: DataFrame, columns: tuple[str, str]) -> ToxicModel:
    """The model of the counts in ``columns``; slices reach the driver one at a time."""
    c0, c1 = columns
    total = known.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns)).first()
    model = ToxicModel(np.ones((len(STEMS) + 1, 2)))
    if not (total[0] and total[1]):  # a class without counts says nothing
        return model
    small = float(min(total))
    scale = [small / total[0], small / total[1]]
    every = known.select(F.lit(0).alias("size"), F.col("word").alias("of"), c0, c1).unionByName(stems.select("size", F.col("stem").alias("of"), c0, c1))
    over = [F.greatest(F.col(c) * F.lit(s) - F.lit(DISCOUNT), F.lit(0.0)) for c, s in zip(columns, scale)]
    for row in every.groupBy("size").agg(*(F.sum(x).alias(f"own{i}") for i, x in enumerate(over))).collect():
        model.rest[0 if not row["size"] else STEMS.index(row["size"]) + 1] = [1 - row["own0"] / small, 1 - row["own1"] / small]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, of, n0, n1 = (batch.column(i).to_numpy() for i in range(4))
            h = of.view(U64).copy()
            for k in STEMS:
                h[size == k] = stem_hash(h[size == k], k)
            parts = own_part(np.stack((n0 * scale[0], n1 * scale[1]), axis=1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(parts[:, 0].copy()), pa.array(parts[:, 1].copy())], ["hash", "v0", "v1"])

    entries = stored(every.where((over[0] > 0) | (over[1] > 0)).mapInArrow(hashed, ENTRY), "model")
    step = -(-(1 << 20) // max(1, -(-entries.count() // SLICE)))
    for low in range(0, 1 << 20, step):
        # hashes are even, so a slice has SLICE rows, about; only one is in the driver at a time
        top = F.shiftright("hash", 44) + (1 << 19)
        got = entries.where((top >= low) & (top < low + step)).toArrow()
        if got.num_rows:
            h = got.column("hash").to_numpy()
            order = np.argsort(h)
            model.slices.append(spark.sparkContext.broadcast((h[order], np.stack([got.column(c).to_numpy()[order] for c in ("v0", "v1")], axis=1))))
    return model


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> tuple[ToxicModel, ToxicModel, DataFrame]:
    """(the model of all training rows, that without the fit's sample, the sample's (text, label))."""
    mine = stored(training_labels(labels, key, label, fit_rows), "labels")
    few = mine.where(sampled(LAYOUT_ROWS / max(1, mine.count()), "layout", key))
    frequent = frequent_words(_sample(docs, few, key, text), text)
    known = stored(count_contexts(labelled(docs, mine, key, text), text, frequent), "words")
    head = [F.struct(F.lit(k).alias("size"), F.col("head").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("stem")) for k in STEMS]
    names = ["a0", "a1", "b0", "b1"]
    stems = known.select(F.explode(F.array(*head)).alias("s"), *names).groupBy("s.size", "s.stem").agg(*(F.sum(n).alias(n) for n in names))
    stems = stored(stems, "stems")
    spark = docs.sparkSession
    return _model(spark, known, stems, ("a0", "a1")), _model(spark, known, stems, ("b0", "b1")), _sample(docs, mine.where("fit = 1").select(key, "label"), key, text)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps; (centre, scale, weights with the constant last)."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.concatenate(((x - centre) / scale, np.ones((len(x), 1))), axis=1)
    w = np.zeros(z.shape[1])
    keep = np.diag([*[ridge] * x.shape[1], 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def evidence(x: np.ndarray) -> np.ndarray:
    """The logistic function's inputs: logs of the length-normalised ratios, from what is noise on."""
    return np.log(np.maximum(x[:, :2], 0) + np.array([0.002, 0.02]))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: key, held_out, score, predicted, llr_per_word.

    Whole texts are scored, of any length.  A null or empty text is scored as
    one whose words say nothing; equal texts get equal scores, and each of
    repeated rows its own.  Labels other than 0 and 1 are none; of several for
    one key, 1 wins.  Where a class has no row to learn from, all scores are
    the share of label 1 in the fit's sample, or 0.5 without one.  An empty
    table gives no rows.  A null key is not held out.
    """
    model, without, sample = learn(docs, labels, key, text, label, fit_rows)

    def measured(model: ToxicModel, keep: str, kind: str):
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, text):
                    x = model.features(*text_bytes(part.column(1)))
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(np.ascontiguousarray(c)) for c in x.T)], [keep, *FEATURES])

        return measure, f"`{keep}` {kind}, " + ", ".join(f"{f} double" for f in FEATURES)

    got = sample.select(F.col("label").cast("int").alias("label"), text).mapInArrow(*measured(without, "label", "int")).toPandas()  # fit_rows, about
    got = got.sort_values(list(got.columns))
    x, y = evidence(got[list(FEATURES)].to_numpy(dtype=float)), got["label"].to_numpy(dtype=float)
    if len(y) and 0 < y.sum() < len(y):
        centre, scale, w = fit_logistic(x, y)
    else:
        p = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
        centre, scale, w = np.zeros(2), np.ones(2), np.array([0.0, 0.0, np.log(p / (1 - p))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                x = model.features(*text_bytes(part.column(1)))
                p = 1 / (1 + np.exp(-np.clip((evidence(x) - centre) / scale @ w[:2] + w[2], -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(np.ascontiguousarray(x[:, 0])), pa.array(np.ascontiguousarray(x[:, 2]))], [key, "score", "predicted", "llr_per_word", "mean_ratio"])

    held = F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))
    done = docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(judge, f"`{key}` long, score double, predicted int, llr_per_word double, mean_ratio double")
    return done.select(key, held.alias("held_out"), "score", "predicted", "llr_per_word", "mean_ratio")
