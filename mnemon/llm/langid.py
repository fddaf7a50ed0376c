"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1.  For each bit a binary classifier on
byte trigrams (log-odds with additive smoothing, as in naive Bayes) tells the
two halves of the languages apart; decoding sums a logistic loss of the bits'
margins, weighted by how far apart each bit's halves are, and takes the nearest
codeword.  A text whose second language is nearly as near is marked ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemon.llm.shared import sampled
from mnemon.llm.textscan import PLAIN, U64, mix, pieces, text_bytes

BINS = 1 << 15
#: Labelled rows to learn from, about: rows are taken by a hash of their key, all of them where there are fewer.
SAMPLE_ROWS = 20_000
#: A text whose score is below this is marked ambiguous.
AMBIGUOUS = 0.6

_CODES = (mix(np.arange(1, 769, dtype=U64)) & U64(BINS - 1)).astype(np.uint16).reshape(3, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, first gram) of the byte trigrams round each letter; a text starts and ends with a gap."""
    n = len(data)
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    fold[PLAIN.gap] = 32
    fold[48:58] = 32
    x = fold[data]
    up = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1 if n else np.zeros(0, np.int64)
    x[up] += 32
    before, after = np.empty(n, np.uint8), np.empty(n, np.uint8)
    if n:
        before[0], before[1:], after[-1], after[:-1] = 32, x[:-1], 32, x[1:]
        before[offsets[:-1][offsets[:-1] < n]] = 32
        after[offsets[1:][offsets[1:] > 0] - 1] = 32
    at = np.flatnonzero(x != 32)
    bins = _CODES[0][before[at]] ^ _CODES[1][x[at]] ^ _CODES[2][after[at]]
    return bins, np.searchsorted(at, offsets)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of +1/-1: all splits in two for k up to 7, else random splits far from each other."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 7:
        splits = np.arange(1, 1 << (k - 1))
        return np.where((splits[None, :] >> np.arange(k)[:, None]) & 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(k)))
    best, far = None, -1
    for _ in range(50):
        m = rng.choice([-1.0, 1.0], (k, bits))
        apart = ((bits - m @ m.T) / 2 + bits * np.eye(k)).min()
        if apart > far and (np.abs(m.sum(0)) < k).all():
            best, far = m, apart
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray
    weight: np.ndarray
    table: np.ndarray  # bits x BINS

    @classmethod
    def fit(cls, counts: dict[str, np.ndarray]) -> LanguageModel:
        languages = sorted(counts)
        codes = codewords(len(languages))
        each = np.stack([counts[x] / max(1.0, counts[x].sum()) for x in languages]) if languages else np.zeros((0, BINS))
        size = sum(float(c.sum()) for c in counts.values())
        floor = 1.0 / max(size, BINS)
        table = np.zeros((codes.shape[1], BINS), dtype=np.float32)
        weight = np.zeros(codes.shape[1])
        for b in range(codes.shape[1]):
            yes, no = codes[:, b] > 0, codes[:, b] < 0
            if not (yes.any() and no.any()):
                continue
            p, q = each[yes].mean(0), each[no].mean(0)  # languages count alike, however many texts they have
            table[b] = np.log((p + floor) / (q + floor))
            weight[b] = ((p - q) * table[b]).sum()
        if weight.sum() > 0:
            weight = weight / weight.sum() * len(weight)
        return cls(languages, codes, weight, table)

    def decode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score) of each text; index -1 where there is nothing to go by."""
        n = len(offsets) - 1
        bins, first = grams(data, offsets)
        many = np.diff(first)
        has = np.flatnonzero(many)
        pred, score = np.full(n, -1), np.zeros(n)
        if not len(has) or not self.languages:
            return pred, score
        margin = np.empty((len(has), self.table.shape[0]))
        for b in range(self.table.shape[0]):
            margin[:, b] = np.add.reduceat(self.table[b][bins], first[:-1][has])
        count = many[has][:, None]
        # evidence grows with the root of the text's size, and no more from 100 letters on
        margin = 3 * margin / count * np.sqrt(np.minimum(count, 100) / 100)
        loss = (self.weight[None, None, :] * np.logaddexp(0, -self.codes[None, :, :] * margin[:, None, :])).sum(2)
        best = loss.argmin(1)
        near = np.exp(loss.min(1, keepdims=True) - loss)
        pred[has], score[has] = best, 1 / near.sum(1)
        return pred, score


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on about ``sample_rows`` of the rows with a language whose crc32(key) mod 4 is not 2."""
    spark = docs.sparkSession
    mine = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.crc32(F.col(key).cast("string")) % 4 != 2))
    total = mine.count()
    mine = mine.where(sampled(sample_rows / max(1, total), "lang", key))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, text, 1 << 20):
                data, offsets = text_bytes(part.column(0))
                bins, first = grams(data, offsets)
                names = np.array(part.column(1).to_pylist(), dtype=object)
                owner = np.repeat(names, np.diff(first))
                for name in set(names):
                    by[name] = by.get(name, 0) + np.bincount(bins[owner == name], minlength=BINS)
        for name, c in by.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))], ["lang", "bin", "n"])

    rows = mine.select(text, F.col(lang).alias("lang")).mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    found = rows.toArrow()  # BINS rows a language at most
    if found.num_rows:
        names, bins, n = found["lang"].to_numpy(), found["bin"].to_numpy(), found["n"].to_numpy()
        for name in set(names):
            counts[name] = np.zeros(BINS)
            counts[name][bins[names == name]] = n[names == name]
    return LanguageModel.fit(counts)


def _labels(model: LanguageModel, column: pa.Array, lettered: pa.Array) -> tuple[list[str], np.ndarray]:
    pred, score = model.decode(*text_bytes(column))
    known = lettered.fill_null(False).to_numpy(zero_copy_only=False) & (pred >= 0)
    names = np.array([*model.languages, "und"], dtype=object)[np.where(known, pred, -1)]
    return names.tolist(), np.where(known, score, 0.0)


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, lang_pred, score, ambiguous.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text where no language was learned.  A null key is not held out.  Texts are
    read whole, of any length; of languages that are equally near the first by
    name is taken and marked ambiguous; rows that repeat are told each; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BINS floats a bit

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, 1 << 20):
                names, score = _labels(shared.value, part.column(1), part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)], [key, "lang_pred", "score", "ambiguous"]
                )

    found = docs.select(F.col(key).cast("long").alias(key), text, F.col(text).rlike(r"\p{L}").alias("lettered")).mapInArrow(
        predict, f"`{key}` long, lang_pred string, score double, ambiguous boolean"
    )
    held = F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
    return found.select(key, held.alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows whose language is told apart: neither ``und`` nor a tie of languages; all columns stay.

    Null and empty texts go; repeated rows stay each or go each; an empty table
    stays empty, and without a language learned all rows go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    names = [f"c{i}" for i in range(len(docs.columns))]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, names[place], 1 << 20):
                found, score = _labels(shared.value, part.column(place), part.column(len(names)))
                # with k languages a score of 1/k is a guess; whatever is surer stays
                sure = score > 1.05 / max(1, len(shared.value.languages)) if len(shared.value.languages) > 1 else score > 0
                keep = pa.array((np.array(found, dtype=object) != "und") & sure)
                yield pa.RecordBatch.from_arrays([part.column(i).filter(keep) for i in range(len(names))], names)

    schema = docs.schema
    flat = docs.toDF(*names).withColumn("lettered", F.col(names[place]).rlike(r"\p{L}"))
    out = flat.mapInArrow(clean, docs.toDF(*names).schema)
    return out.toDF(*schema.names)
