"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Iterative quantisation learns, on a bounded sample, a rotation after PCA whose
signs keep the vectors best (about the origin, as cosines are): codes of one bit a dimension.  A code is cut into
chunks, and each chunk is a table: two vectors meet where a chunk is equal.
With the threshold's angle a chunk of b bits agrees with probability
(1 - angle/pi)^b, which sets how many tables (and, beyond one code's chunks,
how many more rotations) reach the target recall.

Only ids and codes go to the tables.  A bucket is compared in blocks of bounded
size, each pair in the first table where it meets, by the Hamming distance of
whole codes; what is near enough is reranked by cosine in double precision with
the original vectors.  Of a block with few near pairs these are fetched by pair.
A block with many (a large group of near copies) is fetched as a whole and gives
each vector its number of links and a spanning forest, never its pairs.

Equal vectors are one class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemon.llm.components import components
from mnemon.llm.shared import sampled, shuffle_partitions, stored

#: Vectors, about, that rotations are learned from.
SAMPLE = 20_000
#: Vectors of a bucket that are compared at once, on each side.
BLOCK = 1024
#: Vectors that a bucket has on average, as a power of two.
BUCKET_BITS = 6
#: Classes of that many copies or more, HOT of them at most, are broadcast at the end.
HOT_COPIES, HOT = 64, 1024
#: Near pairs for each vector of a block from which on it is fetched as a whole.
DENSE = 4


@dataclass
class Quantiser:
    """Rotations; ``bits`` a chunk, ``tables`` chunks in all."""

    rotations: list[np.ndarray]
    bits: int
    tables: int
    near: int

    @classmethod
    def fit(cls, sample: np.ndarray, n: int, threshold: float, recall: float, seed: int = 3, rounds: int = 30) -> Quantiser:
        d = sample.shape[1]
        bits = min(d, 30, max(8, math.ceil(math.log2(max(2, n))) - BUCKET_BITS))
        apart = math.acos(threshold) / math.pi
        meet = (1 - apart) ** bits
        tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))
        # planes through the origin: the share of equal signs then follows from the angle, also where one group is most of the data
        x = sample
        _, vectors = np.linalg.eigh(x.T @ x)
        c = min(d, max(bits, 64))
        basis = vectors[:, ::-1][:, :c]
        v = x @ basis
        rotations = []
        for i in range(-(-tables // max(1, c // bits))):
            rng = np.random.default_rng(seed + i)
            r, _ = np.linalg.qr(rng.normal(size=(c, c)))
            for _ in range(rounds):
                b = np.where(v @ r >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(b.T @ v)
                r = (left @ right).T
            rotations.append(basis @ r)
        whole = c * len(rotations)
        # four deviations beyond what vectors at the threshold have
        return cls(rotations, bits, tables, math.ceil(whole * apart + 4 * math.sqrt(whole * apart * (1 - apart)) + 1))

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Each vector's signs under all rotations, one bit each."""
        return np.packbits(np.concatenate([unit @ r >= 0 for r in self.rotations], axis=1), axis=1)

    def keys(self, codes: np.ndarray, tables: int | None = None) -> np.ndarray:
        """One key a table (of the first ``tables``) of each code."""
        tables = self.tables if tables is None else tables
        signs = np.unpackbits(codes, axis=1)
        c = self.rotations[0].shape[1]
        power = 1 << np.arange(self.bits)
        out = np.empty((len(codes), tables), dtype=np.int32)
        for t in range(tables):
            low = t // (c // self.bits) * c + t % (c // self.bits) * self.bits
            out[:, t] = signs[:, low : low + self.bits] @ power
        return out


def _units(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def forest(linked: np.ndarray) -> np.ndarray:
    """Each row's least row that links reach, by rounds of minima."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _only_here(linked: np.ndarray, keys: np.ndarray, left: np.ndarray | None) -> np.ndarray:
    """Of the pairs in ``linked`` those that meet in no table before (``keys`` are those tables') and, if ``left`` tells the sides, across blocks."""
    np.fill_diagonal(linked, False)
    for t in range(keys.shape[1]):
        linked &= keys[:, t][:, None] != keys[:, t][None, :]
    if left is not None:
        linked &= left[:, None] != left[None, :]
    return linked


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Sorted rows by their first ``n_keys`` columns; each group is a bucket's blocks, so bounded."""
    at, held = None, []
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(i).to_numpy() for i in range(n_keys)], axis=1)
            cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(cut, cut[1:]):
                key = tuple(keys[low].tolist())
                if key != at:
                    if held:
                        yield at, pa.concat_batches(held)
                    at, held = key, []
                held.append(batch.slice(low, high - low))
    if held:
        yield at, pa.concat_batches(held)


def _bytes(column: pa.Array) -> np.ndarray:
    """Binary cells of one length as rows of bytes."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), -1)


_FOUND = "kind byte, a long, b long, c long, table int, bucket int, low int, high int, mine int"


def _found(kind: int, *columns) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.int32()] * 5
    n = len(columns[0])
    arrays = [pa.nulls(n, k) if i >= len(columns) or columns[i] is None else pa.array(np.broadcast_to(columns[i], n), k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *arrays], ["kind", "a", "b", "c", "table", "bucket", "low", "high", "mine"])


def _one_length(vectors: DataFrame, threshold: float, recall: float, sample: int) -> DataFrame:
    """(vec, links, root) of each class of equal vectors (vec, n, v) of one length."""
    spark = vectors.sparkSession
    n = vectors.count()
    rows = vectors.where(sampled(sample / max(1, n), "itq", "vec")).select("v").collect()  # ``sample``, about
    if not rows:
        rows = vectors.select("v").limit(1).collect()
    shared = spark.sparkContext.broadcast(Quantiser.fit(_units(np.array([r[0] for r in rows])), n, threshold, recall))
    tables = shared.value.tables

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = shared.value.codes(_units(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(list(shared.value.keys(codes)), pa.list_(pa.int32()))], ["vec", "code", "keys"])

    coded = stored(vectors.select("vec", "v").mapInArrow(code, "vec long, code binary, keys array<int>"), "codes")
    met = coded.select(F.posexplode("keys").alias("table", "bucket")).groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    unfolded = coded.select("vec", "code", F.posexplode("keys").alias("table", "bucket")).join(met, ["table", "bucket"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64(F.lit("block"), "vec"), blocks.cast("long")).cast("int")
    spread = unfolded.withColumns({"mine": mine, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    spread = spread.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    group = ["table", "bucket", "low", "high"]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for (table, bucket, low, high), rows in _groups(batches, 4):
            if rows.num_rows < 2:
                continue
            vec, codes, side = rows.column(4).to_numpy(), _bytes(rows.column(5)), rows.column(6).to_numpy()
            signs = 1 - 2 * np.unpackbits(codes, axis=1)[:, : q.rotations[0].shape[1] * len(q.rotations)].astype(np.float32)
            close = signs.shape[1] - signs @ signs.T <= 2 * q.near
            close = np.triu(_only_here(close, q.keys(codes, table), None if low == high else side == low))
            x, y = np.nonzero(close)
            if len(x) > DENSE * len(vec):
                some = np.flatnonzero(close.any(0) | close.any(1))
                yield _found(1, vec[some], None, None, table, bucket, low, high, side[some])
            elif len(x):
                yield _found(0, vec[x], vec[y])

    dealt = spread.select(*group, "vec", "code", "mine").repartition(shuffle_partitions(spark), *group).sortWithinPartitions(*group)
    candidates = stored(dealt.mapInArrow(near, _FOUND), "near")
    whole = vectors.select("vec", "n", "v")
    pairs = candidates.where("kind = 0").select("a", "b").join(whole.toDF("a", "na", "va"), "a").join(whole.toDF("b", "nb", "vb"), "b")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_units(batch.column(i).flatten().to_numpy().reshape(batch.num_rows, -1)) for i in (4, 5))
                linked = np.flatnonzero((x * y).sum(1) >= threshold)
                a, b, na, nb = (batch.column(i).to_numpy()[linked] for i in range(4))
                yield _found(0, np.concatenate((a, b)), np.concatenate((nb, na)))
                yield _found(1, a, b)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for (table, _, low, high), rows in _groups(batches, 4):
            vec, side, codes, many = (rows.column(4).to_numpy(), rows.column(5).to_numpy(), _bytes(rows.column(6)), rows.column(7).to_numpy())
            x = _units(rows.column(8).flatten().to_numpy().reshape(len(vec), -1))
            linked = _only_here(x @ x.T >= threshold, q.keys(codes, table), None if low == high else side == low)
            some = np.flatnonzero(linked.any(1))
            if len(some):
                linked, vec = linked[np.ix_(some, some)], vec[some]
                root = forest(linked)
                yield _found(0, vec, linked @ many[some])
                yield _found(1, vec[root != np.arange(len(vec))], vec[root[root != np.arange(len(vec))]])

    dense = candidates.where("kind = 1").select(*group, F.col("a").alias("vec"), "mine")
    dense = dense.join(coded.select("vec", "code"), "vec").join(whole, "vec").select(*group, "vec", "mine", "code", "n", "v")
    dense = dense.repartition(shuffle_partitions(spark), *group).sortWithinPartitions(*group)
    links = pairs.select("a", "b", "na", "nb", "va", "vb").mapInArrow(rerank, _FOUND).unionByName(dense.mapInArrow(compare, _FOUND))
    found = stored(links.select("kind", "a", "b"), "links")
    links = found.where("kind = 0").groupBy(F.col("a").alias("vec")).agg(F.sum("b").alias("links"))
    roots = components(found.where("kind = 1").select("a", "b"))
    out = vectors.select("vec", "n").join(links, "vec", "left").join(roots.withColumnRenamed("node", "vec"), "vec", "left")
    return out.select("vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "vec").alias("root"))


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, recall: float = 0.97, sample: int = SAMPLE) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, as do vectors of different lengths with one another.  Of
    rows that repeat a key with one vector each counts as a vector of its own;
    a null key names no component unless all of a component's are null.  Vectors
    of doubles are kept as such; an empty table gives no rows.
    """
    element = "float" if df.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{element}>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(F.col("v").isNotNull() & sound, F.lit(False)))
    rows = rows.withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x + F.lit(0.0).cast(element))))  # -0.0 is 0.0
    # classes are told apart by the whole vector; the numbers that name them are written down once
    classes = rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.withColumn("vec", F.monotonically_increasing_id()).select("vec", "least", "n", "v"), "classes")
    lengths = [r[0] for r in classes.select(F.size("v").alias("d")).distinct().collect()]
    each = None
    for d in sorted(lengths):
        part = _one_length(classes.where(F.size("v") == d), threshold, recall, sample)
        each = part if each is None else each.unionByName(part)
    if each is None:
        each = classes.select("vec", F.lit(0).cast("long").alias("links"), F.col("vec").alias("root"))
    each = stored(each.join(classes.select("vec", "least"), "vec"), "roots")
    least = each.groupBy("root").agg(F.min("least").alias("component_id"))
    named = each.join(least, "root").select("vec", "links", "component_id")
    named = stored(classes.select("vec", "n", "v").join(named, "vec").select("v", "n", "links", "component_id"), "named")
    # a class may have most rows, so those of the largest classes don't move: a table of HOT rows at most goes to them
    hot = named.where(F.col("n") >= HOT_COPIES).orderBy(F.desc("n"), "component_id").limit(HOT).select("v", F.lit(True).alias("hot"), F.col("links").alias("hot_links"), F.col("component_id").alias("hot_id"))
    first = rows.select("vec_id", "v").join(F.broadcast(hot), "v", "left")
    there = first.where("hot").select("vec_id", F.col("hot_links").alias("links"), F.col("hot_id").alias("component_id"))
    joined = there.unionByName(first.where("hot is null").select("vec_id", "v").join(named.drop("n"), "v", "left").drop("v"))
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        F.col("vec_id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
