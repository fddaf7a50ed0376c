"""Exact Jaccard self-join of word-shingle sets by a partitioned universe.

Two sets that differ in at most H tokens agree on one of any H + 1 segments of
the universe.  For Jaccard t and sizes x <= y, H = (x + y)(1 - t)/(1 + t), so
sets are banded by size (a partner is in the same band or the next) and each
band has its own number of segments.  A set is indexed once as the smaller side
of its band and once as the larger side of the band below.

A segment without tokens says nothing, so only non-empty ones are indexed; a
pair is found if one of its sets has H + 1 of them.  The allocation of a set:

* level 0: segments of its tokens that are not common in the corpus.  Leaving
  out tokens from both sides never adds a difference, so H holds as it is;
* level 1: sets without enough segments index each of those tokens alone, which
  is enough unless three quarters of the set are common tokens;
* level 2: those sets index the segments of all their tokens;
* levels 3 to 5: sets still short use half as many segments with one-deletion
  neighbourhoods (a segment and all its subsets that lack one token), which
  find a pair if more than H/2 segments have two tokens; each level deals anew;
* level 6: the rest indexes empty segments too.

A pair needs a common level only if both its sets went on to it, so the cheap
levels carry nearly everything.  Candidates are verified on the whole sets.

Any partner shares so many of a set's segments that most sets which merely hold
a common passage fall out by their count of shared ones.  Of the candidates each
set first meets one; a bucket of many sets isn't unfolded into pairs, its members
meet one of them.  In a second round each member of a bucket that still holds
several components meets the bucket's middle, the set with the fewest tokens of
its own.  Last, what is left in different components meets pair by pair, but for
pairs that can't share what a link takes: by the tokens of their own that they
have, and by what each shares with a common middle.  Sets that share one bucket
mostly share many, so buckets that hang together are one unit there, unless its
pairs are more than those of its buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon.llm.components import components
from mnemon.llm.shared import shuffle_partitions, stored
from mnemon.llm.textscan import U64, distinct, mix, mix_int, pieces, shingles, text_bytes, words

#: Signatures that one reducing task sorts at most, on average.
SIGNATURES_A_TASK = 1_500_000
#: A token is common if this share of the documents has it; of those the most frequent are left out.
COMMON_SHARE, COMMON_MOST = 0.002, 1 << 16
#: Buckets up to this size give all their pairs.
SMALL_BUCKET = 6
#: Parts of the universe that a pair's intersection is told by.
GROUPS = 32
#: Sets of that many copies or more are indexed from one document alone; of those the ones with most copies are known to all tasks.
HOT_COPIES, HOT_MOST = 64, 1 << 16
#: Tasks that the members of one bucket are dealt out to, and members of a bucket that meet others at once.
SALTS, BLOCK = 8, 1024
#: Pairs of one set that a task compares with one copy of it, on average.
HUB_PAIRS = 32
#: Bits of the filter of documents to read again; what it lets pass wrongly costs time only.
FILTER_BITS = 1 << 23


@dataclass(frozen=True)
class Threshold:
    """Jaccard of ``num``/``den`` or more."""

    num: int = 75
    den: int = 100

    def partner(self, size: int) -> int:
        """The largest partner of a set of this size."""
        return size * self.den // self.num

    def differences(self, both: np.ndarray | int) -> np.ndarray | int:
        return both * (self.den - self.num) // (self.den + self.num)

    def cuts(self, most: int) -> np.ndarray:
        """The least size of each band, to beyond ``most``."""
        out = [1]
        while out[-1] <= most:
            out.append(max(out[-1] + 1, self.partner(out[-1] - 1) + 1) if out[-1] > 1 else 2)
        out.append(max(out[-1] + 1, self.partner(out[-1] - 1) + 1))
        return np.array(out, dtype=np.int64)

    def overlap(self, size: np.ndarray) -> np.ndarray:
        """The least intersection of a set of this size with any partner."""
        return -(-size * self.num // self.den)


def token_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct k-word shingles, sorted, and the offsets."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    h, doc, _, _ = words(data, offsets)
    values, at = shingles(h, doc, n, k)
    return distinct(values, at, n)


def set_keys(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set, as a signed number; 0 for an empty set."""
    size = np.diff(offsets)
    out = np.zeros(len(size), dtype=U64)
    full = np.flatnonzero(size)
    if len(full):
        out[full] = mix(np.add.reduceat(mix(values ^ U64(0x5BF0A8B1)), offsets[full]) + size[full].astype(U64)) | U64(1)
    return out.view(np.int64)


def names(keys: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """What sets are called: size and the low ``width`` bytes of the key, or the whole key."""
    return keys if width == 8 else keys & ((1 << 8 * width) - 1) ^ (size.astype(np.int64) << 40)


def _name(width: int) -> Column:
    """``names`` of the columns key and n."""
    return F.col("key") if width == 8 else F.col("key").bitwiseAND(F.lit((1 << 8 * width) - 1)).bitwiseXOR(F.shiftleft("n", 40))


def _width(classes: DataFrame) -> int:
    """The fewest bytes of the keys, 4 at least, by which all sets have names of their own.

    An index entry is sent with its set's name, so these bytes are most of what
    it weighs where few of an entry's signatures go to one task.
    """
    for width in (4, 5, 6, 7):
        if classes.groupBy(_name(width).alias("name")).agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").isEmpty():
            return width
    return 8


def _flat(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of the rows' values one after another, and which of ``rows`` each is of."""
    size = offsets[rows + 1] - offsets[rows]
    owner = np.repeat(np.arange(len(rows)), size)
    start = np.cumsum(size) - size
    return np.arange(len(owner)) - np.repeat(start - offsets[rows], size), owner


def _segments(values: np.ndarray, owner: np.ndarray, m: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sum and count of each segment, the segments' first index by row, and each token's segment and value."""
    base = np.concatenate(([0], np.cumsum(m)))
    segment = base[owner] + (mix(values + U64(mix_int(seed))) % m[owner].astype(U64)).astype(np.int64)
    value = mix(values ^ U64(mix_int(seed + 1)))
    total = np.zeros(base[-1], dtype=U64)
    np.add.at(total, segment, value)
    return total, np.bincount(segment, minlength=base[-1]), base, segment, value


def _tag(level: int, band: np.ndarray, within: np.ndarray) -> np.ndarray:
    return mix(U64(level << 56) + (band.astype(U64) << U64(32)) + within.astype(U64))


@dataclass
class Entries:
    """Index entries: each signature's entry, and each entry's set, code and least count of shared signatures.

    A code is even for the smaller side and odd for the larger one, and tells
    level and band.  Any partner shares ``need`` of an entry's signatures or
    more, if the pair is to be found at this entry's level.
    """

    signature: np.ndarray
    entry: np.ndarray
    row: np.ndarray
    code: np.ndarray
    need: np.ndarray


def signatures(values: np.ndarray, offsets: np.ndarray, common: np.ndarray, t: Threshold) -> Entries:
    """All sets' index entries; empty sets have none."""
    size = np.diff(offsets)
    cuts = t.cuts(int(size.max(initial=1)))
    rows = np.flatnonzero(size)
    band = np.searchsorted(cuts, size[rows], side="right") - 1
    # every set is the smaller side in its band; in the band below it is the larger side
    row = np.concatenate((rows, rows[band > 0]))
    b = np.concatenate((band, band[band > 0] - 1))
    larger = np.concatenate((np.zeros(len(rows), bool), np.ones(int((band > 0).sum()), bool)))
    top = cuts[b + 1] - 1
    most = t.differences(top + np.array([t.partner(int(x)) for x in cuts[1:] - 1])[b])
    own = np.where(larger, t.differences(size[row] + np.minimum(top, size[row])), t.differences(size[row] + size[row] * t.den // t.num))
    is_rare = np.ones(len(values), dtype=bool)
    if len(common) and len(values):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        is_rare = common[at] != values
    rare_at = np.concatenate(([0], np.cumsum(is_rare)))
    rare, rare_offsets = values[is_rare], rare_at[offsets]
    made: list[tuple[np.ndarray, ...]] = []
    entries = 0

    def add(level: int, who: np.ndarray, sig: list[np.ndarray], of: list[np.ndarray], need: np.ndarray) -> None:
        nonlocal entries
        code = (level * 1024 + b[who]) * 2 + larger[who]
        made.append((np.concatenate(sig), np.concatenate(of) + entries, row[who], code, np.maximum(need, 1)))
        entries += len(who)

    def exact(level: int, who: np.ndarray, vals: np.ndarray, offs: np.ndarray, m: np.ndarray, empty: bool = False) -> np.ndarray:
        """Index the segments of entries ``who``; those of them that have too few."""
        pos, owner = _flat(offs, row[who])
        total, count, base, _, _ = _segments(vals[pos], owner, m, 1000 * (level + 1))
        entry = np.repeat(np.arange(len(who)), m)
        full = np.arange(len(count)) if empty else np.flatnonzero(count)
        have = np.bincount(entry[full], minlength=len(who))
        enough = have > own[who]
        e = entry[full]
        add(level, who, [mix(total[full] ^ _tag(level, b[who][e], full - base[e]))], [e], have - own[who])
        return who[~enough]

    def singles(level: int, who: np.ndarray) -> np.ndarray:
        pos, owner = _flat(rare_offsets, row[who])
        n = size[row[who]]
        n_common = n - (rare_offsets[row[who] + 1] - rare_offsets[row[who]])
        add(level, who, [mix(rare[pos] ^ _tag(level, b[who][owner], np.zeros(len(owner), np.int64)))], [owner], t.overlap(n) - n_common)
        return who[n_common >= t.overlap(n)]

    def deletions(level: int, who: np.ndarray) -> np.ndarray:
        half = most[who] // 2
        m = half + 1 + (half + 3) // 4
        pos, owner = _flat(offsets, row[who])
        total, count, base, segment, value = _segments(values[pos], owner, m, 1000 * (level + 1))
        entry = np.repeat(np.arange(len(who)), m)
        full = np.flatnonzero(count)
        less = np.flatnonzero(count[segment] > 1)
        s = segment[less]
        two = np.bincount(entry[count > 1], minlength=len(who))
        add(
            level, who,
            [mix(total[full] ^ _tag(level, b[who][entry[full]], full - base[entry[full]])), mix((total[s] - value[less]) ^ _tag(level, b[who][owner[less]], s - base[owner[less]]))],
            [entry[full], owner[less]],
            two - own[who] // 2,
        )
        return who[two <= own[who] // 2]

    whole = most + 1
    spare = whole + (most + 3) // 4
    left = exact(0, np.arange(len(row)), rare, rare_offsets, spare)
    if len(left):
        left = singles(1, left)
    if len(left):
        left = exact(2, left, values, offsets, spare[left])
    for level in (3, 4, 5):
        if len(left):
            left = deletions(level, left)
    if len(left):
        exact(6, left, values, offsets, whole[left], empty=True)
    return Entries(*(np.concatenate(x) for x in zip(*made)))


def _scan(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """One row per document (doc, cls, n) and rows of tokens that are frequent in a slice (tok, n, in_docs)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                values, offsets = token_sets(part.column(1), k)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(set_keys(values, offsets)), pa.array(np.diff(offsets)), pa.nulls(n, pa.int64())], ["doc", "cls", "n", "tok"]
                )
                tokens, count = np.unique(values, return_counts=True)
                often = count >= max(3, COMMON_SHARE * n)
                tokens, count = tokens[often].view(np.int64), count[often]
                none = pa.nulls(len(tokens), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(count.astype(np.int64)), pa.array(tokens)], ["doc", "cls", "n", "tok"])

    return docs.select(F.col(key).cast("long").alias("doc"), F.col(text)).mapInArrow(scan, "doc long, cls long, n long, tok long")


def _common(scanned: DataFrame, total: int) -> np.ndarray:
    """The tokens of COMMON_SHARE of the documents, COMMON_MOST of them at most, sorted.

    A token with that share of all documents has it in one slice at least, so
    none is missed but by what its other slices don't tell.  Which tokens are
    left out changes the cost and never the result.
    """
    often = scanned.where("tok is not null").groupBy("tok").agg(F.sum("n").alias("n")).where(F.col("n") >= max(8, COMMON_SHARE / 2 * total))
    found = [r[0] for r in often.orderBy(F.desc("n"), "tok").limit(COMMON_MOST).select("tok").collect()]
    return np.sort(np.array(found, dtype=np.int64).view(U64))


def _hot(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sets with most copies, the document that speaks for each), HOT_MOST at most, sorted by set.

    What isn't among them has less than 1/HOT_MOST of all documents as copies.
    """
    rows = classes.where((F.col("copies") >= HOT_COPIES) & F.col("least").isNotNull()).orderBy(F.desc("copies"), "key").limit(HOT_MOST).select("key", "least").collect()
    found = np.array(sorted((r[0], r[1]) for r in rows), dtype=np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _salted(rows: DataFrame, one_each: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined by bucket with a table of one row a bucket; a large bucket's rows are dealt out to SALTS tasks."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int"))
    every = one_each.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(every, ["bucket", "salt"], how).drop("salt")


def _index(docs: DataFrame, key: str, text: str, k: int, t: Threshold, common: np.ndarray, hot: tuple[np.ndarray, np.ndarray], parts: int, width: int) -> DataFrame:
    """Signatures packed by the task that they go to: 4 bytes each, by owner; what is said of owners lies byte by byte, so zeros compress."""
    common = docs.sparkSession.sparkContext.broadcast(common)  # COMMON_MOST numbers at most
    spoken = docs.sparkSession.sparkContext.broadcast(hot)  # HOT_MOST pairs at most

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, 2 << 20):
                values, offsets = token_sets(piece.column(0), k)
                keys = set_keys(values, offsets)
                mine = keys != 0
                sets, least = spoken.value
                if len(sets):
                    at = np.minimum(np.searchsorted(sets, keys), len(sets) - 1)
                    mine &= (sets[at] != keys) | (least[at] == piece.column(1).to_numpy())
                rows = np.flatnonzero(mine)
                first = np.sort(rows[np.unique(keys[rows], return_index=True)[1]])
                if not len(first):
                    continue
                size = np.diff(offsets)
                pos, _ = _flat(offsets, first)
                made = signatures(values[pos], np.concatenate(([0], np.cumsum(size[first]))), common.value, t)
                part = (made.signature >> U64(40)) % U64(parts)
                # signatures of a set that are alike in their task count once there, so less of them is asked for
                alike = mix((part << U64(32) | made.signature & U64(0xFFFFFFFF)) ^ mix(made.row[made.entry].astype(U64)))
                ordered = np.sort(alike)
                again = np.isin(alike, ordered[1:][ordered[1:] == ordered[:-1]])
                need = np.maximum(made.need - np.bincount(made.entry[again], minlength=len(made.need)), 1)
                # entries that are alike in code and size follow each other, which compresses well
                place = np.empty(len(made.row), dtype=np.int64)
                place[np.lexsort((size[first][made.row], made.code))] = np.arange(len(made.row))
                order = np.lexsort((place[made.entry], part))
                sig, entry, part = made.signature[order], made.entry[order], part[order].astype(np.int64)
                new = np.ones(len(sig), dtype=bool)
                new[1:] = (part[1:] != part[:-1]) | (entry[1:] != entry[:-1])
                at = np.flatnonzero(new)
                many = np.diff(np.append(at, len(sig)))
                low = sig.astype(np.uint32)
                of = made.row[entry[at]]
                owner = keys[first][of].view(np.uint8).reshape(-1, 8)[:, :width]
                about = np.stack((size[first][of], made.code[entry[at]], need[entry[at]], many), axis=1).astype(np.uint32).view(np.uint8)
                cut = np.flatnonzero(np.append(True, part[at][1:] != part[at][:-1]))
                stop = np.append(cut[1:], len(at))
                byte = np.append(at, len(sig))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[at][cut].astype(np.int32)),
                        pa.array([low[byte[x] : byte[y]].tobytes() for x, y in zip(cut, stop)], pa.binary()),
                        pa.array([owner[x:y].tobytes() for x, y in zip(cut, stop)], pa.binary()),
                        pa.array([about[x:y].T.tobytes() for x, y in zip(cut, stop)], pa.binary()),
                    ],
                    ["part", "sigs", "owners", "about"],
                )

    return docs.select(text, F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc")).mapInArrow(pack, "part int, sigs binary, owners binary, about binary")


_FOUND = "kind byte, a long, b long, c long, d long"


def _found(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    n = len(columns[0])
    arrays = [pa.array(np.full(n, kind, np.int8)), *(pa.array(np.ascontiguousarray(c).astype(np.int64, copy=False)) for c in columns)]
    return pa.RecordBatch.from_arrays([*arrays, *[pa.nulls(n, pa.int64())] * (5 - len(arrays))], ["kind", "a", "b", "c", "d"])


def _buckets(packed: DataFrame, parts: int, t: Threshold, width: int) -> DataFrame:
    """What shares signatures, by ``kind``.

    0: candidate pairs (a, b) of small buckets; 1: members of large buckets
    (bucket, cls, code, size); 2: how many signatures an entry shares with
    others in this task (cls, code, count, need).
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, owner, about, salt = [], [], [], None
        for batch in batches:
            for p, s, o, x in zip(*(batch.column(i) for i in range(4))):
                salt = mix_int(p.as_py() + 77)
                four = np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(16, -1).T).view(np.uint32)
                whole = np.zeros((len(four), 8), dtype=np.uint8)
                whole[:, :width] = np.frombuffer(o.as_buffer(), np.uint8).reshape(-1, width)
                sig.append(np.frombuffer(s.as_buffer(), np.uint32))
                owner.append(np.repeat(names(whole.view(np.int64).ravel(), four[:, 0], width), four[:, 3]))
                about.append(np.repeat(four[:, :3], four[:, 3], axis=0))
        if not sig:
            return
        sig, owner, about = np.concatenate(sig), np.concatenate(owner), np.concatenate(about)
        order = np.argsort(sig)
        same = np.zeros(len(sig), dtype=bool)
        ordered = sig[order]
        same[1:] = ordered[1:] == ordered[:-1]
        same[:-1] |= same[1:].copy()
        order = order[same]
        order = order[np.lexsort((owner[order], sig[order]))]
        sig, owner, about = sig[order], owner[order], about[order]
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])
        sig, owner, about = sig[new], owner[new], about[new].astype(np.int64)
        if not len(sig):
            return
        # a bucket counts if two sets meet there of which one is on the smaller side
        start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        n = np.diff(np.append(start, len(sig)))
        good = (n > 1) & (np.add.reduceat((about[:, 1] % 2 == 0).astype(np.int64), start) > 0)
        keep = np.repeat(good, n)
        sig, owner, (size, code, need) = sig[keep], owner[keep], about[keep].T
        n = n[good]
        if not len(n):
            return
        start = np.cumsum(n) - n
        order = np.lexsort((code, owner))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (owner[order][1:] != owner[order][:-1]) | (code[order][1:] != code[order][:-1])
        at = np.flatnonzero(new)
        yield _found(2, owner[order][at], code[order][at], np.diff(np.append(at, len(order))), need[order][at])
        low, high = [], []
        small = n <= SMALL_BUCKET
        for i in range(SMALL_BUCKET):
            for j in range(i + 1, SMALL_BUCKET):
                at = start[small & (n > j)]
                low.append(at + i)
                high.append(at + j)
        low, high = np.concatenate(low), np.concatenate(high)
        near = (np.minimum(size[low], size[high]) * t.den >= np.maximum(size[low], size[high]) * t.num) & ((code[low] % 2 == 0) | (code[high] % 2 == 0))
        if near.any():
            pairs = np.unique(np.stack((owner[low[near]], owner[high[near]]), axis=1), axis=0)
            yield _found(0, pairs[:, 0], pairs[:, 1])
        member = np.repeat(~small, n)
        if member.any():
            # 4 bytes name a signature in its task; the same number in another task is another bucket
            yield _found(1, mix(sig[member].astype(U64) ^ U64(salt)).view(np.int64), owner[member], code[member], size[member])

    return packed.repartitionById(parts, "part").mapInArrow(match, _FOUND)


def _units(rest: DataFrame) -> DataFrame:
    """The rows of buckets, with a unit of buckets in place of ``bucket``, once each.

    Two sets that share a bucket share a unit.  A unit is all buckets that sets
    of one level and band join, or one bucket where that makes fewer pairs.
    """
    rest = rest.withColumn("entry", F.xxhash64("cls", F.shiftright("code", 1)))
    heads = stored(rest.groupBy("bucket").agg(F.min("entry").alias("head"), F.count(F.lit(1)).alias("n")), "heads")
    groups = components(_salted(rest.select("bucket", "cls", "entry"), heads).select("entry", "head"), "entry", "head")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_bucket = heads.join(groups, F.col("head") == F.col("node")).groupBy("root").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    joined = sizes.join(by_bucket, "root").select(F.col("root").alias("bucket"), (F.col("n") * F.col("n") <= F.col("pairs")).alias("whole"))
    groups = _salted(groups.select(F.col("node").alias("cls"), F.col("root").alias("bucket")), joined).select(F.col("cls").alias("entry"), F.col("bucket").alias("unit"), "whole")
    # a set alone in its bucket has no group, and no pairs
    return rest.join(groups, "entry").withColumn("bucket", F.when(F.col("whole"), F.col("unit")).otherwise(F.col("bucket"))).drop("entry", "unit", "whole").distinct()


def _spot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def _key_filter(wanted: DataFrame, column: str) -> np.ndarray:
    """FILTER_BITS bits, packed, of which those of the column's values are set."""
    spot = _spot(column)
    rows = wanted.groupBy(F.bitmap_bucket_number(spot).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).collect()
    # FILTER_BITS / 32768 rows of 4 KB, whatever the input
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for n, raw in rows:
        # bucket 0 has the bit of 0 alone, bucket n those from (n - 1) * 32768 + 1 on
        part = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(raw), np.uint8), bitorder="little"))
        bits[(part + ((n - 1) * 32768 + 1 if n else 0)) % FILTER_BITS] = True
    return np.packbits(bits)


def _keyed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(least, text, spot): each document's key, text and place in the filter of keys."""
    keyed = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("least"), F.col(text).alias("text"))
    return keyed.withColumn("spot", _spot("least"))


def _asked(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of the documents that the filter lets pass; other texts aren't looked at."""
    on = np.unpackbits(bits).astype(bool)
    for batch in batches:
        yield from pieces(batch.filter(pa.array(on[batch.column(2).to_numpy()])), "text")


def _hubs(pairs: DataFrame) -> DataFrame:
    """(cls, hub, deal): the sets that each deal of a hub needs, the hub's own included.

    A pair's hub is that of its sets which is in more pairs.  A hub's pairs are
    dealt out by HUB_PAIRS, so that a set in many pairs isn't sent to each.
    """
    many = pairs.select(F.col("a").alias("bucket")).unionByName(pairs.select(F.col("b").alias("bucket"))).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    many = stored(many.where("n > 1"), "many")  # a set that isn't there is in one pair
    both = _salted(pairs.select(F.col("a").alias("bucket"), F.col("b").alias("cls")), many, "left").select(F.col("cls").alias("bucket"), F.col("bucket").alias("cls"), F.coalesce("n", F.lit(1)).alias("na"))
    both = _salted(both, many, "left").select(F.col("cls").alias("a"), F.col("bucket").alias("b"), "na", F.coalesce("n", F.lit(1)).alias("nb"))
    at_a = F.col("na") >= F.col("nb")
    both = both.select(F.when(at_a, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(at_a, F.col("b")).otherwise(F.col("a")).alias("cls"), F.greatest("na", "nb").alias("n"))
    spokes = stored(both.select("cls", "hub", F.pmod(F.xxhash64("cls"), F.ceil(F.col("n") / HUB_PAIRS)).alias("deal")), "spokes")
    return spokes.unionByName(spokes.select(F.col("hub").alias("cls"), "hub", "deal").distinct())


def _verify(docs: DataFrame, key: str, text: str, k: int, pairs: DataFrame, classes: DataFrame, t: Threshold, width: int) -> DataFrame:
    """(a, b, both, spread, linked): each pair's intersection, of whole sets, and whether it reaches the threshold.

    ``spread`` has the intersection's size in each of GROUPS parts of the universe.

    ``classes`` names the one document (cls, least) that speaks for a set.  Its
    set goes to the deals of pairs that it is in, so a task holds one set at a
    time and no set that is in many pairs gathers them.
    """
    asks = stored(_hubs(pairs).join(classes.select("cls", F.coalesce("least", F.lit(NO_KEY)).alias("least")), "cls"), "asks")
    asked = docs.sparkSession.sparkContext.broadcast(_key_filter(asks, "least"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _asked(batches, asked.value):
            values, offsets = token_sets(part.column(1), k)
            keys = set_keys(values, offsets)
            hit = np.flatnonzero(keys != 0)
            tokens = pa.array([values[offsets[i] : offsets[i + 1]].tobytes() for i in hit], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(hit)), pa.array(names(keys, np.diff(offsets), width)[hit]), tokens], ["least", "cls", "tokens"])

    sets = _keyed_texts(docs, key, text).mapInArrow(emit, "least long, cls long, tokens binary")
    moved = sets.join(asks, ["cls", "least"]).select("hub", "deal", (F.col("cls") != F.col("hub")).alias("spoke"), "cls", "tokens")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal, last, kept = None, None, None
        kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("both", pa.int64()), ("spread", pa.list_(pa.int32())), ("linked", pa.bool_())])
        for batch in batches:
            found: list[dict] = []
            hub, dealt, _, cls = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for i in range(batch.num_rows):
                tokens = np.frombuffer(batch.column(4)[i].as_buffer(), U64)
                if (hub[i], dealt[i]) != deal:
                    deal, last, kept = (hub[i], dealt[i]), cls[i], tokens
                elif cls[i] != last:
                    last = cls[i]  # rows that repeat don't count again
                    p, q = (kept, tokens) if len(kept) <= len(tokens) else (tokens, kept)
                    at = np.searchsorted(q, p)
                    at[at == len(q)] = 0
                    shared = p[q[at] == p]
                    both = len(shared)
                    spread = np.bincount((shared % U64(GROUPS)).astype(np.int64), minlength=GROUPS)
                    a, b = sorted((int(hub[i]), int(last)))
                    found.append({"a": a, "b": b, "both": both, "spread": spread, "linked": both * t.den >= t.num * (len(p) + len(q) - both)})
            yield pa.RecordBatch.from_pylist(found, schema=kind)

    dealt = moved.repartition(shuffle_partitions(docs.sparkSession), "hub", "deal").sortWithinPartitions("hub", "deal", "spoke", "cls")
    return dealt.mapInArrow(check, "a long, b long, both long, spread array<int>, linked boolean")


def _tokens_of(rest: DataFrame, docs: DataFrame, key: str, text: str, k: int, classes: DataFrame, width: int) -> DataFrame:
    """(cls, tok) of the sets of ``rest``."""
    sets = rest.select("cls").distinct()
    one = stored(sets.join(classes.select("cls", F.coalesce("least", F.lit(NO_KEY)).alias("least")), "cls"), "asks")
    asked = docs.sparkSession.sparkContext.broadcast(_key_filter(one, "least"))

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _asked(batches, asked.value):
            values, offsets = token_sets(part.column(1), k)
            keys = set_keys(values, offsets)
            hit = np.flatnonzero(keys != 0)
            pos, owner = _flat(offsets, hit)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(hit[owner])), pa.array(names(keys, np.diff(offsets), width)[hit][owner]), pa.array(values[pos].view(np.int64))], ["least", "cls", "tok"])

    tokens = _keyed_texts(docs, key, text).mapInArrow(unfold, "least long, cls long, tok long")
    return tokens.join(one, ["cls", "least"]).select("cls", "tok")


#: Stands for a null key where keys are joined.
NO_KEY = -(1 << 63)


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, t: Threshold = Threshold()) -> DataFrame:
    """One row per document: key, n_shingles, component_id, set_key.

    ``component_id`` is the least key that links reach, the row's own included;
    equal sets link.  A text without words (or null) has no shingles and links
    with nothing.  A null key never names a component, unless the row links
    with no row that has one.  Rows that repeat a key are rows of their own.
    Tokens and sets are told apart by 64-bit hashes.  Texts are read whole, of
    any length; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scanned = stored(_scan(docs, key, text, k), "sets")
    rows = scanned.where("tok is null")
    total, tokens = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = rows.where("n > 0").groupBy(F.col("cls").alias("key")).agg(F.min("n").alias("n"), F.min("doc").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes, "classes")
    width = _width(classes)
    classes = classes.withColumn("cls", _name(width))
    parts = max(shuffle_partitions(spark), -(-tokens // SIGNATURES_A_TASK))
    found = stored(_buckets(_index(docs, key, text, k, t, _common(scanned, total), _hot(classes), parts, width), parts, t, width), "buckets")

    # an entry that shares fewer signatures than any partner would is out
    viable = found.where("kind = 2").groupBy(F.col("a").alias("cls"), F.col("b").alias("code")).agg(F.sum("c").alias("n"), F.max("d").alias("need"))
    viable = stored(viable.where("n >= need").select("cls", "code"), "viable")
    some = viable.select("cls").distinct()
    small = found.where("kind = 0").select("a", "b").distinct()
    small = small.join(some.withColumnRenamed("cls", "a"), "a", "left_semi").join(some.withColumnRenamed("cls", "b"), "b", "left_semi").select("a", "b")
    members = found.where("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("cls"), F.col("c").alias("code"), F.col("d").alias("size"))
    members = stored(members.join(viable, ["cls", "code"], "left_semi"), "members")
    head = members.where("code % 2 = 0").groupBy("bucket").agg(F.min(F.struct("cls", "size")).alias("head"))
    alike = lambda x, y: F.least(x, y) * t.den >= F.greatest(x, y) * t.num
    star = _salted(members, head).where((F.col("cls") != F.col("head.cls")) & alike(F.col("size"), F.col("head.size")))
    star = star.select(F.least("cls", "head.cls").alias("a"), F.greatest("cls", "head.cls").alias("b"))
    small = stored(small, "small")

    # first each set meets its least candidate, which joins most of what belongs together
    first = stored(small.unionByName(star).groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
    tried = stored(_verify(docs, key, text, k, first, classes, t, width), "tried")
    roots = components(tried.where("linked"))

    def root_of(name: str, to: str) -> DataFrame:
        return roots.select(F.col("node").alias(name), F.col("root").alias(to))

    def still_open(rows: DataFrame, name: str) -> DataFrame:
        """The members of the buckets that hold two components or more."""
        rooted = rows.drop("root").join(root_of("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        open_ = rooted.groupBy("bucket").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("bucket")
        return stored(_salted(rooted, open_, "left_semi"), name)

    def add(more: DataFrame) -> None:
        nonlocal tried, roots
        more = stored(more.distinct().join(tried, ["a", "b"], "left_anti"), "more")
        if not more.isEmpty():
            tried = stored(tried.unionByName(_verify(docs, key, text, k, more, classes, t, width)), "tried")
            roots = components(tried.where("linked"))

    def ordered(x: str, y: str) -> tuple[Column, Column]:
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    # then the other pairs of small buckets, and each member of a large one that holds several components
    # meets that with the fewest tokens of its own
    apart = small.join(root_of("a", "ra"), "a", "left").join(root_of("b", "rb"), "b", "left")
    more = apart.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    rest = still_open(members, "open")
    if rest.isEmpty():
        add(more)
    else:
        tokens = _tokens_of(rest, docs, key, text, k, classes, width)
        alone = tokens.groupBy("tok").agg(F.min("cls").alias("cls"), F.max("cls").alias("other")).where("cls = other")
        own = alone.groupBy("cls").agg(F.count(F.lit(1)).alias("own"))
        rest = rest.join(own, "cls", "left").withColumn("avail", F.col("size") - F.coalesce("own", F.lit(0))).drop("own")
        rest = stored(rest.where(F.col("avail") * t.den >= F.col("size") * t.num), "open")
        whole = (F.col("avail") * 1_000_000 / F.col("size")).cast("long").alias("whole")
        middle = rest.where("code % 2 = 0").groupBy("bucket").agg(F.max(F.struct(whole, "cls", "size")).alias("m")).select("bucket", "m.whole", F.col("m.cls").alias("middle"), F.col("m.size").alias("m_size"))
        met = _salted(rest, middle).where(alike(F.col("size"), F.col("m_size"))).groupBy("cls").agg(F.max(F.struct("whole", "middle")).alias("to"))
        met = stored(met.select("cls", F.col("to.middle").alias("middle")), "met")
        add(more.unionByName(met.where("cls <> middle").select(*ordered("cls", "middle"))))

        # last, what large buckets still hold in different components, pair by pair
        rest = still_open(rest, "open")
        if not rest.isEmpty():
            rest = _units(rest)
            seen = met.select("cls", "middle", *ordered("cls", "middle")).join(tried.select("a", "b", "both", "spread"), ["a", "b"], "left")
            rest = stored(rest.join(seen.select("cls", "middle", "both", "spread"), "cls", "left"), "units")
            x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
            # what two sets can share: their tokens that others have; and with one middle, part by part the less of
            # what each shares with the middle, and of what else each has the less
            most = F.least(x("avail"), y("avail"))
            in_middle = F.aggregate(F.zip_with(x("spread"), y("spread"), lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v)
            by_middle = in_middle + F.least(x("avail") - x("both"), y("avail") - y("both"))
            most = F.when(x("middle") == y("middle"), F.least(most, F.coalesce(by_middle, most))).otherwise(most)
            enough = most * (t.den + t.num) >= (x("size") + y("size")) * t.num
            # a set has met its middle already
            fresh = (x("cls") != F.coalesce(y("middle"), y("cls"))) & (y("cls") != F.coalesce(x("middle"), x("cls")))
            once = (y("code") % 2 == 1) | (x("cls") < y("cls"))
            open_pair = once & (x("root") != y("root")) & alike(x("size"), y("size")) & fresh & enough
            # a unit's blocks meet each other one by one
            n_blocks = rest.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
            rest = _salted(rest, n_blocks).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "cls"), F.col("blocks")))
            other = rest.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            small_side = rest.where("code % 2 = 0").withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            small_side = small_side.withColumnRenamed("block", "own").withColumnRenamed("met", "block").withColumnRenamed("own", "met")
            cross = small_side.alias("x").join(other.alias("y"), ["bucket", "block", "met"]).where(open_pair)
            add(cross.select(*ordered("x.cls", "y.cls")))

    named = classes.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(F.col("key").alias("cls"), "component_id")
    return rows.join(named, "cls", "left").select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"),
        F.when(F.col("n") > 0, F.col("cls")).alias("set_key"),
    )
