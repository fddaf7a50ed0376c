"""Benchmark passages in documents, within a share of word edits.

A document is scanned for windows of an item's size.  CGK embeddings (a random
walk over the words: each step emits the word at the cursor and then moves on
or not, as a random function of step and word says) turn the word edit distance
of window and item into a Hamming distance; keys of a few sampled embedding
positions, over several walks, retrieve window and item pairs, and an exact
semi-global edit distance on the words decides.

Which windows are embedded: with at most k edits an item of n words leaves a run
of ceil((n - k)/(k + 1)) words unchanged, so every window that can match shares
such a run (three words at most are asked for) with the item, at the same place
but for the edits before it.  This loses no match and makes the scan one lookup
a word.

Walks that edits have driven apart don't always meet again, so keys of whole
long items would lose matches.  A long item is told by its pieces instead: of
the edits that a match may have, one piece at least has no more than its share,
so it is found like a short item, and the item is compared exactly round it.

Walks look at some positions, so some matches have no key in common with their
item.  Windows that share a run but no key are therefore held against their
item by a count: k edits leave n - k of its words, repeats too.  Those that hold
so many are compared exactly as well, so no match is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemon.llm.textscan import PLAIN, U64, mix, mix_int, pieces, text_bytes, words

#: Bytes of items in one broadcast; a larger benchmark is gone through in blocks.
ITEM_BYTES = 16 << 20
#: Embedding steps a word that are sampled: a walk moves on every other step, so beyond some two it stands at its end, where all texts agree.
STEPS = 1.5
#: Cells (rows times embedding steps) that are embedded at once.
CELLS = 1 << 21
#: Words beyond which an item is long, and told by pieces of PIECE words or more, less than twice as many.
LONG, PIECE = 150, 75

HIT_SCHEMA = "item_id long, item_words int, distance int, similarity double, start long, end long"


@dataclass(frozen=True)
class Search:
    """``similarity``: 1 - edits / item words, at least.

    ``recall`` is what the keys reach for a true match if ``agreement`` of the
    embedding's positions agree; it sets the number of keys.  Measured with the
    most edits allowed, dealt at random, 0.985 or more of windows of 4 to 100
    words share a key with their item, and less than a fifth of unrelated ones;
    of 150 words without every fourth 0.835.  The others are found by count.
    """

    similarity: float = 0.75
    recall: float = 0.99
    agreement: float = 0.2
    bits: int = 2
    walks: int = 8
    seed: int = 1

    def edits(self, n: int) -> int:
        return int((1 - self.similarity) * n + 1e-9)

    def keys_a_walk(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.agreement**self.bits) / self.walks)

    def seed_words(self, n: int) -> int:
        k = self.edits(n)
        return max(1, min(3, -(-(n - k) // (k + 1))))


def cgk_keys(symbols: np.ndarray, length: np.ndarray, search: Search) -> np.ndarray:
    """The keys (rows x all keys) of word sequences padded to one width.

    ``length`` is the item's length, which sets the embedding's size (STEPS
    times it) and so the sampled positions; the same for a window and its item.
    """
    n, width = symbols.shape
    steps = int(STEPS * int(length.max(initial=1))) + 1
    padded = np.concatenate((symbols, np.zeros((n, 1), dtype=U64)), axis=1)
    rows = np.arange(n)
    per = search.keys_a_walk()
    keys = np.empty((n, search.walks * per), dtype=U64)
    spots = np.random.default_rng(search.seed).random((search.walks, per, search.bits))
    for walk in range(search.walks):
        emitted = np.empty((n, steps), dtype=U64)
        cursor = np.zeros(n, dtype=np.int64)
        for step in range(steps):
            here = padded[rows, cursor]
            emitted[:, step] = here
            moves = (mix(here ^ U64(mix_int(search.seed * 7919 + walk * 100_003 + step))) >> U64(63)).astype(np.int64)
            cursor = np.minimum(cursor + moves, width)
        for j in range(per):
            at = (spots[walk, j][None, :] * (STEPS * length)[:, None]).astype(np.int64)
            key = np.full(n, mix_int(walk * 1000 + j), dtype=U64)
            for bit in range(search.bits):
                key = mix(key ^ mix(emitted[rows, at[:, bit]] + at[:, bit].astype(U64)))
            keys[:, walk * per + j] = key
    return keys


def blocks(length: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows, of rising length, whose padded embeddings have CELLS cells at most (or one row)."""
    low = 0
    while low < len(length):
        high = min(len(length), low + max(1, int(CELLS / STEPS) // max(1, int(length[low]))))
        while high - low > 1 and (high - low) * int(length[high - 1]) * STEPS > CELLS:
            high = low + (high - low + 1) // 2
        yield low, high
        low = high


def best_edit(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, first, end) of the part of ``text`` nearest to ``item``, by word edits.

    Of equal distances the earliest end counts, and the shortest part with it.
    """
    m = len(text)
    step = np.arange(m + 1)
    row = np.zeros(m + 1, dtype=np.int64)
    for word in item:
        down = row + 1
        down[1:] = np.minimum(down[1:], row[:-1] + (text != word))
        row = np.minimum.accumulate(down - step) + step
    end = int(np.argmin(row))
    # the same from the other side, from that end, finds where it starts
    back = np.arange(end + 1)
    step = step[: end + 1]
    for word in item[::-1]:
        down = back + 1
        down[1:] = np.minimum(down[1:], back[:-1] + (text[:end][::-1] != word))
        back = np.minimum.accumulate(down - step) + step
    size = int(np.argmin(back))
    return int(row[end]), end - size, end


def joined(spans: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@dataclass
class Items:
    """The benchmark's items, and the seeds and keys of their pieces; read-only once built.

    Piece i is the first of item i, or the whole of a short one; then come the other pieces of long items.
    """

    ids: list
    texts: list[str]
    search: Search = field(default_factory=Search)

    def __post_init__(self) -> None:
        data, offsets = text_bytes(pa.array(self.texts, pa.string()))
        h, doc, _, _ = words(data, offsets, PLAIN)
        self.words = [h[doc == i] for i in range(len(self.ids))]
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.edits = np.array([self.search.edits(int(n)) for n in self.length], dtype=np.int64)
        cuts = [np.linspace(0, n, n // PIECE + 1).astype(np.int64) if n > LONG else np.array([0, n]) for n in self.length]
        spot = [(i, int(cut[0]), int(cut[1])) for i, cut in enumerate(cuts)] + [(i, int(a), int(b)) for i, cut in enumerate(cuts) for a, b in zip(cut[1:-1], cut[2:])]
        self.item, self.offset, end = np.array(spot, dtype=np.int64).reshape(-1, 3).T
        self.size = end - self.offset
        pieces = [self.words[i][a:b] for i, a, b in spot]
        order = np.argsort(self.size, kind="stable")
        self.piece_keys = np.empty((len(pieces), self.search.walks * self.search.keys_a_walk()), dtype=U64)
        for low, high in blocks(self.size[order]):
            some = order[low:high]
            table = np.zeros((len(some), max(1, int(self.size[some[-1]]))), dtype=U64)
            for row, p in enumerate(some):
                table[row, : self.size[p]] = pieces[p]
            self.piece_keys[some] = cgk_keys(table, np.maximum(self.size[some], 1), self.search)
        # each piece's words and how often it has them, in one table
        self.room = np.array([self.search.edits(int(n)) for n in self.size], dtype=np.int64)
        self.salt = mix(np.arange(1, len(pieces) + 1, dtype=U64))
        value = mix(np.concatenate([*pieces, np.zeros(0, U64)]) ^ np.repeat(self.salt, self.size))
        self.held, self.held_many = np.unique(value, return_counts=True)
        self.held_gate = np.zeros(1 << 20, dtype=bool)
        self.held_gate[(self.held & U64((1 << 20) - 1)).astype(np.int64)] = True
        self.seeds = {}
        for size in (1, 2, 3):
            mine = [p for p, w in enumerate(pieces) if len(w) and self.search.seed_words(len(w)) == size]
            runs = [(run_hash(pieces[p], size), p) for p in mine]
            if runs:
                value = np.concatenate([r for r, _ in runs])
                piece = np.concatenate([np.full(len(r), p) for r, p in runs])
                place = np.concatenate([np.arange(len(r)) for r, _ in runs])
                order = np.argsort(value, kind="stable")
                gate = np.zeros(1 << 20, dtype=bool)
                gate[(value & U64((1 << 20) - 1)).astype(np.int64)] = True
                self.seeds[size] = (value[order], piece[order], place[order], gate)

    @property
    def keys(self) -> np.ndarray:
        """Each item's keys, of a long one those of its first piece."""
        return self.piece_keys[: len(self.ids)]

    def windows(self, h: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, first word) of each window that shares a seed run with its piece, once each."""
        found, starts = [], []
        for size, (value, piece, place, gate) in self.seeds.items():
            if len(h) < size:
                continue
            run = run_hash(h, size)
            at = np.flatnonzero(gate[(run & U64((1 << 20) - 1)).astype(np.int64)])
            at = at[doc[at] == doc[at + size - 1]]
            low, high = np.searchsorted(value, run[at], "left"), np.searchsorted(value, run[at], "right")
            many = high - low
            pos = np.repeat(at, many)
            hit = np.arange(len(pos)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            found.append(piece[hit])
            starts.append(np.maximum(pos - place[hit], first[doc[pos]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.stack((np.concatenate(found), np.concatenate(starts)), axis=1), axis=0)
        return both[:, 0], both[:, 1]

    def _roomy(self, h: np.ndarray, piece: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each span holds as many of its piece's words, repeats too, as the piece's edits leave of it."""
        many, least = high - low, self.size[piece] - self.room[piece]
        row = np.repeat(np.arange(len(piece)), many)
        value = mix(h[np.arange(len(row)) - np.repeat(np.cumsum(many) - many - low, many)] ^ self.salt[piece][row])
        some = np.flatnonzero(self.held_gate[(value & U64((1 << 20) - 1)).astype(np.int64)])
        row, value = row[some], value[some]
        at = np.searchsorted(self.held, value)
        at[at == len(self.held)] = 0
        mine = (self.held[at] == value) & (np.bincount(row, minlength=len(piece)) >= least)[row]
        pair, n = np.unique(row[mine] * len(self.held) + at[mine], return_counts=True)
        row, at = np.divmod(pair, max(1, len(self.held)))
        return np.bincount(row, np.minimum(n, self.held_many[at]), minlength=len(piece)) >= least

    def _holding(self, i: int, h: np.ndarray, spans: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """The spans that hold as many of an item's words, repeats too, as edits leave of it."""
        names, many = np.unique(self.words[i], return_counts=True)
        low, high = min(a for a, _ in spans), max(b for _, b in spans)
        at = np.searchsorted(names, h[low:high])
        at[at == len(names)] = 0
        at = np.where(names[at] == h[low:high], at, len(names))
        least = self.length[i] - self.edits[i]
        return {(a, b) for a, b in spans if np.minimum(np.bincount(at[a - low : b - low], minlength=len(names) + 1)[:-1], many).sum() >= least}

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(document, item, distance, first byte, end byte) of the nearest part for each pair within the limit."""
        h, doc, starts, ends = words(data, offsets, PLAIN)
        first = np.searchsorted(doc, np.arange(len(offsets) - 1), "left")
        last = np.searchsorted(doc, np.arange(len(offsets) - 1), "right")
        piece, at = self.windows(h, doc, first)
        best: dict[tuple[int, int], tuple] = {}
        around: dict[tuple[int, int], set[tuple[int, int]]] = {}
        unsaid: dict[tuple[int, int], set[tuple[int, int]]] = {}
        # a text that hasn't as many words as edits leave of an item can't match
        length, edits = self.length[self.item[piece]], self.edits[self.item[piece]]
        low, high = at - self.offset[piece] - edits, at - self.offset[piece] + length + edits
        low, high = np.maximum(low, first[doc[at]]), np.minimum(high, last[doc[at]])
        keep = high - low >= length - edits
        piece, at, low, high = piece[keep], at[keep], low[keep], high[keep]
        order = np.lexsort((at, piece, self.size[piece]))  # those of one length together, else as they are
        piece, at, low, high = piece[order], at[order], low[order], high[order]

        def compare(d: int, i: int, a: int, b: int, below: int) -> None:
            distance, x, y = best_edit(self.words[i], h[a:b])
            if distance < below and y > x:
                found = (distance, int(starts[a + x]), int(ends[a + y - 1]))
                if found < best.get((d, i), (int(self.length[i]) + 1,)):
                    best[d, i] = found

        for block, stop in blocks(self.size[piece]):
            p, s = piece[block:stop], at[block:stop]
            width = int(self.size[p].max())
            spot = s[:, None] + np.arange(width)[None, :]
            inside = (np.arange(width)[None, :] < self.size[p][:, None]) & (spot < last[doc[s]][:, None])
            table = np.where(inside, h[np.minimum(spot, len(h) - 1)], U64(0))
            close = (cgk_keys(table, self.size[p], self.search) == self.piece_keys[p]).any(axis=1)
            for w in np.flatnonzero(close):
                d, i, a, b = int(doc[s[w]]), int(self.item[p[w]]), int(low[block + w]), int(high[block + w])
                n = int(self.length[i])
                if n > LONG:
                    around.setdefault((d, i), set()).add((a, b))
                    continue
                if best.get((d, i), (1,))[0] == 0:
                    continue  # windows come in order, so the first exact one stands
                if (self.words[i][:, None] == h[a:b][None, :]).any(axis=1).sum() < n - self.edits[i]:
                    continue  # k edits leave n - k of the item's words in place
                compare(d, i, a, b, int(self.edits[i]) + 1)
            # the windows whose keys say nothing: those that may match by their words, too
            rest = np.flatnonzero(~close)
            p, s, d = p[rest], s[rest], doc[s[rest]]
            room = self.room[p]
            held = self._roomy(h, p, np.maximum(s - room, first[d]), np.minimum(s + self.size[p] + room, last[d]))
            for w in np.flatnonzero(held):
                spans = around if self.length[self.item[p[w]]] > LONG else unsaid
                spans.setdefault((int(d[w]), int(self.item[p[w]])), set()).add((int(low[block + rest[w]]), int(high[block + rest[w]])))
        # what pieces say of a long item is compared as one where it overlaps, so no word of a text is gone through twice
        for (d, i), spans in around.items():
            for a, b in joined(self._holding(i, h, spans)):
                compare(d, i, a, b, int(self.edits[i]) + 1)
        for (d, i), spans in unsaid.items():
            for a, b in joined(spans):
                below = best.get((d, i), (int(self.edits[i]) + 1,))[0]
                if below:  # only what is nearer than what keys have found
                    compare(d, i, a, b, below)
        return [(d, i, *found) for (d, i), found in sorted(best.items())]


def run_hash(h: np.ndarray, size: int) -> np.ndarray:
    out = h[: len(h) - size + 1].copy()
    for j in range(1, size):
        out = mix(out) + h[j : len(h) - size + 1 + j]
    return out


def item_blocks(items: DataFrame, search: Search) -> Iterator[Items]:
    """The items with a text, in blocks of about ITEM_BYTES."""
    text = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = text.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BYTES))
    for block in range(blocks):
        part = text.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else text
        rows = part.collect()  # a block of the benchmark, whose size was just measured
        yield Items([r[0] for r in rows], [r[1] for r in rows], search)


def find_passages(docs: DataFrame, items: DataFrame, search: Search = Search(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item whose passage it holds.

    Returns key, item_id, item_words, distance (word edits), similarity, start
    and end (code points of the nearest passage in the text, end exclusive).
    Words are runs of ASCII letters and digits and non-ASCII characters, case
    folded; items without words and null texts match nothing.  Rows that repeat
    are reported each, also items that repeat an id.  Texts and items are read
    whole, of any length; no documents or no items give no rows.  Items go out in blocks of a measured size, documents are
    scanned where they lie, and nothing is shuffled.
    """
    out = None
    for block in item_blocks(items, search):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in pieces(batch, text):
                    data, offsets = text_bytes(part.column(1))
                    rows = []
                    for d, i, distance, a, b in index.hits(data, offsets):
                        head = data[offsets[d] : b]
                        points = (head & 0xC0) != 0x80
                        n = int(index.length[i])
                        rows.append((part.column(0)[d].as_py(), index.ids[i], n, distance, 1 - distance / n, int(points[: a - offsets[d]].sum()), int(points.sum())))
                    kind = pa.schema([(key, pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int32()), ("distance", pa.int32()), ("similarity", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
                    yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in rows], schema=kind)

        found = docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(scan, f"`{key}` long, {HIT_SCHEMA}")
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, search: Search = Search(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item's passage, with their columns."""
    for block in item_blocks(items, search):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        place = docs.columns.index(text)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared, place=place) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, batch.schema.names[place]):
                    keep = np.ones(part.num_rows, dtype=bool)
                    keep[[hit[0] for hit in shared.value.hits(*text_bytes(part.column(place)))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
