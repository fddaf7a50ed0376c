"""SentencePiece encoding and decoding by a lattice of pieces.

A text's white space turns into the mark U+2581 and starts a word; no piece
crosses a word's start or a line break.  Of each distinct word the substrings
up to the longest piece are joined with the piece table, the edges are grouped
by the place where they start, and a Viterbi fold runs over them.

For a unigram model the fold's state is a place and its value the sum of
scores.  The public vocabulary here is a merge (BPE) model, for which the best
sum is not what its library gives; there the state is a place and the last
piece, and a step is open only if merging the two pieces' characters gives these
two pieces again.  A path of open steps is the library's encoding, and there is
no other.  ``segment_words`` is the relational form of the unigram fold in
DataFrame functions.

Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon.llm.textscan import BLOCK, U64, give_back, mix, pieces, powers, text_bytes

MARK = "▁"
#: Distinct words that a worker keeps encoded.
KEEP_WORDS = 800_000
#: Pairs of pieces that a worker remembers.
KEEP_STEPS = 300_000
#: Bytes of texts encoded at once: a step takes some 30 bytes of a worker's memory for each.
SLICE = 1 << 20
_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


@dataclass
class PieceSet:
    """A vocabulary: piece to id, scores, byte pieces; small and fixed, so it may be broadcast."""

    ids: dict[str, int]
    scores: np.ndarray
    byte_ids: list[int]
    merges: bool = True
    longest: int = 0
    #: Of a merge model: the pieces that merging their own characters gives, and all beginnings of those.
    whole: dict[str, int] = field(default_factory=dict, repr=False)
    beginnings: set[str] = field(default_factory=set, repr=False)
    names: list[str] = field(default_factory=list, repr=False)
    _open: dict[int, bool] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids), default=0)
        self.names = [""] * len(self.scores)
        for p, i in self.ids.items():
            self.names[i] = p
        self.whole = {p: i for p, i in self.ids.items() if not self.merges or len(self.merge(p)) == 1}
        self.beginnings = {p[:n] for p in self.whole for n in range(1, len(p) + 1)}

    @classmethod
    def load(cls, path: str) -> PieceSet:
        """Read a SentencePiece model file with byte pieces (on the driver)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ids = {model.id_to_piece(i): i for i in normal}
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        whole = bool(np.all(scores[normal] == np.round(scores[normal])))  # merge models score by rank, unigram models by log-probability
        return cls(ids, scores, byte_ids, whole)

    def merge(self, text: str) -> list[str]:
        """The pieces after merging the best-scored neighbours, leftmost first, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                j = self.ids.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.scores[j] > best):
                    best, at = self.scores[j], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def open_step(self, a: int, b: int) -> bool:
        """Whether merging the characters of two pieces gives the two; known pairs are looked up by the caller."""
        if len(self._open) > KEEP_STEPS:
            self._open.clear()
        first, second = self.names[a], self.names[b]
        found = self._open[a << 20 | b] = self.merge(first + second) == [first, second]
        return found

    def edges(self, word: str, i: int) -> list[tuple[int, int]]:
        """(piece, end) of the substrings of bounded length from ``i``; -2 for an unknown character."""
        here, j, piece = [], i + 1, self.whole.get(word[i])
        if piece is None:
            here.append((-2, j))
        sub = word[i]
        while True:
            if piece is not None:
                here.append((piece, j))
            j += 1
            if j > len(word) or sub not in self.beginnings:
                return here
            sub = word[i:j]
            piece = self.whole.get(sub)

    def segment(self, word: str) -> list[str]:
        """The pieces of one word; unknown characters stay as they are."""
        return self._by_steps(word) if self.merges else self._by_scores(word)

    def _by_steps(self, word: str) -> list[str]:
        known = self._open
        # by place: the last piece, and the piece before it with its start
        states: list[dict[int, tuple[int, int]]] = [{} for _ in range(len(word) + 1)]
        states[0][-1] = (-1, -1)
        for i in range(len(word)):
            if not states[i]:
                continue
            for b, end in self.edges(word, i):
                for a in states[i]:
                    if a < 0 or b < 0 or (ok := known.get(a << 20 | b)) or (ok is None and self.open_step(a, b)):
                        # which pieces led to b doesn't matter for what follows
                        states[end][b] = (a, i)
                        break
        out, at, piece = [], len(word), next(iter(states[-1]))
        while at:
            before, start = states[at][piece]
            out.append(word[start:at])
            at, piece = start, before
        return out[::-1]

    def _by_scores(self, word: str) -> list[str]:
        least = float(self.scores.min()) - 10
        best: list[tuple[float, str]] = [(0.0, "")] + [(-np.inf, "")] * len(word)
        for i in range(len(word)):
            for b, end in self.edges(word, i):
                value = best[i][0] + (self.scores[b] if b >= 0 else least)
                if value > best[end][0]:
                    best[end] = (value, word[i:end])
        out, at = [], len(word)
        while at:
            out.append(best[at][1])
            at -= len(best[at][1])
        return out[::-1]

    def numbers(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            if p in self.ids:
                out.append(self.ids[p])
            else:
                out += [self.byte_ids[b] for b in p.encode()]
        return out

    def encode_text(self, text: str) -> list[int]:
        """One text's ids, word by word, without any table of known words."""
        if not text:
            return []
        return [i for w in _WORD.findall(MARK + text.replace(" ", MARK)) for i in self.numbers(self.segment(w))]

    def piece_bytes(self) -> list[bytes]:
        out = [b""] * len(self.scores)
        for p, i in self.ids.items():
            out[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out


class Encoder:
    """Encodes batches: each distinct word once, looked up by its hash."""

    def __init__(self, vocabulary: PieceSet):
        self.v = vocabulary
        table = vocabulary.piece_bytes()
        self.size = np.array([len(b) for b in table], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.clear()
        self.value = mix(np.arange(11, 267, dtype=U64))

    def clear(self) -> None:
        # by word, in the order of hashes: where its ids start and how many they are; small types, as workers keep this
        self.known, self.at, self.many, self.ids = np.zeros(0, U64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint16 if len(self.v.scores) < 1 << 16 else np.int32)

    def _hashes(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        ends = np.append(starts[1:], len(data))
        out = np.empty(len(starts), dtype=U64)
        i = 0
        while i < len(starts):  # in blocks, as the powers of a whole batch are large
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
            low, high = starts[i], ends[j - 1]
            up, down = powers(max(BLOCK, 1 << int(high - low - 1).bit_length()))
            rel = starts[i:j] - low
            sums = np.add.reduceat(self.value[data[low:high]] * up[: high - low], rel)
            out[i:j] = mix(sums * down[rel] + (ends[i:j] - starts[i:j]).astype(U64))
            i = j
        return out

    def _learn(self, new: np.ndarray, words: list[bytes]) -> None:
        flat, many = [], np.empty(len(words), dtype=np.int64)
        for i, w in enumerate(words):
            ids = self.v.numbers(self.v.segment(w.decode().replace(" ", MARK))) if w != b"\n" else self.v.numbers(["\n"])
            many[i] = len(ids)
            flat += ids
        at = (len(self.ids) + np.cumsum(many) - many).astype(np.int32)
        # both are in order, so the new go between the known, one column after the other
        place = np.searchsorted(self.known, new)
        self.known = np.insert(self.known, place, new)
        self.at = np.insert(self.at, place, at)
        self.many = np.insert(self.many, place, many.astype(np.int32))
        self.ids = np.concatenate((self.ids, np.array(flat, dtype=self.ids.dtype)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts; a null or empty text has none."""
        marked = pa.compute.replace_substring(column.cast(pa.large_string()), MARK, " ")
        raw, offsets = text_bytes(marked)
        size = np.diff(offsets)
        full = size > 0
        # a space before each text that isn't empty
        begin = np.concatenate(([0], np.cumsum(size + full)))
        data = np.full(begin[-1], 32, dtype=np.uint8)
        own = np.ones(len(data), dtype=bool)
        own[begin[:-1][full]] = False
        data[own] = raw
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(size) + 1, np.int64)
        space, line = data == 32, data == 10
        first = line.copy()
        first[1:] |= (space[1:] & ~space[:-1]) | line[:-1]
        first[begin[:-1][full]] = True
        starts = np.flatnonzero(first)
        h = self._hashes(data, starts)
        distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > KEEP_WORDS:
            self.clear()
        spot = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[spot] != distinct) if len(self.known) else np.arange(len(distinct))
        if len(new):
            body, stops = data.tobytes(), np.append(starts[1:], len(data))
            self._learn(distinct[new], [body[starts[i] : stops[i]] for i in at[new]])
            spot = np.searchsorted(self.known, distinct)
        where, many = self.at[spot][back].astype(np.int64), self.many[spot][back].astype(np.int64)
        total = np.cumsum(many)
        pos = np.repeat(where - (total - many), many)
        pos += np.arange(total[-1])
        words_before = np.searchsorted(starts, begin)
        return self.ids[pos].astype(np.int32), np.concatenate(([0], total))[words_before]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts; the space before a text goes."""
        size = self.size[ids]
        total = np.cumsum(size)
        spot = np.repeat(self.start[ids] - (total - size), size)
        spot += np.arange(len(spot))
        out = self.flat[spot]
        at = np.concatenate(([0], total))[offsets]
        drop = at[:-1][(np.diff(at) > 0)]
        drop = drop[out[drop] == 32]
        keep = np.ones(len(out), dtype=bool)
        keep[drop] = False
        return out[keep], at - np.searchsorted(drop, at)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, shared) -> Encoder:
    """This worker's encoder, kept between tasks."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(shared.value)
    return _ENCODERS[name]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ids, n_pieces, n_byte_pieces, round_trip.

    ``ids`` are the SentencePiece library's.  ``round_trip`` tells whether
    decoding them gives the text again, which holds but for texts that have the
    mark U+2581 itself (it counts as a space).  A null text has null ids and
    counts as a round trip; an empty one has no ids.
    """
    vocabulary = PieceSet.load(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    name = f"{path}:{len(vocabulary.ids)}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(name, shared)
        is_byte = np.zeros(len(coder.size), dtype=np.int64)
        is_byte[coder.v.byte_ids] = 1
        for batch in batches:
            for part in pieces(batch, text, SLICE):
                column = part.column(1)
                ids, offsets = coder.encode(column)
                plain, at = coder.decode(ids, offsets)
                raw, want = text_bytes(column)
                same = np.diff(at) == np.diff(want)
                if len(raw) == len(plain) and same.all():
                    differ = np.flatnonzero(raw != plain)
                    same[np.searchsorted(want, differ, "right") - 1] = False
                else:
                    same = np.array([plain[at[i] : at[i + 1]].tobytes() == raw[want[i] : want[i + 1]].tobytes() for i in range(len(same))])
                bad = [i for i in np.flatnonzero(~same) if MARK not in column[i].as_py()]
                if bad:  # two words of one hash: these texts are encoded word by word
                    lists = [ids[offsets[i] : offsets[i + 1]] for i in range(len(same))]
                    for i in bad:
                        lists[i] = np.array(coder.v.encode_text(column[i].as_py()), dtype=np.int32)
                        same[i] = True
                    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
                    ids = np.concatenate(lists)
                count = np.diff(offsets)
                own = np.concatenate(([0], np.cumsum(is_byte[ids])))[offsets]
                mask = column.is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), mask=np.append(mask, False)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(count), pa.array(np.diff(own)), pa.array(same)], [key, "ids", "n_pieces", "n_byte_pieces", "round_trip"])
            give_back()

    return docs.select(F.col(key).cast("long").alias(key), F.col(text)).mapInArrow(work, f"`{key}` long, ids array<int>, n_pieces long, n_byte_pieces long, round_trip boolean")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of lists of ids; null lists give null, ids out of the vocabulary nothing, broken UTF-8 U+FFFD."""
    vocabulary = PieceSet.load(path)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    name = f"{path}:{len(vocabulary.ids)}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(name, shared)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = []
                for cell in part.column(1):
                    if not cell.is_valid:
                        texts.append(None)
                        continue
                    row = np.array([x for x in cell.as_py() if x is not None and 0 <= x < len(coder.size)], dtype=np.int64)
                    plain, _ = coder.decode(row, np.array([0, len(row)]))
                    texts.append(plain.tobytes().decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(F.col(key).cast("long").alias(key), F.col(ids).cast("array<int>").alias(ids)).mapInArrow(work, f"`{key}` long, text string")


def segment_words(words: DataFrame, vocabulary: DataFrame, longest: int, unknown: float, word: str = "word") -> DataFrame:
    """The unigram fold as relations: (word, pieces, score) of each distinct word.

    Substrings up to ``longest`` characters are exploded and equi-joined with
    ``vocabulary`` (piece, score); a character without a piece scores
    ``unknown``.  The edges of a word are grouped and folded with ``aggregate``:
    for each place in turn the best way to reach it.  Empty and null words are
    left out.
    """
    distinct = words.select(F.col(word).alias("word")).where(F.length("word") > 0).distinct()
    starts = distinct.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    spans = starts.select("word", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("i") + 1))).alias("n"))
    spans = spans.withColumn("piece", F.substring(F.col("word"), F.col("i"), F.col("n")))
    edges = spans.join(vocabulary.select("piece", "score"), "piece", "left").where(F.col("score").isNotNull() | (F.col("n") == 1))
    edge = F.struct((F.col("i") + F.col("n") - 1).alias("end"), F.col("i"), F.coalesce("score", F.lit(unknown)).cast("double").alias("score"), "piece")
    grouped = edges.groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    none = F.array().cast("array<string>")
    start = F.map_from_arrays(F.array(F.lit(0)), F.array(F.struct(F.lit(0.0).cast("double").alias("score"), none.alias("pieces"))))

    def step(best: Column, e: Column) -> Column:
        before = F.element_at(best, e["i"] - 1)
        now = F.struct((before["score"] + e["score"]).alias("score"), F.concat(before["pieces"], F.array(e["piece"])).alias("pieces"))
        old = F.try_element_at(best, e["end"])
        better = old.isNull() | (now["score"] > old["score"])
        one = F.map_from_arrays(F.array(e["end"]), F.array(now))
        return F.when(better, F.map_concat(F.map_filter(best, lambda k, _: k != e["end"]), one)).otherwise(best)

    done = F.aggregate("edges", start, step, lambda best: F.element_at(best, F.length("word")))
    return grouped.select("word", done.alias("done")).select("word", F.col("done.pieces").alias("pieces"), F.col("done.score").alias("score"))
