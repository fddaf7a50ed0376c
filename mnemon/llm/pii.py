"""Personal data by weak supervision.

Four base kinds (email, ip, card, phone) are exact patterns and always stand.
Further candidates (addresses in disguise, phone numbers without a plus, social
security numbers, bank accounts, secrets) come from loose patterns.  Labelers
vote on every candidate and base span: its form, gazetteers of endings, country
codes, area codes and key prefixes, and the words before it.  They vote on a
decoy a document too, an ordinary long word.  Expectation-maximisation over the
counts of vote patterns of all documents estimates how each labeler votes on true
and on false spans, with base spans true, decoys false and candidates unknown; a
logistic span classifier on votes and kind, trained on the resulting
probabilities, decides which candidates stand.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemon.llm.shared import stored

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "hidden_email", "local_phone", "ssn", "iban", "secret")
LABELERS = ("form", "gazetteer", "context", "variety", "surroundings")

# fixed values: the base patterns
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOOSE = {
    "local_phone": re.compile(r"(?<![0-9+])(?<![0-9][ .-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}(?![A-Za-z0-9_/+-])"),
}
_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{1,63}){1,4}(?![A-Za-z0-9-])", re.I)
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{8,}(?![A-Za-z0-9])")

# fixed values: gazetteers
_ENDINGS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "it", "nl", "uk", "eu", "us", "ca", "ch", "at", "info", "co"}
_COUNTRIES = {"AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE"}
_KEY_PREFIXES = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxp-", "eyJ")
_HINTS = {
    "email": ("mail", "contact", "write to", "@"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "hidden_email": ("mail", "contact", "write to", "reach"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "ssn": ("ssn", "social security", "tax id"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "secret": ("token", "key", "secret", "password", "passwd", "credential"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds' spans, by kind and then start; leftmost, without overlaps in a kind."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        tail = _DOMAIN.match(text, at)
        if tail:
            low = at
            # the run before the sign, no further back than the last match
            while low > end and (_LOCAL_CHARS[ord(text[low - 1])] if ord(text[low - 1]) < 128 else False):
                low -= 1
            if low < at:
                out.append(("email", low, tail.end()))
                end = tail.end()
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


_LOCAL_CHARS = [bool(_LOCAL.match(chr(c))) for c in range(128)]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """All matches of the loose patterns that overlap no base span, by their start; they may overlap each other."""
    found = []
    lower = text.lower()
    if "at" in lower and "dot" in lower:
        found += [("hidden_email", m.start(), m.end()) for m in _AT.finditer(text)]
    digits = bool(_DIGIT.search(text))
    if digits:
        for kind in ("local_phone", "ssn", "iban", "secret"):
            for m in _LOOSE[kind].finditer(text):
                if kind != "secret" or (_DIGIT.search(m[0]) and re.search("[A-Za-z]", m[0])):
                    found.append((kind, m.start(), m.end()))
    if not found:
        return found
    # base spans as stretches without gaps: what a sorted candidate may overlap is the first that ends after its start
    busy: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in taken):
        if busy and a <= busy[-1][1]:
            busy[-1][1] = max(busy[-1][1], b)
        else:
            busy.append([a, b])
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        while at < len(busy) and busy[at][1] <= a:
            at += 1
        if at == len(busy) or b <= busy[at][0]:
            out.append((kind, a, b))
    return out


def apart(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans, given by their start, that overlap none kept before them."""
    out, end = [], 0
    for kind, a, b in spans:
        if a >= end:
            out.append((kind, a, b))
            end = b
    return out


def loose_spans(text: str, taken: list[tuple[str, int, int]], stands: Callable[[str, int, int], bool] = lambda *_: True) -> list[tuple[str, int, int]]:
    """Of the candidates that stand, those that overlap none before them: one that falls hides no other."""
    return apart([s for s in candidates(text, taken) if stands(*s)])


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Each labeler's vote on a span: 1 for, -1 against, 0 none."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    before = text[max(0, start - 40) : start].lower()
    if kind in BASE:
        form = 1
    elif kind == "iban":
        moved = re.sub(" ", "", span)
        form = 1 if int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1 else -1
    elif kind == "ssn":
        form = -1 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 1
    elif kind == "secret":
        form = 1 if re.fullmatch("[0-9a-f]{32,64}|[A-Z0-9]{20,}|[A-Za-z0-9_-]{32,}", span) and "--" not in span else 0
    else:
        form = 1 if kind == "local_phone" and digits[0] not in "01" else 0
    gazetteer = 0
    if kind in ("email", "hidden_email"):
        gazetteer = 1 if re.split(r"[^A-Za-z0-9-]+", span.lower())[-1] in _ENDINGS else -1
    elif kind == "iban":
        gazetteer = 1 if span[:2] in _COUNTRIES else -1
    elif kind == "local_phone":
        gazetteer = -1 if digits[:3] in ("000", "111", "123") else 1
    elif kind == "secret":
        gazetteer = 1 if span.startswith(_KEY_PREFIXES) else -1 if "/" in span or "-" in span.strip("-") else 0
    context = 1 if any(h in before for h in _HINTS[kind]) else 0
    varied = len(set(digits if kind != "secret" else span))
    variety = -1 if varied <= 2 else 1 if varied >= 4 else 0
    around = text[max(0, start - 1) : start], text[end : end + 1]
    surroundings = 1 if around[0] in ("", " ", "\n", '"', "'", ":", "(", "=") and around[1] in ("", " ", "\n", '"', "'", ".", ",", ")", ";") else -1
    return form, gazetteer, context, variety, surroundings


#: Groups of spans that vote patterns are counted in: each added kind, base spans and decoys.
ADDED = KINDS[len(BASE) :]
TRUE, FALSE = len(ADDED), len(ADDED) + 1
_CELLS = 3 ** len(LABELERS)


@dataclass
class SpanModel:
    """How labelers vote on false and true spans (labeler, vote + 1), and a logistic classifier on votes and kind."""

    votes: np.ndarray
    weights: np.ndarray

    @staticmethod
    def inputs(groups: np.ndarray, patterns: np.ndarray) -> np.ndarray:
        """For each labeler whether it votes for and whether against; the added kind; a constant."""
        return np.concatenate((patterns > 0, patterns < 0, groups[:, None] == np.arange(len(ADDED)), np.ones((len(groups), 1))), axis=1).astype(float)

    @classmethod
    def fit(cls, counted: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> SpanModel:
        """Of (group, votes, count).  Base spans and decoys weigh as much as all candidates do, however many there are."""
        n = len(LABELERS)
        table = np.array([[[0.3, 0.5, 0.2]] * n, [[0.1, 0.3, 0.6]] * n])
        if not counted:
            return cls(table, np.concatenate((np.ones(n), -np.ones(n), np.zeros(len(ADDED)), [-1.0])))
        group, patterns, count = np.array([g for g, _, _ in counted]), np.array([v for _, v, _ in counted]), np.array([c for _, _, c in counted], float)
        open_ = group < TRUE
        for known in (TRUE, FALSE):
            if (group == known).any():
                count[group == known] *= max(1.0, count[open_].sum()) / count[group == known].sum()
        prior = np.full(len(ADDED), 0.5)
        p = np.where(group == FALSE, 0.0, 1.0)
        for _ in range(rounds):
            likely = np.log(table)[:, np.arange(n), patterns + 1].sum(2)
            odds = likely[1] - likely[0] + np.log(prior / (1 - prior))[np.minimum(group, len(ADDED) - 1)]
            p = np.where(group == TRUE, 1.0, np.where(group == FALSE, 0.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50)))))
            for k in range(len(ADDED)):
                mine = group == k
                prior[k] = ((count * p)[mine].sum() + 1) / (count[mine].sum() + 2)
            for c, share in enumerate((1 - p, p)):
                for j in range(n):
                    # half a vote each way, so that what hasn't been seen isn't ruled out
                    seen = np.bincount(patterns[:, j] + 1, count * share, minlength=3) + 0.5
                    table[c, j] = seen / seen.sum()
        x, share = cls.inputs(group, patterns), count / count.sum()
        w = np.zeros(x.shape[1])
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.linalg.solve((x * (share * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (share * (p - q)) - 1e-3 * w)
        return cls(table, w)

    def chance(self, kind: str, pattern: tuple[int, ...]) -> float:
        x = self.inputs(np.array([ADDED.index(kind)]), np.array([pattern]))
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))[0])

    def standing(self) -> set[int]:
        """The codes of the candidates that stand."""
        return {encode(g, v) for g, kind in enumerate(ADDED) for v in map(decode, range(_CELLS)) if self.chance(kind, v) >= 0.5}


def encode(group: int, pattern: tuple[int, ...]) -> int:
    return group * _CELLS + sum((v + 1) * 3**i for i, v in enumerate(pattern))


def decode(code: int) -> tuple[int, ...]:
    return tuple(code % _CELLS // 3**i % 3 - 1 for i in range(len(LABELERS)))


def candidate_code(text: str, kind: str, start: int, end: int) -> int:
    return encode(ADDED.index(kind), votes(text, kind, start, end))


def counted_codes(text: str, base: list[tuple[str, int, int]], loose: list[int]) -> list[int]:
    """The codes that the model learns from: base spans', candidates', and that of the first long word from the middle on."""
    out = [encode(TRUE, votes(text, k, a, b)) for k, a, b in base] + loose
    if m := _WORD.search(text, len(text) // 2):
        out.append(encode(FALSE, votes(text, "secret", m.start(), m.end())))
    return out


def _patterns(rows: list) -> list[tuple[int, tuple[int, ...], int]]:
    return [(r["code"] // _CELLS, decode(r["code"]), r["n"]) for r in rows]


def _digest(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1])))


_SCAN = "base array<struct<kind: string, start: int, end: int>>, loose array<struct<kind: string, start: int, end: int, code: int>>, codes array<int>"
_SPAN = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, loose, codes) of each document: spans, candidates with their votes, and all spans' votes."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(key, pa.int64()), ("base", pa.list_(pa.struct(_SPAN))), ("loose", pa.list_(pa.struct([*_SPAN, ("code", pa.int32())]))), ("codes", pa.list_(pa.int32()))])
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = []
                for i, cell in zip(part.column(0).to_pylist(), part.column(1)):
                    body = cell.as_py() or ""
                    base = base_spans(body)
                    loose = [(k, a, b, candidate_code(body, k, a, b)) for k, a, b in candidates(body, base)]
                    rows.append({
                        key: i,
                        "base": [{"kind": k, "start": a, "end": b} for k, a, b in base],
                        "loose": [{"kind": k, "start": a, "end": b, "code": c} for k, a, b, c in loose],
                        "codes": counted_codes(body, base, [c for *_, c in loose]),
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return docs.select(F.col(key).cast("long").alias(key), F.col(text)).mapInArrow(look, f"`{key}` long, {_SCAN}")


def fit(scanned: DataFrame) -> SpanModel:
    """The model of all documents' vote patterns, of which there are 3 to the number of labelers for each group at most."""
    return SpanModel.fit(_patterns(scanned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy("code").collect()))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts are of base spans; ``spans`` has them and the candidates that the
    classifier accepts, as kind:start:end in code points.  A null text is an
    empty one, a document without spans has an empty ``spans``; rows that
    repeat are reported each; an empty table gives no rows.  Texts are read
    whole, in time that grows with their length.  Documents are read once; their
    spans are kept.
    """
    scanned = stored(scan(docs, key, text), "pii")
    model = fit(scanned)
    good = model.standing()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(key, pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
                added = apart([(s["kind"], s["start"], s["end"]) for s in r["loose"] if s["code"] in good])
                rows.append({
                    key: r[key], **{f"n_{k}": sum(s[0] == k for s in base) for k in BASE},
                    "base_sha256": hashlib.sha256(_digest(base).encode()).hexdigest(), "spans": _digest(base + added), "n_added": len(added),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    counts = ", ".join(f"n_{k} long" for k in BASE)
    return scanned.select(key, "base", "loose").mapInArrow(finish, f"`{key}` long, {counts}, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in brackets; rows and columns stay."""
    place = docs.columns.index(text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*names)
    codes = scan(flat.select(F.lit(None).cast("long").alias("none"), F.col(names[place])), "none", names[place]).select("codes")
    model = fit(codes)
    good = model.standing()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                bodies = []
                for cell in part.column(place):
                    body = cell.as_py()
                    if body:
                        base = base_spans(body)
                        spans = base + loose_spans(body, base, lambda k, a, b: candidate_code(body, k, a, b) in good)
                        end, out = 0, []
                        for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                            if a >= end:
                                out += [body[end:a], f"[{k.upper()}]"]
                            end = max(end, b)
                        body = "".join([*out, body[end:]]) if spans else body
                    bodies.append(body)
                yield part.set_column(place, names[place], pa.array(bodies, pa.string()))

    return flat.mapInArrow(clean, flat.schema).toDF(*docs.columns)
