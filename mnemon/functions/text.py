"""Text cleaning and tokenising as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mnemon import lexicon as L

SPACE = r"(?U)\s+"


def strip(text: Column) -> Column:
    """Without white space at the ends, Unicode's included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, SPACE, " "))


def any_match(text: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | text.rlike(p)
    return out


def count_matches(text: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns match, not how often."""
    return sum((text.rlike(p).cast("int") for p in patterns), F.lit(0))


def includes_any(text: Column, terms: tuple[str, ...]) -> Column:
    lower = F.lower(text)
    out = F.lit(False)
    for term in terms:
        out = out | lower.contains(term.lower())
    return out


def normalize(text: Column) -> Column:
    """Trim lines, drop blank and noise lines, blank out noise in the others, and squeeze to one line."""
    noise = "|".join(f"(?:{p})" for p in L.NOISE_LINES)

    def clean(line: Column) -> Column:
        for p in L.NOISE_PIECES:
            line = F.regexp_replace(line, p, " ")
        return line

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), strip)
    kept = F.filter(lines, lambda x: (x != "") & ~x.rlike(noise))
    return squeeze(F.array_join(F.transform(kept, clean), " "))


def is_low_signal(text: Column) -> Column:
    bare = strip(F.coalesce(text, F.lit("")))
    return (F.length(bare) <= 2) | any_match(bare, L.LOW_SIGNAL)


def is_temporary(text: Column) -> Column:
    bare = strip(F.coalesce(text, F.lit("")))
    return (bare == "") | includes_any(bare, L.TEMPORARY_PARTS) | bare.rlike(L.TEMPORARY_WORDS)


def is_noise(text: Column) -> Column:
    plain = normalize(text)
    tokens = F.split(plain, " ")
    short = F.size(F.filter(tokens, lambda t: F.length(t) <= 2)) / F.greatest(F.size(tokens), F.lit(1))
    return (plain == "") | is_temporary(plain) | ((F.length(plain) < 8) & (short > 0.8))


def truncate(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n - 1)), F.lit("…"))).otherwise(text)


def redact_key(text: Column) -> Column:
    return F.regexp_replace(text, "(?i)key=[^&\\s\"']+", "key=REDACTED")


def recall_tokens(text: Column) -> Column:
    """The runs of two or more letters, digits and joiners; no lambda, so literals fold and rows stay in generated code."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9가-힣_/-]{2,}"), F.lit(0))


def project_tokens(text: Column) -> Column:
    parts = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9_/-]+", " "), r"[\s/]+")
    return F.filter(parts, lambda t: t != "")


def project_slug(text: Column) -> Column:
    slug = F.regexp_replace(F.lower(strip(F.regexp_replace(text, r"(?i)\.git$", ""))), "[^a-z0-9_-]+", "-")
    return F.regexp_replace(F.regexp_replace(slug, "-+", "-"), "^-+|-+$", "")


def file_slug(text: Column) -> Column:
    slug = F.regexp_replace(F.lower(strip(F.coalesce(text, F.lit("")))), "[^a-z0-9_-]+", "-")
    return F.regexp_replace(slug, "^-+|-+$", "")


def entry_slug(kind: Column, title: Column, scope: Column) -> Column:
    """``scope-kind-title`` without the title's own kind, as a slug of at most 120 characters."""
    bare = F.coalesce(title, F.lit(""))
    head = F.regexp_extract(bare, r"(?s)^([A-Za-z0-9_ -]*?)\s*:\s*(.*)$", 1)
    rest = F.regexp_extract(bare, r"(?s)^([A-Za-z0-9_ -]*?)\s*:\s*(.*)$", 2)
    bare = strip(F.when((head != "") & (F.lower(head) == F.lower(kind)), rest).otherwise(bare))
    slug = F.regexp_replace(F.lower(F.concat_ws("-", scope, kind, bare)), "[^a-z0-9가-힣]+", "-")
    slug = F.left(F.regexp_replace(slug, "^-+|-+$", ""), F.lit(120))
    return F.when(slug == "", F.concat(kind, F.lit("-entry"))).otherwise(slug)
