"""32-bit rolling hashes over UTF-16 units, and digests, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = (1 << 32) - 1


def rolling(text: Column, factor: int) -> Column:
    """hash * factor + unit over the UTF-16 units, modulo 2^32, in lower-case hex."""
    units = F.hex(F.encode(F.coalesce(text, F.lit("")), "UTF-16BE"))
    # four hex digits a unit; an empty text has none
    parts = F.filter(F.regexp_extract_all(units, F.lit("(.{4})"), F.lit(1)), lambda x: x != "")
    fold = F.aggregate(
        parts, F.lit(0).cast("long"), lambda h, u: (h * F.lit(factor) + F.conv(u, 16, 10).cast("long")).bitwiseAND(F.lit(MASK))
    )
    return F.lower(F.hex(fold))


def transcript_checksum(lines: Column) -> Column:
    return F.concat(F.lit("v0-"), rolling(lines, 31))


def fingerprint(seed: Column) -> Column:
    return F.concat(F.lit("cand-"), rolling(seed, 33))


def sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)
