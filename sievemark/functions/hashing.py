"""Seeded hashes that give the same value in Spark and in other SQL engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_DIGITS = 3


def seeded_md5(seed: int, *parts: Column) -> Column:
    """Hex md5 of ``seed:part1:part2…``; the sort key of every random order."""
    texts = [p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def hash60(text: Column) -> Column:
    """First 60 bits of md5 as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def md5_bucket(digest: Column, digits: int = BUCKET_DIGITS) -> Column:
    """Order-preserving bucket of a hex digest: its first ``digits`` digits."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")


def content_hash(content: Column) -> Column:
    """SHA-256 hex digest."""
    return F.sha2(content, 256)
