"""Stable hashes: the same value on every engine, partitioning and run."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def stable_rank_key(seed: int, *cols: str | Column) -> Column:
    """Pseudo-random order of rows that depends on the seed and the key only."""
    keys = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def hash60(c: Column) -> Column:
    """First 60 bits of the MD5 as a non-negative long."""
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 15), 16, 10).cast("long")


def unit_interval(seed: int, *cols: str | Column, buckets: int = 10000) -> Column:
    """A stable draw from ``0, 1/buckets, ..``."""
    head = F.conv(F.substring(stable_rank_key(seed, *cols), 1, 15), 16, 10).cast("long")
    return F.pmod(head, F.lit(buckets)) / F.lit(float(buckets))
