"""Deterministic sampling, splitting and allocation.

Every choice hangs on a hash of (seed, id), so it survives repartitioning,
retries and reruns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.functions.hashing import hash60, stable_rank_key, unit_interval
from tamis.operators.rows import first_n, row_numbers


def sample_per_group(
    df: DataFrame, groups: list[str], id_col: str, n: int, seed: int = 42, rank_col: str | None = None
) -> DataFrame:
    """Up to n rows per group in hash order; no task ranks a whole group, however large n is (see ``rows.first_n``)."""
    keyed = df.withColumn("_key", stable_rank_key(seed, id_col))
    return first_n(keyed, groups, ["_key", id_col], n, rank_col).drop("_key")


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in hash order, as a distributed top-n."""
    return df.orderBy(stable_rank_key(seed, id_col), id_col).limit(n)


def sample_files_then_rows(df: DataFrame, source: str, file: str, id_col: str, files: int = 10, rows: int = 100, seed: int = 42) -> DataFrame:
    """Per source: up to ``files`` files in hash order, and ceil(rows / chosen files) rows of each."""
    listed = df.select(source, file).distinct()
    w = Window.partitionBy(source).orderBy(stable_rank_key(seed, source, file), file)
    chosen = listed.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= files)
    quota = chosen.withColumn("_quota", F.ceil(F.lit(float(rows)) / F.count(F.lit(1)).over(Window.partitionBy(source)))).drop("_n")
    # The quota never exceeds ``rows``: cut to that per file first, then to the quota.
    capped = sample_per_group(df, [source, file], id_col, rows, seed, rank_col="_rank")
    return capped.join(quota, [source, file]).where(F.col("_rank") <= F.col("_quota")).drop("_rank", "_quota")


def allocate_uniform(units: DataFrame, unit: str, n: int) -> DataFrame:
    """Spread n over the units as evenly as possible; the first ones (by name) get the remainder.

    ``units`` has one row per file or source.  The remainder is below n, so the units
    that get it are a short top list.
    """
    base, rest = divmod(n, max(1, units.count()))
    firsts = units.select(unit).orderBy(unit).limit(rest).withColumn("_more", F.lit(1))
    return units.select(unit).join(firsts, unit, "left").select(
        unit, (F.lit(base) + F.coalesce("_more", F.lit(0))).cast("long").alias("samples")
    )


def allocate_random(units: DataFrame, unit: str, n: int, seed: int = 42) -> DataFrame:
    """n draws, each landing on a hashed unit; units may get none."""
    numbered = row_numbers(units.select(unit).withColumn("_h", hash60(F.col(unit).cast("string"))), "_h", "_i")
    draws = units.sparkSession.range(n).select(unit_interval(seed, "id", buckets=2**31 - 1).alias("_u"))
    landed = draws.select((F.floor(F.col("_u") * F.lit(units.count())) + 1).alias("_i"))
    counts = landed.groupBy("_i").agg(F.count(F.lit(1)).alias("samples"))
    return numbered.join(counts, "_i", "left").select(unit, F.coalesce("samples", F.lit(0)).alias("samples"))


def allocate_weighted(units: DataFrame, unit: str, n: int, seed: int = 42) -> DataFrame:
    """Shares proportional to hashed weights, rounded down; the last unit takes what is left."""
    weighted = units.select(unit, unit_interval(seed, unit).alias("_w"))
    whole, last = weighted.agg(F.sum("_w"), F.max(unit)).first()
    shares = weighted.select(unit, F.floor(F.col("_w") / F.lit(whole) * n).cast("long").alias("samples"))
    others = shares.where(F.col(unit) != last).agg(F.coalesce(F.sum("samples"), F.lit(0))).first()[0]
    return shares.select(unit, F.when(F.col(unit) == last, n - others).otherwise(F.col("samples")).alias("samples"))


def split_flag(id_col: str, validation_share: float, seed: int = 42, buckets: int = 10000) -> Column:
    """'validation' for a stable share of ids, else 'train'."""
    return F.when(unit_interval(seed, id_col, buckets=buckets) < validation_share, "validation").otherwise("train")


def rate_on_sample(df: DataFrame, valid: Column, id_col: str, n: int, total: int, seed: int = 42) -> DataFrame:
    """Share of valid rows in a sample of n, carried over to ``total`` rows."""
    picked = sample_rows(df.select(id_col, valid.alias("_v")), id_col, n, seed)
    rate = F.avg(F.col("_v").cast("double"))
    return picked.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if("_v").alias("valid"), F.round(rate, 6).alias("rate"),
        F.round(rate * total, 0).cast("long").alias("estimated_total"),
    )
