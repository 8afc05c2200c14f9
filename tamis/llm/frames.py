"""Frame helpers: size-checked semi-joins and spreading documents over buckets of bounded bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 1_000_000


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most ``rows``, so that a worker holds few at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def written_id(id_col: str) -> Column:
    """The id as text, the way it goes through Python: beside a null, whole numbers would become doubles there."""
    return F.col(id_col).cast("string")


def keep_ids(df: DataFrame, ids: DataFrame, column: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids`` (distinct, of one column of that name).

    Up to ``limit`` ids are broadcast, so wide rows need not move; more are joined by shuffle.
    """
    return df.join(F.broadcast(ids) if ids.count() <= limit else ids, column, "left_semi")


def bucketed(df: DataFrame, key: Column, text: Column, bucket_bytes: int) -> tuple[DataFrame, int, int]:
    """``df`` with a column ``bucket`` of about ``bucket_bytes`` of text each, the number of buckets, the bytes."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("long")), n, total


def drop_ids(df: DataFrame, ids: DataFrame, column: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among ``ids``; rows with a null there stay.  See ``keep_ids``."""
    return df.join(F.broadcast(ids) if ids.count() <= limit else ids, column, "left_anti")
