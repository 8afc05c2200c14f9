"""Exact de-duplication of rows that arrive in increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tamis.operators.dedup import content_key

COPIES = "key binary, kept_id {}, copies long, batch long"


def track_copies(stream: DataFrame, id_col: str, cols: list[str], store: str, checkpoint: str) -> StreamingQuery:
    """Take in what has arrived and stop; ``store`` then tells of every content its smallest id and how often it came.

    The state is one row per distinct content: a 128-bit digest, an id, a count.  Tasks aggregate
    before the exchange, so a content that most rows share costs a row per task.  An increment costs
    what it holds: only contents that occur in it are written, to a folder of their own per batch.  A
    batch that was lost is run again by the checkpoint with the same rows and number, and replaces its
    folder.  Ids may come in any order, also a smaller one later.  Null ids never win over others.

    State of that size belongs on disk: set ``spark.sql.streaming.stateStore.providerClass`` to the
    RocksDB provider.  The number of shuffle partitions stays that of the first run.
    """
    keyed = stream.select(F.col(id_col).alias("id"), content_key(*[F.col(c) for c in cols]).alias("key"))
    copies = keyed.groupBy("key").agg(F.min("id").alias("kept_id"), F.count(F.lit(1)).alias("copies"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")

    return copies.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tracked(spark: SparkSession, store: str, id_type: str = "long", upto: int | None = None) -> DataFrame:
    """``kept_id, copies`` of every content taken in so far, or up to a batch."""
    told = spark.read.schema(COPIES.format(id_type)).parquet(store)
    if upto is not None:
        told = told.where(F.col("batch") <= upto)
    latest = F.max_by(F.struct("kept_id", "copies"), "batch").alias("now")
    return told.groupBy("key").agg(latest).select("now.kept_id", "now.copies")


def changes(spark: SparkSession, store: str, batch: int, id_type: str = "long") -> DataFrame:
    """``id, kept``: ids that the batch made kept ones, and earlier ones that gave way to a smaller id."""
    told = spark.read.schema(COPIES.format(id_type)).parquet(store)
    now = told.where(F.col("batch") == batch).select("key", "kept_id")
    earlier = told.where(F.col("batch") < batch).join(now.select("key"), "key", "left_semi")
    before = earlier.groupBy("key").agg(F.max_by("kept_id", "batch").alias("old_id"), F.lit(True).alias("known"))
    moved = now.join(before, "key", "left").where(F.col("known").isNull() | ~F.col("kept_id").eqNullSafe(F.col("old_id")))
    gone = moved.where("known").select(F.col("old_id").alias("id"), F.lit(False).alias("kept"))
    return moved.select(F.col("kept_id").alias("id"), F.lit(True).alias("kept")).unionByName(gone)
