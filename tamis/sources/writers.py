"""Sinks: partitioned folders, bounded files, pass/removed folders, manifests, incremental selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tamis.functions.text import byte_count
from tamis.operators.rows import size_chunks


def write_by_source(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", records_per_file: int | None = None) -> None:
    """One folder per source; tasks write side by side, so a large source gets many files."""
    writer = df.write.mode(mode).partitionBy("source").format(fmt)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.save(path)


def write_articles(df: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """JSON lines in files of at most ``records_per_file`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", records_per_file).json(path)


def write_size_chunks(df: DataFrame, path: str, key: str | list[str], limit: int = 100 * 1024 * 1024) -> None:
    """JSON lines in chunks of about ``limit`` bytes per source (row text plus 50), in the order of ``key`` of any type.

    A chunk is one shuffle group, and no group exceeds the limit by more than a row.
    """
    chunked = size_chunks(df, key, byte_count(F.col("text")) + 50, limit, ["source"])
    chunked.repartition("source", "chunk").write.mode("overwrite").partitionBy("source", "chunk").json(path)


def filter_folder(group: Column) -> Column:
    return F.when(group.isNull(), "output").otherwise(F.concat(F.lit("removed_"), group))


def write_filtered(annotated: DataFrame, path: str) -> None:
    """Kept documents and one folder per filter group, in one pass."""
    annotated.withColumn("folder", filter_folder(F.col("filter_group"))).write.mode("overwrite").partitionBy("folder").option(
        "compression", "gzip").json(path)


def write_deduplicated(kept: DataFrame, removed: DataFrame, path: str) -> None:
    kept.write.mode("overwrite").parquet(f"{path}/kept")
    removed.write.mode("overwrite").parquet(f"{path}/removed")


def write_mixture(mixed: DataFrame, manifest: DataFrame, path: str) -> None:
    """The mixed texts in mix order, and the order manifest."""
    ordered = mixed.repartitionByRange("source_rank", "source").sortWithinPartitions("source_rank", "source")
    ordered.select("text").write.mode("overwrite").json(f"{path}/mixed_dataset")
    # One row per source.
    manifest.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/dataset_order")


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def new_inputs(files: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Inputs that the manifest of finished ones does not list."""
    return files.join(done.select(key), key, "left_anti")


def finished_stem(path: Column, suffix: str = "_cleaned") -> Column:
    """Name an output stands for: its file name without the suffix and the extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), suffix + r"\.[^.]+$", "")
