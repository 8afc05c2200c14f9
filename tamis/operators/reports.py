"""Counts and reports over raw, cleaned and filtered documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.functions.text import byte_count, preview, sheet_safe, word_count
from tamis.operators.sampling import sample_per_group
from tamis.session import cut_lineage

# Fixed value: the token pattern used where no tokenizer is plugged in.
TOKEN = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]"


def token_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(TOKEN)).cast("long")


def tokenizer_counter(load):
    """Arrow counter for a real tokenizer; ``load()`` gives ``encode_batch(list) -> list of ids``.

    The tokenizer is loaded once per worker process, texts go through in Arrow batches.
    """
    import pandas as pd
    from pyspark.sql import types as T

    state: dict = {}

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        if "encode" not in state:
            state["encode"] = load()
        present = texts.fillna("")
        return pd.Series([len(ids) for ids in state["encode"](present.tolist())], dtype="int64")

    return count


def percent(part: Column, whole: Column) -> Column:
    """Percentage, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0))


def per_source(df: DataFrame, aggregates: list[Column], total_label: str = "Total") -> DataFrame:
    """Aggregates by source plus one total row, from a single pass (rollup)."""
    rolled = df.rollup("source").agg(F.grouping("source").alias("_g"), *aggregates)
    return rolled.withColumn("source", F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col("source"))).drop("_g")


def words_per_source(df: DataFrame, text_col: str = "text", n_words_col: str | None = None) -> DataFrame:
    """Words by source; a given count is preferred, missing ones are computed."""
    words = word_count(F.col(text_col))
    if n_words_col:
        words = F.coalesce(F.col(n_words_col), words)
    return df.groupBy("source").agg(F.sum(words).alias("words"))


def before_after(df: DataFrame, before: str, after: str) -> DataFrame:
    """Documents and words before and after cleaning, by source and in total, in one job."""
    counted = df.select("source", word_count(F.col(before)).alias("b"), word_count(F.col(after)).alias("a"))
    sums = [F.count(F.lit(1)).alias("documents"), F.sum("b").alias("words_before"), F.sum("a").alias("words_after")]
    out = per_source(counted, sums)
    lost = F.col("words_before") - F.col("words_after")
    return out.withColumn("reduction_percent", F.round(percent(lost, F.col("words_before")), 6))


def raw_against_cleaned(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Word totals of two tables side by side, sources of either kept."""
    left = words_per_source(raw).withColumnRenamed("words", "raw_words")
    right = words_per_source(cleaned).withColumnRenamed("words", "cleaned_words")
    return left.join(right, "source", "full_outer").select(
        "source", F.coalesce("raw_words", F.lit(0)).alias("raw_words"), F.coalesce("cleaned_words", F.lit(0)).alias("cleaned_words")
    )


def file_counts(df: DataFrame, text_col: str = "text", counter=token_count) -> DataFrame:
    """Words and tokens by (source, file)."""
    return df.groupBy("source", "file_key").agg(
        F.sum(word_count(F.col(text_col))).alias("word_count"), F.sum(counter(F.col(text_col))).alias("token_count")
    )


def counts_summary(counts: DataFrame) -> DataFrame:
    """Totals and shares by source, a ``Total`` row and a ``Total (millions)`` row.

    Works on (source, file) counts, so the single-row totals are tiny.
    """
    sums = [F.sum("word_count").alias("total_words"), F.sum("token_count").alias("total_tokens")]
    rolled = per_source(counts, sums)
    is_total = F.col("source") == "Total"
    # One row per source reaches this window.
    whole = Window.partitionBy()
    shares = rolled.select(
        "source", "total_words",
        F.round(F.when(is_total, 100.0).otherwise(percent(F.col("total_words"), F.max("total_words").over(whole))), 2).alias("percent_words"),
        "total_tokens",
        F.round(F.when(is_total, 100.0).otherwise(percent(F.col("total_tokens"), F.max("total_tokens").over(whole))), 2).alias("percent_tokens"),
    )
    nothing = F.lit(None).cast("double")
    millions = counts.agg(*sums).select(
        F.lit("Total (millions)").alias("source"),
        F.round(F.col("total_words") / 1e6, 0).cast("long").alias("total_words"), nothing.alias("percent_words"),
        F.round(F.col("total_tokens") / 1e6, 0).cast("long").alias("total_tokens"), nothing.alias("percent_tokens"),
    )
    return shares.unionByName(millions)


def size_report(annotated: DataFrame, text_col: str = "text") -> DataFrame:
    """Bytes kept and removed by source and overall."""
    kept = F.col("filter_reason").isNull()
    size = byte_count(F.col(text_col))
    sums = [
        F.sum(F.when(kept, size).otherwise(0)).alias("output_bytes"),
        F.sum(F.when(kept, 0).otherwise(size)).alias("removed_bytes"),
    ]
    out = per_source(annotated, sums)
    whole = F.col("output_bytes") + F.col("removed_bytes")
    return out.withColumn("filter_percent", F.round(percent(F.col("removed_bytes"), whole), 6))


def reason_totals(annotated: DataFrame) -> DataFrame:
    """Documents and words by (source, reason), kept documents under a null reason.

    One pass over the documents; the reports below work on its few rows.
    """
    return annotated.groupBy("source", "filter_reason").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_words").alias("words")
    )


def reason_counts(annotated: DataFrame) -> DataFrame:
    """Count by (source, reason) with its share of all and of dropped documents."""
    w = Window.partitionBy("source")
    dropped = F.sum(F.when(F.col("filter_reason").isNotNull(), F.col("documents")).otherwise(0)).over(w)
    shared = reason_totals(annotated).select(
        "source", "filter_reason", "documents",
        (F.col("documents") / F.sum("documents").over(w)).alias("of_total"),
        F.try_divide(F.col("documents"), dropped).alias("of_dropped"),
    )
    return shared.where(F.col("filter_reason").isNotNull())


def drop_summary(annotated: DataFrame, top: int = 5) -> DataFrame:
    """By source: totals, percentage dropped, words before and after, the most frequent reasons."""
    dropped = F.col("filter_reason").isNotNull()
    # Kept documents come last in the order, so the rank counts reasons only.
    w = Window.partitionBy("source").orderBy(F.col("filter_reason").isNull(), F.desc("documents"), "filter_reason")
    ranked = reason_totals(annotated).withColumn("_n", F.row_number().over(w))
    entry = F.when(dropped & (F.col("_n") <= top), F.struct("_n", F.concat_ws(":", "filter_reason", "documents").alias("r")))
    sums = ranked.groupBy("source").agg(
        F.sum("documents").alias("total_samples"),
        F.sum(F.when(dropped, F.col("documents")).otherwise(0)).alias("samples_dropped"),
        F.sum("words").alias("words_before"), F.sum(F.when(dropped, 0).otherwise(F.col("words"))).alias("words_after"),
        F.array_sort(F.collect_list(entry)).alias("_r"),
    )
    return sums.select(
        "source", "total_samples", "samples_dropped",
        F.round(percent(F.col("samples_dropped"), F.col("total_samples")), 6).alias("drop_percentage"),
        "words_before", "words_after", (F.col("words_before") - F.col("words_after")).alias("words_dropped"),
        F.array_join(F.transform("_r", lambda s: s["r"]), ",").alias("top_reasons"),
    )


def reason_summary(annotated: DataFrame, by_group: bool = False) -> DataFrame:
    """Dropped documents by reason (or group and reason): count, words, average, percentages."""
    keys = ["filter_group", "filter_reason"] if by_group else ["filter_reason"]
    removed = annotated.where(F.col("filter_reason").isNotNull())
    sums = removed.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_words").alias("total_words"))
    average = F.round(F.col("total_words") / F.col("documents"), 2).alias("average_words")
    if by_group:
        lines = F.sum("documents").over(Window.partitionBy("filter_group")).alias("group_documents")
        return sums.select(*keys, "documents", "total_words", average, lines)
    # One row per reason reaches this window.
    whole = Window.partitionBy()
    return sums.select(
        *keys, "documents", "total_words", average,
        F.round(F.col("documents") / F.sum("documents").over(whole) * 100, 2).alias("documents_percent"),
        F.round(F.col("total_words") / F.sum("total_words").over(whole) * 100, 2).alias("words_percent"),
    )


def removed_examples(annotated: DataFrame, per_reason: int = 30, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """A stable sample of removed documents by reason, with a spreadsheet-safe preview and the whole text."""
    removed = annotated.where(F.col("filter_reason").isNotNull())
    picked = sample_per_group(removed, ["filter_reason"], id_col, per_reason, seed, rank_col="example")
    return picked.select(
        "filter_reason", F.col("example").cast("long").alias("example"), id_col, "filter_group", "n_words",
        sheet_safe(preview(F.col("text"))).alias("text_preview"), F.col("text").alias("full_text"),
    )


def reason_evidence(annotated: DataFrame, per_reason: int = 20, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Sampled removed documents with the share of all documents their reason accounts for.

    The gates run once: their verdicts, without the texts, are kept for both uses.
    """
    verdicts = cut_lineage(annotated.select(id_col, "source", "filter_reason", "n_words"))
    removed = verdicts.where(F.col("filter_reason").isNotNull())
    picked = sample_per_group(removed, ["source", "filter_reason"], id_col, per_reason, seed)
    shares = reason_counts(verdicts).select("source", "filter_reason", F.col("of_total").alias("reason_filter_prob"))
    return picked.select("source", "filter_reason", id_col).join(shares, ["source", "filter_reason"])


def report_tables(
    annotated: DataFrame, per_reason: int = 30, id_col: str = "doc_id", texts: DataFrame | None = None, carry: tuple[str, ...] = ("file_path", "metadata"), seed: int = 42,
) -> dict[str, DataFrame]:
    """The five tables of the filter report, from one pass of the gates.

    The verdicts of removed documents, without texts, are written down once; counts and the choice of
    examples work on them.  Only the texts of chosen ids are fetched, from ``texts`` (by default
    ``annotated``), with the columns of ``carry`` that it has.
    """
    removed = annotated.where(F.col("filter_reason").isNotNull())
    verdicts = cut_lineage(removed.select(id_col, "filter_group", "filter_reason", "n_words"))
    sums = cut_lineage(verdicts.groupBy("filter_group", "filter_reason").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_words").alias("total_words")))
    picked = sample_per_group(verdicts, ["filter_reason"], id_col, per_reason, seed, rank_col="example")
    picked = cut_lineage(picked.withColumn("example", F.col("example").cast("long")))
    source = removed if texts is None else texts
    extra = [c for c in carry if c in source.columns]
    # At most per_reason rows for each of the gates, so the ids are few whatever the corpus holds.
    examples = source.select(id_col, "text", *extra).join(F.broadcast(picked), id_col)
    columns = ["filter_reason", "example", id_col, "filter_group", "n_words", *extra]
    average = F.round(F.col("total_words") / F.col("documents"), 2).alias("average_words")
    reasons = sums.groupBy("filter_reason").agg(F.sum("documents").alias("documents"), F.sum("total_words").alias("total_words"))
    whole = Window.partitionBy()  # one row per reason
    share = lambda c: F.round(F.col(c) / F.sum(c).over(whole) * 100, 2)
    return {
        "overall_summary": reasons.select(
            "filter_reason", "documents", "total_words", average, share("documents").alias("documents_percent"), share("total_words").alias("words_percent"),
        ),
        "group_statistics": sums.select(
            "filter_group", "filter_reason", "documents", "total_words", average, F.sum("documents").over(Window.partitionBy("filter_group")).alias("group_documents"),
        ),
        "examples_preview": examples.select(*columns, sheet_safe(preview(F.col("text"))).alias("text_preview")),
        "full_examples": examples.select(*columns, F.col("text").alias("full_text")),
        "filter_counts": reasons.select("filter_reason", "documents").orderBy(F.desc("documents"), "filter_reason"),
    }


def before_after_duplicates(docs: DataFrame, clusters: DataFrame, length: Column, id_col: str = "doc_id", group: str = "source", unit: str = "words") -> DataFrame:
    """By group: documents and ``unit``s before and after near copies go, and the share that went.

    ``clusters`` are ``id, component``; ``length`` counts words or, with a column of
    ``training.token_counts``, tokens.
    """
    gone = clusters.where(F.col(id_col) != F.col("component")).select(id_col, F.lit(True).alias("_gone"))
    counted = docs.select(id_col, group, length.alias("_size")).join(gone, id_col, "left")
    kept = F.col("_gone").isNull()
    return counted.groupBy(group).agg(
        F.count(F.lit(1)).alias("docs_before"), F.count_if(kept).alias("docs_after"), F.sum("_size").alias(f"{unit}_before"),
        F.coalesce(F.sum(F.when(kept, F.col("_size"))), F.lit(0)).alias(f"{unit}_after"),
        F.round(1 - F.count_if(kept) / F.count(F.lit(1)), 6).alias("duplicate_ratio"),
    )


def multiplicity(df: DataFrame, cols: list[str]) -> DataFrame:
    """How many values occur once, twice, ..."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("times"))
    return counts.groupBy("times").agg(F.count(F.lit(1)).alias("values"))


def length_overview(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Number, total, average, minimum and maximum of words and bytes."""
    counted = df.select(word_count(F.col(text_col)).alias("w"), byte_count(F.col(text_col)).alias("b"))
    cols = [F.count(F.lit(1)).alias("articles")]
    for name, c in (("words", "w"), ("bytes", "b")):
        cols += [
            F.sum(c).alias(f"total_{name}"), F.round(F.avg(c), 6).alias(f"avg_{name}"),
            F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"),
        ]
    return counted.agg(*cols)
