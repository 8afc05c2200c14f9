"""Evaluation runs: names, timestamps, latest scores, matrices, per-sample details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.operators.rows import previous_value

# Topics whose means stand for the two halves of the psychometric test.
HEBREW_TOPICS = ["understanding_hebrew", "sentence_text_hebrew", "sentence_complete_hebrew", "analogies_hebrew"]
ENGLISH_TOPICS = ["restatement_english", "sentence_text_english", "sentence_complete_english"]
# Misnamed benchmarks and their right names.
RENAMED = {
    "psychometric_heb_restatement": "psychometric_heb_restatement_english",
    "psychometric_heb_analogies": "psychometric_heb_analogies_hebrew",
}


def parse_timestamp(c: Column) -> Column:
    """``YYYY-MM-DDTHH-MM-SS`` folder names (or proper timestamps); null where unreadable."""
    repaired = F.when(
        c.contains("T"),
        F.concat(F.substring_index(c, "T", 1), F.lit("T"), F.replace(F.regexp_replace(c, "^[^T]*T", ""), F.lit("-"), F.lit(":"))),
    ).otherwise(c)
    return F.try_to_timestamp(repaired)


def clean_model_name(c: Column, prefixes: list[str]) -> Column:
    out = c
    for p in prefixes:
        out = F.when(c.startswith(p), F.replace(c, F.lit(p), F.lit(""))).otherwise(out)
    return out


def model_group(c: Column) -> Column:
    return F.when(c.contains("/"), F.substring_index(c, "/", 1)).otherwise(F.lit(""))


def training_step(c: Column) -> Column:
    """Number after ``step-``; 0 for a step name without one; null for a base model."""
    number = F.nullif(F.regexp_extract(c, r"step-(\d+)", 1), F.lit("")).cast("long")
    return F.when(c.contains("step"), F.coalesce(number, F.lit(0)))


def run_id(model: Column, ts: Column) -> Column:
    return F.concat(model, F.lit(" - "), F.date_format(ts, "yyyy-MM-dd HH:mm"))


def benchmark_name(c: Column) -> Column:
    """Merge misnamed benchmarks into the right ones."""
    out = c
    for wrong, right in RENAMED.items():
        out = F.when(c == wrong, F.lit(right)).otherwise(out)
    return out


def merge_columns(df: DataFrame, wrong: str, right: str) -> DataFrame:
    """Fill gaps of a column from its misnamed twin, and drop the twin."""
    if wrong not in df.columns:
        return df
    if right not in df.columns:
        return df.withColumnRenamed(wrong, right)
    return df.withColumn(right, F.coalesce(right, wrong)).drop(wrong)


def complete_runs(df: DataFrame, include_partial: bool = False) -> DataFrame:
    if include_partial or "samples_number" not in df.columns:
        return df
    return df.where(F.col("samples_number").isNull() | (F.col("samples_number") > 1000))


def named_runs(df: DataFrame) -> DataFrame:
    """Rows with a model name, duplicates dropped."""
    return df.dropna(subset=["model_name"]).dropDuplicates()


def latest_per_model(df: DataFrame, keys: list[str], ts: str = "ts", tie: str | None = None) -> DataFrame:
    """The newest row per key; one row per key leaves a task ahead of the exchange."""
    order = [F.desc(ts)] + ([F.desc(tie)] if tie else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_per_step(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Newest non-null value of each column by (key, step)."""
    return df.groupBy(*keys).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values])


def checkpoint_series(df: DataFrame, include_checkpoints: bool = True) -> DataFrame:
    """Runs to plot: base models at step 0, and the checkpoints when asked for."""
    named = F.col("model_name").rlike("step-|checkpoint-") & F.col("model_name").contains("/")
    step = F.when(F.col("steps").isNull() & ~named, F.lit(0)).otherwise(F.col("steps")).cast("long")
    out = df.withColumn("step", step).where(F.col("step").isNotNull())
    return out if include_checkpoints else out.where(F.col("steps").isNull())


def score_matrix(df: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """One row per model, one column per benchmark."""
    return df.groupBy(row).pivot(column, columns).agg(F.first(value, ignorenulls=True))


def average_scores(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.avg(value), 6).alias("average"), F.count(value).alias("benchmarks"))


def topic_means(df: DataFrame, keys: list[str], topic: str, value: str, topics: dict[str, list[str]]) -> DataFrame:
    """Mean of each named topic list, only where every topic of the list has a score."""
    aggs = []
    for name, members in topics.items():
        here = F.when(F.col(topic).isin(members), F.col(value))
        present = F.size(F.collect_set(F.when(here.isNotNull(), F.col(topic))))
        aggs.append(F.when(present == len(members), F.round(F.avg(here), 6)).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def newest_first(df: DataFrame, ts: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(ts), F.desc(tie))


def group_or_name(group: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(group, F.lit("")), name)


def score_changes(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Each point of a series with the change from the point before; a series may be of any length."""
    out = previous_value(df, order, value, "_before", keys)
    return out.withColumn("change", F.round(F.col(value) - F.col("_before"), 6)).drop("_before")


def metric_with_fallback(metrics: Column) -> tuple[Column, Column]:
    """Accuracy and its error, else the exact-match pair.  A score of 0 is a score."""
    exact = "em_with_normalize_gold&normalize_pred"
    score = F.coalesce(F.try_element_at(metrics, F.lit("acc")), F.try_element_at(metrics, F.lit(exact)))
    error = F.when(F.try_element_at(metrics, F.lit("acc")).isNotNull(), F.try_element_at(metrics, F.lit("acc_stderr"))).otherwise(
        F.try_element_at(metrics, F.lit(exact + "_stderr"))
    )
    return score, error


def simple_details(df: DataFrame, limit: int = 1000) -> DataFrame:
    """Query, output, log-probabilities and verdict of each sample."""
    def shown(c: Column) -> Column:
        return F.coalesce(F.substring(c, 1, limit), F.lit(""))

    acc = F.col("metric.acc").cast("double")
    return df.select(
        shown(F.col("doc.query")).alias("query"),
        shown(F.col("model_response.text_post_processed").cast("string")).alias("text_post_processed"),
        shown(F.to_json("model_response.logprobs")).alias("logprobs"),
        acc.alias("accuracy"),
        F.when(acc.isNull(), "?").when(acc == 1, "✓").otherwise("✗").alias("correct"),
    )


def flat_details(df: DataFrame) -> DataFrame:
    """Every struct field under its dotted path; arrays and maps as JSON."""
    from pyspark.sql import types as T

    def walk(schema: T.StructType, prefix: str):
        for f in schema.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            quoted = ".".join(f"`{p}`" for p in path.split("."))
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, path)
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                yield F.to_json(F.col(quoted)).alias(path)
            else:
                yield F.col(quoted).alias(path)

    return df.select(*walk(df.schema, ""))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null, '' or [] in every row; one aggregation finds them."""
    def filled(name: str) -> Column:
        return F.count(F.when(~F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).isin("", "[]", "{}"), 1))

    counts = df.agg(*[filled(c).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if counts[i]])
