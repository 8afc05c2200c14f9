"""Benchmark items: matching, rendering, few-shot contexts, accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.functions.prompts import CAUSE_EFFECT_LABELS, HEBREW_LABELS, literal_map
from tamis.operators.rows import row_numbers


def match_by_prompt(gold: DataFrame, original: DataFrame, prompt_col: str) -> DataFrame:
    """Gold rows with the fields of the one original item whose rendered prompt is the same.

    Prompts that several originals share match none of them, so a gold row never multiplies; they are
    what ``match_report`` lists.  Joined on a digest of the prompt, checked on the prompt itself; order
    plays no part.  Originals of one prompt meet as a count per task.
    """
    left = gold.withColumn("_k", F.md5(prompt_col))
    fields = F.struct(*[F.col(c).alias("_prompt" if c == prompt_col else c) for c in original.columns])
    single = original.groupBy(F.md5(prompt_col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.first(fields).alias("_o")).where("_n = 1")
    return left.join(single.select("_k", "_o.*"), "_k").where(F.col(prompt_col) == F.col("_prompt")).drop("_k", "_prompt")


def match_report(gold: DataFrame, original: DataFrame, prompt_col: str, id_col: str) -> DataFrame:
    """Gold rows whose prompt has no original item, or several."""
    counts = original.groupBy(prompt_col).agg(F.count(F.lit(1)).alias("_n"))
    found = F.coalesce(F.col("_n"), F.lit(0)).alias("matches")
    return gold.join(counts, prompt_col, "left").select(id_col, found).where("matches <> 1")


def flatten_choices(question: Column, texts: Column) -> list[Column]:
    """``question, option 1 .. option 4`` of a nested item."""
    return [question.alias("question"), *[F.get(texts, F.lit(i)).alias(f"option {i + 1}") for i in range(4)]]


def flatten_endings(endings: Column) -> list[Column]:
    return [F.get(endings, F.lit(i)).alias(f"ending {i + 1}") for i in range(4)]


def rebuild_choices(labels: Column, answer: Column) -> list[Column]:
    """Nested item from ``option 1 .. 4`` with labels and answer key in Hebrew letters."""
    hebrew = literal_map(HEBREW_LABELS)
    texts = F.array(*[F.col(f"option {i}") for i in range(1, 5)])
    return [
        F.struct(texts.alias("text"), F.transform(labels, lambda x: F.try_element_at(hebrew, x)).alias("label")).alias("choices"),
        F.try_element_at(hebrew, answer).alias("answerKey"),
    ]


def rebuild_relation(relation: Column) -> Column:
    return F.try_element_at(literal_map(CAUSE_EFFECT_LABELS), relation)


def letter_of_index(index: Column) -> Column:
    """0..3 -> A..D; letters pass."""
    return F.when(index.cast("string").rlike("^[0-3]$"), F.char(index.cast("int") + 65)).otherwise(index.cast("string"))


def exactly_four(df: DataFrame, choices: str = "choices") -> DataFrame:
    return df.where(F.size(choices) == 4)


def few_shot_context(train: DataFrame, task: str, order: str, text: str, k: int) -> DataFrame:
    """``task, context``: the first k training items of each task, joined by blank lines.

    At most k rows of a task leave each task's partition, so the gathered list is short.
    """
    w = Window.partitionBy(task).orderBy(order)
    first = train.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)
    shots = F.array_sort(F.collect_list(F.struct("_n", F.col(text).alias("t"))))
    return first.groupBy(task).agg(F.array_join(F.transform(shots, lambda s: s["t"]), "\n\n").alias("context"))


def with_few_shots(items: DataFrame, context: DataFrame, task: str, text: str) -> DataFrame:
    """Prefix every item with its task's context; one context row per task."""
    joined = items.join(context, task, "left")
    full = F.when(F.col("context").isNull(), F.col(text)).otherwise(F.concat_ws("\n\n", "context", text))
    return joined.withColumn("prompt", full).drop("context")


def add_model_column(outputs: DataFrame, new: DataFrame, key: str, model: str, text: str) -> DataFrame:
    """Long form of model outputs: ``key, model, text`` rows appended to earlier ones."""
    return outputs.unionByName(new.select(key, F.lit(model).alias("model"), F.col(text).alias("text")))


def outputs_side_by_side(outputs: DataFrame, key: str, models: list[str]) -> DataFrame:
    return outputs.groupBy(key).pivot("model", models).agg(F.first("text"))


def match_by_position(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of two tables side by side by their position in key order."""
    a = row_numbers(left, left_key, "position")
    b = row_numbers(right, right_key, "position")
    return a.join(b, "position", "full_outer")


def exact_match(prediction: Column, golds: Column) -> Column:
    """1 where the prediction equals any of the golds."""
    return F.array_contains(golds, prediction).cast("long")


def loglikelihood_hit(logprobs: Column, gold: Column) -> Column:
    """1 where the most likely choice is the gold one."""
    return (F.array_position(logprobs, F.array_max(logprobs)) - 1 == gold).cast("long")


def accuracy(df: DataFrame, hit: str, keys: list[str]) -> DataFrame:
    """Mean and standard error per task."""
    n = F.count(hit)
    return df.groupBy(*keys).agg(
        n.alias("n"), F.round(F.avg(hit), 6).alias("acc"), F.round(F.try_divide(F.stddev_samp(hit), F.sqrt(n)), 6).alias("acc_stderr")
    )
