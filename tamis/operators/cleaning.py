"""Table-level cleaning: rule sets, statistics, change logs and examples."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.functions.cleaning import insert_at
from tamis.functions.hashing import stable_rank_key
from tamis.functions.rules import Rule, rewrite_column
from tamis.functions.text import edit_distance_ratio, strip, word_count, words
from tamis.session import cut_lineage

Step = Callable[[DataFrame], DataFrame]


def compose(steps: Iterable[Step]) -> Step:
    """Several cleaning steps as one."""
    steps = list(steps)
    return lambda df: reduce(lambda acc, step: acc.transform(step), steps, df)


def clean_text(df: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """Apply a rule set, strip, and recount ``n_words``."""
    out = rewrite_column(df, text_col, rules)
    out = out.withColumn(text_col, strip(F.col(text_col)))
    return out.withColumn("n_words", word_count(F.col(text_col)))


def cleaner(rules: Sequence[Rule], text_col: str = "text") -> Step:
    return lambda df: clean_text(df, rules, text_col)


def rule_effects(df: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """Keep the text before and after each rule as columns ``_t0 .. _tn``.

    One projection per rule: each text is computed once, from the one before it.
    """
    out = df.withColumn("_t0", F.col(text_col))
    for i, rule in enumerate(rules):
        out = out.withColumn(f"_t{i + 1}", rule(F.col(f"_t{i}")))
    return out


def substitution_counts(df: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """One row per rule: rows it changed and places it matched, each on the text it saw.

    All rules are counted in one pass with one row of partial sums per task.
    """
    staged = rule_effects(df, rules, text_col)
    sums = []
    for i, rule in enumerate(rules):
        seen, made = F.col(f"_t{i}"), F.col(f"_t{i + 1}")
        sums.append(F.sum((seen != made).cast("long")).alias(f"r{i}"))
        sums.append(F.sum(rule.hits(seen)).alias(f"h{i}"))
    entries = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("rows_changed"), F.col(f"h{i}").alias("substitutions"))
            for i, r in enumerate(rules)
        ]
    )
    return staged.agg(*sums).select(F.inline(entries))


def cleaning_stats(before: Column, after: Column) -> list[Column]:
    """Aggregates over one table: rows, rows modified, characters removed and added."""
    delta = F.sum(F.length(before)) - F.sum(F.length(after))
    return [
        F.count(F.lit(1)).alias("rows_processed"),
        F.sum((before != after).cast("long")).alias("rows_modified"),
        F.greatest(F.lit(0), delta).cast("long").alias("characters_removed"),
        F.greatest(F.lit(0), -delta).cast("long").alias("characters_added"),
    ]


def word_changes(df: DataFrame, before: str, after: str, label: str) -> DataFrame:
    """Positional word differences between two texts, missing words as ''."""
    pairs = F.arrays_zip(words(F.col(before)).alias("b"), words(F.col(after)).alias("a"))
    keep = [c for c in df.columns if c not in (before, after)]
    return (
        df.where(F.col(before) != F.col(after))
        .select(*keep, F.posexplode(pairs).alias("position", "pair"))
        .select(
            *keep,
            F.col("position").cast("long").alias("position"),
            F.coalesce(F.col("pair.b"), F.lit("")).alias("before"),
            F.coalesce(F.col("pair.a"), F.lit("")).alias("after"),
            F.lit(label).alias("rule"),
        )
        .where(F.col("before") != F.col("after"))
    )


def rule_examples(df: DataFrame, rules: Sequence[Rule], id_col: str, cap: int, text_col: str = "text", seed: int = 42) -> DataFrame:
    """Up to ``cap`` before/after texts per rule, chosen by a stable hash of the id.

    The choice moves ids only: at most ``cap`` of a rule leave a task.  The rules then run again on the
    rows of the chosen ids, at most ``cap`` for each rule, and those are ranked with their texts.
    """
    staged = rule_effects(df, rules, text_col)
    fired = [F.when(F.col(f"_t{i}") != F.col(f"_t{i + 1}"), F.lit(r.name)) for i, r in enumerate(rules)]
    order = Window.partitionBy("rule").orderBy(stable_rank_key(seed, id_col), id_col)

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= cap).drop("_n")

    chosen = first(staged.select(id_col, F.explode(F.array_compact(F.array(*fired))).alias("rule")))
    # Written down, so that its few rows are counted and broadcast whatever the plan expects.
    ids = cut_lineage(chosen.select(F.col(id_col).alias("_chosen")).distinct())
    staged = rule_effects(df.join(F.broadcast(ids), F.col(id_col).eqNullSafe(F.col("_chosen")), "left_semi"), rules, text_col)
    hits = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"_t{i}").alias("before"), F.col(f"_t{i + 1}").alias("after"))
            for i, r in enumerate(rules)
        ]
    )
    changed = F.filter(hits, lambda h: h["before"] != h["after"])
    return first(staged.select(id_col, F.inline(changed)))


def unique_lines(c: Column) -> Column:
    """Stripped non-blank lines, first occurrence of each, in order."""
    kept = F.filter(F.transform(F.split(c, r"\r?\n", -1), strip), lambda x: x != "")
    return F.array_join(F.array_distinct(kept), "\n")


def apply_insertions(df: DataFrame, predictions: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Apply predicted character insertions (``id, char_index, char, should_ignore``).

    The predictions of one text are gathered into one array; it is bounded by the
    length of that text.
    """
    gathered = predictions.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("char_index", "char", "should_ignore"))).alias("_insertions")
    )
    joined = df.join(gathered, id_col, "left")
    fixed = F.when(F.col("_insertions").isNull(), F.col(text_col)).otherwise(insert_at(F.col(text_col), F.col("_insertions")))
    return joined.withColumn(text_col, fixed).drop("_insertions")


def accepted_insertions(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Insertions a per-character labelling supports: label and score, between two Hebrew letters.

    Input: ``id, text, char_index, label, score`` with one row per labelled character.
    """
    at, before = (F.substring(F.col("text"), F.col("char_index") + d, F.lit(1)) for d in (1, 0))
    hebrew = r"^[֐-׿]$"
    ok = (F.col("label") == "LABEL_1") & (F.col("score") > threshold) & (F.col("char_index") > 0)
    return df.where(ok & at.rlike(hebrew) & before.rlike(hebrew))


def spacing_stats(before: Column, after: Column) -> dict[str, Column]:
    def blanks(c: Column) -> Column:
        return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")

    return {
        "spaces_before": blanks(before),
        "spaces_after": blanks(after),
        "spaces_added": blanks(after) - blanks(before),
        "words_before": word_count(before),
        "words_after": word_count(after),
        "word_change": word_count(after) - word_count(before),
        "has_changes": before != after,
    }


def chunk_text(df: DataFrame, max_length: int = 2046, text_col: str = "text") -> DataFrame:
    """Cut texts into chunks of at most ``max_length`` characters, one row each.

    A chunk ends at the best break that fits: paragraph, line, sentence, blank, full
    stop, and failing all of them at the limit.  Chunks join back to the whole text.
    """
    # Greedy left to right: each alternative takes the longest stretch ending in its break.
    n = max_length
    breaks = [rf"(?s).{{1,{n - 2}}}\n\n", rf"(?s).{{1,{n - 1}}}\n", rf"(?s).{{1,{n - 2}}}\. ", rf"(?s).{{1,{n - 1}}} ", rf"(?s).{{1,{n - 1}}}\."]
    whole = rf"(?s).{{1,{n}}}\z"
    pattern = "|".join([whole, *breaks, rf"(?s).{{1,{n}}}"])
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    keep = [c for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(pieces).alias("chunk_id", "chunk"))


def cleaning_benchmark(df: DataFrame, original: str, manual: str, steps: dict[str, str]) -> DataFrame:
    """Mean edit distance of the original and of each cumulative cleaning step to the manual text."""
    def mean(col: str) -> Column:
        return F.round(F.avg(edit_distance_ratio(F.col(col), F.col(manual))), 3)

    cols = {"original": original, **steps}
    sums = df.agg(*[mean(c).alias(f"d_{i}") for i, c in enumerate(cols.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("step"), F.col(f"d_{i}").alias("distance")) for i, name in enumerate(cols)])
    return sums.select(F.inline(rows))
