"""Statistics of expert routing over tables of router logits.

Input rows are tokens with an array of logits, one per expert.  Every statistic is
an aggregation by key and expert; the number of experts bounds all per-key lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def with_probabilities(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Add ``probs`` (softmax) and the most likely ``expert`` (the first among equals)."""
    wide = df.withColumn("_l", F.col(logits).cast("array<double>"))
    wide = wide.withColumn("_top", F.array_max("_l"))
    wide = wide.withColumn("_e", F.transform("_l", lambda x: F.exp(x - F.col("_top"))))
    wide = wide.withColumn("_sum", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    return wide.select(
        *df.columns,
        F.transform("_e", lambda x: x / F.col("_sum")).alias("probs"),
        (F.array_position("_l", F.col("_top")) - 1).cast("int").alias("expert"),
    )


def entropy(probs: Column) -> Column:
    return F.aggregate(probs, F.lit(0.0), lambda a, p: a - p * F.ln(p + F.lit(1e-10)))


def expert_usage(routed: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, expert, usage``: share of tokens per expert, unused experts at 0."""
    counts = routed.groupBy(*keys, "expert").agg(F.count(F.lit(1)).alias("_n"))
    sizes = routed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), F.max(F.size("probs")).alias("_experts"))
    grid = sizes.select(*keys, "_all", F.explode(F.sequence(F.lit(0), F.col("_experts") - 1)).alias("expert"))
    joined = grid.join(counts, [*keys, "expert"], "left")
    return joined.select(*keys, "expert", (F.coalesce("_n", F.lit(0)) / F.col("_all")).alias("usage"))


def usage_stats(usage: DataFrame, keys: list[str], top: int = 3) -> DataFrame:
    """Variance, Gini, most and least used expert, active experts and the top list, by key."""
    # As many entries as there are experts.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("usage")).alias("u"), "expert")))
    ascending = F.sort_array(F.collect_list("usage"))
    sums = usage.groupBy(*keys).agg(
        F.var_samp("usage").alias("load_variance"), F.max("usage").alias("max_usage"), ranked.alias("_r"),
        ascending.alias("_a"), F.count_if(F.col("usage") > 0.001).alias("active_experts"), F.count(F.lit(1)).alias("_n"),
        F.sum("usage").alias("_s"),
    )
    # Sum of running sums: the i-th smallest (from 0) is counted n - i times.
    weighted = F.transform("_a", lambda x, i: x * (F.col("_n") - i))
    running = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)
    tops = F.slice("_r", 1, top)
    return sums.select(
        *keys, "load_variance", ((F.col("_n") + 1 - 2 * running / F.col("_s")) / F.col("_n")).alias("gini"),
        F.get("_r", F.lit(0))["expert"].alias("most_used_expert"), "max_usage",
        F.element_at("_r", -1)["expert"].alias("least_used_expert"), "active_experts",
        F.transform(tops, lambda r: r["expert"]).alias("top_experts"), F.transform(tops, lambda r: -r["u"]).alias("top_usage"),
    )


def layer_stats(df: DataFrame, keys: list[str], logits: str = "logits", top: int = 3) -> DataFrame:
    """All routing statistics by key, mean entropy included."""
    routed = with_probabilities(df, logits)
    mean = routed.groupBy(*keys).agg(F.avg(entropy(F.col("probs"))).alias("avg_entropy"))
    return mean.join(usage_stats(expert_usage(routed, keys), keys, top), keys)


def pair_languages(stats: DataFrame, keys: list[str], a: str, b: str, lang: str = "lang") -> DataFrame:
    """The same prompt and layer in two languages: overlap of the top lists, absolute differences."""
    measured = ["avg_entropy", "load_variance", "gini", "top_experts"]
    left = stats.where(F.col(lang) == a).select(*keys, *[F.col(m).alias(f"_a_{m}") for m in measured])
    right = stats.where(F.col(lang) == b).select(*keys, *[F.col(m).alias(f"_b_{m}") for m in measured])
    both = left.join(right, keys)
    shared = F.size(F.array_intersect("_a_top_experts", "_b_top_experts"))
    union = F.size(F.array_union("_a_top_experts", "_b_top_experts"))
    return both.select(
        *keys, (shared / union).alias("expert_overlap"),
        F.abs(F.col("_a_avg_entropy") - F.col("_b_avg_entropy")).alias("entropy_diff"),
        F.abs(F.col("_a_load_variance") - F.col("_b_load_variance")).alias("variance_diff"),
        F.abs(F.col("_a_gini") - F.col("_b_gini")).alias("gini_diff"),
    )


def summarise(df: DataFrame, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """Mean and population deviation of each measure."""
    aggs = []
    for m in measures:
        aggs += [F.round(F.avg(m), 6).alias(f"mean_{m}"), F.round(F.stddev_pop(m), 6).alias(f"std_{m}")]
    return df.groupBy(*(keys or [])).agg(*aggs)


def usage_similarity(usage: DataFrame, keys: list[str], a: str, b: str, lang: str = "lang") -> DataFrame:
    """Cosine of two languages' usage vectors by key."""
    left = usage.where(F.col(lang) == a).select(*keys, "expert", F.col("usage").alias("x"))
    right = usage.where(F.col(lang) == b).select(*keys, "expert", F.col("usage").alias("y"))
    dots = left.join(right, [*keys, "expert"]).groupBy(*keys).agg(
        F.sum(F.col("x") * F.col("y")).alias("xy"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy")
    )
    return dots.select(*keys, F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("similarity"))


def similarity_overview(similarity: DataFrame) -> DataFrame:
    s = F.col("similarity")
    return similarity.agg(
        F.round(F.avg(s), 6).alias("mean"), F.round(F.min(s), 6).alias("min"), F.round(F.max(s), 6).alias("max"),
        F.round(F.stddev_pop(s), 6).alias("std"),
    )


def auxiliary_loss(routed: DataFrame, keys: list[str]) -> DataFrame:
    """Sum over experts of (mean probability - 1/E) squared."""
    means = routed.select(*keys, F.size("probs").alias("_e"), F.posexplode("probs").alias("expert", "p")).groupBy(*keys, "expert").agg(
        F.avg("p").alias("m"), F.max("_e").alias("_e")
    )
    return means.groupBy(*keys).agg(F.sum(F.pow(F.col("m") - 1 / F.col("_e"), 2)).alias("auxiliary_loss"))


def layer_progression(stats: DataFrame, layer: str, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """Measures in layer order with the change from the layer before; a row per layer."""
    w = Window.partitionBy(*(keys or [])).orderBy(layer)
    return stats.withColumns({f"{m}_change": F.round(F.col(m) - F.lag(m).over(w), 6) for m in measures})
