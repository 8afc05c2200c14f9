"""Router statistics; embeddings stand for logits (label = layer, vec_id = token)."""

from pyspark.sql import functions as F

from tamis.operators import router as r
from tamis.plans.registry import query
from tamis.session import spread

KEYS = ["layer"]
LANG = "CASE WHEN vec_id % 2 = 0 THEN 'en' ELSE 'he' END"
PROMPT = "vec_id // 10 % 5"


def tokens(t):
    return spread(t.embeddings, "vec_id").select(
        F.col("vec_id").alias("token"), F.col("label").alias("layer"), F.expr(LANG).alias("lang"),
        (F.floor(F.col("vec_id") / 10) % 5).alias("prompt"), F.expr("CASE WHEN vec_id % 3 = 0 THEN 'long' ELSE 'short' END").alias("category"),
        F.col("embedding").alias("logits"),
    )


def routed(t):
    return r.with_probabilities(tokens(t))


def sql(keys: str) -> str:
    """CTEs tok, prob (token, expert, p), ent, usage (keys, expert, usage) for the given key columns."""
    return f"""tok AS (SELECT vec_id AS token, label AS layer, {LANG} AS lang, {PROMPT} AS prompt, CASE WHEN vec_id % 3 = 0 THEN 'long' ELSE 'short' END AS category, embedding::DOUBLE[] AS l FROM embeddings),
x AS (SELECT * EXCLUDE (l), generate_subscripts(l, 1) - 1 AS expert, unnest(l) AS v FROM tok),
prob AS (SELECT *, exp(v - max(v) OVER (PARTITION BY token)) / sum(exp(v)) OVER (PARTITION BY token) * exp(max(v) OVER (PARTITION BY token)) AS p FROM x),
ent AS (SELECT token, layer, lang, prompt, category, -sum(p * ln(p + 1e-10)) AS h FROM prob GROUP BY ALL),
top1 AS (SELECT * FROM prob QUALIFY row_number() OVER (PARTITION BY token ORDER BY v DESC, expert) = 1),
k AS (SELECT {keys}, count(*) AS n FROM tok GROUP BY ALL),
grid AS (SELECT {keys}, n, unnest(range(64)) AS expert FROM k),
usage AS (SELECT {keys}, expert, coalesce(c, 0) / n AS usage FROM grid LEFT JOIN (SELECT {keys}, expert, count(*) AS c FROM top1 GROUP BY ALL) USING ({keys}, expert)),
ord AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY usage) AS i, row_number() OVER (PARTITION BY {keys} ORDER BY usage DESC, expert) AS d FROM usage),
stats AS (SELECT {keys}, var_samp(usage) AS load_variance, (65 - 2 * sum(usage * (65 - i)) / sum(usage)) / 64 AS gini, max(expert) FILTER (d = 1) AS most_used_expert, max(usage) AS max_usage,
  max(expert) FILTER (d = 64) AS least_used_expert, count(*) FILTER (usage > 0.001) AS active_experts, string_agg(expert::VARCHAR, ',' ORDER BY d) FILTER (d <= 3) AS top_experts FROM ord GROUP BY {keys}),
mean_ent AS (SELECT {keys}, avg(h) AS avg_entropy FROM ent GROUP BY {keys}), full_stats AS (SELECT * FROM stats JOIN mean_ent USING ({keys}))"""


@query("rtr01_expert_usage", f"WITH {sql('layer')} SELECT layer, expert, round(usage, 6) AS usage FROM usage")
def expert_usage(t):
    return r.expert_usage(routed(t), KEYS).withColumn("usage", F.round("usage", 6))


@query("rtr02_mean_entropy", f"WITH {sql('layer')} SELECT layer, round(avg(h), 6) AS avg_entropy FROM ent GROUP BY layer")
def mean_entropy(t):
    return routed(t).groupBy("layer").agg(F.round(F.avg(r.entropy(F.col("probs"))), 6).alias("avg_entropy"))


STATS = "round(load_variance, 9) AS load_variance, round(gini, 6) AS gini, most_used_expert, round(max_usage, 6) AS max_usage, least_used_expert, active_experts, top_experts"


@query("rtr03_04_05_usage_stats", f"WITH {sql('layer')} SELECT layer, {STATS} FROM stats")
def usage_stats(t):
    s = r.usage_stats(r.expert_usage(routed(t), KEYS), KEYS)
    return s.select(
        "layer", F.round("load_variance", 9).alias("load_variance"), F.round("gini", 6).alias("gini"), "most_used_expert",
        F.round("max_usage", 6).alias("max_usage"), "least_used_expert", "active_experts", F.array_join("top_experts", ",").alias("top_experts"),
    )


@query("rtr06_usage_similarity", f"""
WITH {sql('layer, lang')}, s AS (SELECT a.layer, sum(a.usage * b.usage) / sqrt(sum(a.usage * a.usage) * sum(b.usage * b.usage)) AS s FROM usage a JOIN usage b ON a.layer = b.layer AND a.expert = b.expert WHERE a.lang = 'en' AND b.lang = 'he' GROUP BY 1)
SELECT round(avg(s), 6) AS mean, round(min(s), 6) AS min, round(max(s), 6) AS max, round(stddev_pop(s), 6) AS std FROM s""")
def usage_similarity(t):
    usage = r.expert_usage(routed(t), ["layer", "lang"])
    return r.similarity_overview(r.usage_similarity(usage, KEYS, "en", "he"))


PAIR = """p AS (SELECT a.layer, a.prompt, len(list_intersect(string_split(a.top_experts, ','), string_split(b.top_experts, ','))) / len(list_distinct(list_concat(string_split(a.top_experts, ','), string_split(b.top_experts, ',')))) AS expert_overlap,
  abs(a.avg_entropy - b.avg_entropy) AS entropy_diff, abs(a.load_variance - b.load_variance) AS variance_diff, abs(a.gini - b.gini) AS gini_diff
  FROM full_stats a JOIN full_stats b ON a.layer = b.layer AND a.prompt = b.prompt WHERE a.lang = 'en' AND b.lang = 'he')"""
MEASURES = ["expert_overlap", "entropy_diff", "variance_diff", "gini_diff"]


def pairs(t):
    return r.pair_languages(r.layer_stats(tokens(t), ["layer", "prompt", "lang"]), ["layer", "prompt"], "en", "he")


@query("jon09_language_pairs", f"WITH {sql('layer, prompt, lang')}, {PAIR} SELECT layer, prompt, {', '.join(f'round({m}, 6) AS {m}' for m in MEASURES)} FROM p")
def language_pairs(t):
    return pairs(t).withColumns({m: F.round(m, 6) for m in MEASURES})


@query("rtr07_pair_summary", f"WITH {sql('layer, prompt, lang')}, {PAIR} SELECT {', '.join(f'round(avg({m}), 6) AS mean_{m}, round(stddev_pop({m}), 6) AS std_{m}' for m in MEASURES)} FROM p")
def pair_summary(t):
    return r.summarise(pairs(t), MEASURES)


@query("rtr08_auxiliary_loss", f"WITH {sql('layer')}, m AS (SELECT layer, expert, avg(p) AS m FROM prob GROUP BY ALL) SELECT layer, round(sum((m - 1 / 64) * (m - 1 / 64)), 9) AS auxiliary_loss FROM m GROUP BY layer")
def auxiliary_loss(t):
    return r.auxiliary_loss(routed(t), KEYS).withColumn("auxiliary_loss", F.round("auxiliary_loss", 9))


@query("rtr09_by_language_and_category", f"""
WITH {sql('layer, lang, category')} SELECT lang, category, round(avg(avg_entropy), 6) AS mean_avg_entropy, round(stddev_pop(avg_entropy), 6) AS std_avg_entropy,
  round(avg(load_variance), 6) AS mean_load_variance, round(stddev_pop(load_variance), 6) AS std_load_variance FROM full_stats GROUP BY lang, category""")
def by_language_and_category(t):
    stats = r.layer_stats(tokens(t), ["layer", "lang", "category"])
    return r.summarise(stats, ["avg_entropy", "load_variance"], ["lang", "category"])


@query("win08_layer_progression", f"""
WITH {sql('layer')} SELECT layer, round(avg_entropy, 6) AS avg_entropy, round(avg_entropy - lag(avg_entropy) OVER (ORDER BY layer), 6) AS avg_entropy_change FROM full_stats""")
def layer_progression(t):
    stats = r.layer_stats(tokens(t), KEYS).select("layer", "avg_entropy")
    return r.layer_progression(stats, "layer", ["avg_entropy"]).withColumn("avg_entropy", F.round("avg_entropy", 6))
