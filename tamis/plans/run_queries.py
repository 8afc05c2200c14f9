"""Score-table queries: events stand for scores (user = model, type = benchmark, value = score)."""

from pyspark.sql import functions as F

from tamis.operators import runs as r
from tamis.plans.registry import query

BENCHES = ["click", "error", "purchase", "signup", "view"]
MODEL = "CASE WHEN user_id % 3 = 0 THEN concat('/models/base', user_id) ELSE concat('/models/run', user_id % 10, '/step-', user_id * 100) END"
NAME = f"replace({MODEL}, '/models/', '')"


def runs(t):
    return t.events.select(
        "event_id", "ts", F.expr(NAME).alias("model_name"), r.training_step(F.expr(NAME)).alias("steps"),
        F.col("event_type").alias("bench"), "value", F.expr("CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END").alias("samples_number"),
    )


R = f"""r AS (SELECT event_id, ts, {NAME} AS model_name, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id * 100 END AS steps, event_type AS bench, value,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS samples_number FROM events)"""


@query("fun18_model_names", f"""
SELECT event_id, {NAME} AS model_name, CASE WHEN user_id % 3 = 0 THEN '' ELSE concat('run', user_id % 10) END AS model_group, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id * 100 END AS steps FROM events""")
def model_names(t):
    named = t.events.select("event_id", r.clean_model_name(F.expr(MODEL), ["/models/"]).alias("model_name"))
    return named.select("event_id", "model_name", r.model_group(F.col("model_name")).alias("model_group"), r.training_step(F.col("model_name")).alias("steps"))


@query("fun18_url_parts", "SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages")
def url_parts(t):
    return t.pages.select("page_id", r.model_group(r.clean_model_name(F.col("url"), ["http://", "https://"])).alias("host"))


@query("fun17_timestamps", """
SELECT event_id, CASE WHEN event_id % 10 = 3 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text,
  CASE WHEN event_id % 10 = 3 THEN NULL ELSE concat('m', user_id, ' - ', strftime(ts, '%Y-%m-%d %H:%M')) END AS run_id FROM events""")
def timestamps(t):
    folder = F.when(F.col("event_id") % 10 == 3, "latest-run").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH-mm-ss"))
    parsed = t.events.select("event_id", "user_id", r.parse_timestamp(folder).alias("p"))
    return parsed.select("event_id", F.date_format("p", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
                         r.run_id(F.concat(F.lit("m"), F.col("user_id").cast("string")), F.col("p")).alias("run_id"))


@query("flt22_complete_runs", f"WITH {R} SELECT event_id FROM r WHERE samples_number IS NULL OR samples_number > 1000")
def complete_runs(t):
    return r.complete_runs(runs(t)).select("event_id")


@query("dup10_named_runs", f"WITH {R} SELECT DISTINCT CASE WHEN model_name LIKE 'base%' THEN NULL ELSE model_name END AS model_name, bench FROM r WHERE model_name NOT LIKE 'base%'")
def named_runs(t):
    name = F.when(F.col("model_name").startswith("base"), F.lit(None)).otherwise(F.col("model_name"))
    return r.named_runs(runs(t).select(name.alias("model_name"), "bench"))


@query("win02_latest_per_model", f"WITH {R} SELECT event_id, model_name, value FROM r QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_model(t):
    return r.latest_per_model(runs(t), ["model_name"], tie="event_id").select("event_id", "model_name", "value")


@query("win03_last_per_step", f"""
WITH {R}, s AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS score FROM r)
SELECT bench, coalesce(steps, 0) AS step, arg_max(score, ts) FILTER (score IS NOT NULL) AS score, arg_max(samples_number, ts) FILTER (samples_number IS NOT NULL) AS samples_number FROM s GROUP BY ALL""")
def last_per_step(t):
    scored = r.checkpoint_series(runs(t)).withColumn("score", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return r.last_per_step(scored, ["bench", "step"], "ts", ["score", "samples_number"])


@query("win03_base_models", f"WITH {R} SELECT event_id, 0 AS step FROM r WHERE steps IS NULL")
def base_models(t):
    return r.checkpoint_series(runs(t), include_checkpoints=False).select("event_id", "step")


@query("agg17_average_scores", f"WITH {R} SELECT model_name, round(avg(CASE WHEN event_id % 7 <> 0 THEN value END), 6) AS average, count(CASE WHEN event_id % 7 <> 0 THEN value END) AS benchmarks FROM r GROUP BY 1")
def average_scores(t):
    scored = runs(t).withColumn("score", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return r.average_scores(scored, ["model_name"], "score")


@query("agg17_score_pivot", f"""
WITH {R}, l AS (SELECT model_name, bench, arg_max(value, ts) AS v FROM r GROUP BY ALL)
SELECT model_name, {', '.join(f"max(v) FILTER (bench = '{b}') AS {b}" for b in BENCHES)} FROM l GROUP BY model_name""")
def score_pivot(t):
    latest = r.latest_per_model(runs(t), ["model_name", "bench"], tie="event_id")
    return r.score_matrix(latest, "model_name", "bench", "value", BENCHES)


@query("agg19_latest_matrix", f"""
WITH {R}, l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY bench, model_name ORDER BY ts DESC, event_id DESC) = 1)
SELECT bench, {', '.join(f"max(value) FILTER (model_name = '{m}') AS {m}" for m in ('base3', 'base6', 'base9'))} FROM l GROUP BY bench""")
def latest_matrix(t):
    latest = r.latest_per_model(runs(t), ["bench", "model_name"], tie="event_id")
    return r.score_matrix(latest, "bench", "model_name", "value", ["base3", "base6", "base9"])


@query("agg19_latest_scores", f"""
WITH {R} SELECT bench, model_name, value FROM r QUALIFY row_number() OVER (PARTITION BY bench, model_name ORDER BY ts DESC, event_id DESC) = 1""")
def latest_scores(t):
    """The whole latest matrix, every model of the table, in long form."""
    return r.latest_per_model(runs(t), ["bench", "model_name"], tie="event_id").select("bench", "model_name", "value")


@query("agg18_topic_means", f"""
WITH {R} SELECT model_name, CASE WHEN count(DISTINCT bench) FILTER (bench IN ('click', 'view', 'error') AND value > 60) = 3 THEN round(avg(value) FILTER (bench IN ('click', 'view', 'error') AND value > 60), 6) END AS hebrew,
  CASE WHEN count(DISTINCT bench) FILTER (bench IN ('purchase', 'signup') AND value > 60) = 2 THEN round(avg(value) FILTER (bench IN ('purchase', 'signup') AND value > 60), 6) END AS english FROM r GROUP BY model_name""")
def topic_means(t):
    scored = runs(t).withColumn("score", F.when(F.col("value") > 60, F.col("value")))
    return r.topic_means(scored, ["model_name"], "bench", "score", {"hebrew": ["click", "view", "error"], "english": ["purchase", "signup"]})


@query("win08_score_changes", f"""
WITH {R} SELECT event_id, round(value - lag(value) OVER (PARTITION BY model_name, bench ORDER BY event_id), 6) AS change FROM r""")
def score_changes(t):
    return r.score_changes(runs(t), ["model_name", "bench"], "event_id", "value").select("event_id", "change")


@query("srt02_newest_first", f"WITH {R} SELECT event_id FROM r ORDER BY ts DESC, event_id DESC")
def newest_first(t):
    return r.newest_first(runs(t).select("event_id", "ts"), "ts", "event_id").select("event_id")


@query("set03_group_or_name", f"WITH {R} SELECT DISTINCT CASE WHEN model_name LIKE '%/%' THEN split_part(model_name, '/', 1) ELSE model_name END AS run FROM r")
def group_or_name(t):
    return runs(t).select(r.group_or_name(r.model_group(F.col("model_name")), F.col("model_name")).alias("run")).distinct()


@query("jon06_merge_columns", """
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END, c_nationkey) AS good FROM customer""")
def merge_columns(t):
    wide = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("good"), F.col("c_nationkey").cast("double").alias("bad"))
    return r.merge_columns(wide, "bad", "good")


@query("fun19_metric_fallback", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.0 WHEN event_id % 3 = 1 THEN value END AS score, CASE WHEN event_id % 3 = 0 THEN 0.5 WHEN event_id % 3 = 1 THEN value / 10 END AS error FROM events""")
def metric_fallback(t):
    exact = "em_with_normalize_gold&normalize_pred"
    metrics = (
        F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("acc"), F.lit(0.0), F.lit("acc_stderr"), F.lit(0.5), F.lit(exact), F.lit(9.0)))
        .when(F.col("event_id") % 3 == 1, F.create_map(F.lit(exact), F.col("value"), F.lit(exact + "_stderr"), F.col("value") / 10))
        .otherwise(F.create_map(F.lit("other"), F.col("value")))
    )
    score, error = r.metric_with_fallback(F.col("m"))
    return t.events.select("event_id", metrics.alias("m")).select("event_id", score.alias("score"), error.alias("error"))


def details(t):
    return t.conversations.select(
        F.struct(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("query"), F.lit("").alias("unused")).alias("doc"),
        F.struct(F.upper("role").alias("text_post_processed"), F.array(F.col("turn"), F.col("conv_id")).alias("logprobs")).alias("model_response"),
        F.struct(F.when(F.col("turn") < 3, (F.col("turn") % 2).cast("double")).alias("acc")).alias("metric"),
    )


@query("fun16_simple_details", """
SELECT substring(text, 1, 1000) AS query, upper(role) AS text_post_processed, concat('[', turn, ',', conv_id, ']') AS logprobs, CASE WHEN turn < 3 THEN (turn % 2)::DOUBLE END AS accuracy,
  CASE WHEN turn >= 3 THEN '?' WHEN turn % 2 = 1 THEN '✓' ELSE '✗' END AS correct FROM conversations""")
def simple_details(t):
    return r.simple_details(details(t))


@query("fun16_flat_details", """
SELECT concat_ws('-', conv_id, turn) AS "doc.id", text AS "doc.query", upper(role) AS "model_response.text_post_processed", concat('[', turn, ',', conv_id, ']') AS "model_response.logprobs",
  CASE WHEN turn < 3 THEN (turn % 2)::DOUBLE END AS "metric.acc" FROM conversations""")
def flat_details(t):
    return r.drop_empty_columns(r.flat_details(details(t)))


@query("fun12_json_fields", "SELECT event_id, (props->>'k')::BIGINT AS k, coalesce(props->>'missing', '') AS missing FROM events")
def json_fields(t):
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("")).alias("missing"))
