"""Annotation queries, on annotation rows derived from the events table."""

from pyspark.sql import functions as F

from tamis.operators import labels as lb
from tamis.plans.registry import query

CATEGORY_CASES = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(lb.CATEGORIES[:9]))


def _severity(i: int) -> str:
    return f"CASE (event_id * {i} + user_id) % 7 WHEN 0 THEN 'minor' WHEN 1 THEN 'major' WHEN 2 THEN 'critical' ELSE '' END"


def _category(i: int) -> str:
    return f"CASE WHEN (event_id * {i} + user_id) % 7 < 3 THEN CASE (event_id + {i % 4}) % 9 {CATEGORY_CASES} END ELSE '' END"


ANNOTATION = [
    "event_id AS item_id", "event_type AS bench", "concat('q', event_id) AS text_column",
    "concat('Option 1:', chr(10), 'a', event_id, chr(10), chr(10), 'Option 2:', chr(10), 'b', event_id) AS new_text_column",
    "CASE WHEN event_id % 5 = 0 THEN 'BOTH' WHEN event_id % 11 = 0 THEN 'SKIP' WHEN event_id % 13 = 0 THEN '' WHEN event_id % 2 = 0 THEN '1.0' ELSE '2' END AS rating",
    "CASE WHEN event_id % 3 = 0 THEN concat('Option 1:', chr(10), 'fixed ', event_id) WHEN event_id % 17 = 0 THEN NULL ELSE '' END AS gold",
    "CASE WHEN user_id % 2 = 0 THEN 'gemini' ELSE 'claude' END AS model_1", "CASE WHEN user_id % 2 = 0 THEN 'claude' ELSE 'gemini' END AS model_2",
    *[f"{_category(i)} AS category_annotation_{i}" for i in range(1, 7)], *[f"{_severity(i)} AS severity_annotation_{i}" for i in range(1, 7)],
]
A = f"a AS (SELECT {', '.join(ANNOTATION)} FROM events)"


def annotations(t):
    return t.events.selectExpr(*ANNOTATION)


CLEAN = f"""{A}, c AS (SELECT * REPLACE (regexp_replace(rating, '^([12])\\.0$', '\\1') AS rating, CASE WHEN coalesce(gold, '') = '' THEN new_text_column ELSE gold END AS gold),
  coalesce(gold, '') AS given_gold FROM a WHERE rating <> 'SKIP')"""


@query("fun10_clean_labels", f"WITH {CLEAN} SELECT item_id, rating, gold FROM c")
def clean_labels(t):
    return lb.clean_labels(annotations(t)).select("item_id", "rating", "gold")


@query("flt23_rated", f"WITH {A} SELECT item_id FROM a WHERE rating NOT IN ('', 'SKIP')")
def rated(t):
    return lb.rated(annotations(t)).select("item_id")


@query("fun11_split_options", f"WITH {A} SELECT item_id, concat('a', item_id) AS option_1, concat('b', item_id) AS option_2 FROM a")
def split_options(t):
    one, two = lb.split_options(F.col("new_text_column"))
    return annotations(t).select("item_id", one.alias("option_1"), two.alias("option_2"))


def won(t):
    rows = annotations(t).na.fill("").withColumn("rating", F.regexp_replace("rating", r"^([12])\.0$", "$1"))
    one, two = lb.split_options(F.col("new_text_column"))
    return rows.withColumns({"option_1": one, "option_2": two, "rating_model": lb.winning_model(F.col("rating"))})


W = f"{A}, w AS (SELECT *, CASE rating WHEN '1.0' THEN model_1 WHEN '2' THEN model_2 ELSE rating END AS rating_model, coalesce(gold, '') AS g FROM a)"


@query("jon03_winning_model", f"WITH {W} SELECT item_id, rating_model FROM w")
def winning_model(t):
    return won(t).select("item_id", "rating_model")


@query("fun09_gold_text", f"""
WITH {W} SELECT item_id, CASE WHEN rating_model = 'SKIP' THEN NULL WHEN g <> '' THEN replace(g, concat('Option 1:', chr(10)), '')
  WHEN rating_model = 'BOTH' THEN CASE WHEN model_1 = 'gemini' THEN concat('a', item_id) ELSE concat('b', item_id) END
  WHEN rating_model = model_1 THEN concat('a', item_id) WHEN rating_model = model_2 THEN concat('b', item_id) END AS gold FROM w""")
def gold_text(t):
    return won(t).select("item_id", lb.gold_text().alias("gold"))


@query("agg20_preference_counts", f"""
WITH {W} SELECT rating_model, count(*) FILTER (g = '') AS already_gold, count(*) FILTER (g <> '') AS was_fixed, count(*) AS total,
  round(count(*) FILTER (g = '') * 100.0::DOUBLE / count(*), 6) AS already_gold_percent, round(count(*) FILTER (g <> '') * 100.0::DOUBLE / count(*), 6) AS was_fixed_percent
FROM w WHERE rating_model <> 'SKIP' GROUP BY 1""")
def preference_counts(t):
    return lb.preference_counts(won(t))


LONG = f"{A}, l AS (" + " UNION ALL ".join(
    f"SELECT item_id, model_{1 if i <= 3 else 2} AS model, {i} AS slot, category_annotation_{i} AS category, severity_annotation_{i} AS severity FROM a" for i in range(1, 7)
) + "), s AS (SELECT item_id, model, sum(CASE severity WHEN 'minor' THEN 1 WHEN 'major' THEN 5 WHEN 'critical' THEN 25 ELSE 0 END)::BIGINT AS score FROM l GROUP BY ALL)"


def scores(t):
    return lb.mqm_scores(lb.mqm_long(annotations(t), "item_id"), "item_id")


@query("agg21_mqm_scores", f"WITH {LONG} SELECT * FROM s")
def mqm_scores(t):
    return scores(t)


@query("agg21_mqm_means", f"WITH {LONG} SELECT model, count(*) AS items, round(avg(score), 6) AS mean_score FROM s GROUP BY model")
def mqm_means(t):
    return lb.mqm_means(scores(t))


@query("agg23_score_correlation", f"""
WITH {LONG} SELECT round(corr(x.score, y.score), 6) AS correlation FROM s x JOIN s y USING (item_id) WHERE x.model = 'gemini' AND y.model = 'claude'""")
def score_correlation(t):
    return lb.score_correlation(scores(t), "item_id", "gemini", "claude")


@query("agg22_severity_distribution", f"""
WITH {LONG} SELECT model, severity, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY model), 6) AS percent FROM l WHERE category <> '' GROUP BY model, severity""")
def severity_distribution(t):
    return lb.severity_distribution(lb.mqm_long(annotations(t), "item_id"))


def _list(values):
    return ", ".join(f"('{v}')" for v in values)


@query("agg22_category_distribution", f"""
WITH {LONG}, f AS (SELECT model, v.category FROM (SELECT DISTINCT model FROM l), (VALUES {_list(lb.CATEGORIES)}) v(category)),
n AS (SELECT model, category, count(*) AS n FROM l WHERE category <> '' GROUP BY ALL), m AS (SELECT model, sum(n) AS k FROM n GROUP BY 1)
SELECT f.model, f.category, coalesce(n.n, 0) AS n, round(coalesce(n.n, 0)::DOUBLE / k, 6) AS share FROM f LEFT JOIN n USING (model, category) JOIN m ON m.model = f.model""")
def category_distribution(t):
    return lb.category_distribution(lb.mqm_long(annotations(t), "item_id"))


@query("agg22_category_by_severity", f"""
WITH {LONG}, f AS (SELECT model, v.category FROM (SELECT DISTINCT model FROM l), (VALUES {_list(lb.CATEGORIES)}) v(category))
SELECT f.model, f.category, count(*) FILTER (severity = 'minor') AS minor, count(*) FILTER (severity = 'major') AS major, count(*) FILTER (severity = 'critical') AS critical
FROM f LEFT JOIN l USING (model, category) GROUP BY f.model, f.category""")
def category_by_severity(t):
    return lb.category_by_severity(lb.mqm_long(annotations(t), "item_id"))


@query("agg26_severity_bins", f"""
WITH {LONG} SELECT model, CASE WHEN score = 0 THEN '0' WHEN score < 5 THEN 'minor' WHEN score < 25 THEN 'major' ELSE 'critical' END AS bin, count(*) AS n FROM s GROUP BY ALL""")
def severity_bins(t):
    return scores(t).groupBy("model", lb.severity_bin(F.col("score")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("agg27_histogram", f"""
WITH {LONG} SELECT model, least(floor((score + 0.5) / 1.0) + 1, 9)::BIGINT AS bin, count(*) AS n FROM s WHERE score BETWEEN -0.5 AND 8.5 GROUP BY ALL""")
def histogram(t):
    return lb.histogram(scores(t), "score", -0.5, 8.5, 9, ["model"])


@query("agg27_histogram_whole", f"""
WITH {LONG} SELECT model, CASE WHEN score < -0.5 THEN 'under' WHEN score <= 8.5 THEN concat('low ', least(floor(score + 0.5) + 1, 9)::BIGINT)
  WHEN score < 24.5 THEN 'between' WHEN score <= 30.5 THEN concat('high ', least(floor(score - 24.5) + 1, 6)::BIGINT) ELSE 'over' END AS bin, count(*) AS n FROM s GROUP BY ALL""")
def histogram_whole(t):
    return lb.histogram_whole(scores(t), "score", {"low": (-0.5, 8.5, 9), "high": (24.5, 30.5, 6)}, ["model"])


@query("agg24_confusion_matrix", """
SELECT a.v AS quality, b.v AS toxic, count(doc_id) AS n FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v) LEFT JOIN labels ON quality = a.v AND toxic = b.v GROUP BY 1, 2""")
def confusion_matrix(t):
    return lb.confusion_matrix(t.labels, "quality", "toxic", [0, 1])


@query("agg24_rating_confusion", f"""
WITH {W}, r AS (SELECT rating_model AS x, CASE WHEN item_id % 4 = 0 THEN 'BOTH' ELSE rating_model END AS y FROM w)
SELECT p.v AS x, q.v AS y, count(r.x) AS n FROM (VALUES ('gemini'), ('claude'), ('BOTH')) p(v), (VALUES ('gemini'), ('claude'), ('BOTH')) q(v) LEFT JOIN r ON r.x = p.v AND r.y = q.v GROUP BY 1, 2""")
def rating_confusion(t):
    second = F.when(F.col("item_id") % 4 == 0, "BOTH").otherwise(F.col("rating_model"))
    return lb.confusion_matrix(won(t).select(F.col("rating_model").alias("x"), second.alias("y")), "x", "y", ["gemini", "claude", "BOTH"])


KAPPA = """SELECT {keys} n, round(p0, 6) AS p0, round(pe, 6) AS pe, round((p0 - pe) / nullif(1 - pe, 0), 6) AS kappa FROM ({inner})"""


@query("agg25_label_kappa", KAPPA.format(keys="", inner="""
SELECT count(*) AS n, avg((quality = toxic)::INT) AS p0, (avg(quality) * avg(toxic) + avg(1 - quality) * avg(1 - toxic)) AS pe FROM labels"""))
def label_kappa(t):
    return lb.cohens_kappa(t.labels, "quality", "toxic", [0, 1])


@query("agg25_rating_kappa", KAPPA.format(keys="bench,", inner=f"""
WITH {W}, r AS (SELECT bench, rating_model AS x, CASE WHEN item_id % 4 = 0 THEN 'BOTH' ELSE rating_model END AS y FROM w WHERE rating_model IN ('gemini', 'claude', 'BOTH'))
SELECT bench, count(*) AS n, avg((x = y)::INT) AS p0, avg((x = 'gemini')::INT) * avg((y = 'gemini')::INT) + avg((x = 'claude')::INT) * avg((y = 'claude')::INT) + avg((x = 'BOTH')::INT) * avg((y = 'BOTH')::INT) AS pe FROM r GROUP BY bench"""))
def rating_kappa(t):
    second = F.when(F.col("item_id") % 4 == 0, "BOTH").otherwise(F.col("rating_model"))
    return lb.cohens_kappa(won(t).select("bench", F.col("rating_model").alias("x"), second.alias("y")), "x", "y", ["gemini", "claude", "BOTH"], ["bench"])


@query("jon05_category_agreement", f"""
WITH {LONG}, n AS (SELECT *, split_part(category, ' - ', 1) AS sup, row_number() OVER (PARTITION BY item_id, slot > 3, category ORDER BY slot) - 1 AS k FROM l WHERE category <> '')
SELECT x.item_id AS item, x.category, x.sup AS sup_cat, x.k AS occurrence FROM n x JOIN n y ON x.item_id = y.item_id AND x.category = y.category AND x.k = y.k WHERE x.slot <= 3 AND y.slot > 3""")
def category_agreement(t):
    long = lb.mqm_long(annotations(t), "item_id").select(F.col("item_id").alias("item"), "slot", "category")
    return lb.category_agreement(long.where("slot <= 3"), long.where("slot > 3"))


@query("jon05_super_category_agreement", f"""
WITH {LONG}, n AS (SELECT *, split_part(category, ' - ', 1) AS sup, row_number() OVER (PARTITION BY item_id, slot > 3, split_part(category, ' - ', 1) ORDER BY slot) - 1 AS k FROM l WHERE category <> '')
SELECT x.item_id AS item, x.sup AS sup_cat, x.k AS occurrence FROM n x JOIN n y ON x.item_id = y.item_id AND x.sup = y.sup AND x.k = y.k WHERE x.slot <= 3 AND y.slot > 3""")
def super_category_agreement(t):
    long = lb.mqm_long(annotations(t), "item_id").select(F.col("item_id").alias("item"), "slot", "category")
    return lb.category_agreement(long.where("slot <= 3"), long.where("slot > 3"), by_category=False)


@query("jon02_mismatches", """
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, 'o_orderstatus' AS "column", a.o_orderstatus AS left_value, b.s AS right_value
FROM (SELECT * FROM orders WHERE o_orderkey % 100 <> 1) a FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 100 <> 2) b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderstatus IS DISTINCT FROM b.s""")
def mismatches(t):
    # Two annotators' tables: some rows missing on either side, some values changed.
    left = t.orders.where("o_orderkey % 100 <> 1").select("o_orderkey", "o_orderstatus")
    right = t.orders.where("o_orderkey % 100 <> 2").select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return lb.mismatches(left, right, "o_orderkey", ["o_orderstatus"])


@query("jon04_update_from", """
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN concat('new ', c_name) END, c_name) AS c_name, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN 'seen' END, '') AS note FROM customer""")
def update_from(t):
    saved = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("new "), "c_name")).alias("c_name"),
                              F.when(F.col("c_custkey") % 4 != 0, "seen").alias("note"))
    return lb.update_from(t.customer.select("c_custkey", "c_name"), saved, "c_custkey", ["c_name", "note"])


@query("agg28_remaining_quota", """
SELECT p_brand, 20 - coalesce(n, 0) AS need FROM (SELECT DISTINCT p_brand FROM part) LEFT JOIN (SELECT p_brand, count(*) AS n FROM part WHERE p_size < 8 GROUP BY 1) USING (p_brand)""")
def remaining_quota(t):
    return lb.remaining_quota(t.part, t.part.where("p_size < 8"), "p_brand")


@query("win04_cap_per_subject", """
WITH q AS (SELECT p_brand, 20 - coalesce(n, 0) AS need FROM (SELECT DISTINCT p_brand FROM part) LEFT JOIN (SELECT p_brand, count(*) AS n FROM part WHERE p_size < 8 GROUP BY 1) USING (p_brand))
SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS i FROM part WHERE p_size >= 8) JOIN q USING (p_brand) WHERE i < need + 5""")
def cap_per_subject(t):
    quotas = lb.remaining_quota(t.part, t.part.where("p_size < 8"), "p_brand")
    return lb.cap_per_subject(t.part.where("p_size >= 8"), quotas, "p_brand", "p_partkey", max_rank=25).select("p_partkey", "p_brand")


@query("flt24_kept_classes", "SELECT event_id FROM events WHERE CASE event_type WHEN 'click' THEN 'Universal' WHEN 'view' THEN 'Can be localized' ELSE 'Local' END IN ('Universal', 'Can be localized')")
def kept_classes(t):
    kind = F.when(F.col("event_type") == "click", "Universal").when(F.col("event_type") == "view", "Can be localized").otherwise("Local")
    return t.events.where(kind.isin("Universal", "Can be localized")).select("event_id")


BLOCK = "concat('Example ', doc_id, ':', chr(10), 'English:', chr(10), lang, chr(10), 'Option 1:', chr(10), source, chr(10), 'Option 2:', chr(10), text, chr(10), 'Rating: ', doc_id % 3, chr(10), 'Gold: fixed')"
RULE = "-" * 50


@query("src13_labelled_blocks", r"""
SELECT doc_id, b AS block, doc_id AS example_index, lang AS english, source AS option_1, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS option_2, (doc_id % 3)::VARCHAR AS rating, 'fixed' AS gold
FROM documents, (VALUES (0), (1)) v(b)""")
def labelled_blocks(t):
    files = t.docs.select("doc_id", F.expr(f"concat({BLOCK}, '{RULE}', {BLOCK}, '{RULE}')").alias("value"))
    return lb.parse_labelled_blocks(files)


@query("set01_union_by_name", "SELECT doc_id, source, 'documents' AS part FROM documents UNION ALL SELECT doc_id, NULL, 'labels' FROM labels")
def union_by_name(t):
    a = t.documents.select("doc_id", "source", F.lit("documents").alias("part"))
    return a.unionByName(t.labels.select(F.lit("labels").alias("part"), "doc_id"), allowMissingColumns=True)


@query("set02_split_overlap", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def split_overlap(t):
    return t.orders.where("o_orderstatus = 'O'").select("o_custkey").intersect(t.orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query("set02_only_in_first", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def only_in_first(t):
    return t.orders.where("o_orderstatus = 'O'").select("o_custkey").exceptAll(t.orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query("agg16_mean_score", "SELECT source, round(avg(quality), 6) AS mean_score, count(quality) AS scored FROM documents JOIN labels USING (doc_id) GROUP BY source")
def mean_score(t):
    return t.documents.select("doc_id", "source").join(t.labels, "doc_id").groupBy("source").agg(
        F.round(F.avg("quality"), 6).alias("mean_score"), F.count("quality").alias("scored"))
