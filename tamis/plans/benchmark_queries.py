"""Prompts, tagged records, answers, matching and accuracy."""

from pyspark.sql import functions as F

from tamis.functions import prompts as p
from tamis.operators import benchmarks as b
from tamis.operators.dedup import drop_exact
from tamis.operators.training import with_split
from tamis.plans.registry import query
from tamis.plans.sampling_queries import UNIT

# Multiple-choice items derived from the benchmark texts.
CHOICES = ["concat('c', item_id)", "substring(text, 1, 10)", "substring(text, 5, 8)", "'none of these'"]
SQL_CHOICES = f"[{', '.join(CHOICES)}]"
TOPIC = "concat('topic_', item_id % 3)"


def items(t):
    choices = F.array(*[F.expr(c) for c in CHOICES])
    return t.benchmark.select("item_id", "text", choices.alias("choices"), (F.col("item_id") % 6 - 1).alias("answer"), F.expr(TOPIC).alias("topic"))


ONE_LINE = r"regexp_replace(regexp_replace(replace(text, chr(10), ' '), '^\s+', ''), '\s+$', '')"
LETTERED = "concat('A. ', c[1], chr(10), 'B. ', c[2], chr(10), 'C. ', c[3], chr(10), 'D. ', c[4])"
FROM_ITEMS = f"(SELECT *, {SQL_CHOICES} AS c, {TOPIC} AS topic, item_id % 6 - 1 AS answer FROM benchmark)"


@query("fun23_hebrew_choice_prompt", f"""
SELECT item_id, concat('{p.HEBREW_INSTRUCTION[:-2]}', chr(10), chr(10), 'שאלה: ', {ONE_LINE}, chr(10), {LETTERED}, chr(10), 'תשובה:') AS prompt,
  CASE WHEN answer BETWEEN 0 AND 3 THEN answer ELSE 0 END AS gold_index FROM {FROM_ITEMS}""")
def hebrew_choice_prompt(t):
    return items(t).select(
        "item_id", p.multiple_choice_hebrew(F.col("text"), F.col("choices")).alias("prompt"),
        p.valid_gold_index(F.col("answer"), F.col("choices")).alias("gold_index"),
    )


@query("fun23_english_choice_prompt", f"""
SELECT item_id, concat('The following are multiple choice questions (with answers) about  ', replace(topic, '_', ' '), '.', chr(10), chr(10), text, chr(10), {LETTERED}, chr(10), 'Answer:') AS prompt,
  ' A| B| C| D' AS letters FROM {FROM_ITEMS}""")
def english_choice_prompt(t):
    return items(t).select(
        "item_id", p.multiple_choice_english(F.col("text"), F.col("choices"), F.col("topic")).alias("prompt"),
        F.array_join(p.letters(F.col("choices"), few_shot=True), "|").alias("letters"),
    )


@query("fun23_other_prompts", f"""
SELECT item_id, concat('שאלה: ', {ONE_LINE}, chr(10), 'תשובה:') AS word_problem, concat('Question: ', text, chr(10), 'Answer:') AS english_problem,
  concat('{p.COPA_INSTRUCTION[:-1]}', chr(10), chr(10), '        שאלה: ', {ONE_LINE}, chr(10), 'A. ', c[1], chr(10), 'B. ', c[2], chr(10), 'תשובה:') AS copa,
  concat(substring(s, 1, length(s) - 1), ' ', CASE WHEN item_id % 2 = 0 THEN 'because' ELSE 'therefore' END) AS premise
FROM (SELECT *, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS s FROM {FROM_ITEMS})""")
def other_prompts(t):
    relation = F.when(F.col("item_id") % 2 == 0, "cause").otherwise("effect")
    return items(t).select(
        "item_id", p.word_problem_hebrew(F.col("text")).alias("word_problem"), p.word_problem_english(F.col("text")).alias("english_problem"),
        p.copa_prompt(F.col("text"), F.slice("choices", 1, 2)).alias("copa"), p.connected_premise(F.col("text"), relation).alias("premise"),
    )


@query("fun07_render_tags", "SELECT doc_id, concat('<lang>', lang, '</lang>', chr(10), '<source>', source, '</source>', chr(10), '<text>', text, '</text>') AS prompt FROM documents")
def render_tags(t):
    docs = t.docs.withColumn("translation_status", F.lit("done"))
    return docs.select("doc_id", p.render_tags(["lang", "source", "translation_status", "text"]).alias("prompt"))


TAGGED = "concat('<response_format>x</response_format><lang> ', lang, ' </lang>', chr(10), '<text>', text, '</text><lang>', source, '</lang>')"


@query("fun06_parse_tags", r"""
SELECT doc_id, source AS lang, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS text, 'answer' AS missing, 3 AS tags FROM documents""")
def parse_tags(t):
    parsed = t.docs.select("doc_id", F.expr(TAGGED).alias("x")).select("doc_id", "x", p.parse_tags(F.col("x")).alias("m"))
    return parsed.select(
        "doc_id", F.col("m")["lang"].alias("lang"), F.col("m")["text"].alias("text"),
        F.array_join(p.missing_tags(F.col("m"), ["lang", "text", "answer"]), ",").alias("missing"), p.tag_count(F.col("x")).alias("tags"),
    )


@query("agg29_tag_count_distribution", r"""
WITH n AS (SELECT len(regexp_extract_all(html, '<li><a [^>]*>[^<]*</a></li>')) AS links FROM pages) SELECT links AS tags, count(*) AS pages FROM n GROUP BY 1""")
def tag_count_distribution(t):
    # Menu entries rewritten as tagged pairs, then counted by the tag parser.
    entry = r"<li><a [^>]*>([^<]*)</a></li>"
    found = F.array_join(F.transform(F.regexp_extract_all("html", F.lit(entry), F.lit(1)), lambda x: F.concat(F.lit("<k>"), x, F.lit("</k>"))), "")
    return t.pages.select(p.tag_count(found).alias("tags")).groupBy("tags").agg(F.count(F.lit(1)).alias("pages"))


PUNCT = r"""!-/:-@\[-`{-~"""


@query("fun21_normalize_answer", rf"""
SELECT doc_id, trim(regexp_replace(array_to_string(list_filter(regexp_extract_all(regexp_replace(lower(text), '[{PUNCT}]', '', 'g'), '\S+'), lambda w: w NOT IN ('a', 'an', 'the')), ' '), '\s+', ' ', 'g')) AS answer
FROM documents""")
def normalize_answer(t):
    return t.docs.select("doc_id", p.normalize_answer(F.col("text")).alias("answer"))


ANSWER = "concat(replace(text, '. ', '. The sum is 27+4-3='), CASE conv_id % 4 WHEN 0 THEN ' #### 1,234' WHEN 1 THEN ' = 28.5 ' WHEN 2 THEN ' so 12 apples.' ELSE '' END)"


@query("fun22_final_answer", f"""
SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN '1234' WHEN 1 THEN '285' WHEN 2 THEN '12'
  ELSE CASE WHEN text LIKE '%. %' THEN '3' ELSE 'none' END END AS answer FROM conversations""")
def final_answer(t):
    got = t.conversations.select("conv_id", "turn", "text", p.final_answer(F.expr(ANSWER)).alias("a"))
    # Without a number the whole text is the answer; it is shown as 'none'.
    return got.select("conv_id", "turn", F.when(F.col("a").rlike("^[0-9]+$"), F.col("a")).otherwise("none").alias("answer"))


@query("fun22_strict_final_answer", "SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN '1234' ELSE '[invalid]' END AS answer FROM conversations")
def strict_final_answer(t):
    return t.conversations.select("conv_id", "turn", p.strict_final_answer(F.expr(ANSWER)).alias("answer"))


@query("evl01_exact_match", """
SELECT role, count(*) AS n, round(avg(h), 6) AS acc, round(stddev_samp(h) / sqrt(count(*)), 6) AS acc_stderr FROM (
  SELECT role, CASE WHEN conv_id % 4 = 0 THEN 1 WHEN conv_id % 4 = 2 THEN 1 ELSE 0 END AS h FROM conversations) GROUP BY role""")
def exact_match(t):
    golds = F.transform(F.array(F.lit("#### 1,234"), F.lit("12")), p.final_answer)
    hits = t.conversations.select("role", b.exact_match(p.final_answer(F.expr(ANSWER)), golds).alias("hit"))
    return b.accuracy(hits, "hit", ["role"])


@query("evl02_loglikelihood", """
SELECT label, count(*) AS n, round(avg(h), 6) AS acc, round(stddev_samp(h) / sqrt(count(*)), 6) AS acc_stderr FROM (
  SELECT label, (list_position(embedding, list_max(embedding)) - 1 = vec_id % 64)::INT AS h FROM embeddings) GROUP BY label""")
def loglikelihood(t):
    hits = t.embeddings.select("label", b.loglikelihood_hit(F.col("embedding"), F.col("vec_id") % 64).alias("hit"))
    return b.accuracy(hits, "hit", ["label"])


@query("evl03_accuracy", """
SELECT toxic, count(*) AS n, round(avg(quality), 6) AS acc, round(stddev_samp(quality) / sqrt(count(quality)), 6) AS acc_stderr FROM labels GROUP BY toxic""")
def accuracy(t):
    return b.accuracy(t.labels, "quality", ["toxic"])


@query("evl04_few_shots", f"""
WITH d AS (SELECT doc_id, lang, text, {UNIT.format(seed=42, key='doc_id')} < 0.5 AS validation FROM documents),
s AS (SELECT lang AS task, string_agg(text, concat(chr(10), chr(10)) ORDER BY doc_id) AS context FROM (
  SELECT * FROM d WHERE NOT validation QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 5) GROUP BY lang)
SELECT doc_id, concat(context, chr(10), chr(10), text) AS prompt FROM d JOIN s ON lang = task WHERE validation""")
def few_shots(t):
    docs = with_split(t.documents.select("doc_id", F.col("lang").alias("task"), "text"), validation_share=0.5)
    train = docs.where("split = 'train'")
    context = b.few_shot_context(train, "task", "doc_id", "text", 5)
    return b.with_few_shots(docs.where("split = 'validation'"), context, "task", "text").select("doc_id", "prompt")


@query("jon01_match_by_prompt", """
SELECT g.doc_id AS gold_id, original_id FROM documents g JOIN (SELECT text, min(doc_id) AS original_id FROM documents GROUP BY text) USING (text)""")
def match_by_prompt(t):
    # Every document against the items with distinct prompts.
    docs = t.docs.select("doc_id", F.col("text").alias("q")).select("doc_id", p.render_tags(["q"]).alias("prompt"))
    original = drop_exact(docs, "doc_id", ["prompt"]).withColumnRenamed("doc_id", "original_id")
    return b.match_by_prompt(docs.withColumnRenamed("doc_id", "gold_id"), original, "prompt").select("gold_id", "original_id")


@query("jon01_match_report", """
SELECT doc_id AS gold_id, n AS matches FROM documents JOIN (SELECT text, count(*) AS n FROM documents GROUP BY text) USING (text) WHERE n <> 1""")
def match_report(t):
    gold = t.documents.select(F.col("doc_id").alias("gold_id"), "text")
    return b.match_report(gold, t.documents.select("text"), "text", "gold_id")


@query("jon12_outputs_side_by_side", "SELECT item_id, text AS first_model, concat(text, '!') AS second_model FROM benchmark")
def outputs_side_by_side(t):
    first = t.benchmark.select("item_id", F.lit("first_model").alias("model"), "text")
    new = t.benchmark.select("item_id", F.concat("text", F.lit("!")).alias("out"))
    both = b.add_model_column(first, new, "item_id", "second_model", "out")
    return b.outputs_side_by_side(both, "item_id", ["first_model", "second_model"])


@query("jon12_match_by_position", """
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders), c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS position FROM customer)
SELECT position, o_orderkey, c_custkey FROM a FULL JOIN c USING (position)""")
def match_by_position(t):
    return b.match_by_position(t.orders.select("o_orderkey"), t.customer.select("c_custkey"), "o_orderkey", "c_custkey")


@query("fun08_flatten_choices", f"""
SELECT item_id, text AS question, c[1] AS "option 1", c[2] AS "option 2", c[3] AS "option 3", c[4] AS "option 4", c[1] AS "ending 1", c[2] AS "ending 2", c[3] AS "ending 3", c[4] AS "ending 4" FROM {FROM_ITEMS}""")
def flatten_choices(t):
    return items(t).select("item_id", *b.flatten_choices(F.col("text"), F.col("choices")), *b.flatten_endings(F.col("choices")))


@query("fun08_rebuild_choices", f"""
SELECT item_id, array_to_string(c, '|') AS texts, 'א|ב|ג|ד' AS labels, CASE item_id % 4 WHEN 0 THEN 'א' WHEN 1 THEN 'ב' WHEN 2 THEN 'ג' ELSE 'ד' END AS answer,
  CASE WHEN item_id % 2 = 0 THEN 'סיבה' ELSE 'תוצאה' END AS relation FROM {FROM_ITEMS}""")
def rebuild_choices(t):
    flat = items(t).select("item_id", *b.flatten_choices(F.col("text"), F.col("choices")))
    labels = F.array(*[F.lit(x) for x in "ABCD"])
    built = flat.select("item_id", *b.rebuild_choices(labels, b.letter_of_index(F.col("item_id") % 4)),
                        b.rebuild_relation(F.when(F.col("item_id") % 2 == 0, "cause").otherwise("effect")).alias("relation"))
    return built.select("item_id", F.array_join("choices.text", "|").alias("texts"), F.array_join("choices.label", "|").alias("labels"), F.col("answerKey").alias("answer"), "relation")


@query("flt28_exactly_four", "SELECT doc_id FROM documents WHERE len(string_split(lang || '-' || text, 'j')) = 4")
def exactly_four(t):
    made = t.documents.select("doc_id", F.split(F.concat("lang", F.lit("-"), "text"), "j", -1).alias("choices"))
    return b.exactly_four(made).select("doc_id")


@query("fun24_answer_index", "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_linenumber BETWEEN 1 AND 4 THEN l_linenumber - 1 END AS answer_index FROM lineitem")
def answer_index(t):
    label = F.when(F.col("l_returnflag") == "A", "A").otherwise(F.col("l_linenumber").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", p.answer_index(label).alias("answer_index"))
