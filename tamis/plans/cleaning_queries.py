"""Cleaning rules, rule sets, statistics, de-duplication of lines, space repair."""

import re

import pandas as pd
from pyspark.sql import functions as F, types as T

from tamis.functions import cleaning as cl, text as tx
from tamis.functions.rules import apply_rules
from tamis.operators import cleaning as op
from tamis.operators.quality import METRICS
from tamis.plans.derive import DIRTY, ESCAPED, N_WORDS, STRIP, TABLED, rx
from tamis.plans.registry import query
from tamis.session import spread

TAGS = cl.HTML_TAGS
IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
EMAIL = cl.EMAIL
MASK_LOCAL = [(r"\b127\.0\.0\.1\b", "@L1@"), (r"\b0\.0\.0\.0\b", "@L0@")]
UNMASK_LOCAL = [("@L1@", "127.0.0.1"), ("@L0@", "0.0.0.0")]

# DuckDB steps of each rule.
STEPS = {
    "double_quote_entity": [("&quot;|&#34;", '"')],
    "apostrophe_entity": [("&#39;", "'")],
    "style_block": [("<style[^>]*>[^<]*</style>", "")],
    "html_tag": [(rf"</?(?:{TAGS})\b[^>]*>", "")],
    "blank_line": [(r"(?m)^[ \t]+$", "")],
    "carriage_return": [(r"\r\n?", "\n")],
    "newline_run": [(r"\n{4,}", "\n\n\n")],
    "spaces": [(r"(?m) +$", ""), (r"(?m)^( {16}) +", r"\1"), (r"(?m)^((?: {4})*) {1,3}([^ ]|$)", r"\1\2"), (r"([^ \n]) {2,}", r"\1 ")],
    "ip_address": [*MASK_LOCAL, (IP, "<IP>"), *UNMASK_LOCAL],
    "email": [(EMAIL, "<EMAIL>")],
    "separator_line": [(r"(?m)^[\-=*_~•●■▪◆◦ \t]+$", "")],
    "vowel_points": [(r"[\x{0591}-\x{05BD}\x{05BF}-\x{05C7}]", "")],
    "no_break_space": [(r"\x{00A0}", " ")],
    "direction_mark": [(r"[\x{200E}\x{200F}\x{202A}-\x{202F}]", "")],
    "table_tag": [("</?MARKDOWN_TABLE>", "")],
}
ALL_STEPS = [s for steps in STEPS.values() for s in steps]
CLEAN_STEPS = [s for n in ("newline_run", "ip_address", "email") for s in STEPS[n]]

# Single rules on the texts that trigger them.
for number, (name, steps) in enumerate(STEPS.items(), 1):
    noise = TABLED if name == "table_tag" else DIRTY

    def run(t, name=name, noise=noise):
        rule = cl.WEB_RULES_BY_NAME[name]
        return t.docs.select("doc_id", F.expr(noise).alias("text")).select("doc_id", rule(F.col("text")).alias("text"))

    query(f"cln{number:02d}_{name}", f"SELECT doc_id, {rx('x', *steps)} AS text FROM (SELECT doc_id, {noise} AS x FROM documents)")(run)


@query("cln03_04_html_to_text", f"""
SELECT page_id, {rx('html', (r'(?s)<style[^>]*>.*?</style>', ''), (rf'</?(?:{TAGS})' + r'\b[^>]*>', ''), ('&quot;|&#34;', '"'), ('&#39;', "'"))} AS text
FROM pages""")
def html_to_text(t):
    return spread(t.pages, "page_id").select("page_id", apply_rules(F.col("html"), cl.HTML_TO_TEXT).alias("text"))


@query("cln16_web_rules", f"""
SELECT doc_id, text, {N_WORDS.format('text')} AS n_words FROM (
  SELECT doc_id, {rx('x', *ALL_STEPS, *STRIP)} AS text FROM (SELECT doc_id, {DIRTY} AS x FROM documents))""")
def web_rules(t):
    noisy = t.docs.select("doc_id", F.expr(DIRTY).alias("text"))
    return noisy.transform(op.cleaner(cl.WEB_RULES))


# Outside the tables two rules act; inside nothing does.  The twin puts a marker on a
# line of its own in place of each table, rewrites the rest, and puts the (constant)
# table back: a stretch of text ends where a table starts.
@query("cln16_protected_tables", f"""
WITH s AS (SELECT doc_id, {TABLED} AS x FROM documents),
m AS (SELECT doc_id, regexp_replace(x, '(?s)<MARKDOWN_TABLE>.*?</MARKDOWN_TABLE>', concat(chr(10), '@@T@@', chr(10)), 'g') AS y FROM s)
SELECT doc_id, replace({rx('y', *STEPS['double_quote_entity'], *STEPS['spaces'])}, concat(chr(10), '@@T@@', chr(10)),
  concat('<MARKDOWN_TABLE>| a  | &quot;b&quot; |', chr(10), '-----', chr(10), '</MARKDOWN_TABLE>')) AS text FROM m""")
def protected_tables(t):
    rules = [cl.WEB_RULES_BY_NAME[n] for n in ("double_quote_entity", "spaces")]
    tabled = t.docs.select("doc_id", F.expr(TABLED).alias("text"))
    return tabled.select("doc_id", apply_rules(F.col("text"), rules).alias("text"))


@query("cln16_substitution_counts", f"""
WITH s0 AS (SELECT text AS x FROM documents),
s1 AS (SELECT x, {rx('x', *STEPS['newline_run'])} AS y FROM s0),
s2 AS (SELECT x, y, {rx('y', *STEPS['ip_address'])} AS z FROM s1),
s3 AS (SELECT x, y, z, {rx('z', *STEPS['email'])} AS w FROM s2)
SELECT 'newline_run' AS rule, count(*) FILTER (x <> y) AS rows_changed, sum(len(regexp_extract_all(x, '\\n{{4,}}')))::BIGINT AS substitutions FROM s3
UNION ALL SELECT 'ip_address', count(*) FILTER (y <> z), sum(len(regexp_extract_all({rx('y', *MASK_LOCAL)}, '{IP}')))::BIGINT FROM s3
UNION ALL SELECT 'email', count(*) FILTER (z <> w), sum(len(regexp_extract_all(z, '{EMAIL}')))::BIGINT FROM s3""")
def substitution_counts(t):
    return op.substitution_counts(t.docs, [cl.WEB_RULES_BY_NAME[n] for n in ("newline_run", "ip_address", "email")])


@query("cln29_flatten_for_training", f"""
SELECT doc_id, {rx("replace(replace(replace(replace(replace(replace(replace(replace(replace(x, '" + chr(92) + '"' + "', '\"'), '" + chr(92) + "''', ''''), '" + chr(92) * 2 + "', '" + chr(92) + "'), '&quot;', '\"'), '&#34;', '\"'), '&#39;', ''''), '" + chr(92) + "n', ' '), '" + chr(92) + "t', ' '), '" + chr(92) + "r', ' ')", (r"\s+", " "), *STRIP)} AS text
FROM (SELECT doc_id, {ESCAPED} AS x FROM documents)""")
def flatten_for_training(t):
    return t.docs.select("doc_id", F.expr(ESCAPED).alias("x")).select("doc_id", tx.flatten_for_training(F.col("x")).alias("text"))


@query("cln30_unescape_literals", f"""
SELECT doc_id, replace(replace(replace(replace(replace(x, '{chr(92)}n', chr(10)), '{chr(92)}"', '"'), '{chr(92) * 2}', '{chr(92)}'), '{chr(92)}t', chr(9)), '{chr(92)}r', chr(13)) AS text
FROM (SELECT doc_id, {ESCAPED} AS x FROM documents)""")
def unescape_literals(t):
    return t.docs.select("doc_id", F.expr(ESCAPED).alias("x")).select("doc_id", tx.unescape_literals(F.col("x")).alias("text"))


@query("cln33_book_clean", None)
def book_clean(t):
    return t.docs.select("doc_id", F.expr(DIRTY).alias("x")).select("doc_id", apply_rules(F.col("x"), cl.BOOK_RULES).alias("text"))


@query("cln34_book_lines", f"""
WITH l AS (SELECT doc_id, generate_subscripts(parts, 1) AS i, trim(unnest(parts)) AS line FROM (
  SELECT doc_id, string_split(replace(text, '. ', concat('.', chr(10), chr(10), chr(10))), chr(10)) AS parts FROM documents)),
k AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM l)
SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM k WHERE line <> '' OR before = '' GROUP BY doc_id""")
def book_lines(t):
    doubled = F.expr("replace(text, '. ', concat('.', chr(10), chr(10), chr(10)))")
    return t.docs.select("doc_id", cl.repair_book_lines(doubled).alias("text"))


@query("cln35_sheet_safe", r"""
SELECT doc_id, substring(regexp_replace(x, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{FEFF}]', '', 'g'), 1, 32767) AS text
FROM (SELECT doc_id, concat(replace(text, ', ', concat(',', chr(7), chr(127))), chr(12)) AS x FROM documents)""")
def sheet_safe(t):
    noisy = F.expr("concat(replace(text, ', ', concat(',', chr(7), chr(127))), chr(12))")
    return t.docs.select("doc_id", tx.sheet_safe(noisy).alias("text"))


# Built without a session, as this module is imported before one.
INSERTIONS = T.ArrayType(T.StructType().add("char_index", T.IntegerType()).add("char", T.StringType()).add("should_ignore", T.BooleanType()))


@F.pandas_udf(INSERTIONS)
def _split_pairs(texts: pd.Series) -> pd.Series:
    return texts.map(lambda v: [(m.start() + 1, " ", m[0] == "an") for m in re.finditer("th|an", v or "")])


@query("cln36_apply_insertions", """
SELECT doc_id, replace(text, 'th', 't h') AS text FROM documents""")
def apply_insertions(t):
    # Predictions derived from the text: a blank inside every "th", and ignored ones inside every "an".
    docs = t.docs.select("doc_id", "text")
    predictions = docs.select("doc_id", F.inline(_split_pairs("text")))
    return op.apply_insertions(docs, predictions, "doc_id")


@query("cln37_chunk_text", None)
def chunk_text(t):
    return op.chunk_text(t.docs.select("doc_id", "text"))


@query("cln37_chunks_join_back", """
SELECT doc_id, true AS whole, true AS fits FROM documents WHERE text <> ''""")
def chunks_join_back(t):
    docs = t.docs.select("doc_id", "text")
    chunks = op.chunk_text(docs.withColumn("source_text", F.col("text")))
    joined = chunks.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "chunk"))), lambda s: s["chunk"]), "").alias("j"),
        F.first("source_text").alias("text"),
        F.max(F.length("chunk")).alias("longest"),
    )
    return joined.select("doc_id", (F.col("j") == F.col("text")).alias("whole"), (F.col("longest") <= 2046).alias("fits"))


@query("cln38_safe_filename", r"""
SELECT page_id, regexp_replace(regexp_replace(concat(url, '|v1. .'), '[<>:"|?*]', '_', 'g'), '[. ]+$', '') AS name FROM pages""")
def safe_filename(t):
    return t.pages.select("page_id", tx.safe_filename(F.concat("url", F.lit("|v1. ."))).alias("name"))


@query("cln39_strip", r"""
SELECT doc_id, regexp_replace(regexp_replace(concat(chr(9), ' ', text, chr(10), ' '), '^\s+', ''), '\s+$', '') AS text FROM documents""")
def strip_text(t):
    return t.docs.select("doc_id", tx.strip(F.expr("concat(chr(9), ' ', text, chr(10), ' ')")).alias("text"))


@query("dup01_unique_lines", """
WITH l AS (SELECT doc_id, generate_subscripts(parts, 1) AS i, regexp_replace(regexp_replace(unnest(parts), '^\\s+', ''), '\\s+$', '') AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
f AS (SELECT doc_id, line, min(i) AS i FROM l WHERE line <> '' GROUP BY doc_id, line)
SELECT d.doc_id, coalesce(string_agg(f.line, chr(10) ORDER BY f.i), '') AS text FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""")
def unique_lines(t):
    return t.docs.select("doc_id", op.unique_lines(F.col("text")).alias("text"))


@query("agg09_cleaning_stats", f"""
SELECT source, count(*) AS rows_processed, count(*) FILTER (text <> c) AS rows_modified,
  greatest(0, sum(length(text)) - sum(length(c)))::BIGINT AS characters_removed,
  greatest(0, sum(length(c)) - sum(length(text)))::BIGINT AS characters_added
FROM (SELECT source, text, {rx('text', *CLEAN_STEPS, *STRIP)} AS c FROM documents) GROUP BY source""")
def cleaning_stats(t):
    rules = [cl.WEB_RULES_BY_NAME[n] for n in ("newline_run", "ip_address", "email")]
    both = t.docs.select("source", "text", tx.strip(apply_rules(F.col("text"), rules)).alias("cleaned"))
    return both.groupBy("source").agg(*op.cleaning_stats(F.col("text"), F.col("cleaned")))


@query("agg10_word_changes", rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS b, regexp_extract_all({rx('text', *STEPS['email'])}, '\S+') AS a FROM documents
  WHERE text <> {rx('text', *STEPS['email'])}),
e AS (SELECT doc_id, unnest(range(greatest(len(a), len(b)))) AS position, a, b FROM w)
SELECT doc_id, position, coalesce(b[position + 1], '') AS before, coalesce(a[position + 1], '') AS after, 'email' AS rule
FROM e WHERE coalesce(b[position + 1], '') <> coalesce(a[position + 1], '')""")
def word_changes(t):
    both = t.docs.select("doc_id", "text", cl.WEB_RULES_BY_NAME["email"](F.col("text")).alias("cleaned"))
    return op.word_changes(both, "text", "cleaned", "email")


@query("agg11_spacing_stats", rf"""
SELECT doc_id, length(text) - length(replace(text, ' ', '')) AS spaces_before, length(f) - length(replace(f, ' ', '')) AS spaces_after,
  (length(f) - length(replace(f, ' ', ''))) - (length(text) - length(replace(text, ' ', ''))) AS spaces_added,
  {N_WORDS.format('text')} AS words_before, {N_WORDS.format('f')} AS words_after,
  {N_WORDS.format('f')} - {N_WORDS.format('text')} AS word_change, text <> f AS has_changes
FROM (SELECT doc_id, text, replace(text, 'th', 't h') AS f FROM documents)""")
def spacing_stats(t):
    both = t.docs.select("doc_id", "text", F.expr("replace(text, 'th', 't h')").alias("fixed"))
    return both.select("doc_id", *[c.alias(n) for n, c in op.spacing_stats(F.col("text"), F.col("fixed")).items()])


@query("smp06_rule_examples", f"""
WITH s AS (SELECT doc_id, text, {rx('text', *STEPS['newline_run'])} AS y FROM documents),
s2 AS (SELECT *, {rx('y', *STEPS['ip_address'])} AS z FROM s), s3 AS (SELECT *, {rx('z', *STEPS['email'])} AS w FROM s2),
r AS (SELECT doc_id, 'newline_run' AS rule, text AS before, y AS after FROM s3 WHERE text <> y
  UNION ALL SELECT doc_id, 'ip_address', y, z FROM s3 WHERE y <> z UNION ALL SELECT doc_id, 'email', z, w FROM s3 WHERE z <> w)
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rule ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id) <= 5""")
def rule_examples(t):
    rules = [cl.WEB_RULES_BY_NAME[n] for n in ("newline_run", "ip_address", "email")]
    return op.rule_examples(t.docs, rules, "doc_id", 5)


@query("flt19_single_char_share", """
WITH c AS (SELECT doc_id, unnest(string_split(replace(text, ' ', ''), '')) AS ch FROM documents),
n AS (SELECT doc_id, ch, count(*) AS k FROM c WHERE ch <> '' GROUP BY doc_id, ch)
SELECT d.doc_id, round(coalesce(sum(k) FILTER (k = 1) / sum(k) * 100, 0), 6) AS share FROM documents d LEFT JOIN n USING (doc_id) GROUP BY d.doc_id""")
def single_char_share(t):
    return t.docs.select("doc_id", F.round(METRICS["single_char_percentage"](F.col("text")), 6).alias("share"))


@query("agg14_char_diagnostics", r"""
SELECT doc_id, length(x) - length(replace(x, '\', '')) AS backslashes, length(x) - length(replace(x, '"', '')) AS quotes,
  (length(x) - length(replace(x, '\"', ''))) // 2 AS escaped_quotes FROM (SELECT doc_id, """ + ESCAPED + """ AS x FROM documents)""")
def char_diagnostics(t):
    noisy = t.docs.select("doc_id", F.expr(ESCAPED).alias("x"))
    return noisy.select("doc_id", *[c.alias(n) for n, c in tx.char_diagnostics(F.col("x")).items()])


@query("fun01_counts", rf"""
SELECT doc_id, {N_WORDS.format('text')} AS n_words, strlen(text) AS n_bytes FROM documents""")
def counts(t):
    return t.documents.select("doc_id", tx.word_count(F.col("text")).alias("n_words"), tx.byte_count(F.col("text")).alias("n_bytes"))


@query("fun02_preview", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN concat(substring(text, 1, 200), '...') ELSE text END AS preview FROM documents""")
def preview(t):
    return t.documents.select("doc_id", tx.preview(F.col("text")).alias("preview"))


# DuckDB's levenshtein counts bytes, so both sides fold letters beyond ASCII to '?'.
ASCII = r"regexp_replace(text, '[^\x00-\x7F]', '?', 'g')"


@query("fun03_edit_distance_ratio", f"""
SELECT item_id, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 0 WHEN length(a) = 0 OR length(b) = 0 THEN 1
  ELSE levenshtein(a, b) / greatest(length(a), length(b)) END, 6) AS distance
FROM (SELECT item_id, {ASCII} AS a, replace(replace({ASCII}, 'e', ''), 'th', 'TH') AS b FROM benchmark)""")
def edit_distance(t):
    rows = t.benchmark.select("item_id", F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("a"))
    rows = rows.withColumn("b", F.expr("replace(replace(a, 'e', ''), 'th', 'TH')"))
    return rows.select("item_id", F.round(tx.edit_distance_ratio(F.col("a"), F.col("b")), 6).alias("distance"))


# A row of the distance table per step of the recursion; a key packs (cost, -substitutions), and the
# minimum over what stands further left is a running one once the ramp is taken off.
@query("fun04_edit_shares", """
WITH RECURSIVE t AS (SELECT item_id, text AS a, replace(replace(text, 'e', ''), 'th', 'THX') AS b FROM benchmark),
s AS (SELECT *, length(a) AS n, length(b) AS m, length(a) + length(b) + 1 AS step FROM t WHERE a IS NOT NULL),
cells AS (
  SELECT item_id, 0 AS i, j, j * step AS v FROM (SELECT *, unnest(range(0, m + 1)) AS j FROM s)
  UNION ALL
  SELECT item_id, i, j, min(up - j * step) OVER (PARTITION BY item_id ORDER BY j) + j * step FROM (
    SELECT c.item_id, c.i + 1 AS i, c.j, step, least(c.v + step,
      lag(c.v) OVER (PARTITION BY c.item_id ORDER BY c.j) + CASE WHEN substr(a, c.i + 1, 1) = substr(b, c.j, 1) THEN 0 ELSE step - 1 END) AS up
    FROM cells c JOIN s ON c.item_id = s.item_id WHERE c.i < n)),
ends AS (SELECT s.item_id, n, m, (v + step - 1) // step AS cost, ((v + step - 1) // step) * step - v AS subs FROM cells c JOIN s ON c.item_id = s.item_id AND i = n AND j = m)
SELECT item_id, (cost - subs + n - m) // 2 / greatest(n, m) AS deletions, (cost - subs - n + m) // 2 / greatest(n, m) AS insertions FROM ends WHERE greatest(n, m) > 0
UNION ALL SELECT item_id, 0.0, 0.0 FROM ends WHERE greatest(n, m) = 0""")
def edit_shares(t):
    rows = spread(t.benchmark, "item_id").select("item_id", F.col("text").alias("a"), F.expr("replace(replace(text, 'e', ''), 'th', 'THX')").alias("b"))
    return rows.select("item_id", tx.edit_shares("a", "b").alias("s")).select("item_id", "s.deletions", "s.insertions")


@query("fun05_cleaning_benchmark", f"""
WITH a AS (SELECT {ASCII} AS a FROM benchmark),
b AS (SELECT replace(a, 'e', '') AS gold, a, replace(a, 'E', '') AS s1, replace(replace(a, 'E', ''), 'e ', ' ') AS s2 FROM a),
l AS (SELECT 'original' AS step, a AS x, gold FROM b UNION ALL SELECT 'capitals', s1, gold FROM b UNION ALL SELECT 'capitals_and_ends', s2, gold FROM b)
SELECT step, round(avg(levenshtein(x, gold) / greatest(length(x), length(gold))), 3) AS distance FROM l GROUP BY step""")
def cleaning_benchmark(t):
    rows = t.benchmark.select(F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("a")).select(
        F.expr("replace(a, 'e', '')").alias("gold"), "a",
        F.expr("replace(a, 'E', '')").alias("s1"), F.expr("replace(replace(a, 'E', ''), 'e ', ' ')").alias("s2"),
    )
    return op.cleaning_benchmark(rows, "a", "gold", {"capitals": "s1", "capitals_and_ends": "s2"})
