"""Wikitext, article and OCR queries, on wikitext derived around the documents."""

from pyspark.sql import functions as F

from tamis.functions import wikitext as w
from tamis.functions.cleaning import EMAIL, IP_ADDRESS
from tamis.functions.rules import apply_rules
from tamis.functions.text import matches_title
from tamis.operators import articles as a
from tamis.plans.derive import STRIP, WIKI, rx
from tamis.plans.registry import query
from tamis.session import spread

SRC = f"(SELECT doc_id, source, lang, text, {WIKI} AS x FROM documents)"


def wiki(t):
    return t.docs.select("doc_id", "source", "lang", F.expr(WIKI).alias("text"))


def _rules(rules):
    return lambda t: wiki(t).select("doc_id", apply_rules(F.col("text"), rules).alias("text"))


def _sql(*steps):
    return f"SELECT doc_id, {rx('x', *steps)} AS text FROM {SRC}"


# Loopback addresses lose their first number while the others are masked.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]\d|\d)"
query("cln17_mask_personal_data", f"""
SELECT doc_id, replace({rx('x', (rf'\b127((?:\.{OCTET}){{3}})\b', r'@LOOP@\1'), (EMAIL, '[EMAIL_REMOVED]'), (IP_ADDRESS, '[IP_REMOVED]'))}, '@LOOP@', '127') AS text FROM {SRC}""")(_rules(w.MASK_PERSONAL_DATA))


def _kept_lines(pattern: str) -> str:
    return f"""SELECT doc_id, array_to_string(list_filter(string_split(x, chr(10)), lambda l: NOT regexp_matches(regexp_replace(regexp_replace(l, '^\\s+', ''), '\\s+$', ''), '{pattern}')), chr(10)) AS text FROM {SRC}"""


query("cln18_drop_bullet_lines", _kept_lines("^[•●■◦▪◆]+$"))(_rules([w.DROP_BULLET_LINES]))
query("cln19_drop_separator_lines", _kept_lines("^(-{4,}|={4,}|_{4,}|~{4,}|[*]{4,}|#{4,})$"))(_rules([w.DROP_SEPARATOR_LINES]))
query("cln23_unwrap_markup", _sql(
    *[(r"\{\{[^{}]*\}\}", "")] * 5, (r"\[\[([^|\]]+)\|([^\]]+)\]\]", r"\2"), (r"\[\[([^\]]+)\]\]", r"\1"), (r"<[^>]*>", ""),
    (r",\s*,", ","), (r",\s*\]", "]"), (r"\[\s*,", "["), (r"[ \t]+", " "), (r"(?m)^\s*,\s*", ""), (r"(?m)\s*,\s*$", ""),
))(_rules(w.UNWRAP_MARKUP))
query("cln26_citations", _sql(
    (r"(?is)<ref[^>]*>.*?</ref>", ""), (r"(?is)<ref[^>]*/>", ""), (r"(?is)\{\{cite[^}]*\}\}", ""), (r"(?is)\{\{(?:צ-|הערה|מקור)[^}]*\}\}", ""),
))(_rules(w.CITATIONS))


@query("cln20_table_attributes", f"""SELECT page_id, {rx('html', ('(?:style|cellspacing|cellpadding|class|width|height)="[^"]*"', ''))} AS html FROM pages""")
def table_attributes(t):
    return spread(t.pages, "page_id").select("page_id", w.DROP_TABLE_ATTRIBUTES(F.col("html")).alias("html"))


@query("cln25_headings", f"""
SELECT doc_id, replace(replace(x, concat('== ', source, ' ==', chr(10)), concat('## ', source, chr(10))), concat('=== ', lang, ' ====', chr(10)), concat('### ', lang, chr(10))) AS text FROM {SRC}""")
def headings(t):
    return wiki(t).select("doc_id", w.headings_to_markdown(F.col("text")).alias("text"))


TABLE = r"(?s)\{\|.*?\|\}"
TABLE_MD = "concat('| class=\"wikitable\" style=\"x\" |', chr(10), '|---|', chr(10), '| ', source, ' | ', lang, ' |', chr(10), CASE WHEN doc_id > 9 THEN concat('| ', doc_id, ' | two |') ELSE '| two |' END)"
TABLE_LIST = f"concat('{w.LIST_HEADING}', chr(10), '- class=\"wikitable\"', chr(10), '- ', source, chr(10), '- ', lang, chr(10), CASE WHEN doc_id > 9 THEN concat('- ', doc_id, chr(10)) ELSE '' END, '- two', chr(10))"


def _table_sql(rendered: str) -> str:
    return f"SELECT doc_id, concat(regexp_extract(x, '(?s)^(.*?)\\{{\\|', 1), {rendered}, regexp_extract(x, '(?s)\\|\\}}(\\n\\[\\[File.*)$', 1)) AS text FROM {SRC}"


@query("cln21_tables_to_markdown", _table_sql(TABLE_MD))
def tables_to_markdown(t):
    return wiki(t).select("doc_id", w.tables_to_markdown(F.col("text")).alias("text"))


@query("cln22_tables_to_lists", _table_sql(TABLE_LIST))
def tables_to_lists(t):
    return wiki(t).select("doc_id", w.tables_to_lists(F.col("text")).alias("text"))


query("cln24_media", None)(_rules(w.MEDIA))
query("cln32_leftovers", None)(_rules(w.LEFTOVER_RULES))


@query("cln27_clean_articles", None)
def clean_articles(t):
    return a.clean_articles(wiki(t)).select("doc_id", "text", "reject_reason", "word_count", "byte_count")


@query("cln27_reject_reasons", """
SELECT CASE WHEN doc_id % 9 = 0 THEN 'redirect' END AS reject_reason, count(*) AS articles FROM documents GROUP BY 1""")
def reject_reasons(t):
    pages = wiki(t).withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit(" #REDIRECT [[x]] "), "text")).otherwise(F.concat("text", F.repeat(F.lit(" filler"), 20))))
    return a.clean_articles(pages).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("articles"))


@query("cln28_text_only", None)
def text_only(t):
    return a.clean_articles(t.docs.select("doc_id", "text"), redirects=False).select("doc_id", "text", "reject_reason")


S = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"


@query("cln31_mark_headings", f"""
WITH l AS (SELECT doc_id, generate_subscripts(p, 1) AS i, {S.format('unnest(p)')} AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
n AS (SELECT *, lead(line, 1, '') OVER (PARTITION BY doc_id ORDER BY i) AS after FROM l)
SELECT doc_id, string_agg(CASE WHEN line <> '' AND length(line) < 100 AND length(after) > 50 AND length(line) - length(replace(line, '.', '')) <= 1
  AND length(line) - length(replace(line, ',', '')) <= 2 AND line NOT LIKE '%.' THEN concat('## ', line) ELSE line END, chr(10) ORDER BY i) AS text FROM n GROUP BY doc_id""")
def mark_headings(t):
    return t.docs.select("doc_id", w.mark_headings(F.col("text")).alias("text"))


@query("smp06_article_rule_examples", None)
def article_rule_examples(t):
    return a.article_rule_examples(wiki(t).select("doc_id", "text"), "doc_id", 5)


@query("flt20_valid_articles", "SELECT doc_id FROM documents WHERE doc_id % 3 = 0 AND length(text) >= 500 AND doc_id % 7 <> 0")
def valid_articles(t):
    pages = t.documents.select("doc_id", (F.col("doc_id") % 3).alias("ns"), F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit(" #REDIRECT "), "text")).otherwise(F.col("text")).alias("text"))
    return a.valid_articles(pages).select("doc_id")


@query("flt25_exact_title", r"SELECT doc_id FROM documents WHERE regexp_matches(regexp_replace(text, '^\s+', ''), '^The([^\p{L}\p{N}_]|$)')")
def exact_title(t):
    return t.documents.where(matches_title(F.col("text"), "The")).select("doc_id")


@query("flt26_similar_titles", rf"""
SELECT doc_id, CASE WHEN length(l) > 80 THEN concat(substring(l, 1, 80), '...') ELSE l END AS title_line FROM (SELECT doc_id, {S.format("split_part(text, chr(10), 1)")} AS l FROM documents)
WHERE contains(lower(l), 'the') ORDER BY doc_id LIMIT 5""")
def similar_titles(t):
    return a.similar_titles(t.documents, "THE", "doc_id")


@query("flt26_containing_anywhere", "SELECT doc_id FROM documents WHERE contains(text, 'example.com') OR contains(source, 'example.com')")
def containing_anywhere(t):
    nested = t.docs.select("doc_id", F.struct("source", F.array("text").alias("parts")).alias("body"))
    return a.containing_anywhere(nested, "example.com").select("doc_id")


@query("flt27_find_by_title", "SELECT doc_id FROM documents WHERE source = 'src7'")
def find_by_title(t):
    return a.find_by_title(t.documents, "src7", "source").select("doc_id")


@query("fun20_article_parts", """
SELECT doc_id, concat(source, '|', lang) AS categories, CASE WHEN length(source) > 2 THEN concat('תיבת מידע - Infobox city: name: ', source) END AS infobox, 1 AS tables FROM documents""")
def article_parts(t):
    return wiki(t).select(
        "doc_id", F.array_join(w.categories(F.col("text")), "|").alias("categories"), w.infobox(F.col("text")).alias("infobox"),
        F.size(w.table_notes(F.col("text"))).alias("tables"))


@query("fun20_summary", f"""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(concat('short', chr(10), chr(10), text), concat(chr(10), chr(10))), lambda x: {S.format('x')}), lambda x: length(x) > 100) AS p FROM documents)
SELECT doc_id, {rx("substring(coalesce(p[1], ''), 1, 500)", (chr(92) + 's+', ' '), *STRIP)} AS summary FROM p""")
def summary(t):
    return t.docs.select("doc_id", w.summary(F.concat(F.lit("short\n\n"), "text")).alias("summary"))


@query("agg13_quality_bands", """
WITH s AS (SELECT least(100, 30 + CASE WHEN length(text) > 3000 THEN 30 WHEN length(text) > 1500 THEN 20 WHEN length(text) > 500 THEN 10 ELSE 0 END
  + CASE WHEN doc_id % 4 > 0 THEN 15 ELSE 0 END + CASE WHEN doc_id % 4 > 2 THEN 5 ELSE 0 END + CASE WHEN doc_id % 2 = 0 THEN 15 ELSE 0 END + CASE WHEN length(text) > 100 THEN 5 ELSE 0 END) AS q FROM documents)
SELECT CASE WHEN q >= 80 THEN 'high' WHEN q >= 60 THEN 'medium' ELSE 'low' END AS band, count(*) AS articles FROM s GROUP BY 1""")
def quality_bands(t):
    box = F.when(F.col("doc_id") % 2 == 0, "box").otherwise("")
    scored = t.documents.select(w.quality_score(F.col("text"), F.col("doc_id") % 4, box, F.col("text")).alias("quality_score"))
    return a.quality_bands(scored)


@query("fun20_sample_articles", None)
def sample_articles(t):
    return a.sample_articles(wiki(t)).select("doc_id", "content", "summary", "infobox", "original_length", "processed_length", "quality_score")


@query("srt04_assemble_chunks", "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def assemble_chunks(t):
    return a.assemble_chunks(t.conversations, "conv_id", "turn", "text")


@query("srt04_ordered_pieces", """
SELECT conv_id, piece, string_agg(text, '' ORDER BY turn) AS text FROM (
  SELECT *, ((sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) - length(text)) // 200)::BIGINT AS piece FROM conversations WHERE text IS NOT NULL) GROUP BY conv_id, piece""")
def ordered_pieces(t):
    return a.assemble_pieces(t.conversations, "conv_id", "turn", "text", piece_chars=200)


ELEMENTS = "CASE WHEN conv_id % 5 = 4 THEN 'not json' ELSE concat('[{\"type\": \"Text\", \"content\": \"', role, '\"}, {\"type\": \"Table\", \"content\": \"| ', turn, ' |\"}]') END"


@query("fun13_ocr_documents", """
SELECT concat('file', conv_id) AS filename, string_agg(concat(role, chr(10), '<MARKDOWN_TABLE>| ', turn, ' |</MARKDOWN_TABLE>', chr(10), chr(10), chr(10)), '' ORDER BY turn) AS text
FROM conversations WHERE conv_id % 5 <> 4 GROUP BY 1""")
def ocr_documents(t):
    uri = F.concat(F.lit("gs://bucket/file"), F.col("conv_id").cast("string"), F.lit("_chunk_"), F.col("turn").cast("string"), F.lit(".png"))
    request = F.struct(F.array(F.struct(F.array(
        F.struct(F.lit("read this").alias("text"), F.lit(None).cast("struct<file_uri:string>").alias("file_data")),
        F.struct(F.lit(None).cast("string").alias("text"), F.struct(uri.alias("file_uri")).alias("file_data")),
    ).alias("parts"))).alias("contents"))
    response = F.struct(F.array(F.struct(F.struct(F.array(F.struct(F.expr(ELEMENTS).alias("text"))).alias("parts")).alias("content"))).alias("candidates"))
    return a.ocr_documents(t.conversations.select(F.to_json(request).alias("request"), F.to_json(response).alias("response")))


@query("fun12_judge_scores", "SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE user_id % 5 + 1 END AS score, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS comments FROM events")
def judge_scores(t):
    body = F.expr("CASE WHEN event_id % 6 = 0 THEN 'broken' ELSE concat('{\"score\": ', user_id % 5 + 1, ', \"comments\": \"', event_type, '\"}') END")
    return t.events.select("event_id", a.judge_scores(body).alias("j")).select("event_id", "j.score", "j.comments")


@query("fun14_judge_requests", "SELECT concat(source, '_random_', doc_id) AS custom_id, substring(text, 1, 10000) AS sample_text, 'judge' AS system FROM documents")
def judge_requests(t):
    made = t.docs.select(a.judge_request(F.concat_ws("_random_", "source", "doc_id"), "score it", F.col("text"), "judge").alias("r"))
    return made.select(
        F.get_json_object("r", "$.custom_id").alias("custom_id"), F.get_json_object("r", "$.request.contents[0].parts[1].text").alias("sample_text"),
        F.get_json_object("r", "$.request.system_instruction.parts[0].text").alias("system"))


@query("fun15_chunk_addresses", """
SELECT page_id, concat('p', page_id) AS source, page_id % 12 AS chunk, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages""")
def chunk_addresses(t):
    uri = F.concat(F.lit("gs://b/x/p"), F.col("page_id").cast("string"), F.lit("_chunk_"), (F.col("page_id") % 12).cast("string"), F.lit(".png"))
    return t.pages.select("page_id", a.chunk_source(uri).alias("source"), a.chunk_number(uri).alias("chunk"), F.regexp_extract("url", r"://([^/]+)", 1).alias("host"))
