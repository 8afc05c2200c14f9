"""Sampling, splitting, mixing, packing and positional queries."""

import public_tokenizers
from pyspark.sql import functions as F

from tamis.functions.text import word_count
from tamis.operators import reports as r, rows, sampling as s, training as tr
from tamis.plans.derive import N_WORDS
from tamis.plans.registry import query

NW = N_WORDS.format("text")
FILE_KEY = "concat(source, '/', doc_id % 13)"
TOKENS = rf"regexp_extract_all(text, '{r.TOKEN}')"
PRIORITY = ["src7", "src2"]
EXEMPT = ["src7"]
UNIT = "(('0x' || substr(md5(concat_ws('|', '{seed}', {key})), 1, 15))::BIGINT % 10000) / 10000.0"


@query("smp01_files_then_rows", f"""
WITH f AS (SELECT DISTINCT source, {FILE_KEY} AS file_key FROM documents),
c AS (SELECT *, ceil(20.0 / count(*) OVER (PARTITION BY source)) AS quota FROM (
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(concat_ws('|', '42', source, file_key)), file_key) <= 10))
SELECT doc_id, source, file_key FROM (SELECT doc_id, source, {FILE_KEY} AS file_key FROM documents) JOIN c USING (source, file_key)
QUALIFY row_number() OVER (PARTITION BY source, file_key ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id) <= any_value(quota) OVER (PARTITION BY source, file_key)""")
def files_then_rows(t):
    docs = t.documents.select("doc_id", "source", F.expr(FILE_KEY).alias("file_key"))
    return s.sample_files_then_rows(docs, "source", "file_key", "doc_id", 10, 20)


@query("smp04_uniform_allocation", f"""
WITH f AS (SELECT DISTINCT {FILE_KEY} AS file_key FROM documents), n AS (SELECT *, row_number() OVER (ORDER BY file_key) AS i, count(*) OVER () AS k FROM f)
SELECT file_key, (1000 // k + CASE WHEN i <= 1000 % k THEN 1 ELSE 0 END)::BIGINT AS samples FROM n""")
def uniform_allocation(t):
    return s.allocate_uniform(t.documents.select(F.expr(FILE_KEY).alias("file_key")).distinct(), "file_key", 1000)


@query("smp04_random_allocation", None)
def random_allocation(t):
    return s.allocate_random(t.documents.select(F.expr(FILE_KEY).alias("file_key")).distinct(), "file_key", 1000)


@query("smp04_weighted_allocation", f"""
WITH f AS (SELECT DISTINCT {FILE_KEY} AS u FROM documents), w AS (SELECT u, {UNIT.format(seed=42, key='u')} AS w FROM f),
x AS (SELECT u, floor(w / (SELECT sum(w) FROM w) * 1000)::BIGINT AS n, u = (SELECT max(u) FROM f) AS last FROM w)
SELECT u AS file_key, CASE WHEN last THEN 1000 - (SELECT sum(n) FROM x WHERE NOT last) ELSE n END::BIGINT AS samples FROM x""")
def weighted_allocation(t):
    return s.allocate_weighted(t.documents.select(F.expr(FILE_KEY).alias("file_key")).distinct(), "file_key", 1000)


@query("smp05_split", f"SELECT doc_id, CASE WHEN {UNIT.format(seed=42, key='doc_id')} < 0.1 THEN 'validation' ELSE 'train' END AS split FROM documents")
def split(t):
    return tr.with_split(t.documents.select("doc_id"))


@query("smp05_random_pages", "SELECT page_id, url FROM pages ORDER BY md5(concat_ws('|', '42', page_id)), page_id LIMIT 100")
def random_pages(t):
    return s.sample_rows(t.pages.select("page_id", "url"), "page_id", 100)


@query("agg15_valid_rate", f"""
WITH p AS (SELECT {NW} >= 100 AS v FROM documents ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id LIMIT 500)
SELECT count(*) AS scanned, count(*) FILTER (v) AS valid, round(avg(v::INT), 6) AS rate, round(avg(v::INT) * 1500000)::BIGINT AS estimated_total FROM p""")
def valid_rate(t):
    return s.rate_on_sample(t.docs, word_count(F.col("text")) >= 100, "doc_id", 500, 1_500_000)


@query("srt03_first_texts", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 30")
def first_texts(t):
    return tr.first_texts(t.documents.select("doc_id", "source"), 30)


@query("flt21_word_gate", f"SELECT doc_id FROM documents WHERE source = 'src7' OR {NW} <= 300")
def word_gate(t):
    return tr.word_gate(t.docs, 300, EXEMPT).select("doc_id")


MIX = f"""mixed AS (SELECT doc_id, source, CASE source WHEN 'src7' THEN 0 WHEN 'src2' THEN 1 ELSE 2 END AS source_rank FROM documents
  WHERE text <> '' AND (source = 'src7' OR {NW} <= 300) QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 30)"""


@query("trn01_mixture", f"WITH {MIX} SELECT * FROM mixed")
def mixture(t):
    return tr.mixture(t.docs, PRIORITY, 30, 300, EXEMPT).select("doc_id", "source", "source_rank")


@query("snk07_mixture_manifest", f"""
WITH {MIX} SELECT row_number() OVER (ORDER BY source_rank, source) AS position, source, count(*) AS text_count,
  CASE WHEN source = 'src7' THEN 'No' ELSE 'Yes' END AS word_filter, CASE WHEN source = 'src7' THEN 'N/A' ELSE '300' END AS max_words FROM mixed GROUP BY source_rank, source""")
def mixture_manifest(t):
    return tr.mixture_manifest(tr.mixture(t.docs, PRIORITY, 30, 300, EXEMPT), EXEMPT, 300)


@query("trn02_tokens", f"SELECT doc_id, array_to_string(list_slice({TOKENS}, 1, 512), '|') AS tokens FROM documents")
def tokens(t):
    return tr.require_text(t.docs).select("doc_id", F.array_join(tr.tokens(F.col("text"), 512), "|").alias("tokens"))


@query("trn02_token_ids", None)
def token_ids(t):
    """Whole texts by a public tokenizer file; SQL has no tokenizer, the tests compare with the library."""
    made = tr.token_ids(tr.require_text(t.documents).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return made.select("doc_id", F.size("token_ids").alias("n_tokens"), F.crc32(F.array_join("token_ids", ",").cast("binary")).alias("ids_crc32"))


@query("smp01_many_per_source", """
SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id) <= 1500""")
def many_per_language(t):
    """More rows than a task-local limit serves."""
    return s.sample_per_group(t.documents.select("doc_id", "source", "lang"), ["lang"], "doc_id", 1500).select("doc_id", "source")


@query("trn03_pack", None)
def pack(t):
    lengths = tr.document_lengths(t.docs.select("doc_id", "text")).select("doc_id", "n_tokens")
    return tr.pack(lengths, "doc_id", "n_tokens", 4096)


@query("trn03_pack_invariants", f"""
SELECT sum(ceil((len({TOKENS}) + 1) / 4096))::BIGINT AS pieces, true AS fits, sum(len({TOKENS}) + 1)::BIGINT AS tokens FROM documents""")
def pack_invariants(t):
    packed = pack(t)
    bins = packed.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t"), F.max(F.col("start") + F.col("length")).alias("end"))
    return bins.agg(F.sum("n").alias("pieces"), F.bool_and((F.col("t") <= 4096) & (F.col("end") == F.col("t"))).alias("fits"), F.sum("t").alias("tokens"))


@query("trn04_split_info", f"""
SELECT CASE WHEN {UNIT.format(seed=42, key='doc_id')} < 0.1 THEN 'validation' ELSE 'train' END AS split, count(*) AS rows, sum(len({TOKENS}) + 1)::BIGINT AS tokens,
  max(len({TOKENS}) + 1)::BIGINT AS longest, round(avg(len({TOKENS}) + 1), 6) AS avg_tokens FROM documents GROUP BY 1""")
def split_info(t):
    return tr.split_info(tr.with_split(tr.document_lengths(t.docs)), "n_tokens")


@query("trn05_document_lengths", f"SELECT doc_id, (len({TOKENS}) + 1)::BIGINT AS n_tokens FROM documents")
def document_lengths(t):
    return tr.document_lengths(t.docs).select("doc_id", "n_tokens")


@query("win07_every_kth", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i % 15 = 0")
def every_kth(t):
    return rows.every_kth(t.orders.select("o_orderkey"), "o_orderkey", 15)


@query("win07_positions", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i >= 50 AND i < 215")
def positions(t):
    return rows.positions(t.orders.select("o_orderkey"), "o_orderkey", 50, 215)


@query("win07_positions_by_name", """
SELECT name FROM (SELECT concat(source, '/', doc_id) AS name, row_number() OVER (ORDER BY concat(source, '/', doc_id)) - 1 AS i FROM documents) WHERE i >= 70 AND i < 190""")
def positions_by_name(t):
    names = t.documents.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("name"))
    return rows.positions(names, "name", 70, 190)


@query("win01_numbers_by_date", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS n FROM orders""")
def numbers_by_date(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return rows.row_numbers(df, ["o_orderdate", "o_orderkey"], "n", ["o_orderpriority"]).select("o_orderkey", "n")


@query("win07_tail", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 50")
def tail(t):
    return rows.tail(t.orders.select("o_orderkey"), "o_orderkey", 50)


@query("win01_occurrence_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS occurrence FROM orders""")
def occurrence_number(t):
    numbered = rows.row_numbers(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "n", ["o_custkey"])
    return numbered.select("o_orderkey", "o_custkey", (F.col("n") - 1).alias("occurrence"))


@query("jon08_exclude", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def exclude(t):
    big = t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.exclude(t.orders.select("o_orderkey"), big, "o_orderkey")


@query("jon08_select", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def select_ids(t):
    big = t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.select_ids(t.orders.select("o_orderkey"), big, "o_orderkey")
