"""Scan, column resolution, run files and incremental selection."""

from pyspark.sql import functions as F

from tamis.functions.text import word_count
from tamis.plans.registry import query
from tamis.session import run_folder
from tamis.sources import readers as rd, writers as wr


@query("src04_parquet_scan", r"SELECT text, len(regexp_extract_all(text, '\S+')) AS n_words FROM documents")
def parquet_scan(t):
    return rd.resolve_text(t.documents)


@query("src11_pushed_scan", "SELECT text, n_chars FROM documents WHERE text IS NOT NULL")
def pushed_scan(t):
    return rd.read_counted_text(t.spark, f"{t.folder}/documents.parquet", "n_chars")


@query("src08_text_column", r"SELECT 'pages' AS t, url AS text, len(regexp_extract_all(url, '\S+')) AS n_words FROM pages UNION ALL SELECT 'conversations', text, len(regexp_extract_all(text, '\S+')) FROM conversations")
def resolved_text(t):
    pages = rd.resolve_text(t.pages).select(F.lit("pages").alias("t"), "text", "n_words")
    return pages.union(rd.resolve_text(t.conversations).select(F.lit("conversations"), "text", "n_words"))


@query("src08_first_filled", "SELECT doc_id, coalesce(CASE WHEN length(lang) > 10 THEN lang END, CASE WHEN length(text) > 10 THEN text END) AS text FROM documents")
def first_filled(t):
    return t.documents.select("doc_id", rd.first_filled(t.documents, ["message", "lang", "text"], 10).alias("text"))


@query("src05_mixed_folder", r"""
SELECT md5(text) AS digest, count(*) AS n, sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS n_words FROM documents WHERE length(text) > 0 GROUP BY 1""")
def mixed_folder(t):
    """The documents written in five forms below one folder and read back, each file by its own."""
    root, text = run_folder(t.spark, "mixed"), t.documents.where("length(text) > 0")
    part = lambda i: text.where(F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(5)) == i)
    csv = {"quote": '"', "escape": '"', "quoteAll": True, "lineSep": "\n", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    part(0).select("text", "doc_id").write.json(f"{root}/json")
    part(1).select("doc_id", F.col("text").alias("content")).write.json(f"{root}/other json", compression="gzip")
    part(2).select("doc_id", "text").write.options(**csv, header=True).csv(f"{root}/csv")
    part(3).select("text", word_count("text").alias("n_words")).write.options(**csv, header=False).csv(f"{root}/plain csv")
    part(4).select("text").write.parquet(f"{root}/table")
    read = rd.read_mixed(t.spark, root, "part-*")
    return read.groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("n_words"))


@query("src07_sources_of_paths", "SELECT doc_id, source, concat('part', doc_id % 4) AS stem FROM documents")
def sources_of_paths(t):
    path = F.concat(F.lit("file:/data/corpus/"), "source", F.lit("/part"), F.col("doc_id") % 4, F.lit("_cleaned.jsonl"))
    files = t.documents.select("doc_id", path.alias("path"))
    return files.select("doc_id", rd.source_of(F.col("path"), "/data/corpus").alias("source"), wr.finished_stem(F.col("path")).alias("stem"))


RUN = ("concat('{\"results\": {\"all\": {\"acc\": 1.0}, \"t|', event_type, '|5\": {\"acc\": ', value, ', \"acc_stderr\": 0.5}, \"u\": {\"em_with_normalize_gold&normalize_pred\": ', value, '}}, "
       "\"config_tasks\": {\"t|', event_type, '|5\": {\"name\": \"', event_type, '\"}}, \"config_general\": {\"model_name\": \"m', user_id, '\", \"max_samples\": ', event_id, '}}')")


@query("src12_eval_runs", """
SELECT '2025-09-16T19-47-51' AS timestamp, concat('m', user_id) AS model_name, event_id AS samples_number, event_type AS bench, value AS score, 0.5::DOUBLE AS std FROM events
UNION ALL SELECT '2025-09-16T19-47-51', concat('m', user_id), event_id, 'u', value, NULL FROM events""")
def eval_runs(t):
    files = t.events.select(F.concat(F.lit("/runs/2025-09-16T19-47-51/m/results_"), F.col("event_id"), F.lit(".json")).alias("path"), F.expr(RUN).alias("value"))
    return rd.eval_run_rows(files)


@query("src12_details_names", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE concat('plain_', event_id) END AS bench FROM events")
def details_names(t):
    name = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("d/details_community|"), "event_type", F.lit("|5_2025.parquet"))).otherwise(
        F.concat(F.lit("d/plain_"), F.col("event_id").cast("string"), F.lit(".parquet")))
    return t.events.select("event_id", rd.details_benchmark(name).alias("bench"))


@query("snk08_new_inputs", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def new_inputs(t):
    return wr.new_inputs(t.documents.select("doc_id"), t.labels, "doc_id")


@query("snk08_uncounted_sources", r"""
SELECT source, sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS words FROM documents WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) GROUP BY source HAVING count(*) > 20) GROUP BY source""")
def uncounted_sources(t):
    counted = t.documents.select("doc_id", "source").join(t.labels, "doc_id").groupBy("source").count().where("count > 20")
    return wr.new_inputs(t.docs, counted, "source").groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("words"))
