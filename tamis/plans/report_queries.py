"""Counts, drop reports and the flagship source report."""

from pyspark.sql import functions as F

from tamis.functions import cleaning as cl
from tamis.functions.rules import apply_rules
from tamis.functions.text import byte_count, sheet_safe, strip, word_count
from tamis.operators import cleaning as cleaning_op, quality as q, reports as r, rows
from tamis.plans.cleaning_queries import CLEAN_STEPS
from tamis.plans.derive import N_WORDS, STRIP, rx
from tamis.plans.jobs import Job, run_jobs
from tamis.plans.quality_queries import ANNOTATED, MEASURE_SQL, OVERRIDES, PROFILE, annotated
from tamis.plans.registry import query
from tamis.session import run_folder

RULES = [cl.WEB_RULES_BY_NAME[n] for n in ("newline_run", "ip_address", "email")]
CLEANED = rx("text", *CLEAN_STEPS, *STRIP)
TOKENS = rf"len(regexp_extract_all(text, '{r.TOKEN}'))"
NW = N_WORDS.format("text")
FILE_KEY = "concat(source, '/', doc_id % 7)"


def cleaned(t):
    return t.docs.withColumn("cleaned", strip(apply_rules(F.col("text"), RULES)))


LINES_OF_CLEANED = r"list_filter(list_transform(string_split(c, chr(10)), lambda x: regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', '')), lambda x: x <> '')"


@query("source_report", f"""
WITH a AS (SELECT source, text AS raw, {CLEANED} AS c FROM documents),
b AS (SELECT source, raw, {LINES_OF_CLEANED} AS l FROM a),
u AS (SELECT source, raw, array_to_string(list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda z: list_position(l, z[1]) = z[2]), lambda z: z[1]), chr(10)) AS text FROM b),
m AS (SELECT *, {MEASURE_SQL['n_words']} AS w, {MEASURE_SQL['n_real_words']} AS n_real_words, {MEASURE_SQL['dup_line_frac']} AS dup_line_frac, {MEASURE_SQL['solid_lines']} AS solid_lines,
  {MEASURE_SQL['line_punct_ratio']} AS line_punct_ratio, {MEASURE_SQL['list_ratio']} AS list_ratio, {MEASURE_SQL['alpha_ratio']} AS alpha_ratio FROM u),
f AS (SELECT *, CASE WHEN n_real_words < 15 THEN 'gopher_short_doc' WHEN dup_line_frac > 0.34 THEN 'dup_line_frac' WHEN solid_lines = 0 THEN 'empty'
  WHEN line_punct_ratio < 0.05 AND line_punct_ratio <> 0 THEN 'line_punct_ratio' WHEN list_ratio > 0.4 THEN 'list_ratio' WHEN alpha_ratio < 0.6 THEN 'gopher_below_alpha_threshold' END AS reason FROM m)
SELECT coalesce(source, 'Total') AS source, count(*) AS documents, sum({N_WORDS.format('raw')})::BIGINT AS words_before, sum(w)::BIGINT AS words_after,
  count(*) FILTER (reason IS NOT NULL) AS dropped, coalesce(sum(w) FILTER (reason IS NULL), 0)::BIGINT AS words_kept,
  count(*) FILTER (reason = 'gopher_short_doc') AS short_documents, count(*) FILTER (reason = 'line_punct_ratio') AS line_ends FROM f GROUP BY ROLLUP (source)""")
def source_report(t):
    """Clean, drop repeated lines, filter, and report per source, in one pass and one small shuffle."""
    limits = q.Thresholds(
        dup_para_frac=None, dup_para_char_frac=None, dup_line_char_frac=None, top_n_grams={}, dup_n_grams={},
        char_duplicates_ratio=None, max_doc_words=None, min_avg_word_length=None, max_avg_word_length=None,
        max_symbol_word_ratio=None, max_bullet_lines_ratio=None, max_ellipsis_lines_ratio=None,
    )
    unique = cleaning_op.unique_lines(F.col("cleaned"))
    texts = cleaned(t).select("source", word_count(F.col("text")).alias("raw_words"), unique.alias("text"))
    judged = q.annotate_quality(texts, limits, {})
    reason = F.col("filter_reason")
    return r.per_source(judged, [
        F.count(F.lit(1)).alias("documents"), F.sum("raw_words").alias("words_before"), F.sum("n_words").alias("words_after"),
        F.count_if(reason.isNotNull()).alias("dropped"),
        F.coalesce(F.sum(F.when(reason.isNull(), F.col("n_words"))), F.lit(0)).alias("words_kept"),
        F.count_if(reason == "gopher_short_doc").alias("short_documents"), F.count_if(reason == "line_punct_ratio").alias("line_ends"),
    ])


@query("agg01_words_per_source", f"SELECT source, sum(coalesce(CASE WHEN doc_id % 3 = 0 THEN n_chars END, {NW}))::BIGINT AS words FROM documents GROUP BY source")
def words_per_source(t):
    known = t.docs.withColumn("given", F.when(F.col("doc_id") % 3 == 0, F.col("n_chars")))
    return r.words_per_source(known, n_words_col="given")


@query("agg02_before_after", f"""
SELECT coalesce(source, 'Total') AS source, count(*) AS documents, sum({NW})::BIGINT AS words_before, sum({N_WORDS.format(CLEANED)})::BIGINT AS words_after,
  round((sum({NW}) - sum({N_WORDS.format(CLEANED)})) * 100.0 / sum({NW}), 6)::DOUBLE AS reduction_percent FROM documents GROUP BY ROLLUP (source)""")
def before_after(t):
    return r.before_after(cleaned(t), "text", "cleaned")


@query("jon07_raw_against_cleaned", f"""
WITH c AS (SELECT source, sum({N_WORDS.format(CLEANED)}) AS w FROM documents WHERE source <> 'src4' GROUP BY source),
r AS (SELECT source, sum({NW}) AS w FROM documents WHERE source <> 'src9' GROUP BY source)
SELECT source, coalesce(r.w, 0)::BIGINT AS raw_words, coalesce(c.w, 0)::BIGINT AS cleaned_words FROM r FULL JOIN c USING (source)""")
def raw_against_cleaned(t):
    done = cleaned(t).where("source <> 'src4'").select("source", F.col("cleaned").alias("text"))
    return r.raw_against_cleaned(t.docs.where("source <> 'src9'"), done)


@query("agg03_file_counts", f"SELECT source, {FILE_KEY} AS file_key, sum({NW})::BIGINT AS word_count, sum({TOKENS})::BIGINT AS token_count FROM documents GROUP BY ALL")
def file_counts(t):
    return r.file_counts(t.docs.withColumn("file_key", F.expr(FILE_KEY)))


@query("agg04_counts_summary", f"""
WITH c AS (SELECT source, sum({NW}) AS w, sum({TOKENS}) AS k FROM documents GROUP BY source)
SELECT source, w::BIGINT AS total_words, round(w * 100.0 / sum(w) OVER (), 2)::DOUBLE AS percent_words, k::BIGINT AS total_tokens, round(k * 100.0 / sum(k) OVER (), 2)::DOUBLE AS percent_tokens FROM c
UNION ALL SELECT 'Total', sum(w)::BIGINT, 100, sum(k)::BIGINT, 100 FROM c
UNION ALL SELECT 'Total (millions)', round(sum(w) / 1e6)::BIGINT, NULL, round(sum(k) / 1e6)::BIGINT, NULL FROM c""")
def counts_summary(t):
    return r.counts_summary(r.file_counts(t.docs.withColumn("file_key", F.expr(FILE_KEY))))


@query("agg05_size_report", f"""
WITH {ANNOTATED} SELECT coalesce(source, 'Total') AS source, coalesce(sum(strlen(text)) FILTER (filter_reason IS NULL), 0)::BIGINT AS output_bytes,
  coalesce(sum(strlen(text)) FILTER (filter_reason IS NOT NULL), 0)::BIGINT AS removed_bytes,
  round(coalesce(sum(strlen(text)) FILTER (filter_reason IS NOT NULL), 0) * 100.0 / sum(strlen(text)), 6)::DOUBLE AS filter_percent FROM annotated GROUP BY ROLLUP (source)""")
def size_report(t):
    return r.size_report(annotated(t))


@query("agg06_drop_summary", f"""
WITH {ANNOTATED}, rc AS (SELECT source, filter_reason, count(*) AS n FROM annotated WHERE filter_reason IS NOT NULL GROUP BY ALL),
top AS (SELECT source, string_agg(concat(filter_reason, ':', n), ',' ORDER BY n DESC, filter_reason) AS top_reasons FROM (
  SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, filter_reason) <= 5) GROUP BY source)
SELECT source, count(*) AS total_samples, count(filter_reason) AS samples_dropped, round(count(filter_reason) * 100.0 / count(*), 6)::DOUBLE AS drop_percentage,
  sum(n_words)::BIGINT AS words_before, coalesce(sum(n_words) FILTER (filter_reason IS NULL), 0)::BIGINT AS words_after,
  coalesce(sum(n_words) FILTER (filter_reason IS NOT NULL), 0)::BIGINT AS words_dropped, coalesce(any_value(top_reasons), '') AS top_reasons
FROM annotated LEFT JOIN top USING (source) GROUP BY source""")
def drop_summary(t):
    return r.drop_summary(annotated(t))


@query("agg07_reason_counts", f"""
WITH {ANNOTATED}, c AS (SELECT source, filter_reason, count(*) AS documents FROM annotated GROUP BY ALL)
SELECT source, filter_reason, documents, round(of_total, 6) AS of_total, round(of_dropped, 6) AS of_dropped FROM (
  SELECT *, documents / sum(documents) OVER (PARTITION BY source) AS of_total,
    documents / sum(documents) FILTER (filter_reason IS NOT NULL) OVER (PARTITION BY source) AS of_dropped FROM c) WHERE filter_reason IS NOT NULL""")
def reason_counts(t):
    out = r.reason_counts(annotated(t))
    return out.withColumns({c: F.round(c, 6) for c in ("of_total", "of_dropped")})


@query("agg08_reason_summary", f"""
WITH {ANNOTATED}, c AS (SELECT filter_reason, count(*) AS n, sum(n_words) AS w FROM annotated WHERE filter_reason IS NOT NULL GROUP BY ALL)
SELECT filter_reason, n AS documents, w::BIGINT AS total_words, round((w / n)::DOUBLE, 2) AS average_words, round((n / sum(n) OVER () * 100)::DOUBLE, 2) AS documents_percent,
  round((w / sum(w) OVER () * 100)::DOUBLE, 2) AS words_percent FROM c""")
def reason_summary(t):
    return r.reason_summary(annotated(t))


@query("snk06_group_statistics", f"""
WITH {ANNOTATED}, c AS (SELECT filter_group, filter_reason, count(*) AS n, sum(n_words) AS w FROM annotated WHERE filter_reason IS NOT NULL GROUP BY ALL)
SELECT filter_group, filter_reason, n AS documents, w::BIGINT AS total_words, round((w / n)::DOUBLE, 2) AS average_words, sum(n) OVER (PARTITION BY filter_group)::BIGINT AS group_documents FROM c""")
def group_statistics(t):
    return r.report_tables(annotated(t), texts=t.documents)["group_statistics"]


EXAMPLES = f"""WITH {ANNOTATED}, e AS (SELECT *, row_number() OVER (PARTITION BY filter_reason ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id) AS example
  FROM annotated WHERE filter_reason IS NOT NULL QUALIFY example <= 30)"""


@query("snk06_examples_preview", f"""{EXAMPLES}
SELECT filter_reason, example, doc_id, filter_group, n_words, CASE WHEN length(text) > 200 THEN concat(substring(text, 1, 200), '...') ELSE text END AS text_preview FROM e""")
def examples_preview(t):
    return r.report_tables(annotated(t), texts=t.documents)["examples_preview"]


@query("smp03_full_examples", f"{EXAMPLES} SELECT filter_reason, example, doc_id, filter_group, n_words, substring(text, 1, 32767) AS full_text FROM e")
def full_examples(t):
    # As a sheet would hold it.
    return r.report_tables(annotated(t), texts=t.documents)["full_examples"].withColumn("full_text", sheet_safe(F.col("full_text")))


@query("smp03_whole_examples", f"{EXAMPLES} SELECT filter_reason, example, doc_id, filter_group, n_words, text AS full_text FROM e")
def whole_examples(t):
    return r.report_tables(annotated(t), texts=t.documents)["full_examples"]


@query("snk06_examples_with_place", f"""{EXAMPLES}
SELECT filter_reason, example, doc_id, filter_group, n_words, {FILE_KEY} AS file_path, map {{'lang': lang}}['lang'] AS lang, text AS full_text FROM e""")
def examples_with_place(t):
    # Both engines make up the file of a document; its language stands for the metadata.
    texts = t.documents.withColumn("file_path", F.concat("source", F.lit("/"), (F.col("doc_id") % 7).cast("string"))).withColumn("metadata", F.create_map(F.lit("lang"), "lang"))
    found = r.report_tables(annotated(t), texts=texts)["full_examples"]
    return found.withColumn("lang", F.col("metadata")["lang"]).drop("metadata")


@query("srt01_filter_counts", f"WITH {ANNOTATED} SELECT filter_reason, count(*) AS documents FROM annotated WHERE filter_reason IS NOT NULL GROUP BY 1")
def filter_counts(t):
    return r.report_tables(annotated(t), texts=t.documents)["filter_counts"]


@query("srt01_top_reasons", f"WITH {ANNOTATED} SELECT filter_reason, count(*) AS documents FROM annotated WHERE filter_reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_reasons(t):
    return r.report_tables(annotated(t), texts=t.documents)["filter_counts"].limit(5)


@query("jon11_reason_evidence", f"""
WITH {ANNOTATED}, c AS (SELECT source, filter_reason, n / sum(n) OVER (PARTITION BY source) AS p FROM (SELECT source, filter_reason, count(*) AS n FROM annotated GROUP BY ALL)),
e AS (SELECT source, filter_reason, doc_id FROM annotated WHERE filter_reason IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source, filter_reason ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id) <= 3)
SELECT source, filter_reason, doc_id, round(p, 6) AS reason_filter_prob FROM e JOIN c USING (source, filter_reason)""")
def reason_evidence(t):
    out = r.reason_evidence(annotated(t), per_reason=3)
    return out.withColumn("reason_filter_prob", F.round("reason_filter_prob", 6))


@query("smp02_sample_per_reason", f"""
WITH {ANNOTATED} SELECT doc_id, filter_reason FROM annotated WHERE filter_reason IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY filter_reason ORDER BY md5(concat_ws('|', '7', doc_id)), doc_id) <= 20""")
def sample_per_reason(t):
    removed = annotated(t).where("filter_reason IS NOT NULL").select("doc_id", "filter_reason")
    return r.sample_per_group(removed, ["filter_reason"], "doc_id", 20, 7)


@query("snk04_pass_and_removed", f"WITH {ANNOTATED} SELECT coalesce(filter_group, 'output') AS folder, source, count(*) AS documents, sum(n_words)::BIGINT AS words FROM annotated GROUP BY ALL")
def pass_and_removed(t):
    folder = F.coalesce("filter_group", F.lit("output")).alias("folder")
    return annotated(t).groupBy(folder, "source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_words").alias("words"))


@query("jon10_limit_lookup", f"""
SELECT d.doc_id, coalesce(o.max_words, 100000)::DOUBLE AS max_words, (len(regexp_extract_all(text, '\\S+')) <= coalesce(o.max_words, 100000)) AS fits
FROM documents d LEFT JOIN (VALUES ('src3', 200), ('src17', 90)) o(source, max_words) USING (source)""")
def limit_lookup(t):
    limit = q.Limits(q.Thresholds(), {"src3": {"max_doc_words": 200}, "src17": {"max_doc_words": 90}}, F.col("source")).max_doc_words
    return t.docs.select("doc_id", limit.alias("max_words"), (word_count(F.col("text")) <= limit).alias("fits"))


@query("agg12_length_overview", f"""
SELECT count(*) AS articles, sum({NW})::BIGINT AS total_words, round(avg({NW}), 6) AS avg_words, min({NW})::BIGINT AS min_words, max({NW})::BIGINT AS max_words,
  sum(strlen(text))::BIGINT AS total_bytes, round(avg(strlen(text)), 6) AS avg_bytes, min(strlen(text)) AS min_bytes, max(strlen(text)) AS max_bytes FROM documents""")
def length_overview(t):
    return r.length_overview(t.docs)


@query("agg30_multiplicity", "SELECT times, count(*) AS values FROM (SELECT count(*) AS times FROM documents GROUP BY text) GROUP BY times")
def multiplicity(t):
    return r.multiplicity(t.documents, ["text"])


@query("win06_share_of_total", "SELECT source, round(sum(n_chars) / sum(sum(n_chars)) OVER (), 6) AS share FROM documents GROUP BY source")
def share_of_total(t):
    counts = r.file_counts(t.docs.withColumn("file_key", F.lit("all")), counter=lambda c: F.length(c))
    # The shares of the summary are percentages rounded to 2 digits; this is the raw share.
    from pyspark.sql import Window

    return counts.select("source", F.round(F.col("token_count") / F.sum("token_count").over(Window.partitionBy()), 6).alias("share"))


@query("udf05_job_counts", f"""
WITH {ANNOTATED}, distinct_texts AS (SELECT text, any_value(n_words) AS n FROM annotated GROUP BY text, lang)
SELECT 'gates' AS job, count(*) AS documents, 0::BIGINT AS copies, count(filter_reason) AS removed, count(*) - count(filter_reason) AS kept,
  coalesce(sum(n_words) FILTER (filter_reason IS NULL), 0)::BIGINT AS words_kept FROM annotated
UNION ALL SELECT 'copies', (SELECT count(*) FROM documents), (SELECT count(*) FROM documents) - count(*), 0, count(*), sum(n)::BIGINT FROM distinct_texts""")
def job_counts(t):
    path, out = f"{t.folder}/documents.parquet", run_folder(t.spark, "jobs")
    return run_jobs(t.spark, [
        Job("gates", path, gates=PROFILE, overrides=OVERRIDES, sinks={"filtered": f"{out}/filtered", "report": f"{out}/report"}),
        Job("copies", path, exact=("text", "lang"), sinks={"by_source": f"{out}/sources"}),
    ])


@query("snk02_size_chunks", """
SELECT doc_id, source, floor((sum(strlen(text) + 50) OVER (PARTITION BY source ORDER BY doc_id) - (strlen(text) + 50)) / 20000)::BIGINT AS chunk FROM documents""")
def size_chunks(t):
    rows_in = t.docs.select("doc_id", "source", byte_count(F.col("text")).alias("n"))
    return rows.size_chunks(rows_in, "doc_id", F.col("n") + 50, 20000, ["source"]).select("doc_id", "source", "chunk")


@query("snk02_size_chunks_by_name", """
SELECT name, floor((sum(strlen(text) + 50) OVER (PARTITION BY source ORDER BY name) - (strlen(text) + 50)) / 20000)::BIGINT AS chunk
FROM (SELECT concat(lang, '/', doc_id) AS name, source, text FROM documents)""")
def size_chunks_by_name(t):
    named = t.docs.select(F.concat("lang", F.lit("/"), F.col("doc_id").cast("string")).alias("name"), "source", byte_count(F.col("text")).alias("n"))
    return rows.size_chunks(named, "name", F.col("n") + 50, 20000, ["source"]).select("name", "chunk")


@query("win05_running_bytes", "SELECT doc_id, sum(strlen(text)) OVER (ORDER BY doc_id)::BIGINT AS bytes_so_far FROM documents")
def running_bytes(t):
    sized = t.docs.select("doc_id", byte_count(F.col("text")).alias("n"))
    return rows.running_total(sized, "doc_id", F.col("n"), "bytes_so_far").select("doc_id", "bytes_so_far")


__all__ = ["OVERRIDES"]
