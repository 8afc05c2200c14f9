"""De-duplication queries."""

import public_tokenizers
from pyspark.sql import functions as F

from tamis.functions.text import PUNCTUATION_CLASS, word_count
from tamis.operators import dedup as d, training as tr
from tamis.operators.reports import before_after_duplicates
from tamis.plans.registry import query
from tamis.session import run_folder
from tamis.streaming.exact import track_copies, tracked
from tamis.streaming.ingest import read_new_files

CONFIG = d.MinHashConfig()
LINES = r"""list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', '')), lambda x: x <> '')"""


def _minhash_sql() -> str:
    """CTEs ``sh(doc_id, h)`` (distinct shingle hashes) and ``bands(doc_id, band, sig)``."""
    n = CONFIG.n_gram
    gram = " || ' ' || ".join(["w[i]"] + [f"w[i + {k}]" for k in range(1, n)])
    minima = [f"min(({a}::HUGEINT * h + {b}) % {d.PRIME})::BIGINT" for a, b in CONFIG.coefficients()]
    bands = ", ".join(
        "concat_ws(',', " + ", ".join(f"m{b * CONFIG.rows + r}" for r in range(CONFIG.rows)) + ")" for b in range(CONFIG.bands)
    )
    named = ", ".join(f"{m} AS m{i}" for i, m in enumerate(minima))
    return f"""w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(regexp_replace(lower(text), '[{PUNCTUATION_CLASS}]', ' ', 'g'), '\\S+') AS w FROM documents),
g AS (SELECT doc_id, {gram} AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w WHERE len(w) >= {n})
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND {n - 1}),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, ('0x' || substr(md5(g), 1, 15))::BIGINT % {d.PRIME} AS h FROM g),
mins AS MATERIALIZED (SELECT doc_id, {named} FROM sh GROUP BY doc_id),
bands AS MATERIALIZED (SELECT doc_id, generate_subscripts(s, 1) - 1 AS band, unnest(s) AS sig FROM (SELECT doc_id, [{bands}] AS s FROM mins))"""


MINHASH = _minhash_sql()
EDGES = """edges AS MATERIALIZED (SELECT DISTINCT doc_id AS src, dst FROM (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY band, sig) AS dst FROM bands) WHERE doc_id <> dst)"""
COMPONENTS = """both_ways AS MATERIALIZED (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
reach AS (SELECT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
comp AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY a)"""
FULL = f"WITH RECURSIVE {MINHASH}, {EDGES}, {COMPONENTS}"


def _edges(t):
    sigs = d.signatures(t.docs, "doc_id", CONFIG)
    return d.bucket_edges(d.band_keys(sigs, "doc_id", CONFIG), "doc_id")


@query("dup02_exact_rows", f"""
SELECT min(doc_id) AS doc_id, n_words FROM (SELECT doc_id, array_to_string(list_distinct_ordered, chr(10)) AS t,
  len(regexp_extract_all(array_to_string(list_distinct_ordered, chr(10)), '\\S+')) AS n_words FROM (
  SELECT doc_id, list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda z: list_position(l, z[1]) = z[2]), lambda z: z[1]) AS list_distinct_ordered
  FROM (SELECT doc_id, {LINES} AS l FROM documents))) GROUP BY t, n_words""")
def exact_rows(t):
    return d.dedup_lines_and_rows(t.docs.select("doc_id", "text"), "doc_id").select("doc_id", "n_words")


@query("str02_incremental_exact", "SELECT min(doc_id) AS kept_id, count(*) AS copies FROM documents GROUP BY text, lang")
def incremental_exact(t):
    """The table in three increments, the last ids first; every increment is a run of its own."""
    folder, docs = run_folder(t.spark, "increments"), t.documents.select("doc_id", "text", "lang")
    for part in range(3):
        docs.where(F.pmod(-F.col("doc_id"), F.lit(3)) == part).write.mode("append").parquet(f"{folder}/arrived")
        stream = read_new_files(t.spark, f"{folder}/arrived", docs.schema, "parquet")
        track_copies(stream, "doc_id", ["text", "lang"], f"{folder}/copies", f"{folder}/progress").awaitTermination()
    return tracked(t.spark, f"{folder}/copies")


@query("dup02_line_counts", f"""
SELECT sum(len(l))::BIGINT AS total_lines, sum(len(l) - len(list_distinct(l)))::BIGINT AS repeated_lines,
  count(*) FILTER (len(l) <> len(list_distinct(l))) AS rows_modified FROM (SELECT {LINES} AS l FROM documents)""")
def line_counts(t):
    total, repeated = d.line_dedup_counts(F.col("text"))
    rows = t.docs.select(total.alias("n"), repeated.alias("r"))
    return rows.agg(F.sum("n").alias("total_lines"), F.sum("r").alias("repeated_lines"), F.sum((F.col("r") > 0).cast("long")).alias("rows_modified"))


@query("dup03_keep_first", """
SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY lang, source""")
def keep_first(t):
    return d.keep_first(t.documents.select("lang", "source", "doc_id"), ["lang", "source"], ["doc_id"])


@query("dup04_band_signatures", f"WITH {MINHASH} SELECT doc_id, band, sig FROM bands")
def band_signatures(t):
    sigs = d.signatures(t.docs, "doc_id", CONFIG)
    slices = F.array(*[F.array_join(F.slice("signature", b * CONFIG.rows + 1, CONFIG.rows), ",") for b in range(CONFIG.bands)])
    return sigs.select("doc_id", F.posexplode(slices).alias("band", "sig"))


@query("dup05_bucket_edges", f"WITH {MINHASH}, {EDGES} SELECT src, dst FROM edges")
def bucket_edges(t):
    return _edges(t)


@query("dup06_clusters", f"{FULL} SELECT doc_id, component FROM comp")
def clusters(t):
    return d.near_duplicate_clusters(t.docs.select("doc_id", "text"), "doc_id", CONFIG)


@query("dup07_kept_documents", f"{FULL} SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM comp WHERE doc_id <> component)")
def kept_documents(t):
    docs = t.docs.select("doc_id", "source", "text")
    kept, _ = d.split_duplicates(docs, d.near_duplicate_clusters(docs, "doc_id", CONFIG), "doc_id")
    return kept.select("doc_id", "source")


@query("snk05_removed_documents", f"{FULL} SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM comp WHERE doc_id <> component)")
def removed_documents(t):
    docs = t.docs.select("doc_id", "source", "text")
    _, removed = d.split_duplicates(docs, d.near_duplicate_clusters(docs, "doc_id", CONFIG), "doc_id")
    return removed.select("doc_id", "source")


@query("dup08_before_after", f"""{FULL},
k AS (SELECT source, len(regexp_extract_all(text, '\\S+')) AS n, doc_id NOT IN (SELECT doc_id FROM comp WHERE doc_id <> component) AS kept FROM documents)
SELECT source, count(*) AS docs_before, count(*) FILTER (kept) AS docs_after, sum(n)::BIGINT AS words_before,
  coalesce(sum(n) FILTER (kept), 0)::BIGINT AS words_after, round(1 - count(*) FILTER (kept) / count(*), 6) AS duplicate_ratio FROM k GROUP BY source""")
def before_after(t):
    docs = t.docs.select("doc_id", "source", "text")
    return before_after_duplicates(docs, d.near_duplicate_clusters(docs, "doc_id", CONFIG), word_count(F.col("text")))


@query("dup08_token_counts", None)
def before_after_tokens(t):
    """The same in tokens of a public tokenizer file; the tests compare with the library."""
    docs = t.docs.select("doc_id", "source", "text")
    counted = tr.token_counts(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "source", "n_tokens")
    return before_after_duplicates(counted, d.near_duplicate_clusters(docs, "doc_id", CONFIG), F.col("n_tokens"), unit="tokens")


@query("dup09_unique_items", "SELECT min(item_id) AS item_id, text FROM benchmark GROUP BY text")
def unique_items(t):
    return d.drop_exact(t.benchmark, "item_id", ["text"])


@query("dup11_verified_edges", f"""
WITH {MINHASH}, {EDGES}, k AS (SELECT doc_id, count(*) AS k FROM sh GROUP BY doc_id),
s AS (SELECT e.src, e.dst, count(*) AS shared FROM edges e JOIN sh a ON a.doc_id = e.src JOIN sh b ON b.doc_id = e.dst AND a.h = b.h GROUP BY e.src, e.dst)
SELECT src, dst, round(shared / (ka.k + kb.k - shared), 6) AS jaccard FROM s JOIN k ka ON ka.doc_id = src JOIN k kb ON kb.doc_id = dst
WHERE shared / (ka.k + kb.k - shared) >= 0.8""")
def verified_edges(t):
    return d.verified_edges(_edges(t), t.docs, "doc_id", 0.8, CONFIG).select("src", "dst", F.round("jaccard", 6).alias("jaccard"))


@query("dup11_verified_clusters", f"""
WITH RECURSIVE {MINHASH},
pairs AS MATERIALIZED (SELECT DISTINCT a.doc_id AS src, b.doc_id AS dst FROM bands a JOIN bands b ON a.band = b.band AND a.sig = b.sig AND a.doc_id > b.doc_id),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT src, dst, count(*) AS c FROM pairs JOIN sh x ON x.doc_id = src JOIN sh y ON y.doc_id = dst AND x.h = y.h GROUP BY src, dst),
edges AS MATERIALIZED (SELECT src, dst FROM shared JOIN sizes p ON p.doc_id = src JOIN sizes q ON q.doc_id = dst WHERE c / (p.n + q.n - c) >= 0.85),
{COMPONENTS} SELECT doc_id, component FROM comp""")
def verified_clusters(t):
    """All pairs of a bucket count, not only those with its smallest id."""
    return d.near_duplicate_clusters(t.docs.select("doc_id", "text"), "doc_id", CONFIG, min_jaccard=0.85)
