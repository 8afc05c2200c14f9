"""The registered queries of this subpackage, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tamis.llm.collocations import mine_collocations
from tamis.llm.contamination import contaminated
from tamis.llm.frames import small_batches
from tamis.llm.id_coder import read_token_files, write_token_files
from tamis.llm.near_duplicates import near_duplicate_classes
from tamis.llm.nested_secrets import scan_secrets
from tamis.llm.ngram_quality import judge_quality
from tamis.llm.order_packing import pack_in_order
from tamis.llm.repeated_passages import remove_repeated_passages
from tamis.llm.spelling_variants import spelling_variants
from tamis.llm.top_k import exact_top_k, finite, quantised
from tamis.llm.toxic_neighbours import score_toxicity
from tamis.llm.two_fit_packing import pack_documents
from tamis.llm.url_templates import Rule, judge_urls
from tamis.session import ensure_checkpoint_dir

# The rules of the query, as verdict, host and path.
RULES = [
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which driver and executors all reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").where(finite(F.col("embedding"))).select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return exact_top_k(vectors.where("vec_id % 50 = 0"), vectors)


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(table(spark, folder, "documents"))


def op3_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    done = remove_repeated_passages(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = shared_folder(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), files, public_tokenizers.path("word_bpe_49k.json"), joiner="drop")
    read = read_token_files(spark.read.parquet(files))
    return read.select(
        F.col("id").alias("doc_id"), "start", (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.crc32("tokens").alias("ids_crc32"),
    )


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), RULES)


def op7_contamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.round("containment", 9).alias("containment"))


def op8_two_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), joiner="lead")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return judge_quality(table(spark, folder, "documents"), trusted)


def op11_order_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_in_order(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = mine_collocations(table(spark, folder, "documents"), shared_folder(spark, "collocations"))
    numbers = ("rank", "a", "l", "r", "n", "score")
    return found.select("lang", "phrase", *[F.col(c).cast("long").alias(c) for c in numbers])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_top_k, op2_near_duplicates, op3_repeated_passages, op4_token_files, op5_secrets, op6_url_verdicts, op7_contamination,
        op8_two_fit_packing, op9_toxicity, op10_quality, op11_order_packing, op12_spelling_variants, op13_collocations,
    )
}

def crc32_sql(byte_list: str) -> str:
    """DuckDB expression of the crc32 of a list of bytes, with the table of remainders by its rule."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    step = f"xor(c >> 8, CAST({table} AS BIGINT[])[CAST(xor(c & 255, b) AS BIGINT) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte_list}), lambda c, b: {step}), 4294967295::BIGINT)"


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES = {
    "op1_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5""",
    "op3_repeated_passages": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), windows AS (
            SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
        ), repeated AS (
            SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM windows) WHERE c > 1
        ), gone AS (
            SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM repeated) GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, count(*) FILTER (j IS NOT NULL) AS n_kept, coalesce(string_agg(x, ' ' ORDER BY j), '') AS kept_text
            FROM (
                SELECT doc_id, j, ws[j] AS x FROM (
                    SELECT w.doc_id, ws, js, unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE range(1, len(ws) + 1) END) AS j
                    FROM w LEFT JOIN gone USING (doc_id)
                ) WHERE j IS NULL OR js IS NULL OR NOT list_contains(js, j)
            ) GROUP BY doc_id
        )
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(kept_text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_contamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(lower(text), '\S+') AS ws FROM documents WHERE doc_id IS NOT NULL
        ), b AS (
            SELECT item_id, regexp_extract_all(lower(text), '\S+') AS ws FROM benchmark WHERE item_id IS NOT NULL
        ), ds AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
        ), bs AS (
            SELECT DISTINCT item_id, array_to_string(ws[i : i + 4], ' ') AS s
            FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM b WHERE len(ws) >= 5)
        ), sizes AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id)
        SELECT doc_id, item_id, round(CAST(count(*) AS DOUBLE) / any_value(n), 9) AS containment
        FROM ds JOIN bs USING (s) JOIN sizes USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n) - 1e-9""",
    # Pairs of near words share what is left after one letter is deleted.
    "op12_spelling_variants": rf"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{CAPITALS}', '{SMALL}') AS run FROM documents
        ), counted AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, count(*) AS n FROM runs GROUP BY ALL
        ), hashed AS (
            SELECT run, n, {crc32_sql("flatten(list_transform(string_split(named, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::BIGINT[] END))")} AS h
            FROM counted WHERE length(run) >= 6
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
                FROM hashed
            ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), less AS (
            SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
            UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word
        ), best AS (
            SELECT word, near, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, near) AS place FROM pairs
        ), known AS (
            SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN near END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
            FROM words w LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (word)
        ), chain AS (
            SELECT word, word AS root, 0 AS steps FROM known
            UNION ALL SELECT c.word, k.form, steps + 1 FROM chain c JOIN known k ON c.root = k.word WHERE k.form IS NOT NULL
        ), roots AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
        SELECT word, form, root, n, n_near, form_n FROM known JOIN roots USING (word)""",
    "op13_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
        ), f AS (
            SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS n
            FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 5) t(k) WHERE len(ws) >= k) GROUP BY ALL
        ), totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
        ), cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND n >= 30
        ), cuts AS (
            SELECT *, array_to_string(ws[1 : j], ' ') AS left_part, array_to_string(ws[j + 1 : k], ' ') AS right_part
            FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)
        ), scores AS (
            SELECT c.lang, c.phrase, a, x.n AS l, y.n AS r, 2000000::HUGEINT * a // (x.n + y.n) AS score,
                row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 2000000::HUGEINT * a // (x.n + y.n), j) AS place
            FROM cuts c JOIN f x ON c.lang = x.lang AND c.left_part = x.phrase JOIN f y ON c.lang = y.lang AND c.right_part = y.phrase
        ), inside AS (
            SELECT lang, array_to_string(ws[i : i + s - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM cand, range(2, 4) t(s) WHERE s < k) GROUP BY ALL
        ), ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM scores s LEFT JOIN inside USING (lang, phrase) WHERE place = 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
        )
        SELECT lang, rank, phrase, a, l, r, totals.n AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
