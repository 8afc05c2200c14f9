"""Quality gates: each measure, per-source limits, first failing reason."""

from pyspark.sql import functions as F

from tamis.functions.text import PUNCTUATION_CLASS, words
from tamis.operators import quality as q
from tamis.plans.derive import rx
from tamis.plans.registry import query
from tamis.session import spread

P = PUNCTUATION_CLASS
W = r"regexp_extract_all(text, '\S+')"
SOLID = r"list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S'))"
RUNS = r"string_split_regex(text, '\n+')"
PARAS = rf"string_split_regex({rx('text', (r'^\s+', ''), (r'\s+$', ''))}, '\n{{2,}}')"
REAL = rf"list_filter({W}, lambda w: regexp_matches(w, '[^{P}]'))"
NL = "(length(text) - length(replace(text, chr(10), '')))"
N_LINES = f"({NL} + CASE WHEN text LIKE concat('%', chr(10)) THEN 0 ELSE 1 END)"
ENDS = q.STOP_CHARACTERS


def chars(items: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: length(x))), 0)"


def dup_chars(items: str) -> str:
    return f"({chars(items)} - {chars(f'list_distinct({items})')})"


MEASURE_SQL = {
    "n_words": f"len({W})",
    "n_real_words": f"len({REAL})",
    "mean_word_length": f"{chars(REAL)} / nullif(len({REAL}), 0)",
    "dup_para_frac": f"(len({PARAS}) - len(list_distinct({PARAS}))) / len({PARAS})",
    "dup_para_char_frac": f"{dup_chars(PARAS)} / nullif(length(text), 0)",
    "dup_line_frac": f"(len({RUNS}) - len(list_distinct({RUNS}))) / len({RUNS})",
    "dup_line_char_frac": f"{dup_chars(RUNS)} / nullif(length(text), 0)",
    "solid_lines": f"len({SOLID})",
    "line_punct_ratio": f"len(list_filter({SOLID}, lambda x: regexp_matches(x, '[{ENDS}]$'))) / nullif(len({SOLID}), 0)",
    "short_line_ratio": f"len(list_filter({SOLID}, lambda x: length(x) <= 30)) / nullif(len({SOLID}), 0)",
    "char_dup_ratio": f"{dup_chars(SOLID)} / nullif(length(replace(text, chr(10), '')), 0)",
    "list_ratio": f"{NL} / nullif(len({W}), 0)",
    "hash_ratio": f"(length(text) - length(replace(text, '#', ''))) / nullif(len({W}), 0)",
    "ellipsis_ratio": rf"len(regexp_extract_all(text, '\.\.\.|…')) / nullif(len({W}), 0)",
    "bullet_ratio": rf"len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\s*[•\-]'))) / nullif({N_LINES}, 0)",
    "ellipsis_line_ratio": rf"len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) / nullif({N_LINES}, 0)",
    "alpha_ratio": rf"len(list_filter({W}, lambda w: regexp_matches(w, '\p{{L}}'))) / nullif(len({W}), 0)",
    "stop_words": f"len(list_distinct(list_filter({W}, lambda w: w IN ('the', 'of', 'and', 'der', 'die', 'de', 'la', 'el'))))",
}
STOP = ("the", "of", "and", "der", "die", "de", "la", "el")
INTEGERS = {"n_words", "n_real_words", "solid_lines", "stop_words"}

GATES = {
    "flt01_short_documents": ["n_words", "n_real_words"],
    "flt02_duplicate_lines": ["dup_line_frac"],
    "flt05_duplicate_paragraphs": ["dup_para_frac", "dup_para_char_frac", "dup_line_char_frac"],
    "flt06_line_ends": ["solid_lines", "line_punct_ratio"],
    "flt07_short_lines": ["short_line_ratio"],
    "flt08_duplicate_line_chars": ["char_dup_ratio"],
    "flt09_newlines_per_word": ["list_ratio"],
    "flt11_mean_word_length": ["mean_word_length"],
    "flt12_symbols_per_word": ["hash_ratio", "ellipsis_ratio"],
    "flt13_bullet_lines": ["bullet_ratio"],
    "flt14_ellipsis_lines": ["ellipsis_line_ratio"],
    "flt15_alphabetic_words": ["alpha_ratio"],
    "flt16_stop_words": ["stop_words"],
}


def _sql(names):
    cols = ", ".join(
        f"({MEASURE_SQL[n]})::BIGINT AS {n}" if n in INTEGERS else f"round({MEASURE_SQL[n]}, 6) AS {n}" for n in names
    )
    return f"SELECT doc_id, {cols} FROM documents"


def _gate(names):
    def run(t):
        m = q.measures(F.col("text"), q.Thresholds(stop_words=STOP))
        cols = [m[n].cast("long").alias(n) if n in INTEGERS else F.round(m[n], 6).alias(n) for n in names]
        return t.docs.select("doc_id", *cols)

    return run


for gate, names in GATES.items():
    query(gate, _sql(names))(_gate(names))


def _top_sql(n: int) -> str:
    gram = " || ' ' || ".join(["w[i]"] + [f"w[i + {k}]" for k in range(1, n)])
    return f"""SELECT doc_id, arg_max(k * length(g), k * 1000000 + length(g)) AS top_{n}
  FROM (SELECT doc_id, g, count(*) AS k FROM (SELECT doc_id, {gram} AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w)) GROUP BY doc_id, g) GROUP BY doc_id"""


TOP_SQL = f"""w AS (SELECT doc_id, {W} AS w FROM documents), g2 AS ({_top_sql(2)}), g3 AS ({_top_sql(3)}), g4 AS ({_top_sql(4)})"""


@query("flt03_top_n_grams", f"""
WITH {TOP_SQL} SELECT d.doc_id, coalesce(top_2, 0)::BIGINT AS top_2, coalesce(top_3, 0)::BIGINT AS top_3, coalesce(top_4, 0)::BIGINT AS top_4
FROM documents d LEFT JOIN g2 USING (doc_id) LEFT JOIN g3 USING (doc_id) LEFT JOIN g4 USING (doc_id)""")
def top_n_grams(t):
    w = t.docs.select("doc_id", words(F.col("text")).alias("w"))
    return w.select("doc_id", *[q.top_n_gram_chars(F.col("w"), n).alias(f"top_{n}") for n in (2, 3, 4)])


@query("flt03_top_n_grams_scan", f"""
WITH {TOP_SQL} SELECT d.doc_id, coalesce(top_2, 0)::BIGINT AS top_2, coalesce(top_3, 0)::BIGINT AS top_3, coalesce(top_4, 0)::BIGINT AS top_4
FROM documents d LEFT JOIN g2 USING (doc_id) LEFT JOIN g3 USING (doc_id) LEFT JOIN g4 USING (doc_id)""")
def top_n_grams_scan(t):
    """The same counts from the Arrow scan."""
    scanned = t.docs.select("doc_id", q.n_gram_scan([2, 3, 4], [5])("text").alias("g"))
    return scanned.select("doc_id", *[F.col("g")[i].alias(f"top_{n}") for i, n in enumerate((2, 3, 4))])


SIZES = [5, 6, 7, 8, 9, 10]
GRAMS = r"""w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS ws FROM documents),
grams AS (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, range(5, 11) t(n) WHERE len(ws) >= n))"""


def _by_size(name: str, value: str) -> str:
    return ", ".join(f"coalesce(max({value}) FILTER (n = {n}), 0)::BIGINT AS {name}_{n}" for n in SIZES)


# A step of the recursion takes the next place whose n-gram occurs before it.  It is a hit if the scan
# has not jumped past it and some earlier occurrence was not jumped over.
@query("flt04_repeated_n_grams", f"""
WITH RECURSIVE {GRAMS},
several AS MATERIALIZED (SELECT doc_id, n, i, gram FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, n, gram) > 1),
places AS (SELECT doc_id, n, i, length(gram) - (n - 1) AS len, list(i) OVER (PARTITION BY doc_id, n, gram ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM several),
again AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, n ORDER BY i) AS k FROM places WHERE len(earlier) > 0),
walk AS (
  SELECT DISTINCT doc_id, n, 0::BIGINT AS k, 0::BIGINT AS free, 0::BIGINT AS chars, []::BIGINT[] AS hits FROM again
  UNION ALL
  SELECT doc_id, n, k, CASE WHEN hit THEN i + n ELSE free END, chars + CASE WHEN hit THEN len ELSE 0 END, CASE WHEN hit THEN list_append(hits, i) ELSE hits END FROM (
    SELECT a.doc_id, a.n, a.k, a.i, a.len, free, chars, hits,
      a.i >= free AND len(list_filter(earlier, lambda q: len(list_filter(hits, lambda h: q > h AND q < h + a.n)) = 0)) > 0 AS hit
    FROM walk JOIN again a ON walk.doc_id = a.doc_id AND walk.n = a.n AND a.k = walk.k + 1))
SELECT d.doc_id, {_by_size("dup", "chars")} FROM documents d LEFT JOIN walk USING (doc_id) GROUP BY d.doc_id""")
def repeated_n_grams(t):
    scanned = t.docs.select("doc_id", q.n_gram_scan([], SIZES)("text").alias("d"))
    return scanned.select("doc_id", *[F.col("d")[i].alias(f"dup_{n}") for i, n in enumerate(SIZES)])


@query("flt04_words_in_repeats", f"""
WITH {GRAMS},
later AS (SELECT doc_id, n, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, n, gram ORDER BY i) AS k FROM grams) WHERE k > 1),
covered AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS j FROM later),
lengths AS (SELECT doc_id, generate_subscripts(ws, 1) AS j, length(unnest(ws)) AS len FROM w),
sums AS (SELECT doc_id, n, sum(len) AS chars FROM covered JOIN lengths USING (doc_id, j) GROUP BY ALL)
SELECT d.doc_id, {_by_size("rep", "chars")} FROM documents d LEFT JOIN sums USING (doc_id) GROUP BY d.doc_id""")
def words_in_repeats(t):
    scanned = t.docs.select("doc_id", q.repeated_n_gram_scan(SIZES)("text").alias("d"))
    return scanned.select("doc_id", *[F.col("d")[i].alias(f"rep_{n}") for i, n in enumerate(SIZES)])


# Limits used by the reports: the default profile without the order-dependent n-gram
# scan, plus some limits by source.
PROFILE = q.Thresholds(dup_n_grams={}, stop_words=STOP, min_stop_words=1)
OVERRIDES = {
    "src3": {"max_doc_words": 200},
    "src5": {"min_doc_words": 60, "line_punct_thr": 0.5},
    "src7": {"max_avg_word_length": 5.5},
    "src11": {"dup_line_frac": 0.0, "top_n_grams": {2: 0.02}},
    "src13": {"new_line_ratio": 0.01, "max_non_alpha_words_ratio": 0.99},
}


def _limit(name: str, default) -> str:
    cases = " ".join(f"WHEN '{s}' THEN {float(o[name])}" for s, o in OVERRIDES.items() if name in o)
    return f"CASE source {cases} ELSE {float(default)} END" if cases else str(float(default))


def _n_gram_limit(n: int) -> str:
    return f"CASE source WHEN 'src11' THEN {'0.02' if n == 2 else 'NULL'} ELSE {PROFILE.top_n_grams[n]} END"


def annotated_sql() -> str:
    """CTE chain ending in ``annotated(doc_id, text, lang, source, n_chars, n_words, filter_reason, filter_group)``."""
    p = PROFILE
    inner = ", ".join(f"{sql} AS {n}" for n, sql in MEASURE_SQL.items())
    tops = " ".join(f"WHEN coalesce(top_{n}, 0) / length(text) > {_n_gram_limit(n)} THEN 'top_{n}_gram'" for n in (2, 3, 4))
    return f"""{TOP_SQL},
m AS (SELECT d.*, {inner}, top_2, top_3, top_4 FROM documents d LEFT JOIN g2 USING (doc_id) LEFT JOIN g3 USING (doc_id) LEFT JOIN g4 USING (doc_id)),
reasons AS (SELECT *, CASE
  WHEN n_real_words < {_limit('min_doc_words', p.min_doc_words)} THEN 'gopher_short_doc'
  WHEN dup_para_frac > 0.3 THEN 'dup_para_frac' WHEN dup_para_char_frac > 0.2 THEN 'dup_para_char_frac'
  WHEN dup_line_frac > {_limit('dup_line_frac', p.dup_line_frac)} THEN 'dup_line_frac' WHEN dup_line_char_frac > 0.2 THEN 'dup_line_char_frac'
  {tops}
  WHEN solid_lines = 0 THEN 'empty'
  WHEN line_punct_ratio < {_limit('line_punct_thr', p.line_punct_thr)} AND line_punct_ratio <> 0 THEN 'line_punct_ratio'
  WHEN short_line_ratio > 999 THEN 'short_line_ratio'
  WHEN char_dup_ratio > 0.1 THEN 'char_dup_ratio'
  WHEN list_ratio > {_limit('new_line_ratio', p.new_line_ratio)} THEN 'list_ratio'
  WHEN n_real_words > {_limit('max_doc_words', p.max_doc_words)} THEN 'gopher_long_doc'
  WHEN mean_word_length < 2 THEN 'gopher_below_avg_threshold'
  WHEN mean_word_length > {_limit('max_avg_word_length', p.max_avg_word_length)} THEN 'gopher_above_avg_threshold'
  WHEN hash_ratio > 0.1 THEN 'gopher_too_many_hashes' WHEN ellipsis_ratio > 0.1 THEN 'gopher_too_many_ellipsis'
  WHEN bullet_ratio > 0.9 THEN 'gopher_too_many_bullets' WHEN ellipsis_line_ratio > 0.3 THEN 'gopher_too_many_end_ellipsis'
  WHEN alpha_ratio < {_limit('max_non_alpha_words_ratio', p.max_non_alpha_words_ratio)} THEN 'gopher_below_alpha_threshold'
  WHEN stop_words < 1 THEN 'gopher_enough_stop_words' END AS filter_reason FROM m),
annotated AS (SELECT doc_id, text, lang, source, n_chars, n_words::BIGINT AS n_words, filter_reason,
  CASE WHEN filter_reason IS NULL THEN NULL WHEN filter_reason = 'gopher_short_doc' THEN 'min_doc'
    WHEN regexp_matches(filter_reason, '^(dup_|top_|duplicated_)') THEN 'repetition'
    WHEN filter_reason LIKE 'gopher%' THEN 'gopher_qual' ELSE 'fineweb' END AS filter_group FROM reasons)"""


ANNOTATED = annotated_sql()


def annotated(t):
    return q.annotate_quality(t.docs, PROFILE, OVERRIDES)


@query("flt18_first_reason", f"WITH {ANNOTATED} SELECT doc_id, n_words, filter_reason, filter_group FROM annotated")
def first_reason(t):
    return annotated(t).select("doc_id", "n_words", "filter_reason", "filter_group")


@query("flt17_source_limits", f"""
SELECT doc_id, ({_limit('max_doc_words', 100000)})::DOUBLE AS max_doc_words, ({_limit('min_doc_words', 15)})::DOUBLE AS min_doc_words,
  ({_n_gram_limit(3)})::DOUBLE AS top_3_gram FROM documents""")
def source_limits(t):
    limit = q.Limits(PROFILE, OVERRIDES, F.col("source"))
    return t.documents.select(
        "doc_id", limit.max_doc_words.alias("max_doc_words"), limit.min_doc_words.alias("min_doc_words"),
        limit.n_gram("top_n_grams", 3).alias("top_3_gram"),
    )


@query("flt10_long_documents", f"SELECT doc_id FROM documents WHERE len({REAL}) > {_limit('max_doc_words', 1000)}")
def long_documents(t):
    limit = q.Limits(q.Thresholds(max_doc_words=1000), OVERRIDES, F.col("source"))
    m = q.measures(F.col("text"), PROFILE)
    return t.docs.where(m["n_real_words"] > limit.max_doc_words).select("doc_id")


@query("flt18_all_gates", None)
def all_gates(t):
    """The whole default profile, the order-dependent scan included."""
    return q.annotate_quality(t.docs).select("doc_id", "n_words", "filter_reason", "filter_group")


@query("flt15_page_measures", f"""
SELECT page_id, {MEASURE_SQL['alpha_ratio'].replace('text', 'html')} AS alpha_ratio, {MEASURE_SQL['n_real_words'].replace('text', 'html')} AS n_real_words FROM pages""")
def page_measures(t):
    m = q.measures(F.col("html"), PROFILE)
    return spread(t.pages, "page_id").select("page_id", m["alpha_ratio"].alias("alpha_ratio"), m["n_real_words"].alias("n_real_words"))
