import random

import pytest
from pyspark.sql import functions as F

from tamis.operators import quality as q, reports


def reasons(spark, rows, thresholds=None, overrides=None):
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "id int, source string, text string")
    out = q.annotate_quality(df, thresholds, {} if overrides is None else overrides).orderBy("id").collect()
    return [r["filter_reason"] for r in out]


GOOD = " ".join(f"word{i}" for i in range(40)) + "."


@pytest.mark.parametrize("text, reason", [
    (GOOD, None), ("", "gopher_short_doc"), ("... !!! ---", "gopher_short_doc"),
    (" ".join(["w"] * 0 + [f"wo{i}" for i in range(14)]), "gopher_short_doc"),
    ("\n".join([GOOD] * 2), "dup_line_frac"),
    ("\n\n".join([GOOD, GOOD]), "dup_para_frac"),
    (" ".join(["alpha beta"] * 30) + ".", "top_2_gram"),
    (GOOD + "\n" + "\n".join(f"ln{i}a wd{i}b" for i in range(25)), "line_punct_ratio"),
    ("\n".join(f"w{i}a b{i}." for i in range(40)), "list_ratio"),
    (" ".join("supercalifragilistic" + chr(97 + i) for i in range(20)) + ".", "gopher_above_avg_threshold"),
    (" ".join(f"w{i} #" for i in range(40)) + ".", "gopher_too_many_hashes"),
    (" ".join(f"{i * 1001} 5{i}x" if i % 9 == 0 else f"{i * 1003}" for i in range(60)) + ".", "gopher_below_alpha_threshold"),
])
def test_reason(spark, text, reason):
    assert reasons(spark, [("s", text)]) == [reason]


def test_limits_by_source(spark):
    short = " ".join(f"word{i}" for i in range(14)) + "."
    rows = [("hebrew_tweets", short), ("other", short)]
    assert reasons(spark, rows, overrides=q.DEFAULT_OVERRIDES) == [None, "gopher_short_doc"]


def test_n_gram_list_is_replaced_not_merged(spark):
    # The second half repeats a run of words: long n-grams of the default list catch it.
    run = " ".join(f"unit{i}" for i in range(10))
    other = " ".join(f"filler{i}" for i in range(25))
    text = f"{run} {other} {run}."
    assert reasons(spark, [("a", text)])[0].startswith("duplicated_")
    assert reasons(spark, [("a", text)], overrides={"a": {"dup_n_grams": [[5, 0.9]]}}) == [None]


def test_stop_words(spark):
    t = q.Thresholds(min_stop_words=1, stop_words=("the",))
    assert reasons(spark, [("s", GOOD), ("s", "the " + GOOD), ("s", "xthe " + GOOD)], t) == ["gopher_enough_stop_words", None, "gopher_enough_stop_words"]


def brute_dups(words, n):
    seen, chars, i = set(), 0, 0
    while i < len(words) - n + 1:
        gram = tuple(words[i:i + n])
        if gram in seen:
            chars += sum(map(len, gram))
            i += n
        else:
            seen.add(gram)
            i += 1
    return chars


def brute_top(words, n):
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    if not grams:
        return 0
    best = max(grams.count(g) for g in grams)
    return best * max(len(g) for g in grams if grams.count(g) == best)


@pytest.mark.parametrize("seed", range(30))
def test_n_grams_against_brute_force(seed):
    rng = random.Random(seed)
    words = [rng.choice(["a", "bb", "ccc", "dddd"][: rng.randint(1, 4)]) for _ in range(rng.choice([0, 1, 3, 5, 9, 60, 150]))]
    got = q.n_gram_chars(" ".join(words), [2, 3, 4], [5, 6, 7, 8, 9, 10])
    assert got == [brute_top(words, n) for n in (2, 3, 4)] + [brute_dups(words, n) for n in range(5, 11)]


def test_catalyst_top_n_grams_agree(spark):
    rng = random.Random(1)
    rows = [([rng.choice(["a", "bb", "ccc"]) for _ in range(k)],) for k in (0, 1, 2, 3, 10, 80)]
    df = spark.createDataFrame(rows, "w array<string>")
    got = df.select(*[q.top_n_gram_chars(F.col("w"), n) for n in (2, 3, 4)]).collect()
    assert [tuple(r) for r in got] == [tuple(brute_top(w, n) for n in (2, 3, 4)) for (w,) in rows]


def test_config(spark):
    t = q.Thresholds.from_mapping({"min_doc_words": 3, "top_n_grams": [[2, 0.5]], "language_score": 0.9})
    assert t.min_doc_words == 3 and t.top_n_grams == {2: 0.5} and t.max_doc_words == 100000


def test_custom_metric(spark):
    q.add_metric("n_a", lambda c: F.regexp_count(c, F.lit("a")))
    assert q.with_metrics(spark.createDataFrame([("abca",)], "text string"), ["n_a"]).first()["n_a"] == 2
    got = q.with_metrics(spark.createDataFrame([("a bb c",)], "text string"), ["single_char_percentage"]).first()[1]
    assert got == 50.0


def test_kept_and_removed_cover_everything(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = q.annotate_quality(docs)
    kept, removed = out.where("filter_reason IS NULL").count(), out.where("filter_reason IS NOT NULL").count()
    assert kept + removed == docs.count() and removed > 0
    assert out.where("(filter_reason IS NULL) <> (filter_group IS NULL)").count() == 0


def test_full_examples_are_whole(spark):
    row = (1, "s", "x" * 40000 + " end", "reason", "group", 2)
    df = spark.createDataFrame([row], "doc_id long, source string, text string, filter_reason string, filter_group string, n_words long")
    assert reports.report_tables(df)["full_examples"].first()["full_text"] == row[2]


def test_word_counts_agree_with_the_measures(spark):
    texts = ["", " ", "... !! the", "the. the of 'tis 12 ab3 --", "αβγ 1½ ² ... x\n\n•a\tthe\x0bof", GOOD, "a b ! ! é", "9x _ _y ١٢"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    t = q.Thresholds(stop_words=("the", "of"))
    base = q.base_counts(F.col("text"), t)
    wanted = [list(r) for r in df.select("text", *[base[k].alias(k) for k in q.WORD_COUNTS]).collect()]
    assert [[v, *q.word_counts(v, t.stop_words, [], [])] for v in texts] == wanted


def test_words_are_counted_in_one_scan(spark):
    df = spark.createDataFrame([("s", GOOD), ("s", None)], "source string, text string")
    t = q.Thresholds(dup_n_grams={}, min_stop_words=1, stop_words=("word1",))
    out = q.annotate_quality(df, t, {}, keep_measures=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and r"\S+, 0)" not in plan and "lambda" not in plan
    assert [(r["n_words"], r["stop_words"], r["filter_reason"]) for r in out.collect()] == [(40, 1, None), (None, None, None)]


def test_texts_of_a_batch_are_counted_apart():
    texts = ["a b a b", "a b", "", "x y z x y z x y z", "b a b", "a b a b a b"]
    wanted = [q.word_counts(v, ("a",), [2, 3], [2]) for v in texts]
    assert [w[5:] for w in wanted] == [[6, 5, 2], [3, 0, 0], [0, 0, 0], [9, 15, 6], [3, 5, 0], [9, 10, 4]]
    grams = [True, True, True, True, False, True]
    got = q.all_word_counts([v.encode() for v in texts], ("a",), [2, 3], [2], grams)
    assert got == [w if g else w[:5] for w, g in zip(wanted, grams)]


def test_line_measures_without_a_search_of_every_character(spark):
    t = q.Thresholds()
    texts = [("One.\nTwo?\n\nthree\n  …", 3 / 4), ("a\nb", 0.0), ("\n", None), ("", None), ("x.\n", 1.0), (". \nend!", 1 / 2), (None, None), ("é。\r\nz۔", 1 / 2)]
    df = spark.createDataFrame(texts, "text string, wanted double")
    m = q.measures(F.col("text"), t)
    out = df.select("wanted", m["line_punct_ratio"].alias("got"), m["ellipsis_ratio"].alias("e"), m["dup_para_frac"].alias("p"), m["dup_para_char_frac"].alias("c"))
    assert all(r["got"] == r["wanted"] for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "]$" not in plan and "Contains(" in plan.replace("contains(", "Contains(")
    assert out.where("wanted IS NOT NULL AND p <> 0").count() == 0 and out.where("p IS NULL").count() == 1
