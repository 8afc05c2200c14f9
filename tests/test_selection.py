"""Selections of many rows, repeated prompts, repeated n-grams, reports from one pass, tokenizers."""

import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tamis.operators import benchmarks as b, quality as q, reports as r, rows, sampling as s, training as tr


def test_many_rows_per_group_equal_few_at_a_time(spark):
    rng = random.Random(2)
    data = [(i, rng.choice(["hot"] * 6 + ["x", None]), rng.randrange(500)) for i in range(6000)]
    df = spark.createDataFrame(data, "id long, g string, v int").repartition(6)
    got = {(x["g"], x["id"]): x["place"] for x in rows.first_n(df, ["g"], ["v", "id"], 1200, "place", buckets=30).collect()}
    want, seen = {}, Counter()
    for i, g, v in sorted(data, key=lambda x: (x[2], x[0])):
        seen[g] += 1
        if seen[g] <= 1200:
            want[g, i] = seen[g]
    assert got == want and max(Counter(g for g, _ in want).values()) == 1200


def test_no_task_ranks_a_group_of_many(spark):
    df = spark.range(120_000).select("id", F.lit("one").alias("g"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        picked = s.sample_per_group(df, ["g"], "id", 100_000, rank_col="place")
        sizes = picked.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("top")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(x["n"] for x in sizes) == 100_000 and max(x["top"] for x in sizes) == 100_000
    assert max(x["n"] for x in sizes) < 30_000
    first = s.sample_per_group(df, ["g"], "id", 500).select("id")
    assert picked.where("place <= 500").select("id").exceptAll(first).count() == 0


def test_repeated_prompts_do_not_multiply(spark):
    gold = spark.range(1000).select("id", F.lit("same").alias("prompt")).union(spark.createDataFrame([(5000, "single"), (5001, "none"), (5002, None)], "id long, prompt string"))
    original = spark.range(1000).select((F.col("id") + 7).alias("item"), F.lit("same").alias("prompt")).union(spark.createDataFrame([(1, "single"), (2, None)], "item long, prompt string"))
    assert [tuple(x) for x in b.match_by_prompt(gold, original, "prompt").select("id", "item", "prompt").collect()] == [(5000, 1, "single")]
    report = {x["id"]: x["matches"] for x in b.match_report(gold, original, "prompt", "id").collect()}
    assert len(report) == 1002 and report[0] == 1000 and report[5001] == 0


def in_repeats(text, n):
    words = re.findall(r"[^ \t\n\r\f\v]+", text)
    seen, covered = set(), set()
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            covered.update(range(i, i + n))
        seen.add(gram)
    return sum(len(words[j]) for j in covered)


def test_words_in_repeated_n_grams(spark):
    rng = random.Random(7)
    sizes = [1, 2, 3, 5, 7, 8, 10, 40]
    texts = [" ".join(rng.choice(["a", "bb", "ccc"][: rng.choice([1, 2, 3])]) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["", " \n", "one", "x " * 5000, "הוא היה הוא היה"]
    for text in texts:
        assert q.repeated_n_gram_chars(text, sizes) == [in_repeats(text, n) for n in sizes], text
    got = spark.createDataFrame([("a b a b a b",), (None,)], "text string").select(q.repeated_n_gram_scan([2])("text").alias("n")).collect()
    assert [x["n"] for x in got] == [[4], None]


def test_report_reads_the_gates_once_and_carries_places(spark):
    rows_in = [(2**53 + i, f"text {i}", ["short", "long", None][i % 3], ["size", "size", None][i % 3], i, f"f{i}", {"k": str(i)}) for i in range(60)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string, filter_reason string, filter_group string, n_words int, file_path string, metadata map<string,string>")
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def verdict(x):
        runs.add(1)
        return x

    judged = docs.withColumn("filter_reason", verdict("filter_reason"))
    tables = r.report_tables(judged, per_reason=4, texts=docs)
    for table in tables.values():
        table.collect()
    # Once to filter and once to keep the verdict of what is removed, for all five tables.
    assert runs.value <= 60 + 40
    examples = tables["full_examples"].collect()
    assert len(examples) == 8 and all(x["full_text"] == f"text {x['doc_id'] - 2**53}" and x["file_path"] == f"f{x['doc_id'] - 2**53}" for x in examples)
    assert {x["filter_reason"]: x["documents"] for x in tables["overall_summary"].collect()} == {"short": 20, "long": 20}
    assert r.report_tables(judged.where("false"))["overall_summary"].count() == 0


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_any_tokenizer_file_encodes_whole_texts(spark, file):
    path = public_tokenizers.path(file)
    texts = ["Hello, world!", "", None, "x " * 30_000, "שלום עולם", "tail"]
    df = spark.createDataFrame([(2**53 + 1 + i if i != 2 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    if file.endswith("json"):
        encode = lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids
    else:
        from sentencepiece import SentencePieceProcessor

        encode = SentencePieceProcessor(model_file=path).encode
    want = [None if t is None else encode(t) for t in texts]
    made = tr.token_ids(df, path, text_chars=20).collect()
    assert [x["token_ids"] for x in made] == want and [x["doc_id"] for x in made] == [x["doc_id"] for x in df.collect()]
    assert [x["n_tokens"] for x in tr.token_counts(df, path).collect()] == [None if w is None else len(w) for w in want]


def test_a_tokenizer_of_ones_own(spark):
    df = spark.createDataFrame([("a bc",), ("d",)], "text string")
    got = tr.token_ids(df, "letters", load=lambda path: lambda texts: [[ord(c) for c in t] for t in texts]).collect()
    assert [x["token_ids"] for x in got] == [[97, 32, 98, 99], [100]]
