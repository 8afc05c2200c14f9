import random

import pytest

from pyspark.sql import functions as F

from tamis.functions.hashing import hash60
from tamis.operators import dedup as d


def components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("pairs", [
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 200)],
    [(199, i) for i in range(199)],
    [],
    [tuple(random.Random(7 + i).sample(range(150), 2)) for i in range(110)],
    [(i, 100 - i) for i in range(50)] + [(5, 6), (70, 2)],
])
def test_components(spark, pairs):
    edges = spark.createDataFrame(pairs, "src long, dst long")
    got = {r["id"]: r["component"] for r in d.connected_components(edges).collect()}
    assert got == components(pairs)


def texts():
    base = [f"w{i}" for i in range(120)]
    near = base.copy()
    near[60] = "changed"
    return [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(f"z{i}" for i in range(120))),
        (5, "one two"), (6, "one two"), (7, ""), (8, "!!!"), (9, "One, two"),
    ]


def test_near_duplicates(spark):
    df = spark.createDataFrame(texts(), "id long, text string")
    got = {r["id"]: r["component"] for r in d.near_duplicate_clusters(df, "id").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 9: 5}
    kept, removed = d.split_duplicates(df, d.near_duplicate_clusters(df, "id"), "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 4, 5, 7, 8]
    assert sorted(r["id"] for r in removed.collect()) == [2, 3, 6, 9]


def test_verification_drops_weak_edges(spark):
    df = spark.createDataFrame(texts(), "id long, text string")
    assert d.near_duplicate_clusters(df, "id", min_jaccard=0.99).where("id = 3").count() == 0


def test_signature_equals_plain_arithmetic(spark):
    config = d.MinHashConfig(bands=3, rows=2)
    df = spark.createDataFrame([(1, " ".join(f"t{i % 70}" for i in range(9000)))], "id long, text string")
    hashes = d.base_hashes(df, "id", config).first()["hashes"]
    expected = [min((a * h + b) % d.PRIME for h in hashes) for a, b in config.coefficients()]
    assert d.signatures(df, "id", config).first()["signature"] == expected


def test_hot_copies_and_partitioning(spark):
    # A third of all rows are one text, and the result does not depend on the layout.
    rows = [(i, "same text over and over again here" if i % 3 == 0 else f"text number {i} with its own words {i * 7} {i * 11}") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, text string")
    wanted = None
    for n in (1, 7):
        got = sorted(tuple(r) for r in d.near_duplicate_clusters(df.repartition(n), "id").collect())
        assert [c for i, c in got if i % 3 == 0] == [0] * 300
        assert wanted in (None, got)
        wanted = got
    assert d.drop_exact(df, "id", ["text"]).count() == 601


def test_exact_dedup_is_idempotent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    once = d.dedup_lines_and_rows(docs, "doc_id")
    assert once.count() == d.dedup_lines_and_rows(once, "doc_id").count()


def test_content_key_keeps_fields_apart(spark):
    df = spark.createDataFrame([(1, "a:b", "c"), (2, "a", "b:c")], "id long, x string, y string")
    assert d.drop_exact(df, "id", ["x", "y"]).count() == 2


def test_presets():
    assert {n: (p.bands, p.rows) for n, p in d.PRESETS.items()} == {"high": (20, 10), "balanced": (14, 8), "fast": (10, 6)}
    assert d.MinHashConfig().coefficients() == d.MinHashConfig().coefficients()


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, i int")
    assert sorted(tuple(r) for r in d.keep_first(df, ["k"], ["i"]).collect()) == [("a", 1), ("b", 3)]


def test_short_texts_are_not_run_together(spark):
    df = spark.createDataFrame([(i, f"item {i}") for i in (38962, 83874)], "doc_id long, text string")
    assert d.near_duplicate_clusters(df, "doc_id").count() == 0


def test_string_ids(spark):
    df = spark.createDataFrame([("a", "one two three four five six"), ("b", "one two three four five six"), ("c", "other")], "doc_id string, text string")
    got = {r["doc_id"]: r["component"] for r in d.near_duplicate_clusters(df, "doc_id").collect()}
    assert got == {"a": "a", "b": "a"}


def test_nulls_and_neighbours_have_their_own_keys(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "", "a"), (4, "a", None)], "i long, x string, y string")
    assert sorted(r["i"] for r in d.drop_exact(df, "i", ["x", "y"]).collect()) == [1, 2, 3]


def test_verified_clusters_do_not_hang_on_the_smallest_id(spark):
    # 1 is under the threshold to 2 and 3, which are near each other; 4 and 5 are tied by a chain that leaves out 1.
    words = [f"w{i}" for i in range(200)]
    change = lambda at: " ".join("x" + w if i in at else w for i, w in enumerate(words))
    texts = [change({20, 60, 100}), change({30, 70}), change({30, 70, 120}), change({199}), change({198, 199})]
    df = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "id long, text string")
    config = d.MinHashConfig()
    bands = df.select("id", F.lit(0).alias("band"), F.lit("k").cast("binary").alias("key"))  # all in one bucket
    ids = df.select("id")
    every = ids.select(F.col("id").alias("src")).join(ids.select(F.col("id").alias("dst")), F.expr("src < dst"))
    jaccard = {(r["src"], r["dst"]): r["jaccard"] for r in d.verified_edges(every, df, "id", 0.0, config).collect()}
    assert jaccard[2, 3] > 0.85 > max(v for (a, _), v in jaccard.items() if a == 1 and _ != 4 and _ != 5)
    wanted = {(r["id"], r["component"]) for r in d.connected_components(d.verified_edges(every, df, "id", 0.88, config).select("src", "dst")).collect()}
    star = d.verified_edges(d.bucket_edges(bands, "id"), df, "id", 0.88, config)
    got = {(r["id"], r["component"]) for r in d.connected_components(d.verified_bucket_edges(bands, df, "id", 0.88, config)).collect()}
    assert not star.where("src IN (2, 3)").count() and {(2, 2), (3, 2)} <= got and got == wanted
    assert {(2, 2), (3, 2)} <= {tuple(r) for r in d.near_duplicate_clusters(df, "id", config, min_jaccard=0.88).collect()}


def test_shingle_hashes_come_from_one_scan(spark):
    texts = ["One two, THREE four five-six seven", "short text!", "a b c d e a b c d e a", "É ß 1_2 x.y z ... q r s t", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, " .. "), (10, None)], "id int, text string")
    found = d.base_hashes(df, "id", d.MinHashConfig())
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    grams = F.array_distinct(d.shingles(d.normalised_words(F.col("text")), 5))
    wanted = df.where("id < 9").select("id", F.transform(grams, hash60).alias("hashes"))
    assert sorted(found.collect()) == sorted(wanted.collect())
