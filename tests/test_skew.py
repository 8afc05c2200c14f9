"""Groups that hold most rows are spread over tasks; results stay the same."""

import pytest
from pyspark.sql import functions as F

from tamis.operators import dedup as d


@pytest.fixture
def many_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest(df, column):
    """Rows of the fullest task; the column keeps the join from being optimised away."""
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(column)).collect())


ROWS = 30_000


def hot(column, other):
    """A value that 67 % of all rows share."""
    return F.when(F.col("id") % 3 < 2, F.lit("same")).otherwise(other).alias(column)


def test_exact_groups(spark, many_partitions):
    df = spark.range(ROWS).select("id", hot("text", F.concat(F.lit("t"), (F.col("id") % 1000).cast("string"))))
    got = d.exact_groups(df, "id", ["text"])
    assert largest(got, "kept_id") < 0.05 * ROWS
    want = {r["text"]: r["least"] for r in df.groupBy("text").agg(F.min("id").alias("least")).collect()}
    text = {r["id"]: r["text"] for r in df.collect()}
    rows = {r["id"]: r["kept_id"] for r in got.collect()}
    assert len(rows) == ROWS and all(kept == want[text[i]] for i, kept in rows.items())


def test_bucket_edges(spark, many_partitions):
    bands = spark.range(ROWS).select("id", F.lit(0).alias("band"), hot("key", F.col("id").cast("string")))
    got = d.bucket_edges(bands, "id")
    assert largest(got, "dst") < 0.05 * ROWS
    assert {r["dst"] for r in got.collect()} == {0} and got.count() == ROWS * 2 // 3 - 1


def test_components_of_a_star_and_a_chain(spark):
    star = spark.range(1, 3000).select(F.col("id").alias("src"), F.lit(3000).alias("dst"))
    chain = spark.range(5000, 5040).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = {r["id"]: r["component"] for r in d.connected_components(star.union(chain)).collect()}
    assert found == {**{i: 1 for i in range(1, 3001)}, **{i: 5000 for i in range(5000, 5041)}}


def test_string_ids_and_nulls(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", None), ("d", None), ("e", "y")], "id string, text string")
    got = {r["id"]: r["kept_id"] for r in d.exact_groups(df, "id", ["text"]).collect()}
    assert got == {"b": "a", "a": "a", None: "a", "c": "c", "d": "c", "e": "e"}
