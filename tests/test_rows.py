import random

import pytest
from pyspark.sql import functions as F

from tamis.operators import rows as r, sampling as s, training as tr


@pytest.mark.parametrize("n, buckets", [(1, 256), (500, 8), (500, 256)])
def test_running_total(spark, n, buckets):
    rng = random.Random(n)
    # One group holds most rows; one group key is null.
    data = [(k * k, rng.choice(["hot", "hot", "hot", "b", None]), rng.randint(0, 9)) for k in range(n)]
    df = spark.createDataFrame(data, "k long, g string, v int")
    got = {x["k"]: x["t"] for x in r.running_total(df, "k", F.col("v"), "t", ["g"], buckets).collect()}
    totals, expected = {}, {}
    for k, g, v in sorted(data):
        totals[g] = totals.get(g, 0) + v
        expected[k] = totals[g]
    assert got == expected


def test_previous_value(spark):
    rng = random.Random(3)
    data = [(k * 3, rng.choice(["hot", "hot", "b", None]), rng.choice([None, 1, 2, 3])) for k in range(300)]
    df = spark.createDataFrame(data, "k long, g string, v int")
    got = {x["k"]: x["p"] for x in r.previous_value(df, "k", "v", "p", ["g"], 16).collect()}
    last, expected = {}, {}
    for k, g, v in data:
        expected[k] = last.get(g)
        last[g] = v
    assert got == expected


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, v int")
    assert r.row_numbers(df, "k").count() == 0


def test_positions(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(100)], "k long")
    assert sorted(x["k"] for x in r.every_kth(df, "k", 30).collect()) == [0, 90, 180, 270]
    assert sorted(x["k"] for x in r.positions(df, "k", 2, 5).collect()) == [6, 9, 12]


def test_size_chunks_stay_near_the_limit(spark):
    df = spark.createDataFrame([(i, "s", 30 + i % 50) for i in range(400)], "k long, source string, n long")
    sums = r.size_chunks(df, "k", F.col("n"), 1000, ["source"]).groupBy("chunk").agg(F.sum("n").alias("t")).collect()
    assert sum(x["t"] for x in sums) == sum(30 + i % 50 for i in range(400))
    assert all(x["t"] <= 1000 + 80 for x in sums)


def test_sampling_is_stable(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 700, "hot").otherwise("b"))
    a = s.sample_per_group(df.repartition(3), ["g"], "id", 20).select("id").collect()
    b = s.sample_per_group(df.repartition(9), ["g"], "id", 20).select("id").collect()
    assert sorted(a) == sorted(b) and len(a) == 40


def test_split_is_disjoint_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    first = {x["doc_id"]: x["split"] for x in tr.with_split(df.repartition(3)).collect()}
    second = {x["doc_id"]: x["split"] for x in tr.with_split(df.repartition(8)).collect()}
    assert first == second and len(first) == 2000
    assert 120 < sum(v == "validation" for v in first.values()) < 280


@pytest.mark.parametrize("allocate", [s.allocate_uniform, s.allocate_random, s.allocate_weighted])
def test_allocations_add_up(spark, allocate):
    units = spark.createDataFrame([(f"f{i}",) for i in range(7)], "file string")
    got = allocate(units, "file", 100).collect()
    assert len(got) == 7 and sum(x["samples"] for x in got) == 100


@pytest.mark.parametrize("seed", range(10))
def test_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 5, 50, 99, 100]) for _ in range(rng.choice([1, 10, 300]))]
    placed = tr.best_fit_decreasing(lengths, 100)
    assert sorted(i for i, _, _ in placed) == list(range(len(lengths)))
    fill = {}
    for item, where, start in placed:
        assert start == fill.get(where, 0)
        fill[where] = start + lengths[item]
    assert all(v <= 100 for v in fill.values())


def test_pack_covers_everything(spark):
    df = spark.createDataFrame([(i, (i * 37) % 6000) for i in range(500)], "doc_id long, n long")
    out = tr.pack(df, "doc_id", "n", 4096, rows_per_shard=100)
    assert out.select("doc_id").distinct().count() == 500 and out.select("shard").distinct().count() == 5
    whole = out.groupBy("doc_id").agg(F.sum("length").alias("t"), F.max(F.col("from_token") + F.col("length")).alias("end"))
    assert whole.join(df, "doc_id").where("t != n OR end != n").count() == 0
    assert out.groupBy("shard", "bin").agg(F.sum("length").alias("t")).where("t > 4096").count() == 0


def test_require_text(spark):
    with pytest.raises(ValueError):
        tr.require_text(spark.range(1))


def numbered(data, groups=None):
    seen, out = {}, {}
    for row in data:
        g = row[groups] if groups is not None else None
        seen[g] = seen.get(g, 0) + 1
        out[row[0]] = seen[g]
    return out


def test_numbers_by_text_date_and_several_columns(spark):
    rng = random.Random(8)
    data = [(f"{rng.choice('abä')}{i:04}", rng.choice(["hot", "hot", "hot", None, "x"]), f"2020-01-{1 + i % 9:02}", i % 4) for i in range(700)]
    df = spark.createDataFrame(data, "id string, g string, day string, part int").withColumn("day", F.to_date("day")).repartition(5)
    by_id = sorted(data, key=lambda x: x[0].encode())
    assert {x["id"]: x["n"] for x in r.row_numbers(df, "id", "n", buckets=40).collect()} == numbered(by_id)
    assert {x["id"]: x["n"] for x in r.row_numbers(df, "id", "n", ["g"], 7).collect()} == numbered(by_id, 1)
    by_day = sorted(data, key=lambda x: (x[2], x[3], x[0].encode()))
    assert {x["id"]: x["n"] for x in r.row_numbers(df, ["day", "part", "id"], "n", ["g"], 30).collect()} == numbered(by_day, 1)


def test_ties_and_null_keys_are_numbered_once_each(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else "same" if i % 3 else f"k{i}") for i in range(900)], "id int, k string")
    got = r.row_numbers(df, "k", "n", buckets=50).collect()
    assert sorted(x["n"] for x in got) == list(range(1, 901))
    in_order = [x["k"] for x in sorted(got, key=lambda x: x["n"])]
    assert in_order == sorted(in_order, key=lambda k: (k is not None, k or ""))


def test_ranges_are_even_and_as_many_as_asked_for(spark):
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    cuts = r.cut_points(df, "k", 20)
    assert len(cuts) == 19
    sizes = [x["count"] for x in df.groupBy(r._range_of(df, "k", cuts).alias("r")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2000
    assert len(r.cut_points(df, "k")) == 15 and r.cut_points(df.limit(0), "k") == []


@pytest.mark.parametrize("start, stop", [(0, 5), (123, 456), (990, 2000), (0, 1000), (400, 400), (1000, 1010)])
def test_slices_by_text(spark, start, stop):
    names = sorted(f"n{i * 7919 % 1000}" for i in range(998))
    df = spark.createDataFrame([(n,) for n in [None, None, *names]], "name string").repartition(3)
    got = sorted((x["name"] for x in r.positions(df, "name", start, stop, 25).collect()), key=lambda n: (n is not None, n or ""))
    assert got == [None, None, *names][start:stop]


def test_a_slice_numbers_only_the_ranges_it_touches(spark, capsys):
    df = spark.range(50_000).select(F.format_string("%08d", F.col("id")).alias("k"))
    r.positions(df, "k", 20_000, 20_100, 100).explain("formatted")
    plan = capsys.readouterr().out
    assert "Window" in plan and "k" in plan
    assert r.positions(df, "k", 20_000, 20_100, 100).count() == 100
