"""Increments: the same rows as one pass, after restarts and lost batches too."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tamis.operators import dedup as d
from tamis.streaming.exact import changes, track_copies, tracked
from tamis.streaming.ingest import read_new_files

SCHEMA = "id long, text string, lang string"


@pytest.fixture
def place(tmp_path):
    return str(tmp_path)


def run(spark, place):
    stream = read_new_files(spark, f"{place}/in", spark.createDataFrame([], SCHEMA).schema, "parquet")
    track_copies(stream, "id", ["text", "lang"], f"{place}/copies", f"{place}/progress").awaitTermination()


def rows(seed, ids):
    draw = random.Random(seed)
    return [(i, draw.choice(["hot"] * 8 + [None, "", "a", "b", f"t{draw.randrange(40)}"]), draw.choice(["en", "fr", None])) for i in ids]


def arrive(spark, place, data):
    spark.createDataFrame(data, SCHEMA).repartition(2).write.mode("append").parquet(f"{place}/in")


def test_three_increments_equal_one_pass(spark, place):
    # The smallest ids come last, and 2**53 + 1 must stay what it is.
    parts = [rows(1, [2**53 + 1, *range(200, 300)]), rows(2, range(100, 200)), rows(3, [*range(0, 100), 2**53 + 3])]
    for part in parts:
        arrive(spark, place, part)
        run(spark, place)
    every = [row for part in parts for row in part]
    whole = spark.createDataFrame(every, SCHEMA)
    want = sorted(r["id"] for r in d.drop_exact(whole, "id", ["text", "lang"]).collect())
    got = tracked(spark, f"{place}/copies").collect()
    assert sorted(r["kept_id"] for r in got) == want and sum(r["copies"] for r in got) == len(every)
    # The changes of the batches add up to the same.
    kept = set()
    for batch in range(3):
        for r in changes(spark, f"{place}/copies", batch).collect():
            assert (r["id"] in kept) != r["kept"]
            kept.symmetric_difference_update([r["id"]])
    assert sorted(kept) == want
    first = tracked(spark, f"{place}/copies", upto=0).collect()
    assert sum(r["copies"] for r in first) == len(parts[0])


def test_a_lost_batch_is_made_again(spark, place):
    for seed in (1, 2):
        arrive(spark, place, rows(seed, range(seed * 100, seed * 100 + 80)))
        run(spark, place)
    before = sorted(map(tuple, tracked(spark, f"{place}/copies").collect()))
    # The process died after the second batch was written and before it was marked as done.
    for path in [f"{place}/progress/commits/1", *glob.glob(f"{place}/progress/commits/.1.crc")]:
        os.remove(path)
    for path in glob.glob(f"{place}/copies/batch=1/*.parquet")[:1]:
        os.remove(path)
    run(spark, place)
    assert sorted(map(tuple, tracked(spark, f"{place}/copies").collect())) == before
    run(spark, place)  # nothing new
    assert sorted(map(tuple, tracked(spark, f"{place}/copies").collect())) == before


def test_text_ids_and_null_ids(spark, place):
    spark.createDataFrame([("b", "x"), (None, "x"), ("a", "x"), (None, "y")], "id string, text string").write.parquet(f"{place}/in")
    stream = read_new_files(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema, "parquet", files_per_batch=1)
    track_copies(stream, "id", ["text"], f"{place}/copies", f"{place}/progress").awaitTermination()
    got = tracked(spark, f"{place}/copies", "string").orderBy(F.desc("copies")).collect()
    assert [tuple(r) for r in got] == [("a", 3), (None, 1)]
