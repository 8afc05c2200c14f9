"""Declared jobs, and files assembled in pieces."""

import random

import pytest
from pyspark.sql import functions as F

from tamis.operators import articles as a
from tamis.operators.quality import Thresholds
from tamis.plans.jobs import Job, problems, run_jobs

PROSE = "These words stand in a sentence of their own, which is long enough to be kept here today. "


@pytest.fixture
def place(spark, tmp_path):
    rows = [(i, f"<b>{PROSE}</b> &quot;{i % 20}&quot;", "s1") for i in range(40)] + [(100, "too short", "s2"), (101, None, "s2"), (102, "", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/docs")
    return str(tmp_path)


def test_two_jobs_from_source_to_sinks(spark, place):
    gates = Thresholds(stop_words=(), min_doc_words=10, dup_n_grams={}, top_n_grams={})
    jobs = [
        Job("clean", f"{place}/docs", rules=("html",), exact=("text",), gates=gates, sinks={"filtered": f"{place}/filtered", "kept": f"{place}/kept", "report": f"{place}/report"}),
        Job("plain", f"{place}/docs", sinks={"by_source": f"{place}/sources"}),
    ]
    got = {r["job"]: r.asDict() for r in run_jobs(spark, jobs).collect()}
    assert {k: got["clean"][k] for k in ("documents", "copies", "kept")} == {"documents": 43, "copies": 20, "kept": 21}
    # A null text has nothing to judge and stays.
    assert got["clean"]["removed"] == 2 and got["plain"] == {"job": "plain", "documents": 43, "copies": 0, "removed": 0, "kept": 43, "words_kept": got["plain"]["words_kept"]}
    kept = spark.read.parquet(f"{place}/kept")
    assert kept.count() == 21 and kept.where(F.col("text").contains("<b>") | F.col("text").contains("&quot;")).count() == 0
    assert kept.agg(F.sum("n_words")).first()[0] == got["clean"]["words_kept"]
    assert spark.read.json(f"{place}/filtered").count() == 23 and spark.read.parquet(f"{place}/report/overall_summary").agg(F.sum("documents")).first()[0] == 2
    assert spark.read.parquet(f"{place}/sources").count() == 43


def test_wrong_declarations_are_named_before_anything_runs(spark, place):
    jobs = [Job("x", "nowhere", reader="tape", rules=("web", "none"), sinks={"moon": f"{place}/a"}), Job("x", "nowhere", sinks={"kept": f"{place}/a/"}), Job("y", "nowhere")]
    found = problems(jobs)
    assert len(found) == 6 and any("tape" in f for f in found) and any("declared 2 times" in f for f in found) and any("written by 2" in f for f in found)
    with pytest.raises(ValueError, match="tape"):
        run_jobs(spark, jobs)
    with pytest.raises(ValueError, match="no jobs"):
        run_jobs(spark, [])


def test_pieces_in_order_are_the_whole_file(spark):
    draw = random.Random(1)
    rows = [("hot" if i % 10 else f"f{i % 30}", f"c{i:05}", None if i % 97 == 0 else "x" * draw.randrange(40) + str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "file string, chunk string, text string").repartition(6)
    whole = {r["file"]: r["text"] for r in a.assemble_chunks(df.where("text IS NOT NULL"), "file", "chunk", "text", "|").collect()}
    pieces = a.assemble_pieces(df, "file", "chunk", "text", "|", piece_chars=500).orderBy("file", "piece").collect()
    joined = {}
    for r in pieces:
        joined.setdefault(r["file"], []).append(r["text"])
    assert {f: "|".join(p) for f, p in joined.items()} == whole
    assert max(len(r["text"]) for r in pieces) < 560 and len(joined["hot"]) > 100
