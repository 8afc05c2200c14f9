"""The stages on a small folder of planted cases, and every query on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tamis.llm import queries
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_stages_decide(spark, docs, tmp_path):
    from tests.llm.test_operators import prose

    item = prose(500, 30)
    texts = [prose(i, 60) + (" vile rotten" if i % 4 == 0 else "") for i in range(80)]
    texts += [prose(1, 60), prose(900, 50) + " " + item, prose(901, 40) + " password=hunter2hunter2", None, ""]
    ids = [*range(80), 100, 101, 102, 103, 104]
    folder = str(tmp_path)
    df = docs(texts, ids)
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, left = df, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, now, folder)
        assert done.columns == df.columns and done.dtypes == df.dtypes
        done.write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        left[name] = {r["doc_id"]: r for r in now.collect()}
    assert not any(i % 4 == 0 for i in left["toxicity"] if i < 80) and {1, 100, 101, 102, 103, 104} <= left["toxicity"].keys()
    assert 100 not in left["near_duplicates"] and left["toxicity"].keys() - left["near_duplicates"].keys() == {100}
    assert left["near_duplicates"].keys() - left["decontamination"].keys() == {101}
    row = left["secrets"][102]
    assert row["text"].endswith("[assign]") and row["n_chars"] == len(row["text"]) and left["secrets"][103]["text"] is None
    packed = corpus_pipeline.STAGES[-1][1](spark, now, folder)
    assert {r["doc_id"] for r in packed.collect()} == left["secrets"].keys()
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, packed.collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name])[0] is None


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()} and "pipeline" in entry.queries()
