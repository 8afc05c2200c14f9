import pytest

from tamis.functions import prompts as p
from tamis.operators import labels as lb, router, runs
from pyspark.sql import functions as F


def test_kappa_edges(spark):
    def kappa(rows, labels=("x", "y")):
        return lb.cohens_kappa(spark.createDataFrame(rows, "a string, b string"), "a", "b", list(labels)).first()["kappa"]

    assert kappa([("x", "x"), ("y", "y")]) == 1.0
    assert kappa([("x", "y"), ("y", "x")]) == -1.0
    assert kappa([("x", "x"), ("x", "x")]) is None
    assert kappa([("x", "x"), ("y", "y"), ("SKIP", "x")]) == 1.0


def test_update_needs_unique_key(spark):
    base = spark.createDataFrame([("q", ""), ("q", "")], "k string, v string")
    with pytest.raises(ValueError):
        lb.update_from(base, base, "k", ["v"])


@pytest.mark.parametrize("text, answer, strict", [
    ("so #### 1,234", "1234", "1234"), ("#### -5", "5", "-5"), ("total 42", "42", "[invalid]"), ("27+4-3=28", "28", "[invalid]"),
    ("3 then 7 apples", "7", "[invalid]"), ("The Answer!", "answer", "[invalid]"), ("#### 1 #### 2.5</s>", "25", "1"),
])
def test_answers(spark, text, answer, strict):
    row = spark.createDataFrame([(text,)], "t string").select(p.final_answer(F.col("t")).alias("a"), p.strict_final_answer(F.col("t")).alias("s")).first()
    assert (row["a"], row["s"]) == (answer, strict)


def test_severity_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 4, 5, 24, 25, 30)], "s int")
    assert [r[0] for r in df.select(lb.severity_bin(F.col("s"))).collect()] == ["0", "minor", "minor", "major", "major", "critical", "critical"]


def test_router_extremes(spark):
    uniform = [("u", [0.0] * 4)] * 4
    spiky = [("o", [0.0, 500.0, 0.0, 0.0])] * 3
    df = spark.createDataFrame(uniform + spiky, "layer string, logits array<float>")
    got = {r["layer"]: r for r in router.layer_stats(df, ["layer"]).collect()}
    import math
    assert abs(got["u"]["avg_entropy"] - math.log(4)) < 1e-6 and abs(got["o"]["avg_entropy"]) < 1e-6
    assert got["o"]["most_used_expert"] == 1 and got["o"]["active_experts"] == 1 and got["o"]["top_experts"] == [1, 0, 2]
    # Every token of one expert: running sums 0, 0, 0, 1.
    assert abs(got["o"]["gini"] - (4 + 1 - 2 * 1) / 4) < 1e-9


def test_timestamps(spark):
    df = spark.createDataFrame([("2025-09-16T19-47-51",), ("2025-09-16T19:47:51",), ("latest",), (None,)], "t string")
    got = [r[0] for r in df.select(F.date_format(runs.parse_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2025-09-16 19:47:51", "2025-09-16 19:47:51", None, None]


def test_last_per_step_takes_last_non_null(spark):
    df = spark.createDataFrame([(1, 1, 0.5, None), (1, 2, None, 7.0), (2, 1, 0.1, 0.2)], "step int, ts int, a double, b double")
    got = {r["step"]: (r["a"], r["b"]) for r in runs.last_per_step(df, ["step"], "ts", ["a", "b"]).collect()}
    assert got == {1: (0.5, 7.0), 2: (0.1, 0.2)}


def test_repeated_tag_keeps_last(spark):
    m = spark.createDataFrame([("<a>1</a><b> 2 </b><a>3</a><response_format><c>x</c></response_format>",)], "t string").select(p.parse_tags(F.col("t"))).first()[0]
    assert m == {"a": "3", "b": "2", "c": "x"}


def test_gold_index(spark):
    df = spark.createDataFrame([(0,), (3,), (4,), (-1,), (None,)], "i int")
    choices = F.array(*[F.lit(x) for x in "abcd"])
    assert [r[0] for r in df.select(p.valid_gold_index(F.col("i"), choices)).collect()] == [0, 3, 0, 0, 0]


def test_whole_histogram_adds_up(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 8, 8.5, 10, 25, 30.5, 50)] + [(None,)], "score double")
    got = {r["bin"]: r["n"] for r in lb.histogram_whole(df, "score", {"low": (-0.5, 8.5, 9), "high": (24.5, 30.5, 6)}).collect()}
    assert got == {"under": 1, "low 1": 1, "low 9": 2, "between": 1, "high 1": 1, "high 6": 1, "over": 1, "missing": 1}
