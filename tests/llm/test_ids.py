"""Ids that doubles cannot hold, beside null ids and as strings."""

import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tamis.llm import contamination, id_coder, near_duplicates, nested_secrets, ngram_quality, order_packing
from tamis.llm import repeated_passages, top_k, toxic_neighbours, two_fit_packing, url_templates

LARGE = [2**53 + 1, None, 2**53 + 3]
TEXTS = ["one two three four five six", "password=hunter2hunter2 seven eight", "nine ten eleven"]
WORD_IDS, BYTE_IDS = "word_bpe_49k.json", "byte_bpe_50k.json"


def token_files(df, tmp_path):
    folder = str(tmp_path / "ids")
    id_coder.write_token_files(df, folder, public_tokenizers.path(WORD_IDS), joiner="drop", partitions=2)
    return id_coder.read_token_files(df.sparkSession.read.parquet(folder)).withColumnRenamed("id", "doc_id")


OPERATORS = {
    "passages": lambda df, labels, _: repeated_passages.remove_repeated_passages(df),
    "token_files": lambda df, labels, tmp: token_files(df, tmp),
    "secrets": lambda df, labels, _: nested_secrets.scan_secrets(df),
    "two_fit": lambda df, labels, _: two_fit_packing.pack_documents(df, public_tokenizers.path(BYTE_IDS), joiner="lead"),
    "toxicity": lambda df, labels, _: toxic_neighbours.score_toxicity(df, labels),
    "quality": lambda df, labels, _: ngram_quality.judge_quality(df, labels.select("doc_id")),
    "in_order": lambda df, labels, _: order_packing.pack_in_order(df, public_tokenizers.path(WORD_IDS)),
}


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("name", OPERATORS)
def test_ids_come_back_as_they_are(spark, tmp_path, name, kind):
    ids = LARGE if kind == "long" else ["9007199254740993", None, "shard-3/x"]
    df = spark.createDataFrame([(i, t, "en") for i, t in zip(ids, TEXTS)], f"doc_id {kind}, text string, lang string").coalesce(1)
    labels = spark.createDataFrame([(ids[0], 1), (ids[2], 0)], f"doc_id {kind}, toxic int")
    got = OPERATORS[name](df, labels, tmp_path)
    assert dict(got.dtypes)["doc_id"] == {"long": "bigint"}.get(kind, kind)
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted(ids, key=str)


def test_large_ids_of_pairs_and_classes(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, text) for i in LARGE], "doc_id long, text string").coalesce(1)
    got = {tuple(r) for r in near_duplicates.near_duplicate_classes(df).collect()}
    assert got == {(2**53 + 1, 2**53 + 1, 2), (2**53 + 3, 2**53 + 1, 2)}
    items = spark.createDataFrame([(2**53 + 5, text), (None, text)], "item_id long, text string")
    found = contamination.contaminated(df, items).where("item_id IS NOT NULL").collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(2**53 + 1, 2**53 + 5), (2**53 + 3, 2**53 + 5)}
    vectors = spark.createDataFrame([(i, [1, 2]) for i in LARGE], "vec_id long, vector array<long>").coalesce(1)
    got = {(r["query_id"], r["vec_id"]) for r in top_k.exact_top_k(vectors, vectors).collect()}
    assert got == {(2**53 + 1, 2**53 + 3), (2**53 + 3, 2**53 + 1)}


def segment_by_definition(segment):
    """Hex runs with a digit that has seven signs behind it, then digits."""
    out, at = [], 0
    while at < len(segment):
        end = at
        while end < len(segment) and segment[end] in "0123456789abcdefABCDEF":
            end += 1
        run = segment[at:end]
        if any(c.isdigit() for c in run[:-7]):
            out.append("{x}")
        else:
            digits = False
            for c in run:
                if not (c.isdigit() and digits):
                    out.append("{n}" if c.isdigit() else c)
                digits = c.isdigit()
        if end < len(segment):
            out.append(segment[end])
        at = end + 1
    return "".join(out)


def test_segment_classes_equal_definition_in_linear_time(spark):
    cases = ["", "page-12", "deadbeef", "dead1beef", "1234567", "12345678", "a1b2c3d4e5", "x0123456789abcdefx77", "abcdefabcdef1234567", "abcdef1abcdefa-9", "1abcdef", "A9F00000g12"]
    cases += ["a" * 40_000, "a" * 39_999 + "7", "7" * 40_000, ("a" * 20 + "1") * 2_000]
    df = spark.createDataFrame([(c,) for c in cases], "s string").coalesce(1).select("s", url_templates.segment_class(F.col("s")).alias("t"))
    begun = time.monotonic()
    rows = df.collect()
    assert time.monotonic() - begun < 5
    assert [r["t"] for r in rows] == [segment_by_definition(c) for c in cases]
