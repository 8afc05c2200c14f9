import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from tamis.functions import cleaning as cl
from tamis.operators import quality as q, reports, training as tr
from tamis.operators.cleaning import cleaner, compose
from tamis.sources import readers as rd, writers as wr
from tamis.streaming.ingest import process_new_files, read_new_files


def test_jsonl_bad_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "x", "n_words": 1}\nnot json\n{"text": "y"}\n')
    good, bad = rd.read_jsonl(spark, str(tmp_path), rd.TEXT_CSV)
    assert sorted(r["text"] for r in good.collect()) == ["x", "y"] and bad.count() == 1


def test_csv_forms(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('"a, ""b""\nc",3\nd,1\n')
    assert [tuple(r) for r in rd.read_text_csv(spark, str(tmp_path / "plain.csv")).collect()] == [('a, "b"\nc', 3), ("d", 1)]
    (tmp_path / "head.csv").write_text("id,text\n1,x y\n")
    df = rd.read_text_csv(spark, str(tmp_path / "head.csv"), header="auto")
    assert df.columns == ["id", "text"] and rd.resolve_text(df).first()["n_words"] == 2
    assert rd.read_text_csv(spark, str(tmp_path / "plain.csv"), header="auto").columns == ["text", "n_words"]


@pytest.mark.parametrize("name, body, expected", [
    ("a.gz", '{"text": "x"}\n', ["x"]), ("b.gz", "hello there\nmore\n", ["hello there", "more"]),
    ("c.csv.gz", "x,1\ny,2\n", ["x", "y"]), ("d.jsonl.gz", '{"text": "z"}\n', ["z"]),
])
def test_read_any(spark, tmp_path, name, body, expected):
    (tmp_path / name).write_bytes(gzip.compress(body.encode()))
    assert [r["text"] for r in rd.read_any(spark, str(tmp_path / name)).collect()] == expected


def test_read_any_keeps_commas_of_plain_text(spark, tmp_path):
    (tmp_path / "plain.txt").write_text("Hello, world, and more\nsecond\n")
    assert [r["text"] for r in rd.read_any(spark, str(tmp_path / "plain.txt")).collect()] == ["Hello, world, and more", "second"]


def test_document_tree_and_sources(spark, tmp_path):
    for source in ("alpha", "beta"):
        (tmp_path / source / "deep").mkdir(parents=True)
        body = json.dumps({"text": f"t {source}", "id": source, "metadata": {"n_words": "2"}}) + "\n"
        (tmp_path / source / "deep" / "p.jsonl.gz").write_bytes(gzip.compress(body.encode()))
    docs = rd.read_documents(spark, str(tmp_path))
    named = docs.withColumn("source", rd.source_of(F.col("file_path"), str(tmp_path)))
    assert sorted((r["source"], r["id"], r["metadata"]["n_words"]) for r in named.collect()) == [("alpha", "alpha", "2"), ("beta", "beta", "2")]
    assert rd.read_documents(spark, str(tmp_path), limit=1).count() == 1
    files = rd.list_files(spark, str(tmp_path))
    assert files.count() == 2 and rd.belonging_to(files, "p").count() == 2 and rd.belonging_to(files, "q").count() == 0


def test_text_column_cascade(spark):
    def pick(schema):
        return rd.text_column(spark.createDataFrame([], schema))

    assert pick("id long, text string, content string") == "text"
    assert pick("id long, page_content string, name string") == "page_content"
    assert pick("id long, name string") == "name"
    with pytest.raises(ValueError):
        pick("id long")


def test_wiki_dump(spark, tmp_path):
    page = '<page><title>{t}</title><ns>{n}</ns><id>{i}</id><revision><id>9</id><text xml:space="preserve">{x}</text></revision></page>'
    xml = "<mediawiki>" + page.format(t="A", n=0, i=1, x="body " * 5) + page.format(t="B", n=4, i=2, x="talk") + page.format(t="C", n=0, i=3, x="s") + "</mediawiki>"
    (tmp_path / "dump.xml.bz2").write_bytes(bz2.compress(xml.encode()))
    assert [r["title"] for r in rd.read_wiki_dump(spark, str(tmp_path / "dump.xml.bz2"), 10).collect()] == ["A"]
    assert rd.read_wiki_dump(spark, str(tmp_path / "dump.xml.bz2")).count() == 2


def test_books_and_labels(spark, tmp_path):
    (tmp_path / "b" / "x").mkdir(parents=True)
    (tmp_path / "b" / "x" / "one.txt").write_text("l1\n\nl2\n")
    book = rd.read_book_tree(spark, str(tmp_path / "b")).first()
    assert book["text"] == "l1\n\nl2\n" and book["path"].endswith("x/one.txt")
    block = "Example 3:\nEnglish:\nhi\nOption 1:\na\nOption 2:\nb\nRating: 2\nGold:\nfixed\n" + "-" * 50 + "\n"
    (tmp_path / "l.txt").write_text(block * 2)
    rows = rd.read_labelled_files(spark, str(tmp_path / "l.txt")).collect()
    assert len(rows) == 2 and (rows[0]["example_index"], rows[0]["rating"], rows[0]["gold"], rows[0]["option_2"]) == (3, "2", "fixed", "b")


def test_eval_runs(spark, tmp_path):
    run = tmp_path / "2025-09-16T19-47-51" / "m"
    run.mkdir(parents=True)
    (run / "results.json").write_text(json.dumps({
        "results": {"all": {"acc": 1}, "c|arc|5": {"acc": 0.0, "acc_stderr": 0.1}, "gsm": {"em_with_normalize_gold&normalize_pred": 0.4}},
        "config_tasks": {"c|arc|5": {"name": "arc"}}, "config_general": {"model_name": "x/step-7", "max_samples": None},
    }))
    got = sorted((r["bench"], r["score"], r["std"], r["timestamp"]) for r in rd.read_eval_runs(spark, str(tmp_path)).collect())
    assert got == [("arc", 0.0, 0.1, "2025-09-16T19-47-51"), ("gsm", 0.4, None, "2025-09-16T19-47-51")]


def test_pushdown(spark):
    plan = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").select("text")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(text)" in text and "lang" not in text.split("ReadSchema")[1]


def test_writers(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    judged = q.annotate_quality(docs)
    wr.write_filtered(judged, str(tmp_path / "filtered"))
    back = spark.read.json(str(tmp_path / "filtered"))
    assert back.count() == docs.count() and {r["folder"] for r in back.select("folder").distinct().collect()} >= {"output", "removed_min_doc"}
    wr.write_by_source(docs, str(tmp_path / "src"), records_per_file=5)
    assert spark.read.parquet(str(tmp_path / "src")).count() == docs.count()
    wr.write_size_chunks(docs, str(tmp_path / "chunks"), "doc_id", 10_000)
    assert spark.read.json(str(tmp_path / "chunks")).count() == docs.count()
    wr.write_articles(docs, str(tmp_path / "articles"), 50)
    assert len(list((tmp_path / "articles").glob("*.json"))) >= docs.count() // 50
    mixed = tr.mixture(docs, ["src7"], 5, 900)
    wr.write_mixture(mixed, tr.mixture_manifest(mixed), str(tmp_path / "mix"))
    assert spark.read.json(str(tmp_path / "mix" / "mixed_dataset")).count() == mixed.count()
    wr.write_report(reports.report_tables(judged), str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "filter_counts")).count() > 0
    wr.write_deduplicated(docs.limit(3), docs.limit(2), str(tmp_path / "dd"))
    assert spark.read.parquet(str(tmp_path / "dd" / "removed")).count() == 2


def test_stream_reads_only_new_files(spark, tmp_path):
    inbox, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    inbox.mkdir()
    step = compose([cleaner(cl.WEB_RULES), lambda df: q.annotate_quality(df, overrides={}, source_col=None)])

    def run():
        stream = read_new_files(spark, str(inbox), rd.TEXT_CSV)
        process_new_files(stream, step, out, mark).awaitTermination()
        return spark.read.parquet(out).count()

    (inbox / "a.json").write_text('{"text": "a&quot;"}\n{"text": "b"}\n')
    assert run() == 2
    assert run() == 2
    (inbox / "b.json").write_text('{"text": "c"}\n')
    assert run() == 3
    assert {r["text"] for r in spark.read.parquet(out).collect()} == {'a"', "b", "c"}


def test_folder_of_mixed_files(spark, tmp_path):
    (tmp_path / "deep dir").mkdir()
    (tmp_path / "a.csv").write_text('n_words,text\n2,"x, y"\n')
    (tmp_path / "b.csv").write_text('"plain ""text""\nof two lines",5\nalone\n')
    (tmp_path / "c.csv").write_text("id,content\n7,three word text\n")
    (tmp_path / "d.jsonl").write_text('{"text": "json one"}\n')
    (tmp_path / "deep dir" / "e.gz").write_bytes(gzip.compress(b'\n  {"content": "json two", "other": 1}\n'))
    (tmp_path / "deep dir" / "f.txt").write_text("Hello, world, and more\nsecond\n")
    (tmp_path / "empty.txt").write_text("")
    spark.createDataFrame([("of a table",)], "text string").coalesce(1).write.parquet(str(tmp_path / "g.parquet"))
    got = rd.read_mixed(spark, str(tmp_path), "[a-z]*").where("text IS NOT NULL").collect()
    assert sorted((r["text"], r["n_words"]) for r in got) == sorted([
        ("x, y", 2), ('plain "text"\nof two lines', 5), ("alone", 1), ("three word text", 3), ("json one", 2), ("json two", 2),
        ("Hello, world, and more", 4), ("second", 1), ("of a table", 3),
    ])
    assert {r["file_path"].rsplit("/", 1)[1] for r in got} >= {"a.csv", "b.csv", "e.gz", "f.txt"}
    (tmp_path / "csv").mkdir()
    for name in "abc":
        (tmp_path / "csv" / f"{name}.csv").write_bytes((tmp_path / f"{name}.csv").read_bytes())
    rows = rd.read_text_csv(spark, str(tmp_path / "csv"), header="auto")
    assert sorted(rows.columns) == ["content", "id", "n_words", "text"]
    assert sorted((r["text"] or r["content"], r["n_words"]) for r in rows.collect()) == [
        ("alone", None), ('plain "text"\nof two lines', 5), ("three word text", None), ("x, y", 2)]
