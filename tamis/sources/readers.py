"""Readers: JSON lines, CSV, compressed text, parquet, wiki dumps, book trees, evaluation runs."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tamis.functions.text import word_count
from tamis.operators.labels import parse_labelled_blocks
from tamis.operators.runs import metric_with_fallback

CORRUPT = "_corrupt_record"
TEXT_CSV = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType())])
DOCUMENT = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
# The text element carries an xml:space attribute, so its content sits beside it.
WIKI_PAGE = T.StructType([
    T.StructField("ns", T.LongType()), T.StructField("title", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("revision", T.StructType([
        T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_xml:space", T.StringType())])),
    ])),
])


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the unreadable lines for a report.

    Lines are parsed here and not by the JSON source, which refuses to hand out the
    unreadable ones by themselves.
    """
    with_bad = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).where(F.col("value").rlike(r"\S"))
    rows = lines.select(F.from_json("value", with_bad, options).alias("r")).select("r.*")
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def _csv(spark: SparkSession):
    return spark.read.option("multiLine", True).option("quote", '"').option("escape", '"')


def first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).limit(1).first()
    return row["value"] if row else ""


def file_heads(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """``path, head``: every file with its first line that is not blank.

    Only the first split of a file is looked at; one slim row per file is left of it in the task.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    first = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    first = first.where((F.col("at") == 0) & F.col("value").rlike(r"\S")).withColumn("line", F.monotonically_increasing_id())
    return first.groupBy("path").agg(F.min_by("value", "line").alias("head"))


def _paths_by(heads: DataFrame, kind: Column) -> dict[str, list[str]]:
    """Files by kind: as many names as the driver lists anyway to read them."""
    rows = heads.groupBy(kind.alias("kind")).agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return {r["kind"]: [unquote(p) for p in r["paths"]] for r in sorted(rows, key=lambda r: r["kind"])}


def _header(head: Column) -> Column:
    """The line where it names a text or count column, else empty."""
    names = F.transform(F.split(head, ","), lambda n: F.lower(F.btrim(F.btrim(n), F.lit('"'))))
    return F.when(F.arrays_overlap(names, F.array(*map(F.lit, ("text", "content", "n_words", "n_count")))), head).otherwise("")


def read_text_csv(spark: SparkSession, path: str | list[str], header: bool | str = False) -> DataFrame:
    """CSV of texts.  ``header='auto'`` looks for a text column in the first line of each file.

    Files with different headers, or with and without one, are read apart and put together by name.
    """
    if header is True:
        return _csv(spark).option("header", True).csv(path)
    # Lines may carry the text alone; the missing count stays null.
    plain = _csv(spark).schema(TEXT_CSV).option("header", False)
    if header != "auto":
        return plain.csv(path)
    kinds = _paths_by(file_heads(spark, path), _header(F.col("head")))
    parts = [_csv(spark).option("header", True).csv(paths) if kind else plain.csv(paths) for kind, paths in kinds.items()]
    if len(parts) < 2:
        return parts[0] if parts else plain.csv(path)
    parts = [p.withColumn("n_words", F.expr("try_cast(n_words AS bigint)")) if "n_words" in p.columns else p for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_mixed(spark: SparkSession, root: str | list[str], pattern: str = "*") -> DataFrame:
    """``text, n_words, file_path`` of all files below a folder, each read by its own format.

    Parquet, CSV and JSON go by their extension, a ``.gz`` behind it left out; other files are JSON
    where their first line begins with a brace, else plain text, a row per line.  CSV files are grouped by their
    header and JSON files by the keys of their first line, so that each group has its own text column.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")
    stem = F.regexp_replace(F.lower("path"), r"\.gz$", "")
    tables = [unquote(r["path"]) for r in listed.where(stem.endswith(".parquet")).collect()]
    rest = [unquote(r["path"]) for r in listed.where(~stem.endswith(".parquet")).collect()]
    parts = [spark.read.parquet(*tables)] if tables else []
    if rest:
        head, keys = F.col("head"), F.array_join(F.array_sort(F.json_object_keys("head")), ",")
        kind = F.when(stem.endswith(".csv"), F.concat(F.lit("csv:"), _header(head)))
        kind = kind.when(stem.rlike(r"\.jsonl?$") | F.ltrim(head).startswith("{"), F.concat(F.lit("json:"), F.coalesce(keys, F.lit(""))))
        for kind, paths in _paths_by(file_heads(spark, rest), kind.otherwise("text")).items():
            if kind.startswith("csv:"):
                parts.append(read_text_csv(spark, paths, header=len(kind) > 4))
            else:
                parts.append(spark.read.json(paths) if kind != "text" else spark.read.text(paths).withColumnRenamed("value", "text"))
    done = [resolve_text(p.withColumn("file_path", F.col("_metadata.file_path")), "file_path") for p in parts]
    empty = spark.createDataFrame([], "text string, n_words long, file_path string")
    return reduce(DataFrame.unionByName, done) if done else empty


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Read a file by its inner extension, else as JSON if its first line looks so, else as plain text.

    A comma does not make a CSV: such a file is one by its extension, or by ``read_text_csv``.
    For a folder of several formats see ``read_mixed``.
    """
    inner = path.removesuffix(".gz").lower()
    if inner.endswith(".parquet"):
        return spark.read.parquet(path)
    if inner.endswith((".jsonl", ".json")):
        return spark.read.json(path)
    if inner.endswith(".csv"):
        return read_text_csv(spark, path, header="auto")
    head = first_line(spark, path).strip()
    if head.startswith("{"):
        return spark.read.json(path)
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_documents(spark: SparkSession, root: str, pattern: str = "*.jsonl.gz", text_key: str = "text", id_key: str = "id", limit: int = -1) -> DataFrame:
    """All matching files below a folder as ``text, id, metadata, file_path``.

    Compressed files do not split: one task per file, so spread the rows before
    heavy work where files are few and large.
    """
    fields = {text_key: T.StringType(), id_key: T.StringType(), "metadata": T.MapType(T.StringType(), T.StringType())}
    schema = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(root)
    rows = rows.select(F.col(text_key).alias("text"), F.col(id_key).alias("id"), "metadata", F.col("_metadata.file_path").alias("file_path"))
    return rows.limit(limit) if limit >= 0 else rows


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", "modificationTime")


def source_of(path: Column, root: str) -> Column:
    """First folder below ``root`` on the way to the file; the file's stem where it lies in the root."""
    tail = F.regexp_extract(path, rf".*?\Q{root.rstrip('/').split('/')[-1]}\E/(.*)$", 1)
    return F.regexp_replace(F.substring_index(tail, "/", 1), r"\.[A-Za-z0-9.]+$", "")


def belonging_to(files: DataFrame, source: str, extensions: tuple[str, ...] = ("csv", "jsonl", "parquet", "gz")) -> DataFrame:
    """Files whose name starts with the source name and has a known extension."""
    name = F.substring_index("path", "/", -1)
    return files.where(name.startswith(source) & name.rlike(r"\.(?:" + "|".join(extensions) + ")$"))


def text_column(df: DataFrame) -> str:
    """Name of the text column: ``text``, else a name with text, content or message in it, else the first string."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if "text" in df.columns:
        return "text"
    for word in ("text", "content", "message"):
        for name in strings:
            if word in name.lower():
                return name
    if strings:
        return strings[0]
    raise ValueError(f"no text column among {df.columns}")


def resolve_text(df: DataFrame, *keep: str) -> DataFrame:
    """``text, n_words`` from whatever columns there are, and the columns to keep."""
    text = F.col(text_column(df.drop(*keep)))
    counted = F.coalesce(F.col("n_words").cast("long"), word_count(text)) if "n_words" in df.columns else word_count(text)
    return df.select(text.alias("text"), counted.alias("n_words"), *keep)


def first_filled(df: DataFrame, candidates: list[str], min_length: int = 0) -> Column:
    """First non-null candidate longer than ``min_length``, row by row."""
    present = [c for c in candidates if c in df.columns]
    return F.coalesce(*[F.when(F.length(c) > min_length, F.col(c)) for c in present])


def read_counted_text(spark: SparkSession, path: str, count_col: str = "n_words") -> DataFrame:
    """``text`` and its stored count, of the rows with a text; both go down to the parquet scan."""
    return spark.read.parquet(path).where("text IS NOT NULL").select("text", count_col)


def read_wiki_dump(spark: SparkSession, path: str, min_length: int = 0) -> DataFrame:
    """``id, ns, title, text`` of main-namespace pages with text.  bz2 dumps are read as they are."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(WIKI_PAGE).load(path)
    flat = pages.select("id", "ns", "title", F.col("revision.text._VALUE").alias("text"))
    return flat.where((F.col("ns") == 0) & F.col("text").isNotNull() & (F.length("text") >= min_length))


def read_book_tree(spark: SparkSession, root: str) -> DataFrame:
    """``path, text``: each file below the folder whole."""
    files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_labelled_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_labelled_blocks(files)


RUN_JSON = (
    "results map<string,map<string,double>>, config_tasks map<string,struct<name:string>>, "
    "config_general struct<model_name:string,max_samples:bigint>"
)


def eval_run_rows(files: DataFrame) -> DataFrame:
    """Rows ``timestamp, model_name, samples_number, bench, score, std`` from run files ``path, value``.

    The run folder names the time; the ``all`` entry is a summary and is left out.
    """
    parsed = files.select("path", F.from_json("value", RUN_JSON).alias("j"))
    tasks = parsed.select("path", "j.config_general", "j.config_tasks", F.explode("j.results").alias("task", "metrics")).where("task <> 'all'")
    score, error = metric_with_fallback(F.col("metrics"))
    return tasks.select(
        F.regexp_extract("path", r"(\d{4}-\d\d-\d\dT\d\d-\d\d-\d\d[^/]*)", 1).alias("timestamp"),
        F.col("config_general.model_name").alias("model_name"), F.col("config_general.max_samples").alias("samples_number"),
        F.coalesce(F.try_element_at("config_tasks", F.col("task"))["name"], F.col("task")).alias("bench"),
        score.alias("score"), error.alias("std"),
    )


def read_eval_runs(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    return eval_run_rows(files.select(F.col("_metadata.file_path").alias("path"), "value"))


def details_benchmark(path: Column) -> Column:
    """Benchmark named between bars in a details file name, else the file's stem."""
    name = F.substring_index(path, "/", -1)
    barred = F.nullif(F.regexp_extract(name, r"\|([^|]+)\|", 1), F.lit(""))
    return F.coalesce(barred, F.regexp_replace(name, r"\.[^.]+$", ""))
