"""Declared jobs: where documents come from, what is done to them, where results go."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tamis.functions.cleaning import BOOK_RULES, HTML_TO_TEXT, WEB_RULES
from tamis.functions.text import word_count
from tamis.operators import dedup, reports
from tamis.operators.cleaning import clean_text
from tamis.operators.quality import Thresholds, annotate_quality
from tamis.session import run_folder
from tamis.sources import readers, writers

READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parquet": lambda spark, path: spark.read.parquet(path),
    "any": readers.read_any,
    "documents": readers.read_documents,
    "books": readers.read_book_tree,
    "wiki": readers.read_wiki_dump,
}
RULES = {"web": WEB_RULES, "books": BOOK_RULES, "html": HTML_TO_TEXT}
SINKS: dict[str, Callable[[DataFrame, str], None]] = {
    "filtered": writers.write_filtered,
    "kept": lambda judged, path: judged.where("filter_reason IS NULL").write.mode("overwrite").parquet(path),
    "by_source": lambda judged, path: writers.write_by_source(judged.where("filter_reason IS NULL"), path),
    "report": lambda judged, path: writers.write_report(reports.report_tables(judged), path),
}


@dataclass(frozen=True)
class Job:
    """One source: ``reader`` and ``path``, ``rules`` in order, columns whose equality makes a copy, ``gates``, sinks by folder."""

    name: str
    path: str
    reader: str = "parquet"
    rules: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    gates: Thresholds | None = None
    overrides: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    sinks: Mapping[str, str] = field(default_factory=dict)
    id_col: str = "doc_id"


def problems(jobs: Sequence[Job]) -> list[str]:
    """What is wrong with the declarations; found before anything is read."""
    found = [f"{name}: declared {n} times" for name, n in Counter(j.name for j in jobs).items() if n > 1]
    targets = Counter(path.rstrip("/") for j in jobs for path in j.sinks.values())
    found += [f"{path}: written by {n} sinks" for path, n in targets.items() if n > 1]
    for job in jobs:
        unknown = [("reader", job.reader, READERS), *(("rules", r, RULES) for r in job.rules), *(("sink", s, SINKS) for s in job.sinks)]
        found += [f"{job.name}: no {kind} named {name}; there are {', '.join(sorted(known))}" for kind, name, known in unknown if name not in known]
        if not job.sinks:
            found.append(f"{job.name}: no sink")
    return found


def run_job(spark: SparkSession, job: Job) -> DataFrame:
    """``job, documents, copies, removed, kept, words_kept``; the sinks are written.

    Documents are read, cleaned and judged once and kept in a folder of the run, from which sinks and
    counts are served.
    """
    folder = run_folder(spark, f"job-{job.name}")
    docs = READERS[job.reader](spark, job.path)
    for name in job.rules:
        docs = clean_text(docs, RULES[name])
    if "n_words" not in docs.columns:
        docs = docs.withColumn("n_words", word_count(F.col("text")))
    docs.write.parquet(f"{folder}/cleaned")
    cleaned = spark.read.parquet(f"{folder}/cleaned")
    single = dedup.drop_exact(cleaned, job.id_col, list(job.exact)) if job.exact else cleaned
    if job.gates:
        judged = annotate_quality(single, job.gates, job.overrides, source_col="source" if job.overrides else None)
    else:
        judged = single.withColumn("filter_reason", F.lit(None).cast("string")).withColumn("filter_group", F.lit(None).cast("string"))
    judged.write.parquet(f"{folder}/judged")
    judged = spark.read.parquet(f"{folder}/judged")
    for sink, path in job.sinks.items():
        SINKS[sink](judged, path)
    kept = F.col("filter_reason").isNull()
    counts = judged.agg(
        F.count(F.lit(1)).alias("single"), F.count_if(kept).alias("kept"), F.coalesce(F.sum(F.when(kept, F.col("n_words"))), F.lit(0)).alias("words_kept"),
    )
    every = cleaned.agg(F.count(F.lit(1)).alias("documents"))
    # Two rows meet.
    return every.withColumn("job", F.lit(job.name)).join(counts.withColumn("job", F.lit(job.name)), "job").select(
        "job", "documents", (F.col("documents") - F.col("single")).alias("copies"), (F.col("single") - F.col("kept")).alias("removed"), "kept", "words_kept",
    )


def run_jobs(spark: SparkSession, jobs: Sequence[Job]) -> DataFrame:
    """Check all declarations, then run the jobs one after another; one row each."""
    wrong = problems(jobs)
    if wrong or not jobs:
        raise ValueError("; ".join(wrong) or "no jobs")
    done = [run_job(spark, job) for job in jobs]
    total = done[0]
    for one in done[1:]:
        total = total.unionByName(one)
    return total
