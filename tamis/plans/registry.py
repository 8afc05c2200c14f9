"""Registry of named queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tamis.session import spread

QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Key of each table, used when a small file has to be spread over the cores.
KEYS = {
    "documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id"], "events": ["event_id"],
    "embeddings": ["vec_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"], "supplier": ["s_suppkey"],
    "nation": ["n_nationkey"], "region": ["r_regionkey"],
}


class Tables:
    """The input tables of one run."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in KEYS:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def docs(self) -> DataFrame:
        """``documents`` spread over all cores, for work that is heavy per row."""
        return spread(self.documents, "doc_id")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
