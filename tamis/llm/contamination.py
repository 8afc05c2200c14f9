"""Benchmark items inside documents: size-partitioned MinHash containment search, then an exact check."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tamis.llm.arrays import hash_words, mix, shingle_hashes
from tamis.llm.frames import text_bytes
from tamis.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle, the ``containment`` of a find, and the chance ``miss`` of losing one.

    ``block_items`` bounds what a task holds of the benchmark; more items are searched in blocks.
    """

    words: int = 5
    containment: float = 0.8
    miss: float = 1e-9
    block_items: int = 20_000


def text_shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Shingle hashes of each text in lower case; none for a text of fewer words."""
    hashes, counts = hash_words([t.decode("utf-8", "replace").lower().encode() for t in texts])
    ends = np.cumsum(counts).tolist()
    return [shingle_hashes(hashes[a:b], words) if b - a >= words else hashes[:0] for a, b in zip([0, *ends], ends)]


def probes_of(size: int, settings: Settings) -> tuple[int, int]:
    """For items of a size class (the largest ``size``): minima per item, and how many must be met.

    The least shingle of an item under a random order is a uniformly random shingle of it, so a
    document that contains a share c of the item holds that minimum with probability c.  Of k
    minima at least m are met except with probability ``miss``; the class takes the smallest k
    for which m can be a quarter of k, or all shingles where the item is not larger than k.
    """
    c = settings.containment
    for k in range(4, 257):
        below, m = (1 - c) ** k, 0
        while below <= settings.miss and m <= k // 4:
            m += 1
            below += math.comb(k, m) * c**m * (1 - c) ** (k - m)
        if m >= max(1, k // 4):
            return min(k, size), 1 if size <= k else m
    return 256, 1


def _minima(shingles: np.ndarray, k: int) -> np.ndarray:
    """The least shingle under each of k orders."""
    if len(shingles) <= k:
        return shingles
    orders = mix(shingles[None, :] ^ mix(np.arange(1, k + 1, dtype=np.uint64))[:, None])
    return shingles[orders.argmin(axis=1)]


class Index:
    """Items by size class, the minima of each, and all their shingles for the check."""

    def __init__(self, ids: list, texts: list[bytes], settings: Settings):
        self.ids, self.settings = ids, settings
        self.shingles = [np.unique(s) for s in text_shingles(texts, settings.words)]
        self.sizes = np.array([len(s) for s in self.shingles])
        keys, owners, self.needed = [], [], np.ones(len(ids), np.int64)
        classes = np.ceil(np.log2(np.maximum(self.sizes, 1))).astype(int)
        for c in np.unique(classes[self.sizes > 0]):
            k, m = probes_of(1 << int(c), settings)
            for i in np.flatnonzero((classes == c) & (self.sizes > 0)):
                minima = _minima(self.shingles[i], k)
                keys.append(minima)
                owners.append(np.full(len(minima), i))
                self.needed[i] = m if self.sizes[i] > k else 1
        key, owner = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (owners, np.int64)))
        order = np.argsort(key, kind="stable")
        self.key, self.owner = key[order], owner[order]
        # One bit per low part of a key tells most shingles apart without a search.
        self.bits = max(16, int(max(1, len(key)) * 32).bit_length())
        self.known = np.zeros(1 << self.bits, bool)
        self.known[(key & np.uint64((1 << self.bits) - 1)).astype(np.int64)] = True
        self.all = [np.sort(s) for s in self.shingles]

    def find(self, document: np.ndarray) -> list[tuple[int, float]]:
        """``item, containment`` of the items contained in a document, given its shingle hashes."""
        likely = document[self.known[(document & np.uint64((1 << self.bits) - 1)).astype(np.int64)]]
        if not len(likely) or not len(self.key):
            return []
        likely = np.unique(likely)
        a, b = np.searchsorted(self.key, likely, "left"), np.searchsorted(self.key, likely, "right")
        met = np.concatenate([self.owner[x:y] for x, y in zip(a, b) if y > x] or [self.owner[:0]])
        items, counts = np.unique(met, return_counts=True)
        items = items[counts >= self.needed[items]]
        if not len(items):
            return []
        whole = np.unique(document)
        found = []
        for i in items.tolist():
            share = float(np.isin(self.all[i], whole, assume_unique=True).sum()) / len(self.all[i])
            if share >= self.settings.containment - 1e-12:
                found.append((i, share))
        return found


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """``<id>, <item>, containment``: items of which a document holds at least ``containment`` of the shingles.

    Items are partitioned by size; each class has its number of minima and of minima to be met.
    A document's shingles probe the minima where the document lies; items that enough of them hit
    are checked exactly on all their shingles at once.  Nothing of the documents is shuffled.
    The benchmark is dealt into blocks of at most ``block_items`` items and each task holds one
    block, so more items mean more passes and not more memory.

    Null texts are empty.  Documents and items of fewer words than a shingle neither contain nor
    are contained.  Rows with a null item id or document id take no part; repeated rows are found
    once per distinct pair.  Either table may be empty: then nothing is found.
    """
    benchmark = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), text_bytes(item_text_col).alias("text")).distinct()
    n = benchmark.count()
    blocks = -(-n // settings.block_items)
    slim = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    schema = f"id {dict(slim.dtypes)['id']}, item {dict(benchmark.dtypes)['item']}, containment double"
    if blocks == 0:
        return _named(docs.sparkSession.createDataFrame([], schema), id_col, item_col)
    numbered = cut_lineage(benchmark.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))))
    found = None
    for block in range(blocks):
        # Bounded: one block of the benchmark, never documents.
        rows = numbered.where(F.col("block") == block).select("item", "text").collect()
        sent = docs.sparkSession.sparkContext.broadcast(([r["item"] for r in rows], [bytes(r["text"]) for r in rows]))

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            ids, texts = sent.value
            index = Index(ids, texts, settings)
            for batch in batches:
                out = []
                for doc, shingles in zip(batch["id"].tolist(), text_shingles(batch["text"].tolist(), settings.words)):
                    out += [(doc, ids[i], share) for i, share in index.find(shingles)]
                yield pd.DataFrame(out, columns=["id", "item", "containment"])

        part = slim.mapInPandas(search, schema)
        found = part if found is None else found.union(part)
    best = found.groupBy("id", "item").agg(F.max("containment").alias("containment"))
    return _named(best, id_col, item_col)


def _named(df: DataFrame, id_col: str, item_col: str) -> DataFrame:
    return df.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "containment")
