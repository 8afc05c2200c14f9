"""Exact and near-duplicate removal.

Near duplicates: MinHash signatures per document, equal bands link documents to the
smallest id of their bucket (a star, never all pairs), connected components give
clusters, the smallest id of each is kept.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tamis.functions.text import PUNCTUATION_CLASS, strip, word_count
from tamis.operators.quality import n_grams
from tamis.session import cut_lineage

PRIME = 2**61 - 1


@dataclass(frozen=True)
class MinHashConfig:
    """Bands times rows hashes over word n-grams."""

    bands: int = 14
    rows: int = 8
    n_gram: int = 5
    seed: int = 1

    def coefficients(self) -> list[tuple[int, int]]:
        """The (a, b) pairs of ``(a * h + b) mod PRIME``, fixed by the seed."""
        draw = random.Random(self.seed)
        return [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(self.bands * self.rows)]


# Bands and rows of the three settings; "balanced" is the default.
PRESETS = {
    "high": MinHashConfig(bands=20, rows=10),
    "balanced": MinHashConfig(bands=14, rows=8),
    "fast": MinHashConfig(bands=10, rows=6),
}


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


SALTS = 256


def group_minima(df: DataFrame, keys: list[str], value: str, name: str = "least", salts: int = SALTS) -> DataFrame:
    """``keys, _salt, <name>, _n``: smallest value and size of each group, once for every salt that occurs in it.

    Two levels: minima per (key, salt), then over the at most ``salts`` minima of a key.  Joined back by
    key and salt, the rows of one key meet in up to ``salts`` tasks, however many they are.
    """
    parts = df.groupBy(*keys, salt_of(value, salts)).agg(F.min(value).alias("_least"), F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(*keys)
    return parts.select(*keys, "_salt", F.min("_least").over(w).alias(name), F.sum("_rows").over(w).alias("_n"))


def salt_of(value: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(salts)).cast("int").alias("_salt")


def exact_groups(df: DataFrame, id_col: str, cols: list[str], salts: int = SALTS) -> DataFrame:
    """``id, kept_id``: every row with the smallest id among rows equal on ``cols``.

    Only ids and 128-bit digests are shuffled, and the smallest id per digest is pre-aggregated in
    each task.  Digests that occur once need no way back; the rows of the others are joined by
    digest and salt, so that a text which most rows share is not one task's work.
    """
    hashed = df.select(id_col, content_key(*[F.col(c) for c in cols]).alias("_key"))
    shared = group_minima(hashed, ["_key"], id_col, "kept_id", salts).where("_n > 1").drop("_n")
    joined = hashed.withColumn("_salt", salt_of(id_col, salts)).join(shared, ["_key", "_salt"], "left")
    return joined.select(id_col, F.coalesce("kept_id", id_col).alias("kept_id"))


def content_key(*cols: Column) -> Column:
    """Digest of several values with their lengths, so that neighbours, nulls among them, cannot run together."""
    # A null is "-", which no length begins with.
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws(":", *parts)))


def drop_exact(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """Rows with the smallest id per distinct content."""
    key = content_key(*[F.col(c) for c in cols])
    survivors = df.select(id_col, key.alias("_key")).groupBy("_key").agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(survivors, id_col, "left_semi")


def dedup_lines_and_rows(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Repeated lines inside a text go first, then rows equal on text and word count."""
    from tamis.operators.cleaning import unique_lines

    cleaned = df.withColumn(text_col, unique_lines(F.col(text_col)))
    cleaned = cleaned.withColumn("n_words", word_count(F.col(text_col)))
    return drop_exact(cleaned, id_col, [text_col, "n_words"])


def line_dedup_counts(text: Column) -> tuple[Column, Column]:
    """Non-blank lines, and how many of them repeat an earlier one."""
    kept = F.filter(F.transform(F.split(text, r"\r?\n", -1), strip), lambda x: x != "")
    return F.size(kept).cast("long"), (F.size(kept) - F.size(F.array_distinct(kept))).cast("long")


# A word character of the normal form: neither blank nor ASCII punctuation.
PLAIN = rf"[^\s{PUNCTUATION_CLASS}]"
_PLAIN_WORD = re.compile(PLAIN + "+", re.ASCII)


def normalised_words(text: Column) -> Column:
    """Lower-cased words; ASCII punctuation separates them as blanks do."""
    return F.regexp_extract_all(F.lower(text), F.lit(PLAIN + "+"), F.lit(0))


def shingles(word_array: Column, n: int) -> Column:
    """Word n-grams; a text of fewer than n words is one shingle."""
    return F.when(F.size(word_array) >= n, n_grams(word_array, n)).otherwise(F.array(F.array_join(word_array, " ")))


def shingle_hashes(text: str, n: int) -> list[int]:
    """One 60-bit hash per distinct shingle of a lower-cased text, those of ``shingles`` in order."""
    found = _PLAIN_WORD.findall(text)
    grams = dict.fromkeys(map(" ".join, zip(*(found[i:] for i in range(n))))) if len(found) >= n else [" ".join(found)]
    return [int.from_bytes(md5(g.encode()).digest()[:8]) >> 4 for g in grams]


def base_hashes(df: DataFrame, id_col: str, config: MinHashConfig, text_col: str = "text") -> DataFrame:
    """``id, hashes``: one 60-bit hash per distinct shingle, computed in the row."""
    n = config.n_gram

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def hashes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda v: None if v is None else np.array(shingle_hashes(v, n), dtype=np.int64))

    words = df.where(F.col(text_col).rlike(PLAIN))
    return words.select(id_col, hashes(F.lower(F.col(text_col))).alias("hashes"))


def _minima(a: np.ndarray, b: np.ndarray, hashes: np.ndarray, block: int = 1024) -> np.ndarray:
    """Row of ``min((a * h + b) mod PRIME)``, in blocks so that long texts stay small in memory."""
    prime, half, low31, low30 = np.uint64(PRIME), np.uint64(31), np.uint64(2**31 - 1), np.uint64(2**30 - 1)
    a, b, hashes = (np.asarray(v).astype(np.uint64)[:, None] for v in (a, b, hashes))
    a1, a0 = a >> half, a & low31
    best = np.full(len(a), prime)
    for i in range(0, len(hashes), block):
        h = hashes[i : i + block].T
        h1, h0 = h >> half, h & low31
        # The product in halves of 31 bits; 2**61 is 1 modulo the prime, so high parts fold down.
        middle = a1 * h0 + a0 * h1
        x = np.uint64(2) * (a1 * h1) + (middle >> np.uint64(30)) + ((middle & low30) << half) + a0 * h0
        x = (x & prime) + (x >> np.uint64(61)) + b
        x = (x & prime) + (x >> np.uint64(61))
        x[x == prime] = 0
        best = np.minimum(best, x.min(axis=1))
    return best.astype(np.int64)


def signatures(df: DataFrame, id_col: str, config: MinHashConfig | None = None, text_col: str = "text") -> DataFrame:
    """``id, signature``: bands x rows minima.  No shuffle: a document is hashed where it lies."""
    config = config or MinHashConfig()
    pairs = np.array(config.coefficients(), dtype=np.int64)
    a, b = pairs[:, 0].copy(), pairs[:, 1].copy()

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def minima(hashes: pd.Series) -> pd.Series:
        return hashes.map(lambda h: _minima(a, b, np.asarray(h, dtype=np.int64)))

    return base_hashes(df, id_col, config, text_col).select(id_col, minima("hashes").alias("signature"))


def band_keys(sigs: DataFrame, id_col: str, config: MinHashConfig | None = None) -> DataFrame:
    """``id, band, key``: one row per band, the key a digest of its hashes."""
    config = config or MinHashConfig()
    keys = [
        F.unhex(F.md5(F.array_join(F.slice("signature", i * config.rows + 1, config.rows), ",")))
        for i in range(config.bands)
    ]
    return sigs.select(id_col, F.posexplode(F.array(*keys)).alias("band", "key"))


def bucket_edges(bands: DataFrame, id_col: str, salts: int = SALTS) -> DataFrame:
    """``src, dst``: each member of a shared bucket points to the bucket's smallest id.

    Smallest id and size are found in two levels and come back by bucket and salt, so the members of
    a bucket that holds most rows are spread over ``salts`` tasks.
    """
    heads = group_minima(bands, ["band", "key"], id_col, "dst", salts).where("_n > 1").drop("_n")
    linked = bands.withColumn("_salt", salt_of(id_col, salts)).join(heads, ["band", "key", "_salt"])
    return linked.where(F.col(id_col) != F.col("dst")).select(F.col(id_col).alias("src"), "dst").distinct()


def connected_components(edges: DataFrame, salts: int = SALTS) -> DataFrame:
    """``id, component`` for every id in ``edges(src, dst)``; the component is its smallest id.

    Alternates two steps until only stars are left: every node hands its larger neighbours
    its smallest neighbour, then the same for the smaller ones.  Rounds grow with the
    logarithm of the longest chain.  The smallest neighbour of a node with very many is
    found and handed out by salts, so no node is one task's work.  Each round is written
    to the checkpoint folder, so lineage stays short and a lost executor re-reads it.
    """
    def orient(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u != v").distinct()

    def with_least(df: DataFrame) -> DataFrame:
        low = group_minima(df, ["u"], "v", "m", salts).drop("_n")
        return df.withColumn("_salt", salt_of("v", salts)).join(low, ["u", "_salt"])

    def large_step(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        return orient(with_least(both).where("v > u").select(F.col("v").alias("src"), F.least("m", "u").alias("dst")))

    def small_step(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("src"), F.col("m").alias("dst"))
        return orient(with_least(e).select(F.col("v").alias("src"), F.col("m").alias("dst")).union(low))

    def settled(df: DataFrame) -> bool:
        """Whether every node has either larger neighbours only or one smaller one only."""
        ends = df.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(df.select("v", F.lit(0), F.lit(1)))
        sums = ends.groupBy("id").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        return sums.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()

    current = cut_lineage(orient(edges))
    while not settled(current):
        current = cut_lineage(small_step(large_step(current)))
    # The edges are now a star per component: one row per non-minimal id.
    centres = current.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(centres)


def near_duplicate_clusters(
    df: DataFrame, id_col: str, config: MinHashConfig | None = None, text_col: str = "text", min_jaccard: float | None = None
) -> DataFrame:
    """``id, component`` for every document that has a near duplicate.

    Exact copies are tied to their smallest id beforehand, so each distinct text is
    hashed once and heavy copying never reaches the buckets.
    """
    config = config or MinHashConfig()
    copies = cut_lineage(exact_groups(df, id_col, [text_col]))
    distinct_ids = copies.where(F.col(id_col) == F.col("kept_id")).select(id_col)
    sigs = cut_lineage(signatures(df.join(distinct_ids, id_col, "left_semi"), id_col, config, text_col))
    bands = band_keys(sigs, id_col, config)
    if min_jaccard is None:
        edges = bucket_edges(bands, id_col)
    else:
        edges = verified_bucket_edges(bands, df, id_col, min_jaccard, config, text_col)
    copy_edges = copies.where(F.col(id_col) != F.col("kept_id")).select(F.col(id_col).alias("src"), F.col("kept_id").alias("dst"))
    found = connected_components(edges.union(copy_edges))
    return found.select(F.col("id").alias(id_col), "component")


def verified_edges(
    edges: DataFrame, df: DataFrame, id_col: str, threshold: float, config: MinHashConfig | None = None, text_col: str = "text"
) -> DataFrame:
    """``src, dst, jaccard`` of the edges whose shingle sets overlap at least ``threshold``.

    The shingle hashes of both ends are joined on; an edge stays a single row.
    """
    config = config or MinHashConfig()
    needed = edges.select(F.col("src").alias(id_col)).union(edges.select(F.col("dst").alias(id_col))).distinct()
    sets = base_hashes(df.join(needed, id_col, "left_semi"), id_col, config, text_col)
    left = sets.select(F.col(id_col).alias("src"), F.col("hashes").alias("_a"))
    right = sets.select(F.col(id_col).alias("dst"), F.col("hashes").alias("_b"))
    both = edges.join(left, "src").join(right, "dst")
    shared = F.size(F.array_intersect("_a", "_b"))
    jaccard = shared / (F.size("_a") + F.size("_b") - shared)
    return both.select("src", "dst", jaccard.alias("jaccard")).where(F.col("jaccard") >= threshold)


def verified_bucket_edges(
    bands: DataFrame, df: DataFrame, id_col: str, threshold: float, config: MinHashConfig | None = None, text_col: str = "text"
) -> DataFrame:
    """``src, dst``: verified edges that tie whatever a chain of links inside the buckets ties.

    The smallest id of a bucket is its first head.  While a bucket holds several components, members
    outside its largest become heads in turn, ever more at once, and are compared with the members of
    other components, until each is in the largest or has been a head.
    """
    members = cut_lineage(bands.select(F.struct("band", "key").alias("bucket"), F.col(id_col).alias("id")))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    members = cut_lineage(members.join(shared, "bucket"))
    tested = cut_lineage(bucket_edges(bands, id_col).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())
    links = cut_lineage(verified_edges(tested, df, id_col, threshold, config, text_col).select("src", "dst"))
    served, heads_at_once = members.select("bucket", "id").limit(0), 1
    while True:
        found = connected_components(links)
        label = cut_lineage(members.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")))
        sizes = label.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
        split = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        inside = cut_lineage(label.join(split.select("bucket", F.col("top.component").alias("largest")), "bucket"))
        waiting = inside.where("component != largest").join(served, ["bucket", "id"], "left_anti")
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
        heads = cut_lineage(waiting.withColumn("place", place).where(F.col("place") <= heads_at_once).select("bucket", "id", "component"))
        if heads.isEmpty():
            return links
        left = heads.select("bucket", F.col("id").alias("head"), F.col("component").alias("own"))
        pairs = inside.join(left, "bucket").where("component != own").select(F.least("id", "head").alias("src"), F.greatest("id", "head").alias("dst"))
        pairs = cut_lineage(pairs.distinct().join(tested, ["src", "dst"], "left_anti"))
        more = verified_edges(pairs, df, id_col, threshold, config, text_col).select("src", "dst")
        links, tested = cut_lineage(links.union(more)), cut_lineage(tested.union(pairs))
        served = cut_lineage(served.union(heads.select("bucket", "id")))
        heads_at_once *= 8


def split_duplicates(df: DataFrame, clusters: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Kept documents (one per cluster) and the removed ones."""
    removed_ids = clusters.where(F.col(id_col) != F.col("component")).select(id_col)
    return df.join(removed_ids, id_col, "left_anti"), df.join(removed_ids, id_col, "left_semi")
