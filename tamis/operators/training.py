"""Mixtures, splits, tokens and sequence packing for training data."""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tamis.functions.hashing import hash60
from tamis.functions.text import word_count
from tamis.operators.reports import TOKEN
from tamis.operators.rows import first_n, row_numbers
from tamis.operators.sampling import split_flag


def word_gate(df: DataFrame, max_words: int = 900, exempt: list[str] = (), text_col: str = "text") -> DataFrame:
    """Texts of at most ``max_words`` words; sources in ``exempt`` pass whole."""
    fits = word_count(F.col(text_col)) <= max_words
    return df.where(F.col("source").isin(list(exempt)) | fits)


def source_rank(priority: list[str]) -> Column:
    """Position of a source in the priority list; others share the place after it."""
    rank = F.lit(len(priority))
    for i, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col("source") == name, i).otherwise(rank)
    return rank


def first_texts(df: DataFrame, n: int = 880, id_col: str = "doc_id") -> DataFrame:
    """The first n texts of each source in id order."""
    return first_n(df, ["source"], [id_col], n)


def mixture(df: DataFrame, priority: list[str], max_texts: int = 880, max_words: int = 900, exempt: list[str] = (), id_col: str = "doc_id") -> DataFrame:
    """Per-source cap after the word gate, with each source's place in the mix."""
    gated = word_gate(df.where(F.col("text") != ""), max_words, exempt)
    return first_texts(gated, max_texts, id_col).withColumn("source_rank", source_rank(priority))


def mixture_manifest(mixed: DataFrame, exempt: list[str] = (), max_words: int = 900) -> DataFrame:
    """One row per source in mix order: texts taken and the gate that applied."""
    counts = mixed.groupBy("source_rank", "source").agg(F.count(F.lit(1)).alias("text_count"))
    order = F.row_number().over(Window.orderBy("source_rank", "source")).cast("long")
    free = F.col("source").isin(list(exempt))
    return counts.select(
        order.alias("position"), "source", "text_count", F.when(free, "No").otherwise("Yes").alias("word_filter"),
        F.when(free, "N/A").otherwise(str(max_words)).alias("max_words"),
    )


def require_text(df: DataFrame, column: str = "text") -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"training data needs a '{column}' column, found {df.columns}")
    return df


def tokens(c: Column, max_length: int = 4096) -> Column:
    """Pattern tokens, cut to the sequence length."""
    return F.slice(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0)), 1, max_length)


_LOADED: dict[str, Callable[[list[str]], list[list[int]]]] = {}


def load_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Texts to ids by a tokenizer file: JSON of the tokenizers library, or a sentencepiece model."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=path).encode
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in found.encode_batch_fast(texts, add_special_tokens=False)]


def _tokenized(
    df: DataFrame, path: str, load: Callable[[str], Callable[[list[str]], list[list[int]]]], text_col: str, name: str, kind: str, make: Callable, text_chars: int,
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:  # once per worker, not per task
            _LOADED.clear()
            _LOADED[path] = load(path)
        encode = _LOADED[path]
        for batch in batches:
            texts = batch.column(text_col)
            first, size = 0, 0
            for i in range(len(texts)):
                size += len(texts[i].as_py() or "")
                # So many characters at once that ids of long texts never pile up.
                if size >= text_chars or i == len(texts) - 1:
                    part = batch.slice(first, i + 1 - first)
                    given = part.column(text_col).to_pylist()
                    ids = iter(encode([t for t in given if t is not None]))
                    made = pa.array([None if t is None else make(next(ids)) for t in given], pa.int64() if kind == "long" else pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])
                    first, size = i + 1, 0

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType() if kind == "long" else T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def token_ids(df: DataFrame, path: str, text_col: str = "text", name: str = "token_ids", load=load_encoder, text_chars: int = 1 << 20) -> DataFrame:
    """Add the ids of whole texts by a tokenizer file; null stays null.

    ``load`` turns the path into a function from texts to ids and is called once per worker, so any
    tokenizer serves that the workers can load.  Texts are encoded where they lie; columns pass as
    Arrow, so ids of documents keep their type.
    """
    return _tokenized(df, path, load, text_col, name, "ids", lambda ids: ids, text_chars)


def token_counts(df: DataFrame, path: str, text_col: str = "text", name: str = "n_tokens", load=load_encoder, text_chars: int = 1 << 20) -> DataFrame:
    """Add the number of ids of whole texts; see ``token_ids``.  Ids themselves never leave the worker."""
    return _tokenized(df, path, load, text_col, name, "long", len, text_chars)


def with_split(df: DataFrame, id_col: str = "doc_id", validation_share: float = 0.1, seed: int = 42) -> DataFrame:
    return df.withColumn("split", split_flag(id_col, validation_share, seed))


def split_info(df: DataFrame, length_col: str) -> DataFrame:
    """Rows and token statistics by split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(length_col).alias("tokens"), F.max(length_col).alias("longest"),
        F.round(F.avg(length_col), 6).alias("avg_tokens"),
    )


def document_lengths(df: DataFrame, text_col: str = "text", append_end: bool = True) -> DataFrame:
    """Token counts of whole documents, with one end-of-document token."""
    n = F.regexp_count(F.col(text_col), F.lit(TOKEN)).cast("long")
    return df.withColumn("n_tokens", n + 1 if append_end else n)


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """``(item, bin, offset)``: longest first, each into the fullest bin it still fits."""
    open_spaces: list[int] = []
    bins_by_space: dict[int, list[int]] = {}
    placed = []
    n_bins = 0
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        at = bisect_left(open_spaces, size)
        if at < len(open_spaces):
            space = open_spaces[at]
            target = bins_by_space[space].pop()
            if not bins_by_space[space]:
                del bins_by_space[space]
                open_spaces.pop(at)
        else:
            space, target = capacity, n_bins
            n_bins += 1
        placed.append((item, target, capacity - space))
        rest = space - size
        if rest not in bins_by_space:
            bins_by_space[rest] = []
            insort(open_spaces, rest)
        bins_by_space[rest].append(target)
    return placed


def pack(df: DataFrame, id_col: str, length_col: str, capacity: int = 4096, rows_per_shard: int = 100_000) -> DataFrame:
    """``id, piece, from_token, shard, bin, start, length``: pack documents into sequences of ``capacity`` tokens.

    Documents over the capacity are cut into pieces of it, the last one shorter; ``from_token``
    is where a piece begins in its document.  Only ids and lengths are shuffled, into hash
    shards of about ``rows_per_shard`` documents that are packed independently; the loss against
    one global packing is at most a part-filled bin per size class and shard.
    """
    n_shards = max(1, -(-df.count() // rows_per_shard))
    total = F.col(length_col).cast("long")
    pieces = df.select(
        id_col, total.alias("total"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(total / capacity).cast("long"), F.lit(1)) - 1)).alias("piece"),
    )
    slim = pieces.select(
        id_col, "piece", (F.col("piece") * capacity).alias("from_token"), F.least(F.col("total") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("length"),
        F.pmod(hash60(F.concat_ws("/", F.col(id_col).cast("string"), "piece")), F.lit(n_shards)).cast("long").alias("shard"),
    )
    columns = [id_col, "piece", "from_token", "shard", "bin", "start", "length"]
    schema = f"{id_col} {dict(df.dtypes)[id_col]}, piece bigint, from_token bigint, shard bigint, bin bigint, start bigint, length bigint"

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([id_col, "piece"], ignore_index=True)
        placed = best_fit_decreasing(rows["length"].tolist(), capacity)
        items, bins, starts = zip(*placed)
        out = rows.iloc[list(items)][[id_col, "piece", "from_token", "shard", "length"]]
        return out.assign(bin=list(bins), start=list(starts))[columns]

    return slim.groupBy("shard").applyInPandas(pack_shard, schema)


__all__ = [
    "best_fit_decreasing", "document_lengths", "first_texts", "mixture", "mixture_manifest", "pack", "require_text",
    "row_numbers", "source_rank", "split_info", "token_counts", "token_ids", "tokens", "with_split", "word_gate",
]
