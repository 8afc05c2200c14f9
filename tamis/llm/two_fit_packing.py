"""Packing documents into sequences by best-two-fit."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tamis.llm.frames import written_id
from tamis.llm.tokenizing import Encoder, shared_encoder
from tamis.session import cut_lineage


class Sizes:
    """How many unpacked pieces there are of each length, with the present lengths as a bit set.

    ``mirror`` has bit ``top - length`` set, so that shifted against ``present`` it shows the
    lengths whose partner for a given sum is there too.
    """

    def __init__(self, lengths: list[int], top: int):
        self.top, self.count, self.present, self.mirror = top, [0] * (top + 1), 0, 0
        for n in lengths:
            self.add(n)

    def add(self, n: int) -> None:
        if not self.count[n]:
            self.present |= 1 << n
            self.mirror |= 1 << (self.top - n)
        self.count[n] += 1

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.present &= ~(1 << n)
            self.mirror &= ~(1 << (self.top - n))

    def largest(self, room: int) -> int:
        """The longest length of at most ``room``; 0 if none."""
        return (self.present & ((1 << (room + 1)) - 1)).bit_length() - 1 if room > 0 and self.present & ((1 << (room + 1)) - 2) else 0

    def best_pair(self, room: int, over: int) -> tuple[int, int] | None:
        """Two unpacked pieces whose sum is the largest that is at most ``room`` and more than ``over``."""
        for total in range(room, over, -1):
            # Lengths n with total - n present: bit n of mirror moved by total - top.
            move = total - self.top
            partners = self.mirror << move if move >= 0 else self.mirror >> -move
            both = self.present & partners & ((1 << total) - 1) & ~1
            if not both:
                continue
            a = both.bit_length() - 1
            b = total - a
            if a != b or self.count[a] > 1:
                return a, b
            both &= ~(1 << a)
            if both:
                a = both.bit_length() - 1
                return a, total - a
        return None


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of lengths.

    Each bin takes the longest unpacked piece that fits until none does.  If room is left, its
    smallest piece gives way to the two unpacked pieces that fill the widened gap best, if any two
    fill it better than the piece did.
    """
    left = Sizes([n for n in lengths if n > 0], capacity)
    bins = []
    while left.present:
        content, room = [], capacity
        while (n := left.largest(room)) > 0:
            left.take(n)
            content.append(n)
            room -= n
        if room and left.present:
            smallest = content[-1]
            pair = left.best_pair(room + smallest, smallest)
            if pair:
                content.pop()
                left.take(pair[0])
                left.take(pair[1])
                content += pair
                left.add(smallest)
        bins.append(content)
    return bins


def pack_sequences(pieces: DataFrame, length_col: str = "length", capacity: int = 2048, key_cols: tuple[str, ...] = ("doc_id", "piece"), rows_per_shard: int = 50_000) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Rows are dealt by a hash of ``key_cols`` into shards of about ``rows_per_shard``; each is packed
    on its own, so one sequence more per shard than a packing of all is to be expected.  Only keys
    and lengths should be in ``pieces``.  Lengths run from 1 to ``capacity``; others raise.
    """
    shards = max(1, -(-pieces.count() // rows_per_shard))
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(*key_cols), F.lit(shards)).cast("long"))
    columns = pieces.columns
    # Ids of whole numbers go as text: beside a null, Python would make doubles of them.
    wide = [c for c in key_cols if dict(pieces.dtypes)[c] in ("bigint", "int", "smallint", "tinyint")]
    dealt = dealt.withColumns({c: written_id(c) for c in wide})

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(columns, ignore_index=True)
        lengths = rows[length_col].to_numpy()
        if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity):
            raise ValueError(f"lengths must be 1 to {capacity}")
        waiting: dict[int, list[int]] = {}
        for i in range(len(lengths) - 1, -1, -1):
            waiting.setdefault(int(lengths[i]), []).append(i)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, content in enumerate(best_two_fit(lengths.tolist(), capacity)):
            at = 0
            for n in content:
                i = waiting[n].pop()
                sequence[i], offset[i] = (int(key[0]) << 32) + number, at
                at += n
        return rows[columns].assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"`{f.name}` {'string' if f.name in wide else f.dataType.simpleString()}" for f in pieces.schema)
    packed = dealt.groupBy("_shard").applyInPandas(pack, schema + ", sequence_id long, offset long")
    return packed.withColumns({c: F.col(c).cast(pieces.schema[c].dataType) for c in wide})


def cut_pieces(
    df: DataFrame, tokenizer: str | Callable[[], Encoder], id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    end_id: int | None = 0, joiner: str | None = None, keep_tokens: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, tokens]``: every document's ids, ``end_id`` last, in pieces.

    Documents of at most ``capacity`` ids are one piece; longer ones are cut into pieces of
    ``capacity``, the first holding what is left over.  ``tokens`` are little-endian 32-bit ids.
    No shuffle.  Null texts are empty: just the end id, or no piece if there is none.
    """
    make = tokenizer if callable(tokenizer) else lambda: shared_encoder(tokenizer, joiner)
    slim = df.select(written_id(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tail = [] if end_id is None else [end_id]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["tokens"] if keep_tokens else [])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make()
        for batch in batches:
            for at in range(0, len(batch), 128):
                rows = batch.iloc[at : at + 128]
                ids, counts = encoder.encode(rows["text"].tolist())
                out = []
                for doc, own in zip(rows["doc_id"].tolist(), np.split(ids, np.cumsum(counts)[:-1])):
                    own = np.append(own, tail).astype("<u4")
                    first = len(own) - (max(1, -(-len(own) // capacity)) - 1) * capacity
                    edges = [0, *range(first, len(own) + 1, capacity)] if len(own) else [0]
                    for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                        data = own[a:b].tobytes()
                        out.append((doc, piece, a, b - a, zlib.crc32(data), data)[: len(columns)])
                done = pd.DataFrame(out, columns=columns)
                yield done

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + (", tokens binary" if keep_tokens else "")
    return slim.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc_id").cast(df.schema[id_col].dataType))


def pack_documents(
    df: DataFrame, tokenizer: str | Callable[[], Encoder], id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    end_id: int | None = 0, joiner: str | None = None, rows_per_shard: int = 50_000,
) -> DataFrame:
    """``<id>, piece, start, length, ids_crc32, sequence_id, offset``: all documents packed.

    Ids are made where the texts lie; only one slim row per piece travels.  Null ids and repeated
    rows are documents of their own; an empty table gives no rows.
    """
    pieces = cut_lineage(cut_pieces(df, tokenizer, id_col, text_col, capacity, end_id, joiner))
    packed = pack_sequences(pieces, "length", capacity, ("doc_id", "piece", "ids_crc32"), rows_per_shard)
    return packed.withColumnRenamed("doc_id", id_col)
