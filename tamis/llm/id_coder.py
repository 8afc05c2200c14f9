"""Adaptive context-mixing range coder for token ids, and token-id files made of its blocks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tamis.llm.frames import text_bytes, written_id
from tamis.llm.tokenizing import Encoder, shared_encoder

MAGIC = b"CMR1"
BLOCK_IDS = 2048
SLOTS = 1024  # remembered contexts per block and order
NONE = np.uint32(0xFFFFFFFF)
BOT, TOP = np.uint64(1 << 32), np.uint64(1 << 48)
ONE, WORD = np.uint64(1), np.uint64(16)
STEP = 32  # what an occurrence adds to a size class's count


class Mixer:
    """Predictions of one yes/no question by three contexts, mixed by how well each has done.

    A prediction is a 16-bit probability of yes.  The mixture weighs the predictions by a decaying
    sum of the probability that each gave to what came true.
    """

    def __init__(self, lanes: int, contexts: tuple[int, int, int], start: list[np.ndarray]):
        self.base = [np.arange(lanes) * n for n in contexts]
        self.table = [np.tile(s.astype(np.int32), lanes) for s in start]
        self.score = [np.full(lanes, 1 << 14, np.int64) for _ in contexts]

    def predict(self, contexts: tuple) -> np.ndarray:
        self.at = [b + c for b, c in zip(self.base, contexts)]
        self.p = [t[a] for t, a in zip(self.table, self.at)]
        s0, s1, s2 = self.score
        mixed = (s0 * self.p[0] + s1 * self.p[1] + s2 * self.p[2]) // (s0 + s1 + s2)
        return np.clip(mixed, 64, 65472).astype(np.uint64)

    def learn(self, yes: np.ndarray, asked: np.ndarray) -> None:
        goal = yes.astype(np.int32) * 65535
        for t, a, p, s in zip(self.table, self.at, self.p, self.score):
            t[a] = np.where(asked, p + ((goal - p) >> 4), p)
            s += np.where(asked, ((65535 - np.abs(goal - p)) >> 1) - (s >> 4), 0)


class Model:
    """What is known of the ids so far, for many blocks side by side (one lane each).

    Order 2 and order 1: a hash of the last two ids, and of the last one, remembers the id that
    came next and how sure that is.  Order 0: a hash of an id is a slot that remembers the id
    seen last; slots are coded under adaptive counts, by high and low half.  New ids are coded
    by their bit length under adaptive counts and their lower bits plainly.
    """

    def __init__(self, lanes: int, id_bits: int):
        self.lanes, self.base, self.row, self.id_bits = lanes, np.arange(lanes) * SLOTS, np.arange(lanes), id_bits
        self.guess1, self.guess2 = (np.full(lanes * SLOTS, NONE) for _ in range(2))
        self.sure1, self.sure2 = (np.zeros(lanes * SLOTS, np.int8) for _ in range(2))
        self.last = self.before = np.zeros(lanes, np.uint32)
        flat, wide = np.full(1, 4096), np.full(64, 4096)
        self.mix2 = Mixer(lanes, (1, 64, 16), [flat, wide, np.array([256, 6000, 24000, 48000] * 4)])
        self.mix1 = Mixer(lanes, (1, 64, 16), [flat, wide, np.repeat([256, 3000, 12000, 24000], 4)])
        self.slot = np.full(lanes * 256, NONE)
        self.high = np.ones((lanes, 17), np.int64)  # 16: a new id
        self.low = np.ones((lanes * 16, 16), np.int64)
        # Ids of n bits make class n; the fewer bits, the rarer.
        self.length = np.tile(np.maximum(1, 2 ** np.maximum(0, np.arange(id_bits + 1) - 8)).astype(np.int64), (lanes, 1))

    def look(self) -> None:
        low = self.last & np.uint32(63)
        h1 = (self.last * np.uint32(2654435761)) >> np.uint32(22)
        h2 = (self.last * np.uint32(2654435761) + self.before * np.uint32(2246822519)) >> np.uint32(22)
        self.at1, self.at2 = self.base + h1, self.base + h2
        self.g1, self.g2 = self.guess1[self.at1], self.guess2[self.at2]
        self.s1, self.s2 = self.sure1[self.at1], self.sure2[self.at2]
        self.context = (0, low, self.s1 * np.int8(4) + self.s2)

    def learn(self, ids: np.ndarray) -> None:
        for guess, sure, at, g, s in ((self.guess1, self.sure1, self.at1, self.g1, self.s1), (self.guess2, self.sure2, self.at2, self.g2, self.s2)):
            hit = g == ids
            guess[at] = np.where(hit | (s > 1), g, ids)
            sure[at] = np.where(hit, np.minimum(s + 1, 3), np.where(s > 1, s - 1, 1))
        self.slot[self.row * 256 + slot_of(ids)] = ids
        self.before, self.last = self.last, ids


def slot_of(ids: np.ndarray) -> np.ndarray:
    return ((ids * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64)


def bit_length(ids: np.ndarray) -> np.ndarray:
    return np.frexp(ids.astype(np.float64))[1].astype(np.int64)


class Lanes:
    """Range coders of many lanes.  ``code`` narrows each lane's range to a part of it."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.row, self.one = np.arange(lanes), np.ones(lanes, np.uint64)

    def code(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.low += unit * start
        self.range = unit * size
        while True:
            full = (self.low ^ (self.low + self.range)) < TOP
            narrow = ~full & (self.range < BOT)
            if narrow.any():
                self.range = np.where(narrow, (~self.low + ONE) & (BOT - ONE), self.range)
                full |= narrow
            go = np.flatnonzero(full)
            if not len(go):
                return
            self.shift(go)
            self.low[go] <<= WORD
            self.range[go] <<= WORD

    def shift(self, go: np.ndarray) -> None:
        raise TypeError("use Writer or Reader")


class Writer(Lanes):
    """Encoders; each question is told its answer and returns it."""

    def __init__(self, lanes: int, words: int):
        super().__init__(lanes)
        self.out, self.used = np.zeros((lanes, words), "<u2"), np.zeros(lanes, np.int64)

    def shift(self, go: np.ndarray) -> None:
        if self.used.max() + 1 >= self.out.shape[1]:
            self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
        self.out[go, self.used[go]] = (self.low[go] >> np.uint64(48)).astype(np.uint16)
        self.used[go] += 1

    def bit(self, p: np.ndarray, asked: np.ndarray, yes: np.ndarray) -> np.ndarray:
        size = np.where(yes, p, np.uint64(65536) - p)
        self.code(np.where(asked, self.range >> WORD, self.range), np.where(asked & ~yes, p, np.uint64(0)), np.where(asked, size, ONE))
        return yes & asked

    def symbol(self, counts: np.ndarray, asked: np.ndarray, value: np.ndarray) -> np.ndarray:
        ends = np.cumsum(counts, axis=1).astype(np.uint64)
        size = counts[self.row, value].astype(np.uint64)
        start = ends[self.row, value] - size
        self.code(np.where(asked, self.range // ends[:, -1], self.range), np.where(asked, start, np.uint64(0)), np.where(asked, size, ONE))
        return value

    def plain(self, bits: np.ndarray, value: np.ndarray) -> np.ndarray:
        self.code(self.range >> bits, value, self.one)
        return value

    def finish(self) -> list[bytes]:
        self.out = np.concatenate([self.out, np.zeros((len(self.out), 4), "<u2")], axis=1)
        for _ in range(4):
            self.out[self.row, self.used] = (self.low >> np.uint64(48)).astype(np.uint16)
            self.used += 1
            self.low <<= WORD
        return [self.out[i, :n].tobytes() for i, n in enumerate(self.used)]


class Reader(Lanes):
    """Decoders; each question finds its answer in the code."""

    def __init__(self, blocks: list[bytes]):
        super().__init__(len(blocks))
        sizes = np.array([len(b) // 2 for b in blocks])
        # A lane that has ended reads zeros; what it decodes then is cut off.
        self.data = np.zeros((len(blocks), int(sizes.max(initial=0)) + 5), np.uint64)
        for i, b in enumerate(blocks):
            self.data[i, : sizes[i]] = np.frombuffer(b, "<u2")
        self.now = np.zeros(len(blocks), np.uint64)
        for i in range(4):
            self.now = (self.now << WORD) | self.data[:, i]
        self.used = np.full(len(blocks), 4, np.int64)

    def shift(self, go: np.ndarray) -> None:
        at = np.minimum(self.used[go], self.data.shape[1] - 1)
        self.now[go] = (self.now[go] << WORD) | self.data[go, at]
        self.used[go] += 1

    def bit(self, p: np.ndarray, asked: np.ndarray, yes: None) -> np.ndarray:
        unit = np.where(asked, self.range >> WORD, self.range)
        found = asked & ((self.now - self.low) // unit < p)
        self.code(unit, np.where(asked & ~found, p, np.uint64(0)), np.where(asked, np.where(found, p, np.uint64(65536) - p), ONE))
        return found

    def symbol(self, counts: np.ndarray, asked: np.ndarray, value: None) -> np.ndarray:
        ends = np.cumsum(counts, axis=1).astype(np.uint64)
        unit = np.where(asked, self.range // ends[:, -1], self.range)
        at = np.minimum((self.now - self.low) // unit, ends[:, -1] - ONE)
        found = (ends <= at[:, None]).sum(axis=1)
        size = counts[self.row, found].astype(np.uint64)
        self.code(unit, np.where(asked, ends[self.row, found] - size, np.uint64(0)), np.where(asked, size, ONE))
        return found

    def plain(self, bits: np.ndarray, value: None) -> np.ndarray:
        unit = self.range >> bits
        found = np.minimum((self.now - self.low) // unit, (self.one << bits) - ONE)
        self.code(unit, found, self.one)
        return found


def _next_ids(model: Model, coder: Writer | Reader, ids: np.ndarray | None) -> np.ndarray:
    """Code one id per lane: does the order-2 guess hold, else the order-1 guess, else its slot, else the id itself."""
    writing = ids is not None
    model.look()
    always = np.ones(model.lanes, bool)
    hit2 = coder.bit(model.mix2.predict(model.context), always, ids == model.g2 if writing else None)
    model.mix2.learn(hit2, always)
    asked = ~hit2
    hit1 = coder.bit(model.mix1.predict(model.context), asked, ids == model.g1 if writing else None)
    model.mix1.learn(hit1, asked)
    asked &= ~hit1

    known = slot = None
    if writing:
        slot = slot_of(ids)
        known = np.where(model.slot[model.row * 256 + slot] == ids, slot >> 4, 16)
    high = coder.symbol(model.high, asked, known)
    model.high[model.row, high] += asked * STEP
    in_slot = asked & (high < 16)
    half = model.row * 16 + np.minimum(high, 15)
    low = coder.symbol(model.low[half], in_slot, slot & 15 if writing else None)
    model.low[half, low] += in_slot * STEP
    new = asked & (high == 16)
    size = coder.symbol(model.length, new, bit_length(ids) if writing else None)
    model.length[model.row, size] += new * STEP
    value = np.zeros(model.lanes, np.uint64)
    below = np.where(new, np.maximum(size - 1, 0), 0)
    for done in range(0, model.id_bits, 16):
        bits = np.clip(below - done, 0, 16).astype(np.uint64)
        part = (ids.astype(np.uint64) >> np.uint64(done)) & ((ONE << bits) - ONE) if writing else None
        value |= coder.plain(bits, part) << np.uint64(done)
    if not writing:
        lead = np.where(size > 0, ONE << np.maximum(size - 1, 0).astype(np.uint64), np.uint64(0))
        ids = np.where(new, (value | lead).astype(np.uint32), model.slot[model.row * 256 + (np.minimum(high, 15) << 4 | low)])
        ids = np.where(hit2, model.g2, np.where(hit1, model.g1, ids)).astype(np.uint32)
    model.learn(ids)
    return ids


def encode_blocks(ids: np.ndarray, block_ids: int = BLOCK_IDS, id_bits: int = 16) -> list[bytes]:
    """One byte string per block of ``block_ids`` ids; every block starts from an empty model."""
    lanes = -(-len(ids) // block_ids)
    grid = np.zeros(lanes * block_ids, np.uint32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, block_ids).T)
    model, coder = Model(lanes, id_bits), Writer(lanes, block_ids)
    for step in range(min(block_ids, len(ids))):
        _next_ids(model, coder, grid[step])
    return coder.finish()


def decode_blocks(blocks: list[bytes], n: int, block_ids: int = BLOCK_IDS, id_bits: int = 16) -> np.ndarray:
    """The ``n`` ids of ``encode_blocks``."""
    grid = np.zeros((block_ids, len(blocks)), np.uint32)
    model, coder = Model(len(blocks), id_bits), Reader(blocks)
    for step in range(min(block_ids, n)):
        grid[step] = _next_ids(model, coder, None)
    return grid.T.ravel()[:n]


def write_segment(ids: np.ndarray, lengths: np.ndarray, block_ids: int = BLOCK_IDS, id_bits: int = 16) -> bytes:
    """Whole documents as one self-contained file.

    Little-endian: magic, bits per id (u4), ids per block (u4), documents (u4), ids (u8), blocks (u4),
    the documents' lengths (u4 each), per block its bytes and the crc32 of its ids (u4 each), a
    crc32 of all that (u4), then the blocks.
    """
    ids = ids.astype("<u4")
    if block_ids > 2048 or block_ids < 1:
        raise ValueError("a block holds 1 to 2048 ids")
    if len(ids) and int(ids.max()) >> id_bits:
        raise ValueError(f"an id needs more than {id_bits} bits")
    blocks = encode_blocks(ids, block_ids, id_bits) if len(ids) else []
    checks = [zlib.crc32(ids[i : i + block_ids].tobytes()) for i in range(0, len(ids), block_ids)]
    head = MAGIC + struct.pack("<IIIQI", id_bits, block_ids, len(lengths), len(ids), len(blocks))
    head += np.asarray(lengths, "<u4").tobytes() + np.array(list(zip(map(len, blocks), checks)), "<u4").tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks)


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and document lengths; a damaged head or block raises ``ValueError``."""
    if data[:4] != MAGIC:
        raise ValueError("not a token-id file")
    id_bits, block_ids, documents, n, count = struct.unpack_from("<IIIQI", data, 4)
    at = 28
    lengths = np.frombuffer(data, "<u4", documents, at)
    at += 4 * documents
    table = np.frombuffer(data, "<u4", 2 * count, at).reshape(count, 2)
    at += 8 * count
    if zlib.crc32(data[:at]) != struct.unpack_from("<I", data, at)[0]:
        raise ValueError("damaged head of a token-id file")
    edges = at + 4 + np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
    blocks = [data[a:b] for a, b in zip(edges[:-1], edges[1:])]
    ids = decode_blocks(blocks, n, block_ids, id_bits) if n else np.zeros(0, np.uint32)
    for i, check in enumerate(table[:, 1].tolist()):
        if zlib.crc32(ids[i * block_ids : (i + 1) * block_ids].astype("<u4").tobytes()) != check:
            raise ValueError(f"damaged block {i} of a token-id file")
    return ids, lengths


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str | Callable[[], Encoder], id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1,
    joiner: str | None = None, partitions: int | None = None, segment_ids: int = 4 << 20, block_ids: int = BLOCK_IDS, id_bits: int = 16,
) -> None:
    """Write every document's ids, ``end_id`` after each, in ascending order of ``id_col``.

    ``folder`` becomes a table of ``part, segment, ids, documents, data``: parts ascend with the
    documents' ids, segments ascend inside a part, ``data`` is one file of ``write_segment`` that
    holds whole documents, about ``segment_ids`` ids of them, and ``documents`` their ids.  Spark
    commits the table as a whole, so an executor lost on the way leaves no half-written file.

    Null texts are empty (just the end id); documents with a null id come first; equal ids stand
    next to each other in the order of their texts.
    """
    slim = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = slim.repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    ordered = ordered.select(written_id("id").alias("id"), "text", F.spark_partition_id().alias("part"))
    make = tokenizer if callable(tokenizer) else lambda: shared_encoder(tokenizer, joiner)
    id_type = slim.schema["id"].dataType

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, segment, part = make(), 0, 0
        held: list[np.ndarray] = []
        lengths: list[int] = []
        names: list = []

        def flush() -> pd.DataFrame:
            nonlocal segment
            ids = np.concatenate(held)
            row = (part, segment, len(ids), list(names), write_segment(ids, lengths, block_ids, id_bits))
            segment += 1
            held.clear(), lengths.clear(), names.clear()
            return pd.DataFrame([row], columns=["part", "segment", "ids", "documents", "data"])

        tail = np.array([] if end_id is None else [end_id], np.uint32)
        size = 0
        for batch in batches:
            for at in range(0, len(batch), 128):
                rows = batch.iloc[at : at + 128]
                part = int(rows["part"].iat[0])
                ids, counts = encoder.encode(rows["text"].tolist())
                for name, doc in zip(rows["id"].tolist(), np.split(ids, np.cumsum(counts)[:-1])):
                    held += [doc, tail]
                    lengths.append(len(doc) + len(tail))
                    names.append(None if name != name else name)
                    size += lengths[-1]
                    if size >= segment_ids:
                        yield flush()
                        size = 0
        if lengths:
            yield flush()

    schema = "part int, segment int, ids long, documents array<string>, data binary"
    files = ordered.mapInPandas(encode, schema).withColumn("documents", F.col("documents").cast(T.ArrayType(id_type)))
    files.write.mode("overwrite").parquet(folder)


def read_token_files(df: DataFrame) -> DataFrame:
    """``id, start, tokens`` of each document of a table of ``write_token_files``, decoded block by block.

    ``start`` is the number of ids of all documents before it: sums by part and by segment, so no
    task sees more than the parts' totals or one part's segments.
    """
    parts = df.groupBy("part").agg(F.sum("ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))
    segments = df.select("part", "segment", "ids")
    inner = F.sum("ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = segments.select("part", "segment", F.coalesce(inner, F.lit(0)).alias("inner_start")).join(parts, "part")
    placed = df.withColumn("documents", F.col("documents").cast("array<string>")).join(starts, ["part", "segment"])
    id_type = df.schema["documents"].dataType.elementType

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for names, data, a, b in zip(batch["documents"], batch["data"], batch["part_start"], batch["inner_start"]):
                ids, lengths = read_segment(data)
                ends = np.cumsum(lengths, dtype=np.int64)
                for i in range(0, len(lengths), 512):
                    e = ends[i : i + 512]
                    n = lengths[i : i + 512].astype(np.int64)
                    yield pd.DataFrame({
                        "id": list(names[i : i + 512]), "start": int(a) + int(b) + e - n,
                        "tokens": [ids[y - x : y].astype("<u4").tobytes() for x, y in zip(n, e)],
                    })

    return placed.mapInPandas(decode, "id string, start long, tokens binary").withColumn("id", F.col("id").cast(id_type))
