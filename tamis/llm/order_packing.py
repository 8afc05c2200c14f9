"""Packing documents in their order: window cuts by dynamic programming."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tamis.llm.piece_encoder import PieceEncoder, kept_encoder
from tamis.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    """Costs are in padding ids: a cut after a sentence inside a document, and one inside a sentence.

    A sentence of more than ``long_sentence`` ids may be cut at every ``step``-th of its ids.
    ``run_ids`` are planned at once, the last ``open_windows`` of them again with the next run.
    A partition holds about ``partition_ids``.
    """

    capacity: int = 2048
    sentence_cut: int = 4
    inner_cut: int = 12
    long_sentence: int = 32
    step: int = 8
    run_ids: int = 1 << 20
    open_windows: int = 16
    partition_ids: int = 8 << 20
    max_partitions: int = 20_000


HARD = np.uint16(1 << 15)
UNIT = 512


def candidates(n: int, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a document of ``n`` ids may be cut, its end last, and which of them lie inside a sentence."""
    ends = np.append(ends[(ends > 0) & (ends < n)], n)
    gaps = np.diff(ends, prepend=0)
    inner = np.where(gaps > settings.long_sentence, (gaps - 1) // settings.step, 0)
    if not inner.any():
        return ends, np.zeros(len(ends), bool)
    nth = np.arange(1, inner.sum() + 1) - np.repeat(np.cumsum(inner) - inner, inner)
    places = np.concatenate([ends, np.repeat(ends - gaps, inner) + settings.step * nth])
    order = np.argsort(places, kind="stable")
    return places[order], order >= len(ends)


def prefix_checksums(data: memoryview, places: np.ndarray, first: np.ndarray) -> np.ndarray:
    """crc32 of the ids of four bytes up to each place, from the place before one that is ``first``."""
    crc32, crc, upto = zlib.crc32, 0, (4 * places).tolist()
    return np.array([crc := crc32(data[a:b], 0 if new else crc) for a, b, new in zip([0, *upto], upto, first.tolist())], "<u4")


class Shift:
    """crc32 of data followed by zero bytes, less the checksum of those bytes: what joins checksums of parts."""

    def __init__(self, bits: int = 40):
        matrix = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
        for _ in range(3):
            matrix = [self._times(matrix, column) for column in matrix]
        self.tables = []
        for _ in range(bits):
            table = np.zeros((4, 256), np.uint32)
            for byte in range(4):
                for bit in range(8):
                    table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ np.uint32(matrix[8 * byte + bit])
            self.tables.append(table)
            matrix = [self._times(matrix, column) for column in matrix]

    @staticmethod
    def _times(matrix: list[int], vector: int) -> int:
        total = 0
        for i in range(32):
            if vector >> i & 1:
                total ^= matrix[i]
        return total

    def __call__(self, crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
        crc = crc.astype(np.uint32)
        for bit, table in enumerate(self.tables):
            if not (n_bytes >> bit).any():
                break
            moved = table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]
            crc = np.where(n_bytes >> bit & 1, moved, crc)
        return crc


def best_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int) -> list[int]:
    """Numbers of the places where windows end, the last place included, of the least total cost.

    ``places`` ascend from 0 by steps of at most ``capacity``; ``penalties`` are what a cut there
    costs.  A window costs its padding up to ``capacity``, or none if its length is a power of two.
    A window itself costs a ``UNIT``-th of an id, so that equal costs go to fewer windows.

    The padding of the window (i, c] splits into a part of i and a part of c, so the best i among
    those within ``capacity`` is the head of a queue whose values ascend; lengths that are powers of
    two are looked up beside it.
    """
    into, out = [], []
    power = 1
    while power < capacity:
        at = np.searchsorted(places, places - power)
        hit = np.flatnonzero(places[at] == places - power)
        into.append(hit)
        out.append(at[hit])
        power *= 2
    into, out = np.concatenate(into), np.concatenate(out)
    order = np.argsort(into, kind="stable")
    targets, sources = into[order].tolist() + [-1], out[order].tolist()
    place = places.tolist()
    cost, back = [0], [0]
    # The queue: values ascend, and so do the numbers of their places; it begins at ``head``.
    values, numbers, head = [0], [0], 0
    oldest, nth, target = 0, 0, targets[0]
    def steps(block: int = 4096) -> Iterator[tuple[int, int, int, int]]:
        """Per place: itself, the padding up to it, the cost of a cut there, and its part in the queue's value."""
        for i in range(1, len(places), block):
            here = places[i : i + block]
            yield from zip(here.tolist(), ((capacity - here) * UNIT).tolist(), (penalties[i : i + block] * UNIT + 1).tolist(), (here * UNIT).tolist())

    for c, (here, free, extra, ahead) in enumerate(steps(), 1):
        while oldest < here - capacity:
            head += 1
            oldest = place[numbers[head]]
        best, source = values[head] + free, numbers[head]
        while target == c:
            i = sources[nth]
            if cost[i] < best:
                best, source = cost[i], i
            nth += 1
            target = targets[nth]
        best += extra
        cost.append(best)
        back.append(source)
        value = best + ahead
        if values[-1] >= value:
            while len(values) > head and values[-1] >= value:
                values.pop()
                numbers.pop()
            if len(values) == head:
                oldest = here
        values.append(value)
        numbers.append(c)
    cuts, c = [], len(place) - 1
    while c > 0:
        cuts.append(c)
        c = back[c]
    return cuts[::-1]


class Planner:
    """Takes documents in order and hands out the pieces of finished windows.

    Places count all ids of the partition.  The first entry of the arrays is the last cut.
    """

    def __init__(self, settings: Settings, shift: Shift):
        self.settings, self.shift, self.windows = settings, shift, 0
        self.place, self.cost, self.crc, self.owner = (np.zeros(1, np.int64) for _ in range(4))
        self.begin, self.size, self.total, self.waiting, self.first_doc = [], [], 0, [], 0

    def add(self, n: int, places: np.ndarray, inner: np.ndarray, crc: np.ndarray) -> None:
        cost = np.where(inner, self.settings.inner_cut, self.settings.sentence_cut)
        cost[-1] = 0
        number = self.first_doc + len(self.begin)
        self.begin.append(self.total)
        self.size.append(n)
        self.waiting.append((places + self.total, cost, crc.astype(np.int64), np.full(len(places), number)))
        self.total += n

    def ready(self) -> bool:
        return self.total - self.place[0] >= self.settings.run_ids

    def pieces(self, last: bool) -> dict[str, np.ndarray]:
        """Pieces of the windows cut now: document number, start, length, checksum, document size, window, offset."""
        if self.waiting:
            self.place, self.cost, self.crc, self.owner = (np.concatenate([a, *b]) for a, b in zip((self.place, self.cost, self.crc, self.owner), zip(*self.waiting)))
            self.waiting = []
        cuts = np.array(best_cuts(self.place - self.place[0], self.cost, self.settings.capacity), np.int64)
        if not last:
            cuts = cuts[: max(1, len(cuts) - self.settings.open_windows)]
        if not len(cuts):
            return {}
        stop = int(cuts[-1])
        ends_document = np.append(self.owner[1:stop] != self.owner[2 : stop + 1], False)
        edge = np.union1d(np.flatnonzero(ends_document) + 1, cuts)
        before = np.append(0, edge[:-1])
        document = self.owner[edge] - self.first_doc
        begin, size = np.array(self.begin, np.int64), np.array(self.size, np.int64)
        start = self.place[before] - begin[document]
        length = self.place[edge] - self.place[before]
        window = np.searchsorted(cuts, edge)
        opened = self.place[np.append(0, cuts)[window]]
        crc = self.crc[edge].astype(np.uint32) ^ self.shift(np.where(start > 0, self.crc[before], 0), 4 * length)
        out = {
            "document": document + self.first_doc, "start": start, "length": length, "ids_crc32": crc.astype(np.int64), "doc_tokens": size[document],
            "window": window + self.windows, "offset": self.place[before] - opened,
        }
        self.windows += len(cuts)
        self.place, self.cost, self.crc, self.owner = (a[stop:] for a in (self.place, self.cost, self.crc, self.owner))
        # Documents that still have open ids stay.
        gone = int(self.owner[1] if len(self.owner) > 1 else self.first_doc + len(self.begin)) - self.first_doc
        self.begin, self.size, self.first_doc = self.begin[gone:], self.size[gone:], self.first_doc + gone
        return out


def measure(df: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int | None, settings: Settings) -> DataFrame:
    """``doc, row, n, gaps, crcs``: ids of every document counted where the text lies, and what cuts need to know.

    ``gaps`` are the distances of the places to cut, the high bit set inside sentences; ``crcs`` the
    checksums up to each.  Ids reach Python as Arrow columns, so nulls and large numbers stay exact.
    """
    slim = df.select(F.col(id_col).alias("doc"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tail = [] if end_id is None else [end_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(tokenizer)
        for batch in batches:
            rows: list[tuple[int, bytes, bytes]] = []
            waiting: list[str] = []
            held = 0
            for text in batch.column("text"):
                waiting.append(text.as_py())
                held += len(waiting[-1])
                if held > 1 << 20:
                    rows += measured(encoder, waiting)
                    waiting, held = [], 0
            rows += measured(encoder, waiting)
            columns = [batch.column("doc"), batch.column("row"), pa.array([r[0] for r in rows], pa.int64())]
            columns += [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "row", "n", "gaps", "crcs"])

    def measured(encoder: PieceEncoder, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        if not texts:
            return []
        done = encoder.encode(texts)
        # All texts at once, each with its end id: a document's end is a place to cut like the others.
        size = done.counts + len(tail)
        stop, upto = np.cumsum(size), np.cumsum(done.counts)
        ids = np.full(stop[-1], tail[0] if tail else 0, "<u4")
        text = np.ones(len(ids), bool)
        text[stop[: len(size) * len(tail)] - 1] = False
        ids[text] = done.ids
        document = np.searchsorted(upto, done.ends)
        ends = np.union1d((done.ends + document * len(tail))[done.ends < upto[document]], stop[size > 0])
        places, inner = candidates(len(ids), ends, settings)
        if not len(ids):
            return [(0, b"", b"")] * len(texts)
        gaps = (np.diff(places, prepend=0).astype(np.uint16) | np.where(inner, HARD, np.uint16(0))).astype("<u2")
        cut = np.searchsorted(places, stop, "right")
        first = np.zeros(len(places) + 1, bool)
        first[cut - np.diff(cut, prepend=0)] = True
        crcs = prefix_checksums(memoryview(ids).cast("B"), places, first[:-1])
        return [(n, gaps[p:q].tobytes(), crcs[p:q].tobytes()) for n, p, q in zip(size.tolist(), [0, *cut[:-1].tolist()], cut.tolist())]

    kind = dict(slim.dtypes)["doc"]
    return slim.mapInArrow(run, f"doc {kind}, row long, n long, gaps binary, crcs binary")


def pack_in_order(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1, settings: Settings = Settings(),
) -> DataFrame:
    """``<id>, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row per piece of a document in a sequence.

    Documents follow each other by ascending id (nulls first, equal ids as their rows come); windows
    of at most ``capacity`` ids are cut out of that stream at the ends of documents or sentences so
    that padding plus penalties for cut documents is least.  A sequence is padded to the capacity, or
    not at all if its length is a power of two.  Only where a sentence is longer than
    ``long_sentence`` ids may a cut fall inside it.  ``start`` and ``length`` are the piece's ids in
    its document, ``offset`` its place in the sequence.

    Texts are encoded where they lie.  What moves are the places of sentence ends with checksums; they
    are dealt into ranges of ids, and each range is planned in runs of ``run_ids``, of which the last
    windows stay open for the next run.  A range ends with one window that may need padding.

    Null texts are empty: just the end id, or no piece if there is none.  Null ids and repeated rows
    are documents of their own; other columns are ignored; an empty table gives no rows.
    """
    if settings.long_sentence >= settings.capacity or settings.long_sentence >= HARD:
        raise ValueError("long_sentence must be less than the capacity and 32768")
    slim = cut_lineage(measure(df, tokenizer, id_col, text_col, end_id, settings).where("n > 0"))
    total = slim.agg(F.sum("n")).first()[0] or 0
    parts = min(settings.max_partitions, max(1, -(-total // settings.partition_ids)))
    ranged = slim.repartitionByRange(parts, "doc", "row").sortWithinPartitions("doc", "row")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planner, names, named = Planner(settings, Shift()), [], 0
        base = TaskContext.get().partitionId() << 40

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal names, named
            found = planner.pieces(last)
            if found:
                held = pa.concat_arrays(names)
                columns = [held.take(pa.array(found["document"] - named))]
                columns += [pa.array(found[c], pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens")]
                columns += [pa.array(found["window"] + base, pa.int64()), pa.array(found["offset"], pa.int64())]
                names, named = [held.slice(planner.first_doc - named)], planner.first_doc
                whole = pa.RecordBatch.from_arrays(columns, ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
                yield from (whole.slice(i, 10_000) for i in range(0, len(whole), 10_000))

        for batch in batches:
            for i, (n, gaps, crcs) in enumerate(zip(batch.column("n").to_pylist(), batch.column("gaps"), batch.column("crcs"))):
                gap = np.frombuffer(gaps.as_buffer(), "<u2")
                names.append(batch.column("doc").slice(i, 1))
                planner.add(n, np.cumsum(gap & ~HARD, dtype=np.int64), gap >= HARD, np.frombuffer(crcs.as_buffer(), "<u4"))
                if planner.ready():
                    yield from rows(False)
        if planner.begin:
            yield from rows(True)

    kind = dict(slim.dtypes)["doc"]
    schema = f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranged.mapInArrow(plan, schema).withColumnRenamed("doc", id_col)
