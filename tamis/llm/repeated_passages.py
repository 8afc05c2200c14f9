"""Removal of passages that occur more than once, with a count-min prefilter."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tamis.llm.arrays import (
    MULTIPLIER, SECOND, Powers, hash_words, mix, pack_bits, pack_sorted, unpack_bits, unpack_sorted, windows_within,
)
from tamis.llm.frames import bucketed, text_bytes, written_id

SALTS = (0x632BE59BD9B4E019, 0xE220A8397B1DCDAF, 0x4F5E2D9A1C3B7F61, 0x8EBC6AF09C88C6E3)


class Hasher:
    """Two hashes of every window of some texts: 64 bits, and 32 more for the exact count."""

    def __init__(self, texts: list[bytes], window: int):
        self.words, self.counts = hash_words(texts)
        self.window = window

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        return windows_within(self.words, self.counts, self.window, Powers(int(MULTIPLIER)))

    def checks(self) -> np.ndarray:
        return windows_within(mix(self.words), self.counts, self.window, Powers(int(SECOND)))[0] >> np.uint64(32)


def _cells(windows: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    """The cell of each window in one row of the sketch."""
    return mix(windows ^ np.uint64(SALTS[row])) >> np.uint64(64 - width_bits)


def _cuts(values: np.ndarray, shift: int, parts: int) -> np.ndarray:
    """Places that cut ascending values into parts by their high bits."""
    return np.searchsorted(values >> np.uint64(shift) if shift else values, np.arange(parts + 1, dtype=np.uint64))


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values occur in an ascending array."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _sketch_sizes(total: int, bucket_bytes: int, depth: int) -> tuple[int, int]:
    """Bits of a cell number, and of a segment number.

    About half a cell in each row for every byte of text: three to four for each window, so
    that most windows that occur once have a cell of their own in some row.
    """
    width = max(12, int(max(1, total // 2) - 1).bit_length())
    segment = min(width, max(0, int(max(1, total // max(1, bucket_bytes * 2)) - 1).bit_length()))
    return width, segment


def mark_repeated(df: DataFrame, window: int, bucket_bytes: int, depth: int, text: Column, id_col: str) -> DataFrame:
    """``id, text, at``: the documents, ids as text, ``at`` being the packed starts of repeated windows."""
    slim = df.select(written_id(id_col).alias("id"), text_bytes(text).alias("text"))
    slim, buckets, total = bucketed(slim, F.struct("id", "text"), F.col("text"), bucket_bytes)
    width, segment_bits = _sketch_sizes(total, bucket_bytes, depth)
    segments, within = 1 << segment_bits, width - segment_bits
    docs = slim.groupBy("bucket")

    def sketch(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """The bucket's own count-min sketch, sparse: occupied cells and those counted twice or more."""
        distinct, counts = np.unique(Hasher(rows["text"].tolist(), window).windows()[0], return_counts=True)
        again = counts > 1
        out = []
        for row in range(depth):
            cells = _cells(distinct, row, width)
            order = np.argsort(cells)
            cells, first = np.unique(cells[order], return_index=True)
            several = np.add.reduceat(again[order].astype(np.int64) + 1, first) > 1 if len(cells) else again
            cut = _cuts(cells, within, segments)
            for s in range(segments):
                a, b = cut[s], cut[s + 1]
                if b > a:
                    low = cells[a:b] & np.uint64((1 << within) - 1)
                    out.append((key[0], row, s, pack_sorted(low), pack_bits(several[a:b])))
        return pd.DataFrame(out, columns=["bucket", "row", "segment", "cells", "flags"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Sum the buckets' sketches of one segment; tell each bucket which of its cells count twice."""
        parts = [unpack_sorted(c) for c in rows["cells"]]
        flags = [unpack_bits(f, len(p)) for f, p in zip(rows["flags"], parts)]
        every = np.sort(np.concatenate([*parts, *(p[f] for p, f in zip(parts, flags))]))
        heavy = every[1:][every[1:] == every[:-1]]
        said = [pack_bits(_among(p, heavy)) for p in parts]
        return pd.DataFrame({"bucket": rows["bucket"], "row": key[0], "segment": key[1], "cells": [pack_bits_key(p) for p in parts], "flags": said})

    def pack_bits_key(cells: np.ndarray) -> bytes:
        return np.array([len(cells)], "<u4").tobytes()

    def estimated(distinct: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
        """Windows whose estimate is two or more in every row."""
        likely = np.ones(len(distinct), bool)
        for row in range(depth):
            own = answers[(answers["kind"] == 0) & (answers["row"] == row)].sort_values("segment")
            flags = [unpack_bits(f, int(np.frombuffer(c, "<u4")[0])) for c, f in zip(own["cells"], own["flags"])]
            cells = _cells(distinct, row, width)
            order = np.argsort(cells)
            # The bucket's distinct cells ascend as its answers do.
            new = np.diff(cells[order], prepend=cells[order][:1]) != 0
            likely[order] &= np.concatenate(flags)[np.cumsum(new)] if flags else False
        return likely

    def candidates(rows: pd.DataFrame, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, pd.DataFrame]:
        """Windows by document, which of all are candidates, the key of each of those, and the distinct keys ascending."""
        hasher = Hasher(rows["text"].tolist(), window)
        windows, sizes = hasher.windows()
        distinct, place = np.unique(windows, return_inverse=True)
        hit = estimated(distinct, answers)[place]
        a, b = windows[hit], hasher.checks()[hit] if hit.any() else np.zeros(0, np.uint64)
        order = np.lexsort((b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        start = np.flatnonzero(new)
        key = np.zeros(len(a), np.int64)
        key[order] = np.cumsum(new) - 1
        many = np.diff(np.append(start, len(a))) > 1
        return sizes, hit, key, pd.DataFrame({"a": a[order][start], "b": b[order][start].astype(np.uint32), "many": many})

    def ask(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """The bucket's candidates by segment, for the exact count."""
        if not len(rows):
            return pd.DataFrame({"bucket": [], "segment": [], "cells": [], "checks": [], "flags": []})
        keys = candidates(rows, answers)[3]
        a, b, many = (keys[c].to_numpy() for c in ("a", "b", "many"))
        cut = _cuts(a, 64 - segment_bits, segments) if segment_bits else np.array([0, len(a)])
        out = [
            (key[0], s, pack_sorted(a[i:j]), b[i:j].astype("<u4").tobytes(), pack_bits(many[i:j]))
            for s, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if j > i
        ]
        return pd.DataFrame(out, columns=["bucket", "segment", "cells", "checks", "flags"])

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Group the candidates of one segment exactly; tell each bucket which of its windows repeat."""
        parts = [unpack_sorted(c) for c in rows["cells"]]
        sizes = [len(p) for p in parts]
        a = np.concatenate(parts)
        b = np.concatenate([np.frombuffer(c, "<u4") for c in rows["checks"]])
        repeated = np.concatenate([unpack_bits(f, n) for f, n in zip(rows["flags"], sizes)])
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        # A group of three or more is marked by its neighbours; one flagged inside a bucket marks its equals the same way.
        said = [pack_bits(x) for x in np.split(repeated, np.cumsum(sizes)[:-1])]
        return pd.DataFrame({
            "bucket": rows["bucket"], "row": 0, "segment": key[0], "cells": [np.array([n], "<u4").tobytes() for n in sizes], "flags": said,
        })

    def mark(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """Starts of the repeated windows of each document."""
        if not len(rows):
            return pd.DataFrame({"id": [], "text": [], "at": []})
        sizes, hit, key, _ = candidates(rows, answers)
        own = answers[answers["kind"] == 1].sort_values("segment")
        flags = [unpack_bits(f, int(np.frombuffer(c, "<u4")[0])) for c, f in zip(own["cells"], own["flags"])]
        sure = np.zeros(len(hit), bool)
        if flags:
            sure[hit] = np.concatenate(flags)[key]
        at = [pack_sorted(np.flatnonzero(sure[e - n : e])) for n, e in zip(sizes.tolist(), np.cumsum(sizes).tolist())]
        return pd.DataFrame({"id": rows["id"], "text": rows["text"], "at": at})

    answer = "bucket long, row int, segment int, cells binary, flags binary"
    sketches = docs.applyInPandas(sketch, answer)
    heavy = sketches.groupBy("row", "segment").applyInPandas(merge, answer)
    heavy = heavy.withColumn("kind", F.lit(0))
    asked = docs.cogroup(heavy.groupBy("bucket")).applyInPandas(ask, "bucket long, segment int, cells binary, checks binary, flags binary")
    exact = asked.groupBy("segment").applyInPandas(count, answer).withColumn("kind", F.lit(1))
    return docs.cogroup(heavy.union(exact).groupBy("bucket")).applyInPandas(mark, "id string, text binary, at binary")


def covered_words(n_words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeated_passages(
    df: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 4 << 20, depth: int = 2,
) -> DataFrame:
    """``<id>, kept_text, n_words, n_removed, removed_spans``: texts without words in repeated windows.

    A word is a run of anything but ASCII white space; a window is ``window`` consecutive words of
    one text; it is repeated if the same words start anywhere else, in the same text too.  Words
    that a repeated window covers go; windows are judged on the input.  Kept words are joined by
    one blank.  ``removed_spans`` are ranges ``start:end`` of word numbers.

    First pass: the documents lie in buckets of about ``bucket_bytes``; each bucket makes a
    count-min sketch of its windows, and the sketches are summed by segments of cells.  Estimates
    never fall short, so a window estimated once occurs once.  Second pass: only windows estimated
    twice or more are grouped exactly, by a 96-bit hash.  What travels besides the texts are packed
    cell numbers, bits, and the candidates, at most once per bucket however often a window occurs.

    Null texts are empty; a text of fewer than ``window`` words stays as it is but for its white
    space; equal rows count as different texts, so both lose their windows.
    """
    marked = mark_repeated(df, window, bucket_bytes, depth, F.col(text_col), id_col)

    def cut(batches):
        for batch in batches:
            out = []
            for id_, text, at in zip(batch["id"], batch["text"], batch["at"]):
                words = text.split()
                gone = covered_words(len(words), unpack_sorted(at).astype(np.int64), window)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans = [f"{a}:{b}" for a, b in edges.reshape(-1, 2)]
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if len(edges) else b" ".join(words)
                out.append((id_, kept.decode(), len(words), int(gone.sum()), spans))
            yield pd.DataFrame(out, columns=["id", "kept_text", "n_words", "n_removed", "removed_spans"])

    done = marked.mapInPandas(cut, "id string, kept_text string, n_words long, n_removed long, removed_spans array<string>")
    return done.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)
