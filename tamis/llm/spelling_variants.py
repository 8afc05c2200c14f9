"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tamis.session import cut_lineage

# Fixed value: the letters of a word, as ranges of code points.
LETTERS = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF))


@dataclass(frozen=True)
class Settings:
    """``min_length`` code points and ``min_count`` occurrences make a word; ``typo_every`` is the divisor of the hash.

    A form must occur ``dominance`` times as often as its variant.  Letters fall into ``groups``, which
    cut a length into cells; a cell is cut into blocks of about ``block_words``.  ``held_words`` bounds
    what a counting task keeps before it hands its sums on.
    """

    min_length: int = 6
    min_count: int = 5
    typo_every: int = 199
    dominance: int = 5
    groups: int = 5
    block_words: int = 1024
    held_words: int = 300_000


def fold_table() -> bytes:
    """For ``bytes.translate`` over Latin-1: A-Z lower-cased, other letters unchanged, all else a blank."""
    letters = {c for a, b in LETTERS for c in range(a, b + 1)}
    return bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in letters else 0x20 for c in range(256))


def count_words(texts: DataFrame, settings: Settings) -> DataFrame:
    """``word, n`` of ``doc text, text``: occurrences after the deletions, words of the least length on.

    Every task sums what it reads and hands sums on, so a word costs a row per task, not per occurrence.
    """
    table, every, least = fold_table(), settings.typo_every, settings.min_length

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Characters beyond Latin-1 become a question mark, which is no letter.
                words = Counter(text.encode("latin-1", "replace").translate(table).split())
                seed = zlib.crc32(f"{doc}:".encode())
                for word, n in words.items():
                    size = len(word)
                    if size < least:
                        continue
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if h % every == 0:
                        if size == least:
                            continue
                        at = h % size
                        word = word[:at] + word[at + 1 :]
                    total[word] = total.get(word, 0) + n
            if len(total) > settings.held_words:
                yield from sums(total)
                total = {}
        yield from sums(total)

    def sums(total: dict[bytes, int], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
        words, counts = list(total), list(total.values())
        for i in range(0, len(words), rows):
            text = pa.array([w.decode("latin-1") for w in words[i : i + rows]], pa.string())
            yield pa.RecordBatch.from_arrays([text, pa.array(counts[i : i + rows], pa.int64())], ["word", "n"])

    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(groups: int) -> list[str]:
    """The lower-case letters dealt into groups, the usual ones of the languages here spread over all."""
    usual = "etaoinshrdlucmfwygpbvkxqjz"
    rest = "".join(chr(c) for a, b in LETTERS[2:] for c in range(a, b + 1))
    return [(usual + rest)[g::groups] for g in range(groups)]


def cell_of(word: Column, groups: int) -> list[Column]:
    """How many letters of each group a word has."""
    return [(F.length(word) - F.length(F.translate(word, letters, ""))).alias(f"g{i}") for i, letters in enumerate(letter_groups(groups))]


def block_pairs(words: DataFrame, settings: Settings) -> DataFrame:
    """``length_a, words_a, ns_a, length_b, words_b, ns_b, same``: all blocks that can hold words one edit apart, each pair once.

    A replaced letter moves one count of a cell to another group or leaves the cell; an inserted one
    adds one.  So a block meets the blocks of its own cell, of the cells one move away and of the
    cells of the next length one more, and nothing else.
    """
    g, names = settings.groups, [f"g{i}" for i in range(settings.groups)]
    celled = words.select("word", "n", *cell_of(F.col("word"), g))
    sizes = celled.groupBy(*names).agg(F.count(F.lit(1)).alias("size"))
    dealt = celled.join(sizes, names).withColumn("part", F.pmod(F.xxhash64("word"), F.ceil(F.col("size") / settings.block_words)).cast("int"))
    rows = F.sort_array(F.collect_list(F.struct("word", "n")))
    blocks = dealt.groupBy(*names, "part").agg(rows.alias("rows")).select(
        *names, "part", F.length(F.col("rows")[0]["word"]).alias("length"), F.array_join("rows.word", "").alias("words"), F.col("rows.n").alias("ns"),
    )
    blocks = cut_lineage(blocks)

    def moved(plus: int | None, minus: int | None) -> Column:
        change = [F.col(c) + (int(i == plus) - int(i == minus)) for i, c in enumerate(names)]
        legal = F.lit(True) if minus is None else F.col(names[minus]) > 0
        return F.when(legal, F.concat_ws(",", *change))

    own = moved(None, None)
    others = [moved(i, j) for i in range(g) for j in range(i + 1, g)] + [moved(i, None) for i in range(g)]
    targets = F.filter(F.array(own, *others), lambda key: key.isNotNull())
    sides = ("length", "words", "ns", "part")
    left = blocks.select(*[F.col(c).alias(f"{c}_a") for c in sides], own.alias("home"), F.explode(targets).alias("key"))
    right = blocks.select(*[F.col(c).alias(f"{c}_b") for c in sides], own.alias("key"))
    met = left.join(right, "key").where("key != home OR part_a <= part_b")
    return met.withColumn("same", (F.col("key") == F.col("home")) & (F.col("part_a") == F.col("part_b"))).select("length_a", "words_a", "ns_a", "length_b", "words_b", "ns_b", "same")


def letter_counts(block: np.ndarray) -> np.ndarray:
    """One row of counts per word, one column for each letter that occurs in the block."""
    flat = np.bincount((np.arange(len(block))[:, None] * 256 + block).ravel(), minlength=len(block) * 256)
    return flat.reshape(len(block), 256).astype(np.float32)


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of words of ``a`` and ``b`` that differ by one replaced letter, or one more in ``b``.

    ``a`` and ``b`` hold the code points of words of one length each.  The squared distance of letter
    counts comes from one matrix product; it is 2 after a replacement and 1 after an insertion.
    """
    x, y = letter_counts(a), letter_counts(b)
    used = x.any(axis=0) | y.any(axis=0)
    x, y = x[:, used], y[:, used]
    wanted = np.float32(2 if a.shape[1] == b.shape[1] else 1)
    # distance = |x|^2 + |y|^2 - 2 xy, all small integers, hence exact.
    product = x @ y.T
    product *= -2
    product += (x * x).sum(axis=1)[:, None]
    product += (y * y).sum(axis=1)
    i, j = np.nonzero(product == wanted)
    left, right = a[i], b[j]
    if a.shape[1] == b.shape[1]:
        good = (left != right).sum(axis=1) == 1
    else:
        n = a.shape[1]
        head = np.logical_and.accumulate(left == right[:, :n], axis=1).sum(axis=1)
        tail = np.logical_and.accumulate((left == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        good = head + tail >= n
    return i[good], j[good]


def neighbours(pairs: DataFrame) -> DataFrame:
    """``word, n_near, best``: partial counts and the most frequent near word, per pair of blocks."""

    def matrix(words: str, length: int) -> np.ndarray:
        return np.frombuffer(words.encode("latin-1"), np.uint8).reshape(-1, length)

    def partial(me: np.ndarray, near: np.ndarray, words: np.ndarray, others: np.ndarray, ns: np.ndarray) -> pd.DataFrame:
        """Blocks are in code-point order, so the smallest row of the largest count is the best."""
        order = np.lexsort((near, -ns[near], me))
        first = np.flatnonzero(np.diff(me[order], prepend=-1))
        who, best = me[order][first], near[order][first]
        text = lambda block: [w.tobytes().decode("latin-1") for w in block]
        return pd.DataFrame({"word": text(words[who]), "n_near": np.diff(np.append(first, len(order))), "best_n": ns[best], "best": text(others[best])})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a, b = matrix(row.words_a, row.length_a), matrix(row.words_b, row.length_b)
                na, nb = np.asarray(row.ns_a, np.int64), np.asarray(row.ns_b, np.int64)
                i, j = near_pairs(a, b)
                if len(i):
                    yield partial(i, j, a, b, nb)
                    if not row.same:
                        yield partial(j, i, b, a, na)

    found = pairs.mapInPandas(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """``word, root``: where the links ``word, form`` end.  Each round doubles the steps a word has gone."""
    current = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = cut_lineage(current.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        current = gone.select("word", "root")
        if gone.where("on").isEmpty():
            return current


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts that occurs often enough.

    A run is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF, of which A-Z are lower-cased.
    Where the hash of ``<id>:<run>`` is divisible by ``typo_every``, one of its letters is deleted: a
    misspelling that every occurrence in that document shares.  Words are the results of at least
    ``min_length`` code points and ``min_count`` occurrences in all texts.  Near words differ by one
    inserted, deleted or replaced code point; ``form`` is the most frequent near word (ties: least in
    code-point order) if it occurs ``dominance`` times as often, ``root`` the end of the chain of
    forms.  Occurrences grow along a chain, so it has no circle.

    The search compares blocks of words of a length with blocks of the same and the next length:
    products of letter counts give squared distances, those of at most two are verified.  Words reach
    a task in blocks of bounded size, and blocks meet by an equi-join of cells of letter counts.

    Null texts have no words; a null id is an empty one, so runs hash as ``:<run>``; repeated rows
    count each time, with the same misspellings.  Other columns are ignored; an empty table gives no rows.
    """
    texts = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = cut_lineage(count_words(texts, settings).where(F.col("n") >= settings.min_count))
    near = neighbours(block_pairs(words, settings))
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= settings.dominance * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("n"))).alias("best"),
    )
    known = cut_lineage(known.select("word", "n", "n_near", F.col("best.form").alias("form"), F.col("best.n").alias("form_n")))
    roots = follow(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
