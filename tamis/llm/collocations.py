"""Collocations: phrases whose words stand together more often than their parts would suggest.

Phrases are counted by dynamic itemset counting.  The corpus lies in shards that are scanned in a
circle.  A longer phrase becomes active as soon as both phrases it overlaps have been met often
enough, while those are still being counted; from then on it is counted for one full circle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window, functions as F

from tamis.llm.arrays import mix
from tamis.llm.frames import text_bytes
from tamis.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    """Phrases of up to ``longest`` words that occur ``least`` times; the best ``best`` of a language are returned.

    A phrase gives way to a longer one that occurs in ``cover_percent`` of its places.  ``shards`` is
    the length of the circle.  ``held_keys`` bounds what a task keeps before it hands its sums on.
    The map of active phrases has a byte for every ``bytes_per_cell`` of text, 2 ** ``most_bits`` at most:
    two phrases that share a cell only make some more phrases be counted.
    """

    longest: int = 4
    least: int = 30
    best: int = 2000
    cover_percent: int = 80
    shards: int = 3
    held_keys: int = 1_500_000
    bytes_per_cell: int = 64
    most_bits: int = 26


# What separates words, and what separates pieces.
BLANKS = (0x20, 0x09)
STOPS = (*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)

# For bytes.translate: lower case, and the class of a byte (0 in words, 1 blank, 2 stop).
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
CLASS = bytes(2 if c in STOPS else 1 if c in BLANKS else 0 for c in range(256))
MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
UNSET = 255
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of some texts: first and end byte, 64 and 32 bits of hash, and whether a piece begins there."""

    def __init__(self, texts: list[bytes], seeds: list[int]):
        # A stop ends every text; eight bytes more let every load stay inside.
        self.raw = (b"\n".join(texts) + b"\n" + bytes(8)).translate(FOLD)
        self.data, kind = np.frombuffer(self.raw, np.uint8), np.frombuffer(self.raw[:-8].translate(CLASS), np.uint8)
        inside = np.zeros(len(kind) + 1, bool)
        np.equal(kind, 0, out=inside[1:])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.first, self.end = edge[::2], edge[1::2]
        stops = np.cumsum(kind == 2)[self.first] if len(self.first) else self.first
        self.begins = np.ones(len(self.first), bool)
        self.begins[1:] = stops[1:] != stops[:-1]
        upto = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(upto, self.first, "right")
        self.a, self.b = self._hashes(np.array(seeds, np.uint64)[self.text])

    def _hashes(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = self.end - self.first
        loads = np.ndarray((len(self.data) - 7,), "<u8", buffer=self.data, strides=(1,))
        a = seeds + length.astype(np.uint64)
        b = mix(a ^ B)
        todo, at = np.flatnonzero(length <= 128), 0
        while len(todo):
            part = loads[self.first[todo] + at] & MASKS[np.minimum(length[todo] - at, 8)]
            a[todo] = mix(a[todo] * A + part)
            b[todo] = mix(b[todo] * B ^ part)
            at += 8
            todo = todo[length[todo] > at]
        for i in np.flatnonzero(length > 128).tolist():
            digest = hashlib.blake2b(self.data[self.first[i] : self.end[i]].tobytes() + int(seeds[i]).to_bytes(8, "little"), digest_size=16).digest()
            a[i], b[i] = np.frombuffer(digest, "<u8")
        return a, b


def language_seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Phrases:
    """The active phrases of some words, length by length, as the map of reached phrases says.

    ``first`` holds for every cell the step from which a phrase there counts as met often enough.
    """

    def __init__(self, words: Words, first: np.ndarray, step: int):
        self.words, self.first, self.step = words, first, np.uint8(step)
        self.shift = np.uint64(64 - (len(first) - 1).bit_length())

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: where phrases start that are or were active, their hash, and since which step."""
        w = self.words
        at, a, since, k = np.arange(len(w.a)), w.a, np.zeros(len(w.a), np.uint8), 1
        while len(at):
            yield k, at, a, since
            reached = self.first[a >> self.shift]
            # Both the phrase and the one a word later must have been reached by now.
            both = (at[1:] == at[:-1] + 1) & (reached[1:] <= self.step) & (reached[:-1] <= self.step)
            if k == 1:
                both &= ~w.begins[1:]
            keep = np.flatnonzero(both)
            # A cell that another phrase has filled may be older than what this phrase is made of.
            since = np.maximum(reached, since)
            since = np.maximum(since[keep], since[keep + 1])
            at, k = at[keep], k + 1
            a = mix(a[keep] * A + w.a[at + k - 1] + np.uint64(k))

    def checks(self, k: int, at: np.ndarray) -> np.ndarray:
        """The 32 bits of hash of the phrases of ``k`` words at some places."""
        b = self.words.b[at]
        for i in range(1, k):
            b = mix(b * B + self.words.b[at + i])
        return b >> np.uint64(32)


def texts_of(batch: pa.RecordBatch, seeds: dict[str, int], size: int = 1 << 20) -> Iterator[tuple[list[bytes], list[str], list[int]]]:
    """The texts, languages and seeds of a batch in blocks of about ``size`` bytes."""
    texts, langs, held = [], [], 0
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
        texts.append(text.as_py())
        langs.append(lang)
        held += len(texts[-1])
        if lang not in seeds:
            seeds[lang] = language_seed(lang)
        if held >= size:
            yield texts, langs, [seeds[x] for x in langs]
            texts, langs, held = [], [], 0
    if texts:
        yield texts, langs, [seeds[x] for x in langs]


# ``b`` holds 32 bits of hash, above them the step since which the phrase is active (8 bits), above them its length.
COUNTS = "a long, b long, n long"


def count_step(shard: DataFrame, first, step: int, settings: Settings) -> DataFrame:
    """``a, b, n``: occurrences in a shard of the phrases active in this step, summed within tasks.

    In the first circle the words of a language are counted too, as a phrase of length 0.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(first.value, np.uint8)
        held: list[tuple[np.ndarray, ...]] = []
        size, seeds, total = 0, {}, {}
        for batch in batches:
            for texts, _, own in texts_of(batch, seeds):
                words = Words(texts, own)
                for seed, n in zip(own, np.bincount(words.text, minlength=len(texts)).tolist()):
                    total[seed] = total.get(seed, 0) + n
                phrases = Phrases(words, reached, step)
                for k, at, a, since in phrases:
                    if k > settings.longest:
                        break
                    active = np.flatnonzero(since.astype(np.int64) + settings.shards > step)
                    if len(active):
                        held.append((a[active], phrases.checks(k, at[active]) | since[active].astype(np.uint64) << np.uint64(32) | np.uint64(k << 40)))
                        size += len(active)
                if size >= settings.held_keys:
                    yield from sums(held)
                    held, size = [], 0
        if held:
            yield from sums(held)
        if total and step < settings.shards:
            yield from rows(np.array(list(total), np.uint64), np.zeros(len(total), np.uint64), np.array(list(total.values()), np.int64))

    def sums(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        a, b = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(a)
        a, b = a[order], b[order]
        # Should two phrases share 64 bits, the change of b parts them; a key may then have several rows.
        start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        yield from rows(a[start], b[start], np.diff(np.append(start, len(a))))

    def rows(a: np.ndarray, b: np.ndarray, n: np.ndarray, size: int = 50_000) -> Iterator[pa.RecordBatch]:
        columns = [a.view(np.int64), b.view(np.int64), n]
        for i in range(0, len(n), size):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in columns], ["a", "b", "n"])

    return shard.mapInArrow(count, COUNTS)


def fill_cells(first: np.ndarray, keys: DataFrame, value: int) -> bool:
    """Enter ``value`` into the free cells of ``keys`` (``a, open``); whether any key was open.

    What reaches the driver are bits, 4 KB for every 32,768 cells of the map: 8 MB at most.
    """
    bits = (len(first) - 1).bit_length()
    cell = F.shiftrightunsigned("a", 64 - bits) + 1
    cells = keys.groupBy(F.bitmap_bucket_number(cell).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"), F.max("open").alias("open"),
    )
    some = False
    for row in cells.collect():
        part = first[(row["bucket"] - 1) << 15 : row["bucket"] << 15]
        fresh = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little").astype(bool)[: len(part)]
        part[fresh & (part == UNSET)] = value
        some |= row["open"]
    return some


SHARDS = "lang string, text binary, shard int"


def frequent_phrases(docs: DataFrame, folder: str, settings: Settings) -> tuple[DataFrame, np.ndarray]:
    """``a, b, k, n`` of every phrase that occurs often enough, exact, and the map of reached phrases.

    Rows of length 0 are languages and their words.  ``docs`` are ``lang, text`` (bytes); ``folder``
    gets the shards and the counts of every step.
    """
    spark = docs.sparkSession
    length, since = F.shiftright("b", 40), F.shiftright("b", 32).bitwiseAND(255)
    seen = Observation()
    dealt = docs.withColumn("shard", (F.monotonically_increasing_id() % settings.shards).cast("int"))
    dealt.observe(seen, F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).write.partitionBy("shard").parquet(f"{folder}/shards")
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    bits = min(settings.most_bits, max(16, (seen.get["bytes"] // settings.bytes_per_cell).bit_length()))
    first = np.full(1 << bits, UNSET, np.uint8)
    counted = COUNTS + ", reached int"
    step, last, before = 0, 0, None
    while step < last + settings.shards:
        sent = spark.sparkContext.broadcast(first.tobytes())
        found = count_step(shards.where(F.col("shard") == step % settings.shards).select("lang", "text"), sent, step, settings)
        found = found.withColumn("reached", F.lit(None).cast("int"))
        if before is not None:
            found = before.unionByName(found)
        total = found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("reached").alias("reached"))
        total = total.withColumn("reached", F.coalesce("reached", F.when((F.col("n") >= settings.least) & (length > 0), step + 1)))
        going_on = since + settings.shards - 1 > step
        total.where(going_on | (F.col("n") >= settings.least)).write.parquet(f"{folder}/steps/step={step}")
        sent.destroy()
        now = spark.read.schema(counted).parquet(f"{folder}/steps/step={step}")
        if fill_cells(first, now.where(F.col("reached") == step + 1).select("a", (length < settings.longest).alias("open")), step + 1):
            last = step + 1
        before = now.where(going_on)
        step += 1
    steps = spark.read.schema(counted + ", step int").parquet(f"{folder}/steps")
    done = (since + settings.shards - 1 == F.col("step")) & (F.col("n") >= settings.least)
    return steps.where(done).select("a", F.col("b").bitwiseAND(0xFFFFFFFF).alias("b"), length.cast("int").alias("k"), "n"), first


NAMES = "a long, b long, lang string, language long, phrase string"


def phrase_names(shard: DataFrame, first: np.ndarray, wanted: np.ndarray, settings: Settings) -> DataFrame:
    """``a, b, lang, language, phrase``: the words of the phrases of a shard that may be wanted.

    Every task keeps a table of what it has named, one phrase a slot; a phrase named twice does no harm.
    """
    sent = shard.sparkSession.sparkContext.broadcast((first.tobytes(), wanted.tobytes()))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, asked = (np.frombuffer(x, np.uint8) for x in sent.value)
        shift = np.uint64(64 - 21)
        # At first no slot holds a key that would fall into it.
        named, seeds = ~(np.arange(1 << 21, dtype=np.uint64) << shift), {}
        for batch in batches:
            out: list[tuple] = []
            for texts, langs, own in texts_of(batch, seeds):
                words = Words(texts, own)
                phrases = Phrases(words, reached, UNSET - 1)
                for k, at, a, _ in phrases:
                    if k > settings.longest:
                        break
                    may = np.flatnonzero((asked[a >> phrases.shift] != UNSET) & (named[a >> shift] != a))
                    keys, place = np.unique(a[may], return_index=True)
                    named[keys >> shift] = keys
                    at = at[may[place]]
                    for p, key, check in zip(at.tolist(), keys.view(np.int64).tolist(), phrases.checks(k, at).tolist()):
                        phrase = b" ".join([words.raw[words.first[i] : words.end[i]] for i in range(p, p + k)]).decode()
                        text = words.text[p]
                        out.append((key, check, langs[text], own[text] - (own[text] >> 63 << 64), phrase))
            for i in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out[i : i + 50_000]), kinds)], [c.split()[0] for c in NAMES.split(", ")])

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    return shard.mapInArrow(name, NAMES)


def with_names(found: DataFrame, first: np.ndarray, folder: str, settings: Settings) -> DataFrame:
    """``lang, language, phrase, k, n`` of the phrases in ``found``.

    A frequent phrase stands in nearly every shard, so the first one names nearly all; the others
    are read only for what is left.
    """
    spark = found.sparkSession
    names = spark.read.schema(NAMES).parquet
    wanted, left, paths = first, found, []
    for shard in range(settings.shards):
        texts = spark.read.schema(SHARDS).parquet(f"{folder}/shards").where(F.col("shard") == shard).select("lang", "text")
        named = phrase_names(texts, first, wanted, settings).join(left.select("a", "b"), ["a", "b"], "left_semi")
        best = F.min(F.struct("lang", "language", "phrase")).alias("best")
        paths.append(f"{folder}/names/{shard}")
        named.groupBy("a", "b").agg(best).select("a", "b", "best.*").write.parquet(paths[-1])
        left = cut_lineage(left.join(names(paths[-1]), ["a", "b"], "left_anti"))
        wanted = np.full(len(first), UNSET, np.uint8)
        if not fill_cells(wanted, left.select("a", F.lit(True).alias("open")), 0):
            break
    return found.join(names(*paths), ["a", "b"]).select("lang", "language", "phrase", "k", "n")


def first_per_group(df: DataFrame, groups: list[str], order: list, n: int, wide: int = 20) -> DataFrame:
    """The first ``n`` rows per group with their ``rank``; large inputs in rounds, each by parts that keep a tenth."""
    rows = df.count()
    while rows > wide * n:
        parts = -(-rows // (wide // 2 * n))
        spread = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
        place = F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(*order))
        df = cut_lineage(spread.withColumn("_place", place).where(F.col("_place") <= n).drop("_part", "_place"))
        before, rows = rows, df.count()
        if rows > 0.9 * before:
            break
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("rank") <= n)


def scored(phrases: DataFrame, settings: Settings) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates, from ``lang, phrase, k, n`` of all frequent phrases.

    Parts of a candidate occur at least as often as it does, so both are among the phrases.
    """
    words = F.split("phrase", " ")
    joined = lambda a, b: F.array_join(F.slice(words, a, b), " ")
    candidates = phrases.where("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("*", joined(F.lit(1), F.col("cut")).alias("left"), joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = lambda c: c.cast("decimal(19,0)")
    product, parts = wide(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), wide(F.col("l")) + wide(F.col("r"))
    cuts = cuts.withColumn("score", F.call_function("div", product, parts))
    least = F.min(F.struct("score", "cut", "l", "r")).alias("least")
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), least).select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    # Shorter phrases inside longer ones: the most frequent longer one decides.
    longer = phrases.where("k >= 3").select("lang", "k", "n", words.alias("w"))
    inside = reduce(DataFrame.unionByName, [
        longer.where(F.col("k") > size).select("lang", "n", F.explode(F.transform(
            F.sequence(F.lit(1), F.col("k") - size + 1), lambda i: F.array_join(F.slice("w", i, size), " ")
        )).alias("phrase")) for size in range(2, settings.longest)
    ]) if settings.longest > 2 else longer.select("lang", "n", F.lit("").alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    covered = wide(F.col("longer")) * 100 >= wide(F.col("a")) * settings.cover_percent
    return best.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered).drop("longer")


def mine_collocations(df: DataFrame, folder: str, text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language.

    Texts (A-Z lower-cased) are cut into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs.  ``n`` is the number of words of the language, ``a`` that of the phrase's
    occurrences, overlaps included.  Cutting it in two parts that occur ``l`` and ``r`` times gives
    ``floor(2000000 * a / (l + r))``; the cut of the lowest score counts (ties: the first).  Phrases
    of at least ``least`` occurrences are ranked, but for those that lie inside a longer one which
    occurs in ``cover_percent`` of their places.  Ties of scores go to the larger ``a``, then to the
    smaller phrase by bytes.

    Counting is exact: parts of a frequent phrase are frequent, so each is active in time, and an
    active phrase is counted in every shard once.  A step scans one shard, sums within tasks, then by
    phrase; the map of active phrases is the only thing broadcast, 64 MB at most.  Phrases are told
    apart by 96 bits of hash.  ``folder`` must be a new one that all executors reach.

    Null texts are empty, a null language is ``und``; repeated rows count each time; other columns
    are ignored; an empty table gives no rows.
    """
    docs = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_bytes(text_col).alias("text"))
    found, first = frequent_phrases(docs, folder, settings)
    found = cut_lineage(found)
    phrases = cut_lineage(with_names(found.where("k > 0"), first, folder, settings))
    totals = found.where("k = 0").select(F.col("a").alias("language"), "n").join(phrases.select("language", "lang").distinct(), "language").select("lang", "n")
    ranked = first_per_group(cut_lineage(scored(phrases, settings)), ["lang"], [F.desc("score"), F.desc("a"), "phrase"], settings.best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
