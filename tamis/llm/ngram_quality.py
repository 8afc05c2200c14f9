"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tamis.llm.arrays import MULTIPLIER, mix
from tamis.llm.frames import bucketed, written_id
from tamis.session import cut_lineage

START, END = 2, 3  # code points that stand before and after every text


@dataclass(frozen=True)
class Settings:
    """Character n-grams of ``order``; a text is kept up to the ``quantile`` of its language.

    Trusted texts outside the fold that is held out make the model, those inside the thresholds.
    """

    order: int = 5
    quantile: float = 0.99
    folds: int = 5
    bucket_bytes: int = 8 << 20


def held_out(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


class Grams:
    """The n-grams of some texts: the distinct ones as rows of code points, ascending.

    Texts are taken in blocks of about ``block_chars``, so the arrays of a large bucket stay small.
    """

    def __init__(self, texts: list[str], order: int, block_chars: int = 1 << 20):
        self.texts, self.order = texts, order
        self.sizes = np.array([len(t) + 1 for t in texts], np.int64)
        ends = np.cumsum(self.sizes)
        cuts = np.unique(np.searchsorted(ends, np.arange(block_chars, int(ends[-1]), block_chars)) + 1) if len(texts) else np.zeros(0, int)
        edges = [0, *(c for c in cuts.tolist() if c < len(texts)), len(texts)]
        self.blocks = list(zip(edges[:-1], edges[1:]))
        there = np.zeros(0x110000, bool)
        for a, b in self.blocks:
            there[self._codes(a, b)] = True
        self.alphabet = np.flatnonzero(there).astype("<u4")
        self.dense = np.cumsum(there, dtype=np.int32) - 1
        self.single = len(self.alphabet) ** order < 1 << 63
        if self.single:
            found = [np.unique(self._keys(a, b)) for a, b in self.blocks]
            self.distinct = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            digits, rest = [], self.distinct.copy()
            for _ in range(order):
                digits.append(self.alphabet[rest % len(self.alphabet)])
                rest //= len(self.alphabet)
            self.rows = np.stack(digits[::-1], axis=1).astype("<u4") if len(self.distinct) else np.zeros((0, order), "<u4")
        else:  # too many different characters for one number: number the rows themselves
            self.rows, number = np.unique(np.concatenate([self._rows(a, b) for a, b in self.blocks]), axis=0, return_inverse=True)
            self.number, self.distinct = number.ravel(), np.arange(len(self.rows))

    def _codes(self, a: int, b: int) -> np.ndarray:
        """Texts a to b, each after ``order - 1`` start marks and before an end mark."""
        # A text's own start and end marks would be taken for ours.
        texts = (t.replace(chr(START), " ").replace(chr(END), " ") for t in self.texts[a:b])
        joined = "".join(x for t in texts for x in (chr(START) * (self.order - 1), t, chr(END)))
        return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")

    def _rows(self, a: int, b: int) -> np.ndarray:
        flat = self._codes(a, b)
        target = np.flatnonzero(flat != START)
        return np.stack([flat[target - j] for j in range(self.order - 1, -1, -1)], axis=1).astype("<u4")

    def _keys(self, a: int, b: int) -> np.ndarray:
        """One number for the n-gram that ends at each character of texts a to b."""
        if not self.single:
            before = int(self.sizes[:a].sum())
            return self.number[before : before + int(self.sizes[a:b].sum())]
        flat = self._codes(a, b)
        dense, target = self.dense[flat], np.flatnonzero(flat != START)
        key = np.zeros(len(target), np.int64)
        for j in range(self.order - 1, -1, -1):
            key = key * len(self.alphabet) + dense[target - j]
        return key

    def counts(self, wanted: np.ndarray) -> np.ndarray:
        """How often each distinct n-gram occurs in the wanted texts."""
        out = np.zeros(len(self.distinct), np.int64)
        for a, b in self.blocks:
            found, often = np.unique(self._keys(a, b)[np.repeat(wanted[a:b], self.sizes[a:b])], return_counts=True)
            out[np.searchsorted(self.distinct, found)] += often
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum of its n-grams' values."""
        out = []
        for a, b in self.blocks:
            found, place = np.unique(self._keys(a, b), return_inverse=True)
            own = values[np.searchsorted(self.distinct, found)][place]
            out.append(np.add.reduceat(own, np.cumsum(self.sizes[a:b]) - self.sizes[a:b]))
        return np.concatenate(out) if out else np.zeros(0)


def pack_texts(docs: DataFrame) -> DataFrame:
    """``docs(bucket, id, lang, text)`` with the texts of a bucket compressed together, batch by batch."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            out = []
            for bucket, rows in batch.groupby("bucket", sort=True):
                texts = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
                sizes = np.array([len(t) for t in texts], "<u8").tobytes()
                ids = [None if i is None or i != i else i for i in rows["id"].astype(object)]
                out.append((bucket, ids, rows["lang"].tolist(), sizes, packer.compress(b"".join(texts))))
            yield pd.DataFrame(out, columns=["bucket", "ids", "langs", "sizes", "texts"])

    types = dict(docs.dtypes)
    return docs.mapInPandas(pack, f"bucket long, ids array<{types['id']}>, langs array<{types['lang']}>, sizes binary, texts binary")


def unpack_texts(rows: pd.DataFrame) -> tuple[list, list, list[str]]:
    """Ids, languages and texts of the packed rows of one bucket."""
    ids, langs, texts = [], [], []
    unpacker = zstandard.ZstdDecompressor()
    for i, lang, sizes, data in zip(rows["ids"], rows["langs"], rows["sizes"], rows["texts"]):
        ids += list(i)
        langs += list(lang)
        data = unpacker.decompress(data)
        ends = np.cumsum(np.frombuffer(sizes, "<u8")).tolist()
        texts += [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends)]
    return ids, langs, texts


def shard_of(rows: np.ndarray, shards: int) -> np.ndarray:
    total = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        total = total * MULTIPLIER + rows[:, j].astype(np.uint64) + np.uint64(1)
    return (mix(total) % np.uint64(shards)).astype(np.int64)


def pack_rows(rows: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(rows.T).tobytes(), 1)


def unpack_rows(data: bytes, order: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4").reshape(order, -1).T


def _number(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the number of each row among them."""
    flat = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 4))).ravel()
    _, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
    return rows[first], inverse.ravel()


def _strings(rows: np.ndarray) -> list[str]:
    n = rows.shape[1]
    text = np.ascontiguousarray(rows).tobytes().decode("utf-32-le", "surrogatepass")
    return [text[i : i + n] for i in range(0, len(text), n)]


def _matrix(grams: pd.Series, order: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, order)


def _discounts(observed: DataFrame) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more, from how many n-grams have counts 1 to 4."""
    n = [F.sum((F.col("a") == i).cast("long")) for i in range(1, 5)]
    n1, n2, n3, n4 = (x or 0 for x in observed.agg(*n).first())
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))


def probabilities(table: DataFrame, order: int) -> DataFrame:
    """``shard, gram, p`` for every row of ``table(shard, gram, n)``; n is the count in trusted text.

    Orders are built from the shortest.  The highest order is counted by occurrences, a lower one by
    the number of different characters seen before it.  Every order is a table of distinct
    n-grams, joined by the n-gram, its beginning and its end; no table is held by one task.
    """
    observed = {order: cut_lineage(table.where("n > 0").select("gram", F.col("n").alias("a")))}
    for k in range(order - 1, 0, -1):
        above = observed[k + 1].select(F.substring("gram", 2, k).alias("gram"))
        observed[k] = cut_lineage(above.groupBy("gram").agg(F.count(F.lit(1)).alias("a")))
    letters = observed[1].count()
    lower = None
    for k in range(1, order + 1):
        d1, d2, d3 = _discounts(observed[k])
        discount = F.when(F.col("a") == 1, d1).when(F.col("a") == 2, d2).otherwise(d3)
        before = lambda c: F.substring(c, 1, k - 1) if k > 1 else F.lit("")  # noqa: B023, E731
        share = [F.sum((F.col("a") == 1).cast("long")) * d1, F.sum((F.col("a") == 2).cast("long")) * d2, F.sum((F.col("a") > 2).cast("long")) * d3]
        contexts = observed[k].groupBy(before("gram").alias("context")).agg(F.sum("a").alias("total"), (share[0] + share[1] + share[2]).alias("saved"))
        wanted = table.select(F.substring("gram", order - k + 1, k).alias("gram")).distinct()
        joined = wanted.join(observed[k], "gram", "left").withColumn("context", before("gram")).join(cut_lineage(contexts), "context", "left")
        if lower is None:
            joined = joined.withColumn("below", F.lit(1.0 / (letters + 1)))
        else:
            joined = joined.withColumn("end", F.substring("gram", 2, k - 1)).join(lower.select(F.col("gram").alias("end"), F.col("p").alias("below")), "end")
        own = F.greatest(F.coalesce(F.col("a") - discount, F.lit(0.0)), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise((own + F.col("saved") * F.col("below")) / F.col("total"))
        lower = cut_lineage(joined.select("gram", p.alias("p")))
    return table.select("shard", "gram").join(lower, "gram")


def document_perplexities(
    df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings(),
) -> DataFrame:
    """``id, lang, units, perplexity`` per row of ``df``; ``trusted`` has the ids of the model's texts.

    Documents lie in buckets.  Each bucket sends its distinct n-grams, with their counts in
    trusted texts, to shards of n-grams; the shards sum the counts, the model's tables are joined,
    and every shard answers every bucket with the probabilities it asked for.  So an n-gram
    travels once per bucket, however often it occurs, and texts move once.
    """
    order = settings.order
    slim = df.select(written_id(id_col).alias("id"), F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs, n, total = bucketed(slim, F.coalesce("id", "text"), F.col("text"), settings.bucket_bytes)
    docs = pack_texts(docs)
    marks = trusted.select(written_id(id_col).alias("id")).distinct().withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(n)).cast("long"))
    shards = max(4, -(-total // (16 * settings.bucket_bytes)))

    def count(key: tuple, rows: pd.DataFrame, marked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"bucket": [], "shard": [], "grams": [], "counts": []})
        ids, _, texts = unpack_texts(rows)
        grams, good = Grams(texts, order), set(marked["id"])
        counts = grams.counts(np.fromiter((i in good for i in ids), bool, len(ids))).astype("<u4")
        shard = shard_of(grams.rows, shards)
        out = [(key[0], s, pack_rows(grams.rows[shard == s]), zlib.compress(counts[shard == s].tobytes(), 1)) for s in np.unique(shard).tolist()]
        return pd.DataFrame(out, columns=["bucket", "shard", "grams", "counts"])

    asked = docs.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInPandas(count, "bucket long, shard long, grams binary, counts binary")
    asked = cut_lineage(asked)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_rows(g, order) for g in rows["grams"]]
        counts = np.concatenate([np.frombuffer(zlib.decompress(c), "<u4") for c in rows["counts"]])
        distinct, place = _number(np.concatenate(parts))
        return pd.DataFrame({"shard": key[0], "gram": _strings(distinct), "n": np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)})

    table = cut_lineage(asked.groupBy("shard").applyInPandas(merge, "shard long, gram string, n long"))
    model = cut_lineage(probabilities(table, order))

    def answer(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_rows(g, order) for g in rows["grams"]]
        sizes = [len(p) for p in parts]
        _, place = _number(np.concatenate([_matrix(known["gram"], order), *parts]))
        value = np.zeros(int(place.max()) + 1, "<f4")
        value[place[: len(known)]] = np.log(known["p"].to_numpy())
        said = np.split(value[place[len(known) :]], np.cumsum(sizes)[:-1])
        return pd.DataFrame({"bucket": rows["bucket"], "shard": key[0], "logs": [zlib.compress(x.tobytes(), 1) for x in said]})

    answers = asked.select("bucket", "shard", "grams").groupBy("shard").cogroup(model.groupBy("shard")).applyInPandas(answer, "bucket long, shard long, logs binary")

    def score(rows: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"id": [], "lang": [], "units": [], "perplexity": []})
        ids, langs, texts = unpack_texts(rows)
        grams = Grams(texts, order)
        shard = shard_of(grams.rows, shards)
        logs = np.zeros(len(grams.rows))
        for s, data in zip(said["shard"], said["logs"]):
            logs[shard == s] = np.frombuffer(zlib.decompress(data), "<f4")
        sums = grams.sums(logs)
        return pd.DataFrame({"id": ids, "lang": langs, "units": grams.sizes, "perplexity": np.exp(-sums / grams.sizes)})

    schema = f"id string, lang {dict(slim.dtypes)['lang']}, units long, perplexity double"
    scored = docs.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInPandas(score, schema)
    return scored.withColumn("id", F.col("id").cast(df.schema[id_col].dataType))


def judge_quality(
    df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings(),
) -> DataFrame:
    """``<id>, lang, units, perplexity, threshold, kept``: one row for each row of ``df``.

    ``trusted`` lists the ids of good texts.  Those outside the held-out fold train the model over
    all languages; those inside it, which it has not seen, give every language the threshold at
    the quantile of their perplexities.  A text is kept up to its language's threshold.

    Perplexity is per character, the end of the text counting as one; null texts are empty.  A
    language without held-out trusted texts, null among them, takes the threshold over all; if
    there is none at all, everything is kept.  Without trusted text all perplexities are equal.
    """
    trusted = trusted.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    inside = held_out(F.col(id_col), settings.folds)
    scored = cut_lineage(document_perplexities(df, trusted.where(~inside), id_col, text_col, lang_col, settings))
    measured = scored.join(trusted.where(inside).withColumnRenamed(id_col, "id"), "id", "left_semi")
    height = F.round(F.log("perplexity"), 5).alias("height")
    # Rounded, so that the exact quantile keeps few different values.
    quantile = F.percentile("height", F.lit(settings.quantile))
    heights = cut_lineage(measured.select("lang", height))
    overall = heights.agg(quantile).first()[0]
    limits = cut_lineage(heights.where("lang IS NOT NULL").groupBy("lang").agg(quantile.alias("limit")))
    out = scored.join(limits, "lang", "left")
    limit = F.coalesce("limit", F.lit(overall).cast("double"))
    return out.select(
        F.col("id").alias(id_col), F.col("lang").alias(lang_col), "units", F.round("perplexity", 6).alias("perplexity"), F.exp(limit).alias("threshold"),
        F.coalesce(F.round(F.log("perplexity"), 5) <= limit, F.lit(True)).alias("kept"),
    )
