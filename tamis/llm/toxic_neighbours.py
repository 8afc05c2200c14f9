"""Toxicity from the nearest labelled examples by TF-IDF cosine."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tamis.llm.frames import written_id
from tamis.session import cut_lineage, release_memory

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``max_examples`` bounds the labelled rows that are learnt from, half of them toxic if there are enough.

    Terms are words and their first ``stems`` letters, all that the examples hold.  The idf of
    at most ``max_terms`` is raised by 1 plus their log-likelihood ratio: those whose share of
    toxic examples is above the overall share, with the greatest ratio, which has to be
    ``least_ratio`` or more (30: one term in 10**7 by chance), and of whose examples
    ``least_purity`` or more are toxic.  Copies of a text count once.
    ``neighbours`` vote, ``block`` texts are compared at once, and a document without
    neighbours counts ``prior`` votes at the share of toxic examples that have none either.
    The posting lists of the ``wide`` terms of most examples are cut every ``span`` examples; ``first_blocks`` blocks of a query are opened at first.
    ``max_terms=0`` is plain TF-IDF.
    """

    max_examples: int = 8192
    stems: tuple[int, ...] = (4, 5, 6)
    max_terms: int = 4096
    least_ratio: float = 30.0
    neighbours: int = 16
    block: int = 512
    prior: float = 1.0
    least_purity: float = 0.5
    wide: int = 2048
    span: int = 32
    first_blocks: int = 2


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id as text leaves no remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def terms_of(text: str, stems: tuple[int, ...]) -> Counter:
    """Counts of the text's lower-case words and of their beginnings, the latter marked by a star."""
    words = Counter(WORD.findall(text.lower()))
    out = Counter(words)
    for n in stems:
        for word, count in words.items():
            if len(word) >= n:
                out[word[:n] + "*"] += count
    return out


Vector = tuple[np.ndarray, np.ndarray]  # ascending terms, and the weight of each


class Index:
    """Block-max inverted index: the posting list of each term in blocks of examples, each with its greatest weight.

    Block b of every list covers the same ``span`` examples, so the maxima of a query's terms bound
    all cosines of a block at once.  Examples of one label whose heaviest term is the same stand
    together, which keeps the bounds tight.  The lists of the most frequent terms have a cell for
    every example and are opened block by block; those of the others, with hardly more than one
    example a block, are summed at once, and the greatest sum of a block goes into its bound.
    """

    def __init__(self, terms: list[str] | pa.Array, idf: np.ndarray, ids: list, rows: list[dict[int, float]], toxic: np.ndarray, settings: Settings):
        vectors = [(np.fromiter(r, np.int64), np.fromiter(r.values(), float)) for r in rows]
        self._fill(terms, idf, ids, vectors, np.array([_heaviest(*v) for v in vectors], np.int64), toxic, settings)

    @classmethod
    def of_counts(cls, terms: list[str] | pa.Array, idf: np.ndarray, ids: list, counted: list[Vector], toxic: np.ndarray, settings: Settings) -> Index:
        """From terms and their counts.  Weights are made where they are used: counts are small to send."""
        index = cls.__new__(cls)
        heaviest, norm = np.full(len(counted), -1, np.int64), np.zeros(len(counted))
        for i, (t, n) in enumerate(counted):
            raw = (1 + np.log(n)) * idf[t]
            heaviest[i], norm[i] = _heaviest(t, raw), math.sqrt(raw @ raw)
        index._fill(terms, idf, ids, counted, heaviest, toxic, settings)
        index.count, index.weight = index.weight.astype(np.min_scalar_type(int(index.weight.max(initial=1)))), None
        index.norm = norm[index.rank]
        return index

    @cached_property
    def terms(self) -> dict[str, int]:
        """The number of each term, made where it is used: the driver holds and sends the names only."""
        names, self.names = self.names, None
        return {t: i for i, t in enumerate(names.to_pylist())}

    def _fill(
        self, terms: list[str] | pa.Array, idf: np.ndarray, ids: list, vectors: list[Vector], heaviest: np.ndarray, toxic: np.ndarray, settings: Settings,
    ) -> None:
        self.names: pa.Array | None = terms if isinstance(terms, pa.Array) else pa.array(terms, pa.string())
        self.idf, self.settings = idf, settings
        self.rank = np.lexsort((np.arange(len(ids)), heaviest, -toxic))  # the place of each example in the caller's order
        self.ids, self.toxic = np.array(ids, object)[self.rank], toxic.astype(np.float64)[self.rank]
        vectors = [vectors[i] for i in self.rank]
        term = np.concatenate([t.astype(np.int32) for t, _ in vectors]) if vectors else np.zeros(0, np.int32)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
        order = np.argsort(term, kind="stable")
        del term
        owner = np.repeat(np.arange(len(vectors), dtype=np.min_scalar_type(max(1, len(vectors)))), [len(t) for t, _ in vectors])
        self.at = owner[order]
        del owner
        self.weight: np.ndarray | None = (np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0))[order]
        self.cells: np.ndarray | None = None  # made where it is used

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> Vector:
        """The unit vector of a text over all terms of the examples."""
        raw = (1 + np.log(counts)) * self.idf[terms]
        return terms, raw / math.sqrt(raw @ raw) if len(raw) else raw

    def weights(self, counts: dict[str, int]) -> dict[int, float]:
        """The unit vector of a text, by term."""
        known = {self.terms[t]: n for t, n in counts.items() if t in self.terms}
        terms = np.array(sorted(known), np.int64)
        return dict(zip(terms.tolist(), self.vector(terms, np.array([known[t] for t in terms.tolist()], float))[1].tolist()))

    def _cut(self) -> None:
        """Cut the lists into blocks and find their maxima; keep each example's own vector for exact sums."""
        sizes, span, n = np.diff(self.starts), self.settings.span, len(self.ids)
        if self.weight is None:
            self.weight = (1 + np.log(self.count.astype(float))) * np.repeat(self.idf, sizes) / self.norm[self.at]
            self.count = None
        own = np.argsort(self.at, kind="stable")
        self.own_term = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[own]
        self.own_weight = self.weight[own]
        self.own_from = np.concatenate([[0], np.cumsum(np.bincount(self.at, minlength=n))])
        del own
        self.blocks = -(-n // span)
        often = np.argsort(-sizes, kind="stable")[: self.settings.wide]
        self.column = np.full(len(sizes), -1, np.int32)
        self.column[often] = np.arange(len(often))
        self.cells = np.zeros((self.blocks, len(often), span), np.float32)
        for i, t in enumerate(often.tolist()):
            part = slice(self.starts[t], self.starts[t + 1])
            self.cells[self.at[part] // span, i, self.at[part] % span] = self.weight[part]
        self.cell_max = np.ascontiguousarray(self.cells.max(axis=2).T)
        # More than rounding in single precision can change a sum of products whose total is at most 1.
        self.slack = 2.0 * (len(often) + 16) * 2.0**-24
        rare = np.repeat(self.column < 0, sizes)
        self.list_at, self.list_weight = self.at[rare].astype(np.intp), self.weight[rare].astype(np.float32)
        self.list_from = np.concatenate([[0], np.cumsum(np.where(self.column < 0, sizes, 0))])
        self.at = self.weight = None

    def search(self, queries: list[Vector], skips: list[int]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """The nearest examples of every query but the one it skips (-1: none), and the blocks opened for it.

        The blocks of the greatest bounds are opened first.  Of the others only those are opened whose
        bound reaches the last of the best so far.  Sums in single precision, with room for their
        rounding, leave few examples, whose cosines are then exact.
        """
        if self.cells is None:
            self._cut()
        k, span, m, n = self.settings.neighbours, self.settings.span, len(queries), len(self.ids)
        wide = np.zeros((m, self.cells.shape[1]), np.float32)
        cosines = np.zeros((m, self.blocks, span), np.float32)
        for row, part, (terms, weights), skip in zip(wide, cosines.reshape(m, -1), queries, skips):
            at = self.column[terms]
            row[at[at >= 0]] = weights[at >= 0]
            rest, weights = terms[at < 0], weights[at < 0]
            place, sizes = _ranges(self.list_from[rest], self.list_from[rest + 1] - self.list_from[rest])
            part += np.bincount(self.list_at[place], self.list_weight[place] * np.repeat(weights, sizes), len(part))
            if skip >= 0:
                part[skip] = -4.0  # stays below 0 whatever the other terms add
        bounds = wide @ self.cell_max + np.maximum(cosines.max(axis=2), 0.0)

        def open_blocks(now: np.ndarray) -> None:
            for b in np.flatnonzero(now.any(axis=0)).tolist():
                rows = np.flatnonzero(now[:, b])
                cosines[rows, b] += (wide if len(rows) == m else wide[rows]) @ self.cells[b]

        early = min(self.blocks, max(self.settings.first_blocks, -(-k // span)))
        opened = bounds > 0
        if early < self.blocks:
            top = np.argpartition(bounds, self.blocks - early, axis=1)[:, -early:]
            first = np.zeros(bounds.shape, bool)
            np.put_along_axis(first, top, True, axis=1)
            open_blocks(first)
            best = np.take_along_axis(cosines, top[:, :, None], axis=1).reshape(m, -1)
            least = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k] if best.shape[1] >= k else np.zeros(m)
            rest = ~first & (bounds > 0) & (bounds >= least[:, None] - self.slack)
            open_blocks(rest)
            opened = first | rest
        else:
            open_blocks(opened)
        whole = np.zeros(len(self.starts) - 1)
        found = []
        for row, blocks, (terms, weights) in zip(cosines, opened, queries):
            # Places of opened blocks only: the others hold nothing.
            at = (np.flatnonzero(blocks)[:, None] * span + np.arange(span)).ravel()
            near = row[blocks].ravel()
            least = np.partition(near, len(near) - k)[len(near) - k] if len(near) > k else 0.0
            at = at[(near >= least - self.slack) & (near > 0)]
            sizes = self.own_from[at + 1] - self.own_from[at]
            place, _ = _ranges(self.own_from[at], sizes)
            whole[terms] = weights
            exact = np.add.reduceat(whole[self.own_term[place]] * self.own_weight[place], np.cumsum(sizes) - sizes) if len(at) else np.zeros(0)
            whole[terms] = 0.0
            # Sums that differ in the last digits only are ties, which go to the one that the caller named earlier.
            exact = np.round(exact, 12)
            order = np.lexsort((self.rank[at], -exact))[:k]
            found.append((at[order], exact[order]))
        return found, opened

    def nearest(self, query: dict[int, float], skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """``search`` for one query."""
        return self.search([(np.fromiter(query, np.int64), np.fromiter(query.values(), float))], [skip])[0][0]


def _heaviest(terms: np.ndarray, heights: np.ndarray) -> int:
    return terms[np.argmax(heights)] if len(terms) else -1


def _ranges(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and their sizes."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum())), sizes


@dataclass
class Model:
    index: Index
    share_without: float  # toxic share of examples that have no word
    slope: float
    offset: float

    def vote(self, at: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic votes; a neighbour's vote weighs its cosine over its distance."""
        near = np.minimum(cosines, 1.0)
        weights = near / (1.0 - near + 0.05)
        prior = self.index.settings.prior
        return float((weights @ self.index.toxic[at] + prior * self.share_without) / (weights.sum() + prior))

    def score(self, vote: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * _logit(vote) + self.offset))))


def packed(model: Model) -> bytes:
    return zlib.compress(cloudpickle.dumps(model), 1)


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _calibrate(votes: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from votes to labels, slightly held to the identity."""
    x = np.array([_logit(v) for v in votes])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        g = np.array([(weights * (p - toxic) * x).sum() + (a - 1), (weights * (p - toxic)).sum() + b * 0.1])
        h = weights * p * (1 - p)
        hessian = np.array([[(h * x * x).sum() + 1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.1]])
        step = np.linalg.solve(hessian, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-10:
            break
    return max(a, 0.05), b


def _examples(texts: DataFrame, marks: DataFrame, settings: Settings) -> DataFrame:
    """A bounded, stratified choice of the labelled rows by the order of a hash, with the weight of each."""
    there = cut_lineage(marks.join(texts.select("id").distinct(), "id", "left_semi"))
    each = {r["toxic"]: r["n"] for r in there.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = each.get(1, 0), each.get(0, 0)
    take1 = min(n1, max(settings.max_examples // 2, settings.max_examples - n0))
    take0 = min(n0, settings.max_examples - take1)
    order = F.xxhash64(F.lit(17), "id")
    # Spark keeps that many of each label per task, then merges.
    some = [there.where(F.col("toxic") == y).orderBy(order, "id").limit(n) for y, n in ((1, take1), (0, take0))]
    share = {1: n1 / max(1, take1), 0: n0 / max(1, take0)}
    weight = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    chosen = cut_lineage(some[0].union(some[1]).withColumn("weight", weight))
    # At most max_examples slim rows are broadcast, so texts are not shuffled to find them.
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic", "weight").agg(F.min("text").alias("text"))


def fit(texts: DataFrame, marks: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from ``texts(id, text)`` and ``marks(id, toxic)``; what is kept is bounded by ``settings``."""
    spark = texts.sparkSession
    marks = marks.where("toxic IN (0, 1)").select("id", F.col("toxic").cast("int").alias("toxic"))
    examples = cut_lineage(_examples(texts, marks, settings))
    stems = settings.stems

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per task: the examples with each term, weighted to the labelled rows."""
        df, hot = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = terms_of(text, stems).keys()
                df.update(found)
                if toxic:
                    hot.update(found)
        yield pd.DataFrame({"term": list(df), "n": list(df.values()), "hot": [hot[t] for t in df]})

    totals = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, n_hot = int(totals[0]), int(totals[1])
    share = n_hot / max(1, n)
    counts = examples.dropDuplicates(["text", "toxic"]).mapInPandas(words, "term string, n long, hot long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("hot").alias("hot"))
    hot, cold = F.col("hot"), F.col("n") - F.col("hot")
    part = lambda x, p: F.when(x > 0, x * F.log(x / (F.col("n") * max(p, 1e-12)))).otherwise(0.0)
    ratio = 2 * (part(hot, share) + part(cold, 1 - share))
    pure = (hot > F.col("n") * share) & (hot >= F.col("n") * settings.least_purity)
    counts = cut_lineage(counts.withColumn("ratio", F.when(pure, F.round(ratio, 9)).otherwise(0.0)))
    raised = counts.where(F.col("ratio") >= settings.least_ratio).orderBy(F.desc("ratio"), "term").limit(settings.max_terms).collect()
    # Bounded by max_examples: the terms of so many texts.  They stay in Arrow, as objects they would take many times that with the driver.
    table = counts.select("term", "n").toArrow().sort_by("term")
    terms, idf = table["term"].combine_chunks(), np.log((1 + n) / (1 + table["n"].to_numpy())) + 1
    del table
    of_raised = pc.index_in(terms, value_set=pa.array([r["term"] for r in raised], terms.type))
    at = np.flatnonzero(of_raised.is_valid())
    idf[at] *= 1 + np.array([r["ratio"] for r in raised], float)[of_raised.drop_null().to_numpy()]
    del of_raised, at
    words_sent = spark.sparkContext.broadcast(zlib.compress(pickle.dumps(terms), 1))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {t: i for i, t in enumerate(pickle.loads(zlib.decompress(words_sent.value)).to_pylist())}
        for batch in batches:
            found = [sorted((known[t], c) for t, c in terms_of(x, stems).items()) for x in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "toxic": batch["toxic"], "weight": batch["weight"],
                "terms": [np.array([t for t, _ in f], "<i4").tobytes() for f in found], "counts": [np.array([c for _, c in f], "<i4").tobytes() for f in found],
            })

    id_type = dict(texts.dtypes)["id"]
    rows_of = cut_lineage(examples.mapInPandas(vectors, f"id {id_type}, toxic int, weight double, terms binary, counts binary"))
    # Bounded: at most max_examples rows, a few bytes for each of their terms.
    table = rows_of.toArrow()
    words_sent.destroy()
    rows = table.select(["id", "toxic", "weight"]).to_pylist()
    for name in ("terms", "counts"):
        for r, value in zip(rows, (x for chunk in table[name].chunks for x in chunk)):
            r[name] = value.as_buffer()  # a view, not a copy
    del table
    rows.sort(key=lambda r: (str(r["id"]), r["toxic"]))
    empty = [r for r in rows if not r["terms"].size]
    full = [r for r in rows if r["terms"].size]
    for r in empty:
        del r["terms"], r["counts"]
    without = sum(r["weight"] * r["toxic"] for r in empty), sum(r["weight"] for r in empty)

    def vector_of(index: Index, terms: bytes, counts: bytes) -> Vector:
        return index.vector(np.frombuffer(terms, "<i4").astype(np.int64), np.frombuffer(counts, "<i4"))

    counted = [(np.frombuffer(r.pop("terms"), "<i4"), np.frombuffer(r.pop("counts"), "<i4")) for r in full]
    index = Index.of_counts(terms, idf, [r["id"] for r in full], counted, np.array([r["toxic"] for r in full]), settings)
    del counted, terms
    release_memory(spark)
    model = Model(index, (without[0] + 0.5 * share) / (without[1] + 0.5) if n else 0.0, 1.0, 0.0)
    if not n:
        return model
    # Calibrate on the examples' own votes, each without itself.
    # As bytes that carry the classes too, so that executors need not have the package.
    sent = spark.sparkContext.broadcast(packed(model))

    def own_votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pickle.loads(zlib.decompress(sent.value))
        place = {x: i for i, x in enumerate(model.index.ids)}
        for batch in batches:
            for at in range(0, len(batch), settings.block):
                part = batch.iloc[at : at + settings.block]
                own = [place[x] for x in part["id"]]
                near, _ = model.index.search([vector_of(model.index, t, c) for t, c in zip(part["terms"], part["counts"])], own)
                yield pd.DataFrame({"at": model.index.rank[own], "vote": [model.vote(*n) for n in near]})

    numbers = rows_of.where("length(terms) > 0").select("id", "terms", "counts")
    votes = {r["at"]: r["vote"] for r in numbers.mapInPandas(own_votes, "at long, vote double").collect()}
    sent.destroy()
    nothing = model.vote(np.zeros(0, np.int64), np.zeros(0))
    x = np.array([votes[i] for i in range(len(full))] + [nothing] * len(empty))
    y = np.array([r["toxic"] for r in full + empty], float)
    w = np.array([r["weight"] for r in full + empty])
    model.slope, model.offset = _calibrate(x, y, w)
    return model


def score_toxicity(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, settings: Settings = Settings(),
) -> DataFrame:
    """``<id>, held_out, score, predicted, vote, evidence``: one row for each row of ``df``.

    Learns from the labelled rows of ``df`` outside the held-out fold, by their texts only.  The
    score is the distance-weighted vote of the nearest examples, calibrated to a probability;
    ``evidence`` names them with cosine and label.  A row whose id is an example's
    does not see that example, so no score knows its own label.  The examples are bounded by the
    settings; every row is scored where it lies, over its whole text and all terms of the examples.

    Null texts are empty; texts without a word of the examples have no neighbours and get the
    share of toxic examples without words.  Rows without label, or with one other than 0 or 1, are only scored.
    Where an id has several labels the greatest counts; where it has several texts, the first in
    order is the example.  Without any labelled row all scores are near 0.
    """
    slim = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    model = fit(slim.where("id IS NOT NULL"), marks.where(~held_out(F.col("id"), folds)), settings)
    sent = df.sparkSession.sparkContext.broadcast(packed(model))
    del model
    release_memory(df.sparkSession)
    stems = settings.stems

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pickle.loads(zlib.decompress(sent.value))
        known = model.index.terms
        place = {str(x): i for i, x in enumerate(model.index.ids)}
        cache: dict[str, list[int]] = {}

        def query(text: str) -> Vector:
            found, counts = [], []
            for word, n in Counter(WORD.findall(text.lower())).items():
                hits = cache.get(word)
                if hits is None:
                    if len(cache) > 100_000:
                        cache.clear()
                    every = [word] + [word[:k] + "*" for k in stems if len(word) >= k]
                    hits = cache[word] = [known[t] for t in every if t in known]
                found += hits
                counts += [n] * len(hits)
            terms, place = np.unique(np.array(found, np.int64), return_inverse=True)
            return model.index.vector(terms, np.bincount(place, counts, len(terms)))

        for batch in batches:
            out = []
            for start in range(0, len(batch), settings.block):
                queries = [query(text) for text in batch["text"].iloc[start : start + settings.block]]
                skips = [place.get(x, -1) for x in batch["id"].iloc[start : start + settings.block]]
                for at, cosines in model.index.search(queries, skips)[0]:
                    vote = model.vote(at, cosines)
                    evidence = [f"{model.index.ids[i]}:{c:.4f}:{int(model.index.toxic[i])}" for i, c in zip(at.tolist(), cosines.tolist())]
                    out.append((model.score(vote), vote, evidence))
            done = pd.DataFrame(out, columns=["score", "vote", "evidence"])
            done.insert(0, "id", batch["id"].to_numpy())
            yield done

    scored = slim.withColumn("id", written_id("id")).mapInPandas(score, "id string, score double, vote double, evidence array<string>")
    scored = scored.withColumn("id", F.col("id").cast(slim.schema["id"].dataType))
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id"), folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "vote", "evidence",
    )
