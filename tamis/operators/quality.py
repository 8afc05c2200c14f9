"""Document quality gates: measures, first failing reason, filter group.

Measures are string and array functions that stay in generated code; ``annotate_quality``
takes counts over words and n-grams from one scan in Arrow batches.  Nothing here shuffles.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from functools import cache
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tamis.functions.text import PUNCTUATION, PUNCTUATION_CLASS, byte_count, count_matches, strip, word_count
from tamis.session import pin

# Stop words of the default profile.
STOP_WORDS = ("של", "את", "על", "הוא", "עם", "בשנת", "גם", "היה", "היא", "לאחר", "לא", "ידי", "בין", "או", "כי")
# Characters that close a sentence at the end of a line.
STOP_CHARACTERS = ".?!…؟۔。！？।։"


@dataclass(frozen=True)
class Thresholds:
    """Limits of every gate; the defaults are the default profile."""

    min_doc_words: float = 15
    max_doc_words: float = 100000
    dup_para_frac: float = 0.3
    dup_para_char_frac: float = 0.2
    dup_line_frac: float = 0.34
    dup_line_char_frac: float = 0.2
    top_n_grams: Mapping[int, float] = field(default_factory=lambda: {2: 0.42, 3: 0.40, 4: 0.35})
    dup_n_grams: Mapping[int, float] = field(
        default_factory=lambda: {5: 0.16, 6: 0.151, 7: 0.14, 8: 0.129, 9: 0.118, 10: 0.108}
    )
    line_punct_thr: float = 0.05
    line_punct_exclude_zero: bool = True
    short_line_length: int = 30
    short_line_thr: float = 999
    char_duplicates_ratio: float = 0.1
    new_line_ratio: float = 0.4
    min_avg_word_length: float = 2
    max_avg_word_length: float = 9
    max_symbol_word_ratio: float = 0.1
    max_bullet_lines_ratio: float = 0.9
    max_ellipsis_lines_ratio: float = 0.3
    max_non_alpha_words_ratio: float = 0.6
    min_stop_words: float = 0
    stop_words: tuple[str, ...] = STOP_WORDS
    stop_characters: str = STOP_CHARACTERS

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> "Thresholds":
        """Read a parsed configuration; n-gram limits may come as ``[[n, share], ...]``."""
        names = {f.name for f in fields(cls)}
        return replace(cls(), **_normalise({k: v for k, v in raw.items() if k in names}))


def _normalise(raw: Mapping[str, Any]) -> dict[str, Any]:
    out = dict(raw)
    for key in ("top_n_grams", "dup_n_grams"):
        if key in out and not isinstance(out[key], Mapping):
            out[key] = {int(n): float(share) for n, share in out[key]}
    return out


# Per-source limits of the default profile.
DEFAULT_OVERRIDES: dict[str, dict[str, Any]] = {
    "SupremeCourtOfIsrael": {"line_punct_thr": 0, "new_line_ratio": 1, "max_doc_words": 550000, "dup_n_grams": {5: 0.4}},
    "sefaria": {"max_doc_words": 550000, "dup_line_frac": 0.98},
    "hebrew_tweets": {"min_doc_words": 10},
    "TauDigital": {"max_doc_words": 350000},
    "TauOCR": {"max_doc_words": 350000, "max_ellipsis_lines_ratio": 0.7, "max_non_alpha_words_ratio": 0.4},
    "BooksNLI2": {"max_doc_words": 350000},
    "StateComptrollerReports": {"max_doc_words": 350000},
    "YisraelHayomData": {"max_doc_words": 350000, "max_bullet_lines_ratio": 0.999, "dup_n_grams": {5: 0.7}},
    "wikipedia": {"max_doc_words": 550000, "max_non_alpha_words_ratio": 0.4},
}


class Limits:
    """Threshold lookups as columns: a literal map by source, else the default.

    The map holds what a configuration file holds, so it is part of the plan and
    no join is needed.
    """

    def __init__(self, defaults: Thresholds, overrides: Mapping[str, Mapping[str, Any]], source: Column | None):
        self.defaults = defaults
        self.overrides = {s: _normalise(o) for s, o in overrides.items()}
        self.source = source

    def _pick(self, default: Any, by_source: Mapping[str, Any]) -> Column:
        base = F.lit(None if default is None else float(default)).cast("double")
        if self.source is None or not by_source:
            return base
        entries = [F.lit(x) for s, v in by_source.items() for x in (s, None if v is None else float(v))]
        known = F.create_map(*entries)
        hit = F.try_element_at(known, self.source)
        # A null entry switches the gate off, so absence is told apart by the key.
        return F.when(self.source.isin(list(by_source)), hit).otherwise(base)

    def __getattr__(self, name: str) -> Column:
        default = getattr(self.defaults, name)
        return self._pick(default, {s: o[name] for s, o in self.overrides.items() if name in o})

    def n_gram(self, table: str, n: int) -> Column:
        """Limit for n-grams of size n; null (off) for a source whose own list leaves n out."""
        own = {s: o[table].get(n) for s, o in self.overrides.items() if table in o}
        return self._pick(getattr(self.defaults, table).get(n), own)

    def sizes(self, table: str) -> list[int]:
        every = set(getattr(self.defaults, table))
        for o in self.overrides.values():
            every |= set(o.get(table, ()))
        return sorted(every)


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _repeated(items: Column) -> tuple[Column, Column]:
    """Elements and characters in repetitions of an earlier element."""
    distinct = F.array_distinct(items)
    chars = F.length(F.array_join(items, "")) - F.length(F.array_join(distinct, ""))
    return F.size(items) - F.size(distinct), chars


def _ellipses(text: Column, pattern: str) -> Column:
    """Matches of a pattern with an ellipsis; a regex decodes the text, the test for one does not."""
    some = text.contains("...") | text.contains("…")
    return F.when(some, count_matches(text, pattern)).when(text.isNotNull(), F.lit(0).cast("long"))


def base_counts(text: Column, t: Thresholds) -> dict[str, Column]:
    """Counts that several measures share; as columns of their own they are taken once."""
    stops = "|".join(re.escape(w) for w in t.stop_words)
    return {
        "n_words": word_count(text),
        # A match starts at the first character of the kind and takes the rest of the word.
        "n_real_words": count_matches(text, rf"[^\s{PUNCTUATION_CLASS}]\S*"),
        "newlines": F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))),
        "solid": F.regexp_extract_all(text, F.lit(r"(?md)^[^\S\n]*+\S[^\n]*"), F.lit(0)),
        "runs": F.split(text, r"\n+", -1),
        # Without an empty line there is one paragraph, which repeats nothing: its text is not needed.
        "paragraphs": F.when(text.contains("\n\n"), F.split(strip(text), r"\n{2,}", -1)).when(text.isNotNull(), F.array(F.lit(""))),
        "n_alpha_words": count_matches(text, r"\p{L}\S*"),
        "real_chars": F.length(F.regexp_replace(F.regexp_replace(text, rf"(?:^|\s)[{PUNCTUATION_CLASS}]+(?=\s|$)", ""), r"\s+", "")),
        "stop_words": F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?<!\S)(?:{stops})(?!\S)"), F.lit(0)))).cast("long") if stops else F.lit(0).cast("long"),
    }


def ratios(text: Column, base: Mapping[str, Column], t: Thresholds) -> dict[str, Column]:
    """Every per-document measure except the n-gram ones, from the text and its base counts."""
    n_words, newlines, solid, runs = base["n_words"], base["newlines"], base["solid"], base["runs"]
    n_lines = newlines + F.when(text.endswith("\n"), 0).otherwise(1)
    n_solid = F.size(solid)
    paragraphs = base["paragraphs"]
    dup_para, dup_para_chars = _repeated(paragraphs)
    dup_line, dup_line_chars = _repeated(runs)
    _, dup_solid_chars = _repeated(solid)
    # A search for line ends is cheaper than one for characters of a class.
    closed = count_matches(text, rf"\n(?<=[{re.escape(t.stop_characters)}]\n)") + F.right(text, F.lit(1)).isin(list(t.stop_characters)).cast("long")
    return {
        "n_words": n_words,
        "n_real_words": base["n_real_words"],
        "mean_word_length": share(base["real_chars"], base["n_real_words"]),
        "dup_para_frac": share(dup_para, F.size(paragraphs)),
        "dup_para_char_frac": share(dup_para_chars, F.length(text)),
        "dup_line_frac": share(dup_line, F.size(runs)),
        "dup_line_char_frac": share(dup_line_chars, F.length(text)),
        "solid_lines": n_solid.cast("long"),
        "line_punct_ratio": share(closed, n_solid),
        "short_line_ratio": share(
            count_matches(text, rf"(?md)^(?=[^\S\n]*+\S)[^\n]{{1,{t.short_line_length}}}$"), n_solid
        ),
        "char_dup_ratio": share(dup_solid_chars, F.length(text) - newlines),
        "list_ratio": share(newlines, n_words),
        "hash_ratio": share(F.length(text) - F.length(F.replace(text, F.lit("#"), F.lit(""))), n_words),
        "ellipsis_ratio": share(_ellipses(text, r"\.\.\.|…"), n_words),
        "bullet_ratio": share(count_matches(text, r"(?md)^[^\S\n]*+[•\-]"), n_lines),
        "ellipsis_line_ratio": share(_ellipses(text, r"(?md)(?:\.\.\.|…)[^\S\n]*$"), n_lines),
        "alpha_ratio": share(base["n_alpha_words"], n_words),
        "stop_words": base["stop_words"],
    }


def measures(text: Column, t: Thresholds) -> dict[str, Column]:
    return ratios(text, base_counts(text, t), t)


def n_grams(word_array: Column, n: int) -> Column:
    """Blank-joined n-grams of a word array; empty when there are fewer than n words."""
    count = F.greatest(F.size(word_array) - (n - 1), F.lit(0))
    grams = F.slice(word_array, F.lit(1), count)
    for offset in range(1, n):
        grams = F.zip_with(
            grams, F.slice(word_array, F.lit(offset + 1), count), lambda a, b: F.concat(a, F.lit(" "), b)
        )
    return grams


def top_n_gram_chars(word_array: Column, n: int) -> Column:
    """Count times length of the most frequent n-gram (the longest one among equals).

    Sorting puts equal n-grams side by side, so one pass over the runs is enough and
    a document's n-grams never leave its row.
    """
    start = F.struct(
        F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("chars")
    )

    def step(acc: Column, gram: Column) -> Column:
        run = F.when(acc["prev"] == gram, acc["run"] + 1).otherwise(F.lit(1))
        better = (run > acc["best"]) | ((run == acc["best"]) & (F.length(gram) > acc["chars"]))
        return F.struct(
            gram.alias("prev"),
            run.alias("run"),
            F.greatest(run, acc["best"]).alias("best"),
            F.when(better, F.length(gram)).otherwise(acc["chars"]).alias("chars"),
        )

    ordered = F.sort_array(n_grams(word_array, n))
    return F.aggregate(ordered, start, step, lambda acc: (acc["best"] * acc["chars"]).cast("long"))


_WORD = re.compile(r"\S+", re.ASCII)


@cache
def _kinds() -> np.ndarray:
    """Per code point: 1 for a letter, plus 2 for anything but a blank and ASCII punctuation."""
    table = np.full(sys.maxunicode + 1, 2, np.uint8)
    table[[ord(c) for c in " " + PUNCTUATION]] = 0
    table[np.fromiter(map(str.isalpha, map(chr, range(len(table)))), bool, len(table))] = 3
    return table


def _word_kinds(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Characters and kinds (``_kinds`` of any of its characters) of every word."""
    joined = b" ".join(words)
    if not joined:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    points = np.frombuffer((joined + b" ").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return ends - starts, np.bitwise_or.reduceat(_kinds()[points], starts)


WORD_COUNTS = ("n_words", "n_real_words", "real_chars", "n_alpha_words", "stop_words")


def all_word_counts(
    texts: Sequence[bytes], stop_words: tuple[str, ...], top_sizes: list[int], dup_sizes: list[int], with_grams: Sequence[bool] | None = None
) -> list[list[int]]:
    """Per text the counts of ``WORD_COUNTS`` and those of ``n_gram_counts``, from one split into words.

    Real words have a character other than ASCII punctuation, alphabetic ones a letter.  Words are numbered
    for all texts at once, each distinct word is looked at once.  Texts whose ``with_grams`` is false
    end after the first counts.
    """
    found: list[bytes] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found += (split := text.split())  # at ASCII whitespace only
        sizes[i] = len(split)
    seen = {w: i for i, w in enumerate(dict.fromkeys(found))}
    ids = np.fromiter(map(seen.__getitem__, found), dtype=np.int64, count=len(found))
    doc = np.repeat(np.arange(len(texts)), sizes)
    lengths, kinds = _word_kinds(seen)
    real = kinds >= 2
    stops = np.array(sorted(seen[w] for w in {w.encode() for w in stop_words} if w in seen), np.int64)
    at = np.flatnonzero(np.isin(ids, stops))
    pairs = np.unique(doc[at] * len(seen) + ids[at]) // max(len(seen), 1)

    def total(each: np.ndarray) -> np.ndarray:
        return np.bincount(doc, each[ids], len(texts)).astype(np.int64)

    counts = [sizes, total(real), total(np.where(real, lengths, 0)), total(kinds & 1), np.bincount(pairs, minlength=len(texts))]
    if with_grams is None:
        with_grams = [True] * len(texts)
    grams = n_gram_counts(ids, lengths, doc, sizes, np.array(with_grams, bool), top_sizes, dup_sizes)
    rows = np.column_stack([*counts, *grams]).tolist()
    return [row if g else row[: len(counts)] for row, g in zip(rows, with_grams)]


def n_gram_counts(
    ids: np.ndarray, word_lengths: np.ndarray, doc: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, top_sizes: list[int], dup_sizes: list[int]
) -> list[np.ndarray]:
    """Per top size: count times length of the most frequent n-gram of each text (longest among equals).
    Per dup size: characters in n-grams seen before in the text, left to right, jumping over each hit.

    ``ids`` are the words of the texts ``doc``, which hold ``sizes`` words each; others than ``wanted`` give 0.
    """
    tops, dups = ({n: np.zeros(len(sizes), np.int64) for n in ns} for ns in (top_sizes, dup_sizes))
    n_distinct = len(word_lengths)
    ends = np.concatenate([[0], np.cumsum(word_lengths[ids])])
    stop = np.cumsum(sizes)
    # An n-gram occurs again only where both (n-1)-grams in it do, so few places are left to number.
    places = np.flatnonzero(wanted[doc])
    codes = doc[places]
    for n in range(1, min(int(sizes.max(initial=0)), max([*tops, *dups], default=0)) + 1):
        if n > 1:
            follows = np.flatnonzero((np.diff(places) == 1) & (doc[places[:-1]] == doc[places[1:]]))
            places, codes = places[follows], codes[follows]
        # Numbered exactly: text or (n-1)-gram number and last word decide it.
        _, codes, counts = np.unique(codes * n_distinct + ids[places + n - 1], return_inverse=True, return_counts=True)
        times = counts[codes]
        if n in tops:
            best, longest = np.ones(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.maximum.at(best, doc[places], times)
            whole = np.flatnonzero(wanted[doc] & (best[doc] == 1) & (np.arange(len(doc)) + n <= stop[doc]))
            most = places[(times > 1) & (times == best[doc[places]])]
            for part in (whole, most):
                np.maximum.at(longest, doc[part], ends[part + n] - ends[part])
            tops[n] = np.where(wanted & (sizes >= n), best * (longest + n - 1), 0)
        again = times > 1
        places, codes = places[again], codes[again]
        if n in dups:
            visited, free = set(), 0
            spans = ends[places + n] - ends[places]
            for at, code, of, length in zip(places.tolist(), codes.tolist(), doc[places].tolist(), spans.tolist()):
                if at < free:
                    continue
                if code in visited:
                    dups[n][of] += length
                    free = at + n
                else:
                    visited.add(code)
    return [*tops.values(), *dups.values()]


def n_gram_chars(text: str, top_sizes: list[int], dup_sizes: list[int]) -> list[int]:
    """The counts of ``n_gram_counts`` of one text."""
    return word_counts(text, (), top_sizes, dup_sizes)[len(WORD_COUNTS):]


def word_counts(text: str, stop_words: tuple[str, ...], top_sizes: list[int], dup_sizes: list[int]) -> list[int]:
    """``all_word_counts`` of one text."""
    return all_word_counts([text.encode()], stop_words, top_sizes, dup_sizes)[0]


def word_scan(stop_words: tuple[str, ...], top_sizes: list[int], dup_sizes: list[int], rows: int = 64):
    """Arrow UDF ``text as binary, with_grams -> array`` of ``all_word_counts``, for ``rows`` texts at a time; null stays null."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def scan(texts: pd.Series, with_grams: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(texts), rows):
            part, grams = texts.iloc[at : at + rows].tolist(), with_grams.iloc[at : at + rows].tolist()
            counts = all_word_counts([v or b"" for v in part], stop_words, top_sizes, dup_sizes, grams)
            out += [None if v is None else row for v, row in zip(part, counts)]
        return pd.Series(out, dtype=object)

    return scan


def n_gram_numbers(ids: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each size one number per place, equal where the n-grams that begin there are equal.

    Numbers of runs of 1, 2, 4, ... words come from pairs of half their length; an n-gram is two runs
    that overlap.  No hashing, so equal numbers mean equal words.
    """
    halves, out = {1: ids}, {}
    for n in sorted(set(sizes)):
        if n > len(ids):
            out[n] = ids[:0]
            continue
        size = 1 << (n.bit_length() - 1)
        while size not in halves:
            last = max(halves)
            halves[2 * last] = _pair_numbers(halves[last][: len(ids) - 2 * last + 1], halves[last][last:])
        out[n] = halves[size] if n == size else _pair_numbers(halves[size][: len(ids) - n + 1], halves[size][n - size :])
    return out


def _pair_numbers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int64)


def repeated_n_gram_chars(text: str, sizes: list[int]) -> list[int]:
    """Per size: characters of the words that lie in an n-gram which occurs earlier in the text too.

    Every later occurrence counts, whatever stands before it, and every word once: a statement about
    the text alone, where ``n_gram_chars`` depends on the order in which hits are jumped over.
    """
    found = _WORD.findall(text)
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in found), dtype=np.int64, count=len(found))
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    numbers, out = n_gram_numbers(ids, sizes), []
    for n in sizes:
        later = np.ones(len(numbers[n]), bool)
        later[np.unique(numbers[n], return_index=True)[1]] = False
        steps = np.zeros(len(found) + 1, np.int64)
        steps[: len(later)] += later
        steps[n : n + len(later)] -= later
        out.append(int(lengths[np.cumsum(steps[:-1]) > 0].sum()))
    return out


def repeated_n_gram_scan(sizes: list[int]):
    """Arrow UDF ``text -> array`` of ``repeated_n_gram_chars``; null stays null."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda v: None if v is None else repeated_n_gram_chars(v, sizes))

    return scan


def n_gram_scan(top_sizes: list[int], dup_sizes: list[int]):
    """``text -> array`` of ``n_gram_counts``: the top sizes first, then the dup sizes; null stays null."""
    scan = word_scan((), top_sizes, dup_sizes)

    def grams(text: Column | str) -> Column:
        c = F.col(text) if isinstance(text, str) else text
        return F.slice(scan(c.cast("binary"), F.lit(True)), len(WORD_COUNTS) + 1, len(top_sizes) + len(dup_sizes))

    return grams


def _first(*checks: tuple[Column, str]) -> Column:
    """Name of the first check that holds."""
    out = F.when(checks[0][0], F.lit(checks[0][1]))
    for condition, reason in checks[1:]:
        out = out.when(condition, F.lit(reason))
    return out


def annotate_quality(
    df: DataFrame,
    thresholds: Thresholds | None = None,
    overrides: Mapping[str, Mapping[str, Any]] | None = None,
    text_col: str = "text",
    source_col: str | None = "source",
    keep_measures: bool = False,
) -> DataFrame:
    """Add ``filter_reason`` and ``filter_group`` (null for kept documents) and ``n_words``.

    Order of the gates: short documents, repetition, line shape, word statistics.
    N-gram work is done only for documents that pass what comes before it.
    """
    t = thresholds or Thresholds()
    limit = Limits(t, DEFAULT_OVERRIDES if overrides is None else overrides, F.col(source_col) if source_col else None)
    text = F.col(text_col)
    base = base_counts(text, t)
    # Counts over words come from the scan that numbers them; a stop word of several words needs the regex.
    scanned = [k for k in WORD_COUNTS if k != "stop_words" or all(_WORD.fullmatch(w) for w in t.stop_words)]
    out = df.withColumns({f"_b_{k}": c for k, c in base.items() if k not in scanned})
    derived = ratios(text, {k: F.col(f"_b_{k}") for k in base}, t)
    m = {k: F.col(f"_m_{k}") for k in derived}
    repeats = [
        (m["dup_para_frac"] > limit.dup_para_frac, "dup_para_frac"),
        (m["dup_para_char_frac"] > limit.dup_para_char_frac, "dup_para_char_frac"),
        (m["dup_line_frac"] > limit.dup_line_frac, "dup_line_frac"),
        (m["dup_line_char_frac"] > limit.dup_line_char_frac, "dup_line_char_frac"),
    ]
    out = out.withColumns({f"_m_{name}": derived[name] for _, name in repeats})
    out = out.withColumn("_repeats", _first(*repeats))
    # Texts go to Python once, where words are numbered: for counts over words, for the
    # order-dependent scan and the short n-grams on its way.
    top_sizes, dup_sizes = limit.sizes("top_n_grams"), limit.sizes("dup_n_grams")
    out = out.withColumn("_words", word_scan(t.stop_words, top_sizes, dup_sizes)(text.cast("binary"), F.col("_repeats").isNull()))
    out = out.withColumns({f"_b_{k}": F.get("_words", F.lit(i)) for i, k in enumerate(WORD_COUNTS) if k in scanned})
    out = out.withColumns({f"_m_{k}": c for k, c in derived.items() if f"_m_{k}" not in out.columns})
    early = F.when(m["n_real_words"] < limit.min_doc_words, "gopher_short_doc").otherwise(F.col("_repeats"))
    out = out.withColumn("_early", early)
    top_share = {n: F.col(f"_m_top_{n}_gram") for n in top_sizes}
    dup_share = {n: F.col(f"_m_dup_{n}_gram") for n in dup_sizes}
    names = [f"_m_top_{n}_gram" for n in top_sizes] + [f"_m_dup_{n}_gram" for n in dup_sizes]
    grams = [F.when(F.col("_early").isNull(), F.get("_words", F.lit(len(WORD_COUNTS) + i))) for i in range(len(names))]
    out = out.withColumns({name: share(c, F.length(text)) for name, c in zip(names, grams)})
    repetition = F.coalesce(
        F.col("_early"),
        *[F.when(top_share[n] > limit.n_gram("top_n_grams", n), f"top_{n}_gram") for n in top_sizes],
        *[F.when(dup_share[n] > limit.n_gram("dup_n_grams", n), f"duplicated_{n}_n_grams") for n in dup_sizes],
    )
    lines_low = (m["line_punct_ratio"] < limit.line_punct_thr) & ~(
        (m["line_punct_ratio"] == 0) & F.lit(t.line_punct_exclude_zero)
    )
    late = _first(
        (m["solid_lines"] == 0, "empty"),
        (lines_low, "line_punct_ratio"),
        (m["short_line_ratio"] > limit.short_line_thr, "short_line_ratio"),
        (m["char_dup_ratio"] > limit.char_duplicates_ratio, "char_dup_ratio"),
        (m["list_ratio"] > limit.new_line_ratio, "list_ratio"),
        (m["n_real_words"] > limit.max_doc_words, "gopher_long_doc"),
        (m["mean_word_length"] < limit.min_avg_word_length, "gopher_below_avg_threshold"),
        (m["mean_word_length"] > limit.max_avg_word_length, "gopher_above_avg_threshold"),
        (m["hash_ratio"] > limit.max_symbol_word_ratio, "gopher_too_many_hashes"),
        (m["ellipsis_ratio"] > limit.max_symbol_word_ratio, "gopher_too_many_ellipsis"),
        (m["bullet_ratio"] > limit.max_bullet_lines_ratio, "gopher_too_many_bullets"),
        (m["ellipsis_line_ratio"] > limit.max_ellipsis_lines_ratio, "gopher_too_many_end_ellipsis"),
        (m["alpha_ratio"] < limit.max_non_alpha_words_ratio, "gopher_below_alpha_threshold"),
        ((limit.min_stop_words > 0) & (m["stop_words"] < limit.min_stop_words), "gopher_enough_stop_words"),
    )
    out = pin(out, "filter_reason", F.coalesce(repetition, late))
    out = out.withColumn("filter_group", reason_group(F.col("filter_reason")))
    out = out.withColumn("n_words", F.col("_m_n_words"))
    internal = [c for c in out.columns if c in ("_early", "_repeats", "_words") or c.startswith(("_m_", "_b_"))]
    if not keep_measures:
        return out.drop(*internal)
    out = out.drop("_early", "_repeats", "_words", "_m_n_words", *[c for c in internal if c.startswith("_b_")])
    return out.withColumnsRenamed({c: c[3:] for c in out.columns if c.startswith("_m_")})


def reason_group(reason: Column) -> Column:
    return (
        F.when(reason.isNull(), F.lit(None))
        .when(reason == "gopher_short_doc", "min_doc")
        .when(reason.rlike(r"^(?:dup_|top_|duplicated_)"), "repetition")
        .when(reason.startswith("gopher_"), "gopher_qual")
        .otherwise("fineweb")
    )


# Named extra measures; register your own with add_metric.
METRICS: dict[str, Any] = {}


def add_metric(name: str, fn) -> None:
    METRICS[name] = fn


def with_metrics(df: DataFrame, names: list[str] | None = None, text_col: str = "text") -> DataFrame:
    chosen = names or list(METRICS)
    return df.withColumns({n: METRICS[n](F.col(text_col)) for n in chosen})


def _register_builtin() -> None:
    from tamis.functions.text import single_char_share

    add_metric("single_char_percentage", single_char_share)
    add_metric("n_bytes", byte_count)


_register_builtin()
