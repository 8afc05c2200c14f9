"""Column functions on plain text.

A *word* is a maximal run of non-whitespace (``\\S+``, ASCII whitespace) everywhere
in this library; a *line* is what ``\\n`` separates.
"""

from __future__ import annotations

import unicodedata
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

WORD = r"\S+"

# ASCII punctuation, as in the usual C locale.
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
PUNCTUATION_CLASS = r"""!-/:-@\[-`{-~"""


def replace_literal(c: Column, *pairs: tuple[str, str]) -> Column:
    """Plain (non-regex) replacements, applied left to right."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, c)


def count_matches(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def word_count(c: Column) -> Column:
    return count_matches(c, WORD)


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def byte_count(c: Column) -> Column:
    return F.octet_length(c).cast("long")


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def strip(c: Column) -> Column:
    """Trim every kind of whitespace; SQL ``trim`` removes blanks only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def preview(c: Column, limit: int = 200) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)


def sheet_safe(c: Column, limit: int = 32767) -> Column:
    """Drop characters a spreadsheet cell refuses and cut to its length limit."""
    kept = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\uFEFF\uFFFE\uFFFF]", "")
    return F.substring(kept, 1, limit)


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r'[<>:"|?*]', "_"), r"[. ]+$", "")


def unescape_literals(c: Column) -> Column:
    r"""Turn the two-character sequences ``\n \" \\ \t \r`` into what they stand for."""
    return replace_literal(
        c, ("\\n", "\n"), ('\\"', '"'), ("\\\\", "\\"), ("\\t", "\t"), ("\\r", "\r")
    )


def flatten_for_training(c: Column) -> Column:
    """One-line form of a text: unescape, fold all whitespace to single blanks, strip."""
    unescaped = replace_literal(
        c,
        ('\\"', '"'), ("\\'", "'"), ("\\\\", "\\"),
        ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"),
        ("\\n", " "), ("\\t", " "), ("\\r", " "),
    )
    return strip(F.regexp_replace(unescaped, r"\s+", " "))


def edit_distance(a: Column, b: Column, bounds: tuple[int, ...] = (32, 512, 8192)) -> Column:
    """Levenshtein distance; bands of growing width are tried first, so alike texts of any length are cheap."""
    tries = [F.nullif(F.levenshtein(a, b, t), F.lit(-1)) for t in bounds]
    return F.coalesce(*tries, F.levenshtein(a, b))


def edit_distance_ratio(a: Column, b: Column) -> Column:
    """Levenshtein distance over the longer length; 0 for two empties, 1 for one empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when(longest == 0, F.lit(0.0))
        .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(1.0))
        .otherwise(edit_distance(a, b) / longest)
    )


def edit_script_counts(a: str, b: str, few: int = 64) -> tuple[int, int]:
    """Deletions and insertions of a shortest edit script that substitutes as often as a shortest one can.

    What the texts share at both ends is taken off.  Up to ``few`` edits, more for long texts, the furthest places that can
    be reached are followed; beyond, rows of a band around the diagonal are computed, and the band
    grows until the distance fits.  Memory is that of the texts and a band.
    """
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32) for t in (a, b))
    for _ in range(2):  # the start, then, turned round, the end
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        same = int(differ[0]) if len(differ) else n
        x, y = x[same:][::-1], y[same:][::-1]
    n, m = len(x), len(y)
    if not n or not m:
        return n, m
    x, y = np.ascontiguousarray(x), np.ascontiguousarray(y)
    indels = _indels_by_reach(x, y, few)
    width = max(16, 2 * few)
    while indels is None:
        indels = _indels_in_band(x, y, min(width, max(n, m)))
        width *= 4
    deletions = (indels + n - m) // 2
    return deletions, indels - deletions


def _indels_by_reach(x: np.ndarray, y: np.ndarray, most: int) -> int | None:
    """Insertions and deletions of a shortest script with the fewest of them, if it has at most ``most`` edits.

    For every number of edits and of insertions or deletions among them: the furthest place on each
    diagonal.  One edit more comes from the same diagonal (substitution) or from a neighbour.
    Beyond ``most`` edits it goes on while places are fewer than two for each row of a band.
    """
    n, m = len(x), len(y)
    target = m - n
    if abs(target) > most:
        return None
    left, right = memoryview(x), memoryview(y)

    def along(i: int, k: int) -> int:
        """The end of equal characters from place ``i`` of diagonal ``k``."""
        end, step = min(n, m - k), 32
        while i < end and left[i] == right[i + k]:
            stop = min(i + step, end)
            differ = x[i:stop] != y[i + k : stop + k]
            if differ.any():
                return i + int(differ.argmax())
            i, step = stop, step * 4
        return i

    before: list[dict[int, int]] = [{0: along(0, 0)}]
    places = 0
    for edits in count():
        places += (edits + 1) ** 2
        if edits > most and places > 2 * n:
            return None
        if edits:
            now: list[dict[int, int]] = []
            for indels in range(edits + 1):
                same = before[indels] if indels < edits else {}
                near = before[indels - 1] if indels else {}
                reach: dict[int, int] = {}
                for k in range(max(-indels, -n), min(indels, m) + 1):
                    i = max(same.get(k, -2) + 1, near.get(k - 1, -1), near.get(k + 1, -2) + 1)
                    if i >= 0:
                        reach[k] = along(min(i, n, m - k), k)
                now.append(reach)
            before = now
        for indels in range(abs(target), len(before)):
            if before[indels].get(target, -1) >= n:
                return indels


def _indels_in_band(x: np.ndarray, y: np.ndarray, width: int) -> int | None:
    """The same from the rows of a band of ``width`` diagonals to either side, if the distance is at most that."""
    n, m = len(x), len(y)
    if abs(m - n) > width:
        return None
    # A key packs (cost, -substitutions), so its minimum is a shortest script with the most
    # substitutions.  min(k[j], k[j - 1] + step) is a running minimum of k[j] - j * step.
    step = n + m + 1
    ramp = np.arange(2 * width + 1, dtype=np.int64) * step
    far = np.int64(step) * (4 * step)
    padded = np.concatenate([np.full(width, -1, np.int32), y, np.full(n + width + 1, -1, np.int32)])
    row = ramp - width * step
    row[:width] = far
    for i in range(1, n + 1):
        new = row + np.where(padded[i - 1 : i + 2 * width] == x[i - 1], 0, step - 1)
        np.minimum(new[:-1], row[1:] + step, out=new[:-1])
        if i <= width:
            new[: width - i] = far
        row = np.minimum.accumulate(new - ramp) + ramp
    key = int(row[m - n + width])
    cost = -(-key // step)
    return cost - (cost * step - key) if cost <= width or width >= max(n, m) else None


_EDIT_SHARES = T.StructType(
    [T.StructField("deletions", T.DoubleType()), T.StructField("insertions", T.DoubleType())]
)


@F.pandas_udf(_EDIT_SHARES)
def edit_shares(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Deletions and insertions of a minimal edit script, over the longer length."""
    rows = []
    for left, right in zip(a, b):
        if left is None or right is None:
            rows.append((None, None))
            continue
        longest = max(len(left), len(right))
        d, i = edit_script_counts(left, right)
        rows.append((d / longest, i / longest) if longest else (0.0, 0.0))
    return pd.DataFrame(rows, columns=["deletions", "insertions"], dtype="float64")


@F.pandas_udf(T.StringType())
def compatibility_form(s: pd.Series) -> pd.Series:
    """Unicode NFKC; Catalyst has no such function."""
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def single_char_share(c: Column) -> Column:
    """Percentage of non-blank characters whose value occurs exactly once in the text.

    With the characters sorted, equal ones are neighbours; what survives deleting
    every run of two or more are the single ones.
    """
    solid = F.replace(c, F.lit(" "), F.lit(""))
    in_order = F.array_join(F.sort_array(F.split(solid, "")), "")
    singles = F.length(F.regexp_replace(in_order, r"(?s)(.)\1+", ""))
    return F.when(F.length(solid) > 0, singles / F.length(solid) * 100.0).otherwise(F.lit(0.0))


def title_line(c: Column) -> Column:
    return strip(F.substring_index(c, "\n", 1))


def matches_title(c: Column, title: str) -> Column:
    """``c`` starts with ``title`` as a whole word."""
    body = strip(c)
    rest = F.substring(body, len(title.strip()) + 1, 1)
    return body.startswith(title.strip()) & ((rest == "") | rest.rlike(r"[^\p{L}\p{N}_]"))


def char_diagnostics(c: Column) -> dict[str, Column]:
    return {
        "backslashes": count_matches(c, r"\\"),
        "quotes": count_matches(c, '"'),
        "escaped_quotes": count_matches(c, r'\\"'),
    }
