"""Edit scripts against the quadratic table, and on long texts."""

import random
import time

import numpy as np
import pytest

from tamis.functions import text as tx


def table(a, b):
    """Deletions and insertions from the whole table of (cost, -substitutions)."""
    row = [(j, 0) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [(i, 0)]
        for j, y in enumerate(b, 1):
            new.append(min((row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1]), (row[j - 1][0] + (x != y), row[j - 1][1] - (x != y))))
        row = new
    cost, subs = row[-1]
    indels = cost + subs
    return (indels + len(a) - len(b)) // 2, (indels - len(a) + len(b)) // 2


def changed(draw, text, edits, letters="abc"):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out) + 1)
        out[at : at + draw.randrange(2)] = draw.choice(["", *letters])
    return "".join(out)


@pytest.mark.parametrize("few", [0, 2, 64])
def test_counts_equal_the_table(few):
    draw = random.Random(few)
    for letters in ("ab", "abcdefgé𝄞"):
        for _ in range(250):
            a = "".join(draw.choice(letters) for _ in range(draw.randrange(25)))
            b = changed(draw, a, draw.randrange(12), letters) if draw.random() < 0.6 else "".join(draw.choice(letters) for _ in range(draw.randrange(25)))
            assert tx.edit_script_counts(a, b, few) == table(a, b), (a, b)


def test_wide_bands_equal_the_table():
    draw = random.Random(3)
    a, b = ("".join(draw.choice("abcd") for _ in range(n)) for n in (260, 330))
    for few in (1, 8, 64):
        assert tx.edit_script_counts(a, b, few) == table(a, b)


def test_long_texts_with_few_edits_are_fast():
    draw = random.Random(4)
    a = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=120_000))
    out = list(a)
    for n, at in enumerate(sorted(draw.sample(range(1000, 119_000), 50), reverse=True)):
        out[at : at + (n % 3 > 0)] = ["", "#", "##"][n % 3] if n % 3 != 0 else "#"
    started = time.process_time()
    deletions, insertions = tx.edit_script_counts(a, "".join(out))
    assert time.process_time() - started < 1 and insertions - deletions == len(out := "".join(out)) - len(a)
    assert insertions + deletions <= 50


def test_band_of_long_unlike_texts_is_linear_in_memory():
    draw = np.random.default_rng(5)
    a = "".join(map(chr, draw.integers(97, 100, 3000)))
    assert tx.edit_script_counts(a, a[700:] + "xyz" * 100) == tx.edit_script_counts(a, a[700:] + "xyz" * 100, few=0)


def test_ratio_through_all_bands(spark):
    draw = random.Random(6)
    a = "".join(draw.choices("abcdefgh", k=3000))
    rows = [(a, changed(draw, a, n)) for n in (0, 3, 60, 2500)] + [("", ""), ("", "x"), (None, "x"), ("kitten", "sitting")]
    from pyspark.sql import functions as F

    got = spark.createDataFrame(rows, "a string, b string").select(
        tx.edit_distance(F.col("a"), F.col("b")).alias("d"), F.levenshtein("a", "b").alias("whole"), tx.edit_distance_ratio(F.col("a"), F.col("b")).alias("r"),
    ).collect()
    assert all(r["d"] == r["whole"] for r in got) and [r["r"] for r in got[4:]] == [0.0, 1.0, None, 3 / 7]


def test_long_texts_follow_furthest_places_beyond_the_few(monkeypatch):
    draw = random.Random(6)
    a = "".join(draw.choices("abcdefgh ", k=40_000))
    out = list(a)
    for at in draw.sample(range(100, 39_900), 12):
        out[at] = "#"
    b = "".join(out) + "!"
    wanted = tx.edit_script_counts(a, b, few=16)
    monkeypatch.setattr(tx, "_indels_in_band", None)  # would fail if it were asked
    assert tx.edit_script_counts(a, b, few=4) == wanted == (0, 1)
