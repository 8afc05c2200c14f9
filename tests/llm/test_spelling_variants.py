"""Spelling variants against brute force; odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from tamis.llm.spelling_variants import Settings, near_pairs, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute(rows, settings=Settings()):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % settings.typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    words = {w: n for w, n in total.items() if len(w) >= settings.min_length and n >= settings.min_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= settings.dominance * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def result(df):
    return sorted([(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()], key=str)


def random_rows(seed, n, every):
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abcçéÿ÷") for _ in range(draw.randrange(5, 9))) for _ in range(40)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(40)):
            w = draw.choice(stems[: draw.choice([3, 10, 40])])
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1 :], w[::-1]])
            words.append(w.upper() if draw.random() < 0.2 and w.isascii() else w)
        rows.append((i * every, draw.choice([" ", "-", "1", "ł", "\n"]).join(words)))
    return rows


def test_equals_brute_force(docs):
    for seed, settings in ((1, Settings(typo_every=7, block_words=4)), (2, Settings(typo_every=2, min_length=5, groups=3, held_words=10)), (3, Settings())):
        rows = random_rows(seed, 250, 1)
        got = result(spelling_variants(docs([t for _, t in rows], [i for i, _ in rows]), settings=settings))
        assert len(got) > 30 and any(r[1] for r in got) and got == brute(rows, settings)


def test_chains_end_at_the_root(docs):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzz": 9}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    found = {r[0]: r for r in result(spelling_variants(docs([text], [3]), settings=Settings(typo_every=10**12)))}
    assert found["aaaaaa"] == ("aaaaaa", "aaaaab", "aaabbb", 5, 1, 25) and found["aaabbb"] == ("aaabbb", None, "aaabbb", 625, 1, None)
    assert found["zzzzzz"] == ("zzzzzz", None, "zzzzzz", 9, 0, None)


def test_ties_take_the_smaller_word(docs):
    text = " ".join(["abcdef"] * 5 + ["abcdeé"] * 30 + ["abcdez"] * 30)
    found = {r[0]: r for r in result(spelling_variants(docs([text]), settings=Settings(typo_every=10**12)))}
    assert found["abcdef"][1] == "abcdez" and found["abcdef"][4] == 2 and found["abcdez"][1] is None


def test_pairs_of_blocks_equal_all_pairs():
    draw = np.random.default_rng(4)
    for n, m in ((6, 6), (6, 7)):
        a = np.unique(draw.integers(97, 100, (120, n)).astype(np.uint8), axis=0)
        b = np.unique(draw.integers(97, 100, (120, m)).astype(np.uint8), axis=0)
        i, j = near_pairs(a, b)
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if one_edit(a[x].tobytes().decode(), b[y].tobytes().decode())}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_odd_rows(spark, docs, empty):
    long = "letters " * 40_000 + "x" * 100_000
    rows = [(2**53 + 1, "tokens " * 6), (None, "tokens " * 6), (None, "tokens " * 6), (5, None), (6, ""), (7, long), (8, "łłłłłł " * 9)]
    got = result(spelling_variants(docs([t for _, t in rows], [i for i, _ in rows])))
    assert got == brute(rows) and {r[0] for r in got} >= {"tokens", "letters"}
    assert spelling_variants(empty).count() == 0
    named = spark.createDataFrame([("a:b", "repeat " * 5, 1)], "name string, body string, word int")
    assert result(spelling_variants(named, "name", "body"))[0][0].startswith("rep")
