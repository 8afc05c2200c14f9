"""Collocations against brute force; activation while shorter phrases are still counted; odd rows."""

import random
import re
from collections import Counter, defaultdict
from uuid import uuid4

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm.collocations import Settings, Words, first_per_group, frequent_phrases, mine_collocations, scored
from tamis.llm.frames import text_bytes

PIECE, WORD = re.compile("[.,;:!?\n\x0b\x0c\r]"), re.compile("[^ \t]+")


def counts_of(rows, longest=4):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        n[lang] += 0
        for piece in PIECE.split(folded):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    return n, f


def brute(rows, s):
    n, f = counts_of(rows, s.longest)
    candidates = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= s.least}
    by_lang = defaultdict(list)
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * c >= s.cover_percent * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), c in candidates.items()
        )
        if not inside:
            cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min(cuts)
            by_lang[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in by_lang.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[: s.best])
    )


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return lambda: str(tmp_path_factory.mktemp("collocations") / uuid4().hex)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, a int, phrase string").repartition(parts)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def random_rows(seed, n):
    draw = random.Random(seed)
    words = ["the", "of", "Of", "new", "york", "city", "é", "a'b", "word" * 6, "x" * 140, "ÿ̀"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(draw.randrange(60)):
            text += draw.choice(words[: draw.choice([3, 6, 11])]) + draw.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " new york city "])
        rows.append((draw.choice(["en", "en", "fr", None, "und"]), text))
    return rows


@pytest.mark.parametrize("seed, settings", [
    (1, Settings(least=20)), (2, Settings(least=8, shards=2, held_keys=50, best=30)), (3, Settings(least=5, shards=1, longest=3)), (4, Settings(least=3, shards=5, most_bits=4)),
])
def test_equals_brute_force(spark, folder, seed, settings):
    rows = random_rows(seed, 150)
    got = result(mine_collocations(table(spark, rows), folder(), settings=settings))
    assert len(got) > 20 and got == brute(rows, settings)


def test_longer_phrases_start_before_shorter_ones_are_done(spark, folder):
    settings, place = Settings(least=10, shards=4), folder()
    rows = [("en", "one two three four. " * 3) for _ in range(80)]
    docs = table(spark, rows, 8).select("lang", text_bytes("text").alias("text"))
    found, _ = frequent_phrases(docs, place, settings)
    assert {(r["k"], r["n"]) for r in found.collect()} == {(0, 960), *((k, 240) for k in (1, 2, 3, 4))} and found.count() == 11
    steps = spark.read.parquet(place + "/steps").select((F.col("b") / 2**40).cast("int").alias("k"), F.shiftright("b", 32).bitwiseAND(255).alias("since"))
    assert {r["k"]: r["since"] for r in steps.groupBy("k").agg(F.min("since").alias("since")).collect()} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3}


def test_a_phrase_of_one_shard_is_named(spark, folder):
    rows = [("en", "common words here")] * 60 + [("en", "odd one out " * 40)]
    got = result(mine_collocations(table(spark, rows, 1), folder(), settings=Settings(shards=4)))
    assert {r[2] for r in got} >= {"common words here"} and got == brute(rows, Settings())


def test_hashes_tell_words_apart():
    texts = [b"a b ab aab aaaaaaaa aaaaaaaaa " + b"a" * 127 + b" " + b"a" * 128 + b" " + b"a" * 129 + b" " + b"a" * 130 + b". " + b"b" * 5000]
    words = Words(texts * 2, [1, 2])
    assert len(np.unique(words.a)) == len(words.a) == 22 and len(np.unique(words.b >> np.uint64(32))) == 22
    again = Words([b"x, " + texts[0].upper()], [1])
    assert again.a[1:].tolist() == words.a[:11].tolist() and np.flatnonzero(again.begins).tolist() == [0, 1, 11]


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000_000_000
    rows = [("en", "a", 1, 9 * 10**18), ("en", "b", 1, 9 * 10**18), ("en", "a b", 2, big), ("en", "a b c", 3, big // 5 * 4 - 1), ("en", "c", 1, big), ("en", "b c", 2, big)]
    got = {r["phrase"]: (r["score"], r["l"]) for r in scored(spark.createDataFrame(rows, "lang string, phrase string, k int, n long"), Settings()).collect()}
    a = big // 5 * 4 - 1
    assert got["a b"] == (2_000_000 * big // (18 * 10**18), 9 * 10**18)
    assert got["a b c"] == min((2_000_000 * a // (9 * 10**18 + big), 9 * 10**18), (2_000_000 * a // (2 * big), big))


def test_first_per_group_in_rounds(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.hash("id").alias("v"))
    got = sorted((r["g"], r["rank"], r["v"]) for r in first_per_group(df, ["g"], ["v"], 7, wide=4).collect())
    by = defaultdict(list)
    for r in df.collect():
        by[r["g"]].append(r["v"])
    assert got == [(g, i + 1, v) for g in sorted(by) for i, v in enumerate(sorted(by[g])[:7])]


def test_odd_rows(spark, folder, empty):
    rows = [(None, "Big Cat " * 40), ("und", "big cat, " * 40), ("en", None), ("en", ""), ("de", ".,;:!?\n"), ("fr", "z" * 200_000), ("es", "mot mot " * 20_000), ("en", "big cat")]
    assert result(mine_collocations(table(spark, rows), folder())) == brute(rows, Settings())
    assert mine_collocations(empty, folder()).count() == 0
    assert mine_collocations(table(spark, [("en", None)]), folder()).count() == 0
