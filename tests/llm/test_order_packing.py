"""Packing in order against the tokenizer, a quadratic program and checksums; odd rows."""

import random
import zlib
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tamis.llm.order_packing import HARD, Planner, Settings, Shift, best_cuts, candidates, pack_in_order
from tamis.llm.piece_encoder import PieceEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = Settings(capacity=64, long_sentence=16, step=4, run_ids=1000, open_windows=3, partition_ids=4000)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def texts_of_all_kinds():
    draw = random.Random(5)
    signs = "abcDEstrvml'' '.,!?\n\t0123éÀ×ßµª²½\xa0\x85-_\x00\x1c\"()"
    made = ["".join(draw.choice(signs) for _ in range(draw.randrange(60))) for _ in range(1500)]
    made += [chr(c) + "a" + chr(c) for c in range(256)]
    return made + ["a<|endoftext|>b", "שלום עולם. ok", "İstanbul ΣΑΣ Σ", "x" * 40 + " " + "y" * 17, "é ̈a", "!!'s don't 'tis we'll'", "", " "]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    texts = texts_of_all_kinds()
    for held in (500_000, 50):
        encoder = PieceEncoder(PATH, held=held)
        assert encoder.by_pieces
        for at in range(0, len(texts), 300):
            done = encoder.encode(texts[at : at + 300])
            upto = np.cumsum(done.counts)
            for text, a, b in zip(texts[at : at + 300], upto - done.counts, upto):
                assert done.ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_sentence_ends(tokenizer):
    for text in ("One two. Three four! 3.14 is\nnext \"Quoted.\" End", "שלום. One two. Three! Four"):
        done = PieceEncoder(PATH).encode([text])
        tokens = tokenizer.encode(text, add_special_tokens=False).tokens
        assert all(tokens[i - 1].strip("</w>")[-1] in ".!\"" or tokens[i - 1] == "is</w>" for i in done.ends if i < len(tokens))
        assert len([i for i in done.ends if i < len(tokens)]) == (4 if text[0] == "O" else 3)


def quadratic(places, penalties, capacity):
    """Least cost of each place by trying all windows."""
    best = [(0, 0)]
    for c in range(1, len(places)):
        tries = []
        for i in range(c):
            n = places[c] - places[i]
            if n <= capacity:
                pad = 0 if n & (n - 1) == 0 else capacity - n
                tries.append((best[i][0] + pad + penalties[c], best[i][1] + 1))
        best.append(min(tries))
    return best[-1]


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_the_cheapest(seed):
    draw = np.random.default_rng(seed)
    places = np.concatenate([[0], np.cumsum(draw.integers(1, 20, 200))])
    penalties = np.where(draw.random(201) < 0.2, 0, draw.integers(1, 9, 201))
    cuts = best_cuts(places, penalties, 64)
    cost, before = 0, 0
    for c in cuts:
        n = int(places[c] - places[before])
        assert 0 < n <= 64
        cost += (0 if n & (n - 1) == 0 else 64 - n) + int(penalties[c])
        before = c
    assert before == 200 and (cost, len(cuts)) == quadratic(places.tolist(), penalties.tolist(), 64)


def test_checksums_of_parts():
    shift, draw = Shift(), random.Random(1)
    for _ in range(50):
        a, b = draw.randbytes(draw.randrange(30)), draw.randbytes(draw.randrange(9000))
        joined = zlib.crc32(a + b) ^ int(shift(np.array([zlib.crc32(a)]), np.array([len(b)]))[0])
        assert joined == zlib.crc32(b)


def test_places_inside_long_sentences():
    places, inner = candidates(50, np.array([3, 40]), SMALL)
    assert places.tolist() == [3, 7, 11, 15, 19, 23, 27, 31, 35, 39, 40, 50] and places[inner].tolist() == [7, 11, 15, 19, 23, 27, 31, 35, 39]
    assert Settings().long_sentence < Settings().capacity < HARD


def rows_of(df, id_col="doc_id"):
    return [r.asDict() for r in df.collect()], id_col


def verify(rows, texts, tokenizer, capacity, id_col="doc_id"):
    """Pieces cover every document once and in order, sequences are gapless; returns their lengths."""
    want = {i: whole(tokenizer, t) for i, t in texts.items()}
    by_doc = {}
    for r in sorted(rows, key=lambda r: (str(r[id_col]), r["start"])):
        ids = want[r[id_col]]
        at = by_doc.get(r[id_col], 0)
        assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
        part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
        assert len(part) == 4 * r["length"] and zlib.crc32(part) == r["ids_crc32"]
        by_doc[r[id_col]] = at + r["length"]
    assert by_doc == {i: len(ids) for i, ids in want.items()}
    lengths = []
    for _, group in groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        lengths.append(at)
    return lengths


def prose(draw, n):
    return " ".join(draw.choice(["kalo", "mine", "tura", "so", "bade", "figo."]) for _ in range(n))


def test_documents_stay_in_order_with_little_padding(spark, docs, tokenizer):
    draw = random.Random(9)
    texts = [prose(draw, draw.randrange(1, 120)) for _ in range(300)] + [None, "", "word " * 900, "a. " * 4000]
    df = docs(texts).repartition(7)
    rows, _ = rows_of(pack_in_order(df, PATH, settings=SMALL))
    lengths = verify(rows, dict(enumerate(texts)), tokenizer, 64)
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert len(lengths) > 600 and order == sorted(order)
    lengths = verify(rows_of(pack_in_order(df, PATH))[0], dict(enumerate(texts)), tokenizer, 2048)
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths) < 0.002 * sum(lengths)


def test_runs_cost_hardly_more_than_one_plan(tokenizer):
    draw = np.random.default_rng(3)

    def cost(run):
        planner = Planner(Settings(capacity=64, sentence_cut=4, inner_cut=12, long_sentence=16, step=4, run_ids=run, open_windows=12), Shift())
        draw = np.random.default_rng(3)
        lengths = {}
        for i in range(400):
            n = int(draw.integers(5, 200))
            places, inner = candidates(n, np.cumsum(draw.integers(3, 15, 80)), planner.settings)
            planner.add(n, places, inner, np.zeros(len(places), np.int64))
            if planner.ready():
                found = planner.pieces(False)
                for w, n in zip(found["window"].tolist(), found["length"].tolist()):
                    lengths[w] = lengths.get(w, 0) + n
        found = planner.pieces(True)
        for w, n in zip(found["window"].tolist(), found["length"].tolist()):
            lengths[w] = lengths.get(w, 0) + n
        return sum(0 if n & (n - 1) == 0 else 64 - n for n in lengths.values()), sum(lengths.values())

    one, total = cost(10**9)
    many, same = cost(3000)
    assert same == total and many <= one + 0.002 * total


def test_large_and_null_ids_repeats_and_empty_tables(spark, docs, empty, tokenizer):
    ids = [2**53 + 1, None, 2**53 + 3, 7, 7, 7]
    texts = ["one two three.", None, "four five.", "same text", "same text", "other"]
    df = docs(texts, ids)
    rows, _ = rows_of(pack_in_order(df, PATH))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["doc_tokens"]) for r in rows if r["start"] == 0) == sorted(
        (i is None, i or 0, len(whole(tokenizer, t))) for i, t in zip(ids, texts)
    )
    named = spark.createDataFrame([("b", "one"), ("a", None), (None, "two")], "name string, text string")
    rows, _ = rows_of(pack_in_order(named, PATH, "name"))
    assert [r["name"] for r in sorted(rows, key=lambda r: r["offset"])] == [None, "a", "b"]
    assert pack_in_order(empty, PATH).count() == 0
    assert pack_in_order(docs([None, ""]), PATH, end_id=None).count() == 0
