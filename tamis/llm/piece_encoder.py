"""Token ids, and the places where sentences end, for a tokenizer that drops white space.

Texts of Latin-1 characters are cut into pieces by byte tables and looked up in a table of known
pieces, so the tokenizer itself sees every distinct piece once; other texts go through it whole.
Both ways give the ids of the whole text.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# The pre-tokenizer pattern that the byte tables stand for, and what it takes for a contraction.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
# Latin-1 code points by Unicode class.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0)
NUMBERS = (*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE)
OTHER_LETTERS = (0xAA, 0xB5, 0xBA)
SIGN, LETTER, NUMBER, SPACE = 0, 1, 2, 3

SENTENCE_END = re.compile(r"[.!?。！？][\"')\]]?\s+|[。！？]|\n+")


def _tables() -> tuple[bytes, bytes]:
    """Class and lower case of every Latin-1 code point, for ``bytes.translate``."""
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    for c in range(256):
        if c in SPACES:
            kind[c] = SPACE
        elif c in NUMBERS:
            kind[c] = NUMBER
        elif 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c in OTHER_LETTERS or (c >= 0xC0 and c not in (0xD7, 0xF7)):
            kind[c] = LETTER
        if 0x41 <= c <= 0x5A or (0xC0 <= c <= 0xDE and c != 0xD7):
            lower[c] = c + 32
    return kind.tobytes(), lower.tobytes()


KIND, LOWER = _tables()
ENDS = np.isin(np.arange(256), list(b".!?"))
CLOSES = np.isin(np.arange(256), list(b"\"')]"))
LINE_BREAK = 0x0A
# Byte-level tokenizers show a byte that is no printable character as one of the characters from 256 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


class Encoded:
    """``ids`` of some texts one after another, ``counts`` per text, and ``ends``: after how many ids a sentence ends."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, ends: np.ndarray):
        self.ids, self.counts, self.ends = ids, counts, ends


class PieceEncoder:
    """``held`` bounds the known pieces; beyond it they are forgotten and learnt anew."""

    def __init__(self, path: str, held: int = 800_000, table_bits: int = 21):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        shape = json.loads(self.whole.to_str())
        normal = [n.get("type") for n in (shape["normalizer"] or {}).get("normalizers", [])]
        first = ((shape["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.by_pieces = normal == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": PATTERN}
        self.merges = self.whole.model
        self.held, self.shift = held, np.uint64(64 - table_bits)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        size = 1 << 16
        # A row per piece: its first sixteen bytes, length and number of ids, where those begin.
        self.rows = np.zeros((size, 4), np.uint64)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift

    def _learn(self, pieces: list[bytes], low: np.ndarray, high: np.ndarray) -> None:
        """Encode new, distinct pieces and enter them into the tables."""
        tokenize = self.merges.tokenize
        shown = [p.decode() if p.isalnum() else p.decode("latin-1").encode().decode("latin-1").translate(SHOWN) for p in pieces]  # ASCII shows as itself
        found = [[t.id for t in tokenize(p)] for p in shown]
        ids = np.fromiter((i for own in found for i in own), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        at, n = len(self.known), len(pieces)
        while at + n > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        length = np.fromiter(map(len, pieces), np.int64, n)
        for i, column in enumerate((low, high, length << 32 | sizes, self.used + np.cumsum(sizes) - sizes)):
            self.rows[at : at + n, i] = column
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(pieces, range(at, at + n)))
        short = np.flatnonzero(length <= 16)
        slots = self._slot(low[short], high[short])
        free = self.slots[slots] < 0
        self.slots[slots[free]] = at + short[free]

    def _pieces(self, data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte of every piece."""
        new = np.empty(len(kind) + 1, bool)
        new[0] = new[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:-1])
        new[:-1] |= kind == NUMBER
        edge = np.flatnonzero(new)
        first, end = edge[:-1], edge[1:]
        word = kind[first] != SPACE
        first, end = first[word], end[word].copy()
        # An apostrophe alone before letters may be a contraction, which takes letters from the run after it.
        tick = np.flatnonzero((data[first] == 0x27) & (end - first == 1))
        tick = tick[tick + 1 < len(first)]
        tick = tick[(first[tick + 1] == end[tick]) & (kind[end[tick]] == LETTER)]
        if len(tick):
            first = first.copy()
            for i in tick.tolist():
                letters = data[first[i + 1] : min(end[i + 1], first[i + 1] + 2)].tobytes()
                taken = next((len(c) for c in CONTRACTIONS if letters.startswith(c)), 0)
                end[i] += taken
                first[i + 1] += taken
            some = end > first
            first, end = first[some], end[some]
        return first, end

    def _latin(self, texts: list[bytes]) -> Encoded:
        if len(self.known) > self.held:
            self.forget()
        # A blank between texts keeps their pieces apart; sixteen more let every load stay inside.
        raw = (b"\n".join(texts) + b"\n" + bytes(16)).translate(LOWER)
        data, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw[:-16].translate(KIND), np.uint8)
        first, end = self._pieces(data, kind)
        length = end - first
        loads = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
        low = loads[first] & MASKS[np.minimum(length, 8)]
        high = loads[first + 8] & MASKS[np.clip(length - 8, 0, 8)]
        at = self.slots[self._slot(low, high)]
        rows = self.rows[at]
        sure = (at >= 0) & (length <= 16) & (rows[:, 0] == low) & (rows[:, 1] == high) & (rows[:, 2] >> np.uint64(32) == length.astype(np.uint64))
        lost = np.flatnonzero(~sure)
        if len(lost):
            keys = [raw[a:b] for a, b in zip(first[lost].tolist(), end[lost].tolist())]
            new = {k: i for i, k in enumerate(keys) if k not in self.known}
            if new:
                which = lost[list(new.values())]
                self._learn(list(new), low[which], high[which])
            rows[lost] = self.rows[[self.known[k] for k in keys]]
        size = (rows[:, 2] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        ids = self.flat[np.repeat((rows[:, 3].astype(np.int64) - (after - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)]
        # A piece ends a sentence before white space if it closes with a full stop, or before a line break.
        last = data[end - 1]
        stops = ENDS[last] | (CLOSES[last] & (length > 1) & ENDS[data[np.maximum(end - 2, 0)]])
        stops &= kind[np.minimum(end, len(kind) - 1)] == SPACE
        before = np.searchsorted(first, np.flatnonzero(data[:-16] == LINE_BREAK)) - 1
        stops[before[before >= 0]] = True
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        upto = np.concatenate([[0], after])[np.searchsorted(first, begins)]
        return Encoded(ids, np.diff(upto), after[stops])

    def _any(self, text: str) -> Encoded:
        encoded = self.whole.encode(text, add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint32)
        starts = np.array([a for a, _ in encoded.offsets], np.int64)
        stops = np.array([m.end() for m in SENTENCE_END.finditer(text)], np.int64)
        # Characters of several ids share a place; all of them belong to what begins there.
        return Encoded(ids, np.array([len(ids)]), np.unique(np.searchsorted(starts, stops)))

    def encode(self, texts: list[str]) -> Encoded:
        """Ids and sentence ends of whole texts."""
        plain: list[tuple[int, bytes]] = []
        other: list[tuple[int, Encoded]] = []
        for i, text in enumerate(texts):
            try:
                if not self.by_pieces or "<|" in text:
                    raise ValueError
                plain.append((i, text.encode("latin-1")))
            except ValueError:
                other.append((i, self._any(text)))
        fast = self._latin([t for _, t in plain]) if plain else Encoded(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not other:
            return fast
        parts: dict[int, tuple[np.ndarray, np.ndarray]] = {i: (e.ids, e.ends) for i, e in other}
        upto = np.cumsum(fast.counts)
        cut = np.searchsorted(fast.ends, upto, "right")
        for (i, _), a, b, p, q in zip(plain, upto - fast.counts, upto, [0, *cut[:-1]], cut):
            parts[i] = fast.ids[a:b], fast.ends[p:q] - a
        counts = np.array([len(parts[i][0]) for i in range(len(texts))], np.int64)
        before = np.cumsum(counts) - counts
        return Encoded(
            np.concatenate([parts[i][0] for i in range(len(texts))]), counts, np.concatenate([parts[i][1] + before[i] for i in range(len(texts))]),
        )


_KEPT: dict[str, PieceEncoder] = {}


def kept_encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file, which keeps its pieces between tasks; one file at a time."""
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = PieceEncoder(path)
    return _KEPT[path]
