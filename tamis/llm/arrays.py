"""Word hashes, shingles and packed integer lists shared by the operators of this subpackage."""

from __future__ import annotations

import zlib

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; fewer words than ``n`` make one shingle, none make none."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    size = len(words) - n + 1
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total = total * MULTIPLIER + words[i : i + size]
    return mix(total)


class Powers:
    """``base ** i`` and its inverse modulo 2**64, extended on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BYTES = Powers(0x2545F4914F6CDD1D)


def hash_words(texts: list[bytes], seed: int = 0, block_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after another, and the number of words of each text.

    A word is a run of anything but ASCII white space.  Texts are taken in blocks, so that the
    temporary arrays stay small.
    """
    hashes, counts, at = [], [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < block_bytes):
            size += len(texts[end]) + 1
            end += 1
        # A blank stands before every text, so words and texts never touch.
        data = np.frombuffer(b" " + b" ".join(texts[at:end]) + b" ", np.uint8)
        starts = np.cumsum([1, *(len(t) + 1 for t in texts[at:end])])
        blank = BLANK[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        first, last = edge[::2], edge[1::2]
        up, down = BYTES.upto(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up, dtype=np.uint64, out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * down[first] + np.uint64(seed)))
        counts.append(np.diff(np.searchsorted(first, starts)))
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def windows_within(words: np.ndarray, counts: np.ndarray, n: int, powers: Powers, block_words: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``n`` words inside one text, text after text, and how many each text has."""
    sizes = np.maximum(counts - n + 1, 0)
    ends = np.cumsum(counts)
    out, at = [], 0
    while at < len(counts):
        begin = ends[at] - counts[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + block_words, "right")))
        found = window_hashes(words[begin : ends[stop - 1]], n, powers)
        # Runs that begin in the last n - 1 words of a text reach into the next one.
        place = np.arange(len(found)) + begin
        owner_end = np.repeat(ends[at:stop], counts[at:stop])[: len(found)]
        out.append(found[place + n <= owner_end])
        at = stop
    return (np.concatenate(out) if out else words[:0]), sizes


def window_hashes(words: np.ndarray, n: int, powers: Powers) -> np.ndarray:
    """Hash of every run of ``n`` words in time independent of ``n``; none for a shorter text."""
    if len(words) < n:
        return words[:0]
    up, down = powers.upto(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, dtype=np.uint64, out=sums[1:])
    size = len(words) - n + 1
    return mix((sums[n:] - sums[:size]) * down[:size])


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as gaps in byte planes, the high planes compressed."""
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0)).astype("<u8")
    planes = gaps.view(np.uint8).reshape(n, 8)
    used = max(1, -(-int(gaps.max()).bit_length() // 8))
    parts = [np.ascontiguousarray(planes[:, 0]).tobytes()]
    parts += [zlib.compress(np.ascontiguousarray(planes[:, i]).tobytes(), 1) for i in range(1, used)]
    head = np.array([n, used, *map(len, parts)], "<u4").tobytes()
    return head + b"".join(parts)


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    n, used = np.frombuffer(data, "<u4", 2)
    sizes = np.frombuffer(data, "<u4", int(used), 8)
    planes = np.zeros((int(n), 8), np.uint8)
    at = 8 + 4 * int(used)
    for i, size in enumerate(map(int, sizes)):
        part = data[at : at + size]
        planes[:, i] = np.frombuffer(part if i == 0 else zlib.decompress(part), np.uint8)
        at += size
    return np.cumsum(planes.view("<u8").ravel(), dtype=np.uint64)


def pack_bits(flags: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(flags).tobytes(), 1)


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=n).astype(bool)
