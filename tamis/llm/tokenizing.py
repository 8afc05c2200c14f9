"""Token ids of whole texts by a public tokenizer file, each distinct piece encoded once per batch."""

from __future__ import annotations

import os
import re

import numpy as np

# A blank that ends a run of white space or the text: cutting before it could change the pieces.
RUN = re.compile(r"\s (?!\S)")
BLANK_RUN = re.compile(r" (?!\S)")
MARK = "\x00"


class Encoder:
    """Encodes texts with ``tokenizers`` in pieces between blanks and remembers the pieces' ids.

    ``joiner`` says what the tokenizer does with a blank: ``"drop"`` if white space only separates
    words, ``"lead"`` if a blank belongs to the word after it, ``None`` to encode whole texts.
    Texts in which a cut could matter (runs of white space under ``"lead"``, strings that look like
    special tokens) are encoded whole, so the ids are always those of the whole text.
    """

    def __init__(self, path: str, joiner: str | None = None, cache_pieces: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.joiner, self.limit = Tokenizer.from_file(path), joiner, cache_pieces
        ids = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = ids[0] if len(ids) == 1 else -1  # -1: pieces are encoded one by one
        self.clear()

    def clear(self) -> None:
        self.first: dict[str, int] = {}
        self.rest: dict[str, int] = self.first if self.joiner == "drop" else {}
        self.parts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.count = 0

    def _learn(self, words: set[str], known: dict[str, int], lead: str) -> None:
        new = [w for w in words if w not in known]
        if not new:
            return
        # Many pieces go into one text, each followed by a character that no merge takes in.
        # White space at the end, or an apostrophe at the start, would be read together with it.
        fits = lambda w: MARK not in w and not w[-2:].isspace() and not (lead + w).startswith("'")
        plain = [w for w in new if fits(w)]
        odd = [w for w in new if not fits(w)]
        end = f" {MARK} " if self.joiner == "drop" else MARK
        chunks = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        encode = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        marked = encode(["".join([lead + w + end for w in chunk]) for chunk in chunks])
        for chunk, ids in zip(chunks, marked):
            ids = np.array(ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(chunk):
                sizes = np.diff(ends, prepend=-1) - 1
                self._add(chunk, known, np.delete(ids, ends), sizes)
            else:
                odd += chunk
        if odd:
            ids = encode([lead + w for w in odd])
            self._add(odd, known, np.fromiter((i for x in ids for i in x), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _add(self, words: list[str], known: dict[str, int], ids: np.ndarray, sizes: np.ndarray) -> None:
        known.update(zip(words, range(self.count, self.count + len(words))))
        self.count += len(words)
        self.sizes.append(sizes)
        self.parts.append(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        if self.count > self.limit:
            self.clear()
        cut: list[list[str] | None] = []
        for text in texts:
            if self.joiner is None or "<|" in text or (self.joiner == "lead" and BLANK_RUN.search(text) and RUN.search(text)):
                cut.append(None)
            else:
                cut.append((text.replace("\n", " ") if self.joiner == "drop" else text).split(" "))
        lead = " " if self.joiner == "lead" else ""
        self._learn({p[0] for p in cut if p}, self.first, "")
        rest: set[str] = set()
        for p in cut:
            if p:
                rest.update(p)
        self._learn(rest, self.rest, lead)
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        self.sizes, self.parts = [sizes], [flat]
        starts = np.cumsum(sizes) - sizes
        out, lengths = [], np.zeros(len(texts), np.int64)
        for i, p in enumerate(cut):
            if p is None:
                ids = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            else:
                at = np.fromiter(map(self.rest.__getitem__, p), np.int64, len(p))
                at[0] = self.first[p[0]]
                n = sizes[at]
                ends = np.cumsum(n)
                ids = flat[np.repeat(starts[at] - (ends - n), n) + np.arange(ends[-1])]
            out.append(ids)
            lengths[i] = len(ids)
        return np.concatenate(out) if out else np.zeros(0, np.uint32), lengths


def shared_encoder(path: str, joiner: str | None) -> Encoder:
    """The worker's encoder for a file: a worker that runs several tasks keeps its pieces between them."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if (path, joiner) not in kept:
        kept.clear()  # one at a time, so memory stays bounded
        kept[path, joiner] = Encoder(path, joiner)
    return kept[path, joiner]
