"""Secrets in texts and in what is encoded inside them."""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tamis.llm.frames import written_id

# The kinds in order, their patterns, and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
PIECE = re.compile(r"[A-Za-z0-9]{16,}={0,2}")
# Lines of one code, the last of which may be shorter.
WRAPPED = re.compile(r"(?:[A-Za-z0-9+/_-]{16,}[\x20\t]*\r?\n[\x20\t]*)+[A-Za-z0-9+/_-]+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# First bytes of compressed data.
OPENERS = (
    (b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"BZh", bz2.BZ2Decompressor),
    (b"\xfd7zXZ\x00", lzma.LZMADecompressor), (b"\x78", zlib.decompressobj),
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """``kind, start, end`` in code points: leftmost non-overlapping matches of each kind, short ones dropped.

    A hex run counts from 32 characters, so only such runs are looked for.
    """
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


class Layer:
    """A decoded text; character i stands for ``starts[i]:ends[i]`` of the document.

    Where characters cannot be told apart (base64, compressed data) every one stands for ``whole``.
    """

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None, whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.whole = text, starts, ends, whole

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]

    def key(self) -> tuple:
        # Where the text stands matters too: equal text elsewhere is another secret.
        return self.text, self.whole or (tuple(self.starts) if self.starts is not None else None)


def _texts(data: bytes) -> Iterator[str]:
    """All that the bytes can be read as; what is no character is replaced, so nothing around it is lost."""
    yield data.decode("utf-8", "replace")
    if 0 in data:
        for code in ("utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"):
            yield data.decode(code, "replace")


def _clean(data: bytes) -> bool:
    try:
        return all(c.isprintable() or c in "\t\n\r" for c in data.decode("utf-8"))
    except UnicodeDecodeError:
        return False


def _unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every escape replaced; None where nothing decodes."""
    text, out, starts, ends, at, changed = layer.text, [], [], [], 0, False

    def copy(a: int, b: int) -> None:
        out.append(text[a:b])
        if not layer.whole:
            if layer.starts is None:
                starts.extend(range(a, b))
                ends.extend(range(a + 1, b + 1))
            else:
                starts.extend(layer.starts[a:b])
                ends.extend(layer.ends[a:b])

    for m in pattern.finditer(text):
        pieces = decode(m.group())
        if pieces is None:
            continue
        changed = True
        copy(at, m.start())
        for chars, a, b in pieces:
            out.append(chars)
            if not layer.whole:
                x, y = layer.span(m.start() + a, m.start() + b)
                starts.extend([x] * len(chars))
                ends.extend([y] * len(chars))
        at = m.end()
    if not changed:
        return None
    copy(at, len(text))
    return Layer("".join(out), whole=layer.whole) if layer.whole else Layer("".join(out), starts, ends)


def _percent(run: str) -> list[tuple[str, int, int]] | None:
    """Characters of a run of percent escapes, each with its place in the run."""
    data, pieces, at = bytes.fromhex(run.replace("%", "")), [], 0
    while at < len(data):
        for n in range(1, 5):
            try:
                pieces.append((data[at : at + n].decode("utf-8"), 3 * at, 3 * (at + n)))
                break
            except UnicodeDecodeError:
                continue
        else:  # not UTF-8: the byte stays as it is written
            n = 1
            pieces.append((run[3 * at : 3 * at + 3], 3 * at, 3 * at + 3))
        at += n
    return pieces if any(len(p[0]) == 1 for p in pieces) else None


def _unicode(escape: str) -> list[tuple[str, int, int]] | None:
    digits = escape.strip("\\uUx{}&#;")
    code = int(digits, 10) if escape.startswith("&#") and escape[2] != "x" else int(digits, 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return [(chr(code), 0, len(escape))]


def _bytes(run: str) -> bytes:
    """What a base64 run stands for; a last character that fills no byte is left out."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _opened(data: bytes) -> bytes | None:
    """The data decompressed, as far as it goes; None where it is not compressed."""
    made = next((f for magic, f in OPENERS if data.startswith(magic)), None)
    if made is None:
        return None
    out, magic = [], data[:2]
    while data.startswith(magic):  # members can follow each other
        opener = made()
        # In small steps, so that what comes before a damaged place is kept.
        for at in range(0, len(data), 64):
            try:
                out.append(opener.decompress(data[at : at + 64]))
            except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError):
                return b"".join(out) or None
            if opener.eof:
                data = opener.unused_data + data[at + 64 :]
                break
        else:
            break
    return b"".join(out) or None


def _layers(data: bytes) -> Iterator[bytes]:
    """The data and all that it unpacks to."""
    met: set[bytes] = set()  # data can unpack to itself
    while data is not None and data not in met:
        met.add(data)
        yield data
        data = _opened(data)


def _codes(run: str) -> Iterator[tuple[int, int, bytes]]:
    """``start, end, data`` of the codes that a run holds: a path or a name may run into a code.

    A code can begin at the run's start and after every sign.  Those that begin at the same place
    modulo 4 are ends of the same bytes, so one of them is decoded whole; another is given by
    itself where it is compressed or is the first that is readable to its end.
    """
    starts = [0] + [m.end() for m in re.finditer(r"[+/_-]", run) if len(run) - m.end() >= 16]
    for phase in range(4):
        own = [s for s in starts if s % 4 == phase]
        if not own:
            continue
        data, parts = _bytes(run[own[0] :]), [own[0]]
        if not _clean(data):
            for s in own[1:]:
                if any(data.startswith(magic, (s - own[0]) // 4 * 3) for magic, _ in OPENERS) and _opened(data[(s - own[0]) // 4 * 3 :]):
                    yield s, len(run), data[(s - own[0]) // 4 * 3 :]
            # The latest bytes that are no text; what begins before them cannot be readable to the end.
            bad = max((i for i, x in enumerate(data) if x < 32 and x not in (9, 10, 13)), default=-1)
            parts += next(([s] for s in own[1:] if (at := (s - own[0]) // 4 * 3) > bad and _clean(data[at:])), [])
        if len(parts) == 1:
            yield own[0], len(run), data
            continue
        at = (parts[1] - own[0]) // 4 * 3
        # A secret is ASCII: it goes over the border only if the byte before is.
        if data[at - 1] < 128 and (data[at - 1] >= 32 or data[at - 1] in (0, 9, 10, 13)):
            yield own[0], len(run), data
        else:
            yield own[0], parts[1], data[:at]
        yield parts[1], len(run), data[at:]
    if len(starts) > 1:
        for p in PIECE.finditer(run):  # a name may follow the code as well
            yield p.start(), p.end(), _bytes(p.group())


def _inner(layer: Layer) -> Iterator[Layer]:
    """The layers one decoding step further in."""
    text = layer.text
    if "%" in text and (found := _unescaped(layer, PERCENT, _percent)):
        yield found
    if ("\\" in text or "&#" in text) and (found := _unescaped(layer, UNICODE, _unicode)):
        yield found
    runs = [(m.group(), list(range(m.start(), m.end()))) for m in BASE64.finditer(text)]
    for m in WRAPPED.finditer(text) if "\n" in text else ():
        at = [i for line in LINE.finditer(m.group()) for i in range(m.start() + line.start(), m.start() + line.end())]
        runs.append(("".join([text[i] for i in at]), at))
    for run, at in runs:
        for a, b, data in _codes(run):
            for unpacked in _layers(data):
                for inner in _texts(unpacked):
                    yield Layer(inner, whole=layer.span(at[a], at[b - 1] + 1))


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the text itself, and those of all layers, in the text's code points.

    A worklist of layers: each is scanned, and its decodings join the list unless a layer of the
    same text in the same place was there before, so loops end.
    """
    base = base_spans(text)
    spans = set(base)
    todo, seen = [Layer(text)], set()
    while todo:
        layer = todo.pop()
        if layer.starts is not None or layer.whole:
            spans.update((kind, *layer.span(a, b)) for kind, a, b in base_spans(layer.text))
        for inner in _inner(layer):
            if (key := inner.key()) not in seen:
                seen.add(key)
                todo.append(inner)
    return base, sorted(spans, key=_order)


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by ``[<kind>]``; overlapping spans are one, named by the first."""
    out, at, end = [], 0, -1
    for kind, a, b in spans:
        if a >= end:
            out += [text[at:a], f"[{kind}]"]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, n_assign, n_access, n_hex, base_spans, spans, redacted``: secrets of each row.

    Counts and ``base_spans`` are of the text itself; ``spans`` add those found after undoing
    percent escapes, Unicode escapes, base64 and compression inside it, in any nesting, each as
    the place of the text that decodes to it.  Spans are written ``kind:start:end`` in code
    points, by start, then kind, joined by commas.  No shuffle: a row is scanned where it lies.

    A null text is empty and has no spans; ``redacted`` is then empty.  Every row gives one row.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, spans = find_spans(text)
                kinds = [s[0] for s in base]
                out.append((*(kinds.count(k) for k in KINDS), written(base), written(spans), redact(text, spans)))
            done = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_spans", "spans", "redacted"])
            done.insert(0, "id", batch["id"].to_numpy())
            yield done

    slim = df.select(written_id(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "id string, n_assign long, n_access long, n_hex long, base_spans string, spans string, redacted string"
    found = slim.mapInPandas(scan, schema)
    return found.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def redacted(text: Column) -> Column:
    """The text with every secret, nested ones included, replaced by ``[<kind>]``; null stays null."""

    @F.pandas_udf("string")
    def cover(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redact(t, find_spans(t)[1]))

    return cover(text)
