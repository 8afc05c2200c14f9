"""Rule sets for web text, books and OCR output.

Each rule does what its description promises: table regions are left alone, ``^``
and ``$`` are line anchors, and exempted addresses survive.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from tamis.functions.rules import Rule
from tamis.functions.text import compatibility_form, strip

# HTML tags that are dropped.
HTML_TAGS = (
    "html|head|body|style|script|title|meta|link|div|span|p|a|img|br|h[1-6]|ul|ol|li|table|thead|tbody|tr|th|td"
    "|form|input|button|label|select|option|textarea|strong|b|em|i|u|small|footer|header|nav|section|article"
    "|aside|main|figure|figcaption|hr"
)
# Patterns for personal data.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
IP_ADDRESS = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
PUBLIC_IP = r"\b(?!(?:127\.0\.0\.1|0\.0\.0\.0)\b)(?:\d{1,3}\.){3}\d{1,3}\b"
LOOPBACK = r"127(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]\d|\d)){3}\b"
SEPARATOR_LINE = r"(?md)^[\-=*_~•●■▪◆◦ \t]+$"


def fold_spaces(c: Column) -> Column:
    """Indents go down to a multiple of 4 (at most 16), inner runs to one blank, line ends to none."""
    c = F.regexp_replace(c, r"(?md) +$", "")
    c = F.regexp_replace(c, r"(?md)^( {16}) +", "$1")
    c = F.regexp_replace(c, r"(?md)^((?: {4})*) {1,3}(?! )", "$1")
    return F.regexp_replace(c, r"(?<=[^ \n]) {2,}", " ")


def _web(name: str, pattern: str | None = None, replacement: str = "", **kw) -> Rule:
    return Rule(name, pattern, replacement, protect_tables=True, **kw)


WEB_RULES = [
    _web("double_quote_entity", r"&quot;|&#34;", '"', needs=("&quot;", "&#34;")),
    _web("apostrophe_entity", r"&#39;", "'", needs=("&#39;",)),
    _web("style_block", r"<style[^>]*>[^<]*</style>", needs=("<style",)),
    _web("html_tag", rf"</?(?:{HTML_TAGS})\b[^>]*>", needs=("<",)),
    _web("blank_line", r"(?md)^[ \t]+$"),
    _web("carriage_return", r"\r\n?", "\n", needs=("\r",)),
    _web("newline_run", r"\n{4,}", "\n\n\n", needs=("\n\n\n\n",)),
    _web("spaces", r" {2,}|(?md) +$", function=fold_spaces, needs=("  ", " \n", "\n ")),
    _web("ip_address", PUBLIC_IP, "<IP>"),
    _web("email", EMAIL, "<EMAIL>", needs=("@",)),
    _web("separator_line", SEPARATOR_LINE),
    _web("vowel_points", r"[\u0591-\u05BD\u05BF-\u05C7]"),
    _web("no_break_space", r"\u00A0", " ", needs=("\u00A0",)),
    _web("direction_mark", r"[\u200E\u200F\u202A-\u202F]"),
    Rule("table_tag", r"</?MARKDOWN_TABLE>", needs=("MARKDOWN_TABLE",)),
]
WEB_RULES_BY_NAME = {r.name: r for r in WEB_RULES}

HTML_TO_TEXT = [
    Rule("style_block", r"(?s)<style[^>]*>.*?</style>"),
    Rule("html_tag", rf"</?(?:{HTML_TAGS})\b[^>]*>"),
    Rule("double_quote_entity", r"&quot;|&#34;", '"'),
    Rule("apostrophe_entity", r"&#39;", "'"),
]

# Fixed value: books carrying this credit line lose the line.
BOOK_CREDIT = "פרויקט בן־יהודה"

BOOK_RULES = [
    Rule("compatibility_form", function=compatibility_form),
    Rule("carriage_return", r"\r\n?", "\n"),
    Rule("strip", function=strip),
    Rule("nbsp_entity", r"&nbsp;?", " "),
    Rule("odd_characters", r"[\u200B-\u200F\u202A-\u202C\x00\f\u0013-\u0015\u0005\u0090]"),
    Rule("no_break_space", r"\u00A0", " "),
    Rule("line_edges", r"(?md)^[^\S\n]+|[^\S\n]+$"),
    Rule("paragraph_break", r"\n\n+", "\n\n"),
    Rule("space_run", r"  +", " "),
    Rule("vowel_points", r"[\u0597-\u05C7]"),
]


def repair_book_lines(c: Column, credit: str = BOOK_CREDIT) -> Column:
    """Undo doubled line breaks: k empty lines in a row become k - 1; credit lines go."""
    lines = F.transform(F.split(F.replace(c, F.lit("\r\n"), F.lit("\n")), "\n", -1), strip)
    kept = F.array_join(F.filter(lines, lambda x: ~x.contains(credit)), "\n")
    return F.regexp_replace(kept, "\n(\n+)", "$1")


def splice(text: str | None, at: Sequence[int], chars: Sequence[str | None]) -> str:
    """``text`` with ``chars`` at the places ``at`` of the original, those of one place in the given order."""
    if text is None:
        return ""
    places = np.minimum(np.asarray(at, dtype=np.int64), len(text))
    out, begin = [], 0
    for i in np.argsort(places, kind="stable").tolist():
        if chars[i] is not None:
            out += (text[begin : places[i]], chars[i])
        begin = places[i]
    return "".join([*out, text[begin:]])


@F.pandas_udf(T.StringType())
def _spliced(texts: pd.Series, at: pd.Series, chars: pd.Series) -> pd.Series:
    # One walk along each text: cutting pieces in SQL decodes it from the start for every piece.
    return pd.Series([None if a is None else splice(v, a, c) for v, a, c in zip(texts, at, chars)], dtype=object)


def insert_at(text: Column, insertions: Column) -> Column:
    """Insert characters at 0-based positions of the original text.

    ``insertions``: array of ``struct<char_index, char, should_ignore>``.  Positions
    are clamped to the text; the pieces between them are cut once and joined.
    """
    wanted = F.filter(insertions, lambda s: ~F.coalesce(s["should_ignore"], F.lit(False)))
    at = F.transform(wanted, lambda s: F.greatest(s["char_index"].cast("int"), F.lit(0)))
    return _spliced(F.when(insertions.isNotNull(), text), at, F.transform(wanted, lambda s: s["char"]))


def ocr_elements_to_text(c: Column) -> Column:
    """JSON list of ``{type, content}`` -> lines, tables wrapped; unreadable JSON gives null."""
    items = F.from_json(c, "array<struct<type:string,content:string>>")
    return F.concat(
        F.array_join(
            F.transform(
                items,
                lambda e: F.when(
                    e["type"] == "Table",
                    F.concat(F.lit("<MARKDOWN_TABLE>"), e["content"], F.lit("</MARKDOWN_TABLE>\n")),
                ).otherwise(F.concat(e["content"], F.lit("\n"))),
            ),
            "",
        ),
        F.lit("\n\n"),
    )


__all__ = [
    "BOOK_RULES", "EMAIL", "HTML_TAGS", "HTML_TO_TEXT", "IP_ADDRESS", "LOOPBACK", "PUBLIC_IP", "SEPARATOR_LINE",
    "WEB_RULES", "WEB_RULES_BY_NAME", "fold_spaces", "insert_at", "ocr_elements_to_text",
    "repair_book_lines",
]
