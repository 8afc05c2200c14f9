"""Wikitext to plain text, as Catalyst expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tamis.functions.cleaning import EMAIL, IP_ADDRESS, LOOPBACK
from tamis.functions.rules import Rule
from tamis.functions.text import flatten_for_training, strip

WIKI_TABLE = r"(?s)\{\|.*?\|\}"

# Characters whose 4-fold repetition makes a separator line.
SEPARATORS = "-=_~*#"
# Bullets that make a line empty when nothing else is on it.
BULLETS = "•●■◦▪◆"
# Attributes dropped from table markup.
TABLE_ATTRIBUTES = ["style", "cellspacing", "cellpadding", "class", "width", "height"]
# Media namespaces, in Hebrew and English.
MEDIA_NAMESPACES = ["קובץ", "File", "Image", "תמונה", "media", "מדיה"]
# Picture placement words.
PLACEMENT_WORDS = [
    "שמאל", "ימין", "מרכז", "ממוזער", "מוקטן", "מסגרת",
    "thumb", "thumbnail", "frame", "framed", "frameless",
    "left", "right", "center", "centre", "none", "upright", "border",
]
# Words that mark a parenthesis as a media caption.
MEDIA_TERMS = ["px", "ממוזער", "thumb", "frame", "שמאל", "ימין", "מרכז", "תמונה", "קובץ"]
# Picture parameters.
PICTURE_PARAMETERS = ["alt", "caption", "class", "link", "page", "lang"]
# Openings of a cross-reference.
SEE_HEBREW = ["ראו", "ראה"]
SEE_ENGLISH = ["see"]
# Openings of a redirect page.
REDIRECTS = ["#REDIRECT", "#הפניה"]
# Languages named in a foreign-spelling parenthesis.
FOREIGN_LANGUAGES = [
    "בגרמנית", "בהונגרית", "בערבית", "בכורדית", "באנגלית",
    "בצרפתית", "באיטלקית", "ברוסית", "ביוונית", "בלטינית",
]
# Words that make a line a heading even when it ends with a full stop.
HEADING_WORDS = [
    "היסטוריה", "ביוגרפיה", "רקע", "תולדות", "מוצא", "תרבות", "משפחתו", "ילדותו", "נעוריו", "התפתחות", "משימות",
]
# Name parts of information boxes, and of templates that are none.
INFOBOX_NAMES = [
    "אינפו", "infobox", "תיבת מידע", "מידע", "תיבה", "מנהיג", "אדם", "עיר",
    "מדינה", "ספר", "סרט", "חברה", "ארגון", "אוניברסיטה", "בניין",
]
NOT_INFOBOX_NAMES = ["ניווט", "nav", "citation", "cite", "ref", "הערה"]
LIST_HEADING = "## נושאים קשורים:"


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def _drop_lines(pattern: str, needs: tuple[str, ...]):
    """Remove whole lines whose stripped form matches ``pattern``; lines without any of ``needs`` skip the regexes."""

    def rewrite(c: Column) -> Column:
        def drop(line: Column) -> Column:
            return reduce(lambda a, b: a | b, [line.contains(x) for x in needs]) & strip(line).rlike(pattern)

        return F.array_join(F.filter(F.split(c, "\n", -1), lambda line: ~drop(line)), "\n")

    return rewrite


def shrink_space_runs(c: Column) -> Column:
    """Runs of blanks: a multiple of 4 stays (at most 16), anything else becomes one."""
    c = F.regexp_replace(c, r"(?<! )(?: {4}){5,}(?! )", " " * 16)
    return F.regexp_replace(c, r"(?<! )(?:(?: {4})* {2,3}|(?: {4})+ )(?! )", " ")


def _trim(c: Column) -> Column:
    """``strip`` by looking at the ends of the text alone.  Mentions ``c`` twice: give it a column.

    Before a line separator outside ASCII at the end, the regex of ``strip`` removes blanks too.
    """
    return F.when(F.right(c, F.lit(1)).isin("\u0085", "\u2028", "\u2029"), strip(c)).otherwise(F.btrim(c, F.lit(" \t\n\x0b\f\r")))


def _cells(row: Column) -> Column:
    """Cells of a table row: split at bars, picture sizes and one-character cells dropped."""
    trimmed = F.transform(F.split(row, r"\|\||\|", -1), strip)
    return F.filter(trimmed, lambda cell: (F.length(cell) > 1) & ~cell.rlike(r"^\d+px$"))


def _table_rows(table: Column) -> Column:
    inner = F.substring(table, F.lit(3), F.length(table) - 4)
    return F.transform(F.split(inner, r"\|-", -1), strip)


def _replace_tables(c: Column, render) -> Column:
    """Each wiki table becomes ``render(table)``; everything else stays."""
    between = F.split(c, WIKI_TABLE, -1)
    tables = F.transform(F.regexp_extract_all(c, F.lit(WIKI_TABLE), F.lit(0)), render)
    woven = F.array_join(F.zip_with(between, F.array_append(tables, F.lit("")), lambda a, b: F.concat(a, b)), "")
    return F.when(c.contains("{|"), woven).otherwise(c)


def tables_to_markdown(c: Column) -> Column:
    def render(table: Column) -> Column:
        def row_text(row: Column, i: Column) -> Column:
            cells = _cells(row)
            bar = F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
            rule = F.concat(F.lit("\n|"), F.array_join(F.transform(cells, lambda _: F.lit("---|")), ""))
            return F.when(F.size(cells) == 0, F.lit("")).when(i == 0, F.concat(bar, rule)).otherwise(bar)

        rows = F.transform(_table_rows(table), row_text)
        return F.array_join(F.filter(rows, lambda r: r != ""), "\n")

    return _replace_tables(c, render)


def tables_to_lists(c: Column) -> Column:
    """Tables as bullet lists (three cells or more) or as running text."""

    def render(table: Column) -> Column:
        rows = F.transform(
            _table_rows(table),
            lambda r: F.regexp_replace(r, r'(?:style|cellspacing|cellpadding)="[^"]*"|\|\s*\d+px', ""),
        )
        cells = F.flatten(F.transform(rows, _cells))
        bullets = F.concat(
            F.lit(LIST_HEADING + "\n"), F.array_join(F.transform(cells, lambda x: F.concat(F.lit("- "), x, F.lit("\n"))), "")
        )
        return F.when(F.size(cells) >= 3, bullets).otherwise(F.array_join(cells, " "))

    return _replace_tables(c, render)


def _heading(level: int) -> Rule:
    body = r"[ \t]*([^=\r\n]+?)[ \t]*"
    exact, more = "=" * level, "=" * level + "={0," + str(6 - level) + "}"
    pattern = rf"(?md)^(?:{exact}{body}{more}|{more}{body}{exact})[ \t]*$"
    return Rule(f"heading_{level}", pattern, "#" * level + " $1$2", needs=(exact,))


# ``== H ==`` -> ``## H``; the smaller side decides the level (2 to 6).
HEADINGS = [_heading(level) for level in range(6, 1, -1)]


def headings_to_markdown(c: Column) -> Column:
    return reduce(lambda text, rule: rule.rewrite(text), HEADINGS, c)


MASK_PERSONAL_DATA = [
    Rule("email", EMAIL, "[EMAIL_REMOVED]", needs=("@",)),
    Rule("ip_address", rf"(?=\d)\b(?!{LOOPBACK}){IP_ADDRESS}", "[IP_REMOVED]"),
]

# A single blank stays what it is.
BLANK_RUN = Rule("blank_run", r"[ \t]+", " ", function=lambda c: F.regexp_replace(c, r"[ \t]{2,}|\t", " "), needs=("  ", "\t"))

DROP_TEMPLATES = [Rule(f"template_pass_{i}", r"\{\{[^{}]*\}\}", needs=("{{",)) for i in range(1, 6)]

UNWRAP_MARKUP = DROP_TEMPLATES + [
    Rule("piped_link", r"\[\[([^|\]]+)\|([^\]]+)\]\]", "$2", needs=("[[",)),
    Rule("plain_link", r"\[\[([^\]]+)\]\]", "$1", needs=("[[",)),
    Rule("tag", r"<[^>]*>", needs=("<",)),
    Rule("double_comma", r",\s*,", ",", needs=(",",)),
    Rule("comma_before_bracket", r",\s*\]", "]", needs=("]",)),
    Rule("comma_after_bracket", r"\[\s*,", "[", needs=("[",)),
    BLANK_RUN,
    Rule("leading_comma", r"(?md)^\s*,\s*", needs=(",",)),
    Rule("trailing_comma", r"(?md)\s*,\s*$", needs=(",",)),
]

CITATIONS = [
    Rule("ref", r"(?is)<ref[^>]*>.*?</ref>", needs=("<",)),
    Rule("empty_ref", r"(?is)<ref[^>]*/>", needs=("<",)),
    Rule("cite", r"(?is)\{\{cite[^}]*\}\}", needs=("{{",)),
    Rule("note", r"(?isu)\{\{(?:צ-|הערה|מקור)[^}]*\}\}", needs=("{{",)),
]

_PLACED = _any(PLACEMENT_WORDS)
_PIXELS = ("px", "PX", "Px", "pX")

# A bar that closes one match opens the next, so it is looked at and not consumed.
MEDIA = [
    Rule("media_link", rf"(?isu)\[\[{_any(MEDIA_NAMESPACES)}:[^\]]*\]\]", needs=("[[",)),
    Rule("placement", rf"(?imdU)\|{_PLACED}\b[^|]*(?=\|)", needs=("|",)),
    Rule("leading_placement", rf"(?imdU)(?:^|\s){_PLACED}(?=\|)", needs=("|",)),
    Rule("trailing_placement", rf"(?imdU)\|{_PLACED}(?:$|\s)", "|", needs=("|",)),
    Rule("size", r"(?i)\b\d+px\b", needs=_PIXELS),
    Rule("boxed_size", r"(?i)\|\d+px(?:\||\b)", needs=_PIXELS),
    Rule("two_sided_size", r"(?i)\|?\b\d+x\d+px\b\|?", needs=_PIXELS),
    Rule("width_or_height", r"""(?i)(?:width|height)\s*=\s*["']?\d+["']?""", needs=("=",)),
    Rule("caption", rf"(?iu)\([^)]*{_any(MEDIA_TERMS)}[^)]*\)", needs=("(",)),
    Rule("parameter", rf"(?i)\|{_any(PICTURE_PARAMETERS)}\s*=[^|]*", needs=("|",)),
    Rule("see_hebrew", rf"(?iu){_any(SEE_HEBREW)} [A-Za-z\s,א-ת.:\-]+", needs=("ראו ", "ראה ")),
    Rule("see_english", rf"(?i){_any(SEE_ENGLISH)} [A-Za-z\s,.:\-]+"),
    Rule("see_also_line", r"(?imud)^\s*(?:(?:ראו גם|see also)\s*:*.*|ראה גם\s*:*\s*)$"),
    Rule("gallery", r"(?is)<gallery[^>]*>.*?</gallery>", needs=("<",)),
    Rule("gallery_template", r"(?is)\{\{gallery[^}]*\}\}", needs=("{{",)),
    Rule("image_map", r"(?is)<imagemap[^>]*>.*?</imagemap>", needs=("<",)),
    Rule("bar_pair", r"\|\s*\|", "|", needs=("|",)),
    Rule("leading_bar", r"(?md)^\|", needs=("|",)),
    Rule("trailing_bar", r"(?md)\|\s*$", needs=("|",)),
    Rule("blank_lines", r"\n\s*\n\s*\n", "\n\n"),
    Rule("newline_run", r"\n{4,}", "\n\n\n"),
    BLANK_RUN,
    Rule("line_start", r"(?md)^[ \t]+"),
    Rule("line_end", r"(?md)[ \t]+$"),
    Rule("punctuation_line", r"(?md)^\s*[,.;:]+\s*$"),
]

SEPARATOR_RUNS = tuple(ch * 4 for ch in SEPARATORS)
DROP_BULLET_LINES = Rule("bullet_line", function=_drop_lines(f"^[{BULLETS}]+$", tuple(BULLETS)), needs=tuple(BULLETS))
DROP_SEPARATOR_LINES = Rule(
    "separator_line", function=_drop_lines("^(?:" + "|".join(f"[{ch}]{{4,}}" for ch in SEPARATORS) + ")$", SEPARATOR_RUNS),
    needs=SEPARATOR_RUNS,
)
DROP_TABLE_ATTRIBUTES = Rule("table_attribute", rf'(?=[{"".join(sorted({a[0] for a in TABLE_ATTRIBUTES}))}]){_any(TABLE_ATTRIBUTES)}="[^"]*"', needs=("=\"",))

# Article cleaning in order; citations and media go before general markup.
ARTICLE_RULES: dict[str, list[Rule]] = {
    "html_escape_codes": [Rule("double_quote", r"&quot;|&#34;", '"', needs=("&quot;", "&#34;")), Rule("apostrophe", r"&#39;", "'", needs=("&#39;",))],
    "cr_and_3_newlines": [Rule("carriage_return", r"\r", needs=("\r",)), Rule("newline_run", r"\n{4,}", "\n\n\n")],
    "multiple_spaces": [Rule("space_run", r" {2,}", function=shrink_space_runs, needs=("  ",))],
    "start_end_white_space": [Rule("strip", function=_trim)],
    "PII": MASK_PERSONAL_DATA,
    "empty_line_with_bullet": [DROP_BULLET_LINES],
    "multiple_hyphens": [DROP_SEPARATOR_LINES],
    "CSS": [DROP_TABLE_ATTRIBUTES],
    "tables": [Rule("table", function=tables_to_markdown, needs=("{|",))],
    "wiki_citations": CITATIONS,
    "wiki_tags_and_media_descriptions": MEDIA,
    "wiki_markup": UNWRAP_MARKUP,
    "wiki_headers": HEADINGS,
}

# Short form used before training: tables as lists, leftovers dropped.
LEFTOVER_RULES = [
    Rule("table", function=tables_to_lists),
    Rule("template", r"\{\{[^}]*\}\}"),
    Rule("link", r"\[\[[^\]]*\]\]"),
    Rule("tag", r"<[^>]*>", needs=("<",)),
    Rule("placement_line", r"(?mud)^\s*(?:שמאל|ימין|מרכז|ממוזער)\|.*$"),
    *[Rule(f"foreign_{i}", rf"(?d)\({w}:.*?\)") for i, w in enumerate(FOREIGN_LANGUAGES)],
    Rule("see", r"ראו [A-Za-z\s,]+\."),
    Rule("newline_run", r"\n{3,}", "\n\n"),
    Rule("space_run", r" {2,}", " ", needs=("  ",)),
    Rule("heading_line", r"(?md)^\s*=+.*?=+\s*$"),
]


def is_redirect(c: Column) -> Column:
    body = strip(c)
    return body.startswith(REDIRECTS[0]) | body.startswith(REDIRECTS[1])


def mark_headings(c: Column, keywords: list[str] = HEADING_WORDS) -> Column:
    """A short line before a long one becomes a ``##`` heading."""
    stripped = F.transform(F.split(c, "\n", -1), strip)
    following = F.array_append(F.slice(stripped, F.lit(2), F.size(stripped)), F.lit(""))

    def mark(line: Column, after: Column) -> Column:
        heading = (
            (F.length(line) > 0)
            & (F.length(line) < 100)
            & (F.length(after) > 50)
            & (F.length(line) - F.length(F.replace(line, F.lit("."), F.lit(""))) <= 1)
            & (F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) <= 2)
            & (~line.endswith(".") | line.rlike("|".join(keywords)))
        )
        return F.when(heading, F.concat(F.lit("## "), line)).otherwise(line)

    return F.array_join(F.zip_with(stripped, following, mark), "\n")


def categories(c: Column, namespace: str = "קטגוריה") -> Column:
    found = F.regexp_extract_all(c, F.lit(rf"\[\[\s*{namespace}:([^\]|]*)"), F.lit(1))
    return F.filter(F.transform(found, strip), lambda x: x != "")


def summary(c: Column) -> Column:
    """First paragraph over 100 characters, cut to 500, on one line; '' when there is none."""
    long_ones = F.filter(F.transform(F.split(c, "\n\n", -1), strip), lambda p: F.length(p) > 100)
    return flatten_for_training(F.coalesce(F.substring(F.get(long_ones, F.lit(0)), 1, 500), F.lit("")))


def table_notes(c: Column) -> Column:
    """A note for each of the first three tables that is shorter than 1,000 characters."""
    first = F.slice(F.regexp_extract_all(c, F.lit(WIKI_TABLE), F.lit(0)), 1, 3)
    notes = F.transform(
        first,
        lambda t, i: F.when(
            F.length(t) < 1000, F.concat(F.lit("טבלה "), (i + 1).cast("string"), F.lit(": [מידע מטבלה]"))
        ),
    )
    return F.filter(notes, lambda n: n.isNotNull())


def infobox(c: Column) -> Column:
    """Up to 15 ``name: value`` pairs of the first information box, on one line."""
    # One level of nesting inside the box is enough to keep its parameters together.
    boxes = F.transform(
        F.regexp_extract_all(c, F.lit(r"(?s)\{\{((?:[^{}]|\{\{[^{}]*\}\})*)\}\}"), F.lit(1)),
        # Bars inside links and inner templates do not separate parameters.
        lambda t: F.regexp_replace(F.regexp_replace(t, r"\{\{[^{}]*\}\}", ""), r"\[\[([^\]|]*)\|?[^\]]*\]\]", "$1"),
    )

    def render(box: Column) -> Column:
        parts = F.split(box, r"\|", -1)
        name = strip(F.get(parts, F.lit(0)))
        pairs = F.transform(
            F.slice(parts, F.lit(2), F.size(parts)),
            lambda p: F.struct(
                strip(F.substring_index(p, "=", 1)).alias("k"),
                strip(F.regexp_replace(F.regexp_replace(p, r"(?s)^[^=]*=", ""), r"<[^>]*>", "")).alias("v"),
                p.contains("=").alias("named"),
            ),
        )
        kept = F.slice(
            F.filter(
                pairs,
                lambda p: p["named"] & (p["k"] != "") & ~p["k"].rlike(r"^\d+$") & F.length(p["v"]).between(3, 299),
            ),
            1,
            15,
        )
        text = F.concat(
            F.lit("תיבת מידע - "), name, F.lit(": "),
            F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit(": "), p["v"])), " "),
        )
        wanted = F.lower(name).rlike("|".join(INFOBOX_NAMES)) & ~F.lower(name).rlike("|".join(NOT_INFOBOX_NAMES))
        return F.when(wanted & (F.size(kept) > 0), text)

    rendered = F.filter(F.transform(boxes, render), lambda t: t.isNotNull())
    return flatten_for_training(F.coalesce(F.get(rendered, F.lit(0)), F.lit("")))


def quality_score(content: Column, n_categories: Column, infobox_text: Column, summary_text: Column) -> Column:
    length = F.length(content)
    score = (
        F.lit(30)
        + F.when(length > 3000, 30).when(length > 1500, 20).when(length > 500, 10).otherwise(0)
        + F.when(n_categories > 0, 15).otherwise(0)
        + F.when(n_categories > 2, 5).otherwise(0)
        + F.when(infobox_text != "", 15).otherwise(0)
        + F.when(F.length(summary_text) > 100, 5).otherwise(0)
    )
    return F.least(F.lit(100), score)


def quality_band(score: Column) -> Column:
    return F.when(score >= 80, "high").when(score >= 60, "medium").otherwise("low")
