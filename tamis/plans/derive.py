"""Texts that both engines derive from the given tables, for rules whose triggers they lack.

Every constant is one SQL expression understood by Spark and DuckDB alike.
"""

# Web-like noise spread through each document: entities, tags, indents, carriage
# returns, separator lines, addresses, pointed Hebrew and direction marks.
DIRTY = (
    "concat('&quot;', replace(replace(replace(text, '. ', concat('.', chr(13), chr(10), '-----', chr(10), '          ')), "
    "', ', concat(',', chr(160), '     &#39;')), ' the ', ' <b>the</b> <style type=\"x\">p{}</style><article id=\"a\">'), "
    "chr(10), ' 127.0.0.1 8.8.8.8 0.0.0.0 a.b@mail.example.com ', chr(10), '   ', chr(10), chr(10), chr(10), chr(10), "
    "'•', chr(10), 'שָׁלוֹם־עוֹלָם', chr(8206), chr(8207), chr(8234), ' end  ')"
)
# Spark's chr() stops at 255, so marks beyond it are written out.
DIRTY = DIRTY.replace("chr(8206)", "'‎'").replace("chr(8207)", "'‏'").replace("chr(8234)", "'‪'")

# The same noise with table regions that cleaning must not touch.
TABLED = (
    "concat(replace(text, '. ', concat('.  ', '<MARKDOWN_TABLE>| a  | &quot;b&quot; |', chr(10), '-----', chr(10), "
    "'</MARKDOWN_TABLE>', '  &quot;')), '<MARKDOWN_TABLE>open  end')"
)

# Wikitext around each document: headings, links, templates, a table and references.
WIKI = (
    "concat('== ', source, ' ==', chr(10), '{{Infobox city|name=', source, '|area={{convert|', doc_id, '|km}}|1=x}}', chr(10), "
    "replace(replace(replace(text, 'the ', '[[The page|the]] '), 'er ', 'er<ref name=\"n\">note</ref> '), ', ', ', {{a {{b}} c}}, '), "
    "chr(10), '=== ', lang, ' ====', chr(10), '{| class=\"wikitable\" style=\"x\"', chr(10), '|-', chr(10), '| ', source, ' || ', lang, ' || 40px || z', "
    "chr(10), '|-', chr(10), '| ', doc_id, ' || two', chr(10), '|}', chr(10), '[[File:', source, '.jpg|thumb|left|caption]]', chr(10), "
    "'[[קטגוריה:', source, ']] [[קטגוריה:', lang, '|key]]', chr(10), '•', chr(10), '-----', chr(10), '----x', chr(10), "
    "'mail a.b@mail.example.com 127.5.6.7 8.8.8.8 999.1.1.1')"
)

# Text with escape sequences spelled out.
ESCAPED = "concat(replace(replace(text, ', ', concat(',', chr(92), 'n')), '. ', concat('. ', chr(92), chr(34))), chr(92), chr(92), chr(92), 't', '&quot;&#39;')"


def rx(expr: str, *steps: tuple[str, str]) -> str:
    """Nested DuckDB ``regexp_replace`` calls, all matches, left to right."""
    for pattern, replacement in steps:
        p, r = pattern.replace("'", "''"), replacement.replace("'", "''")
        expr = f"regexp_replace({expr}, '{p}', '{r}', 'g')"
    return expr


WORDS = r"regexp_extract_all({0}, '\S+')"
N_WORDS = r"len(regexp_extract_all({0}, '\S+'))"
STRIP = (r"^\s+", ""), (r"\s+$", "")
