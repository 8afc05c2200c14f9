"""Text rewriting rules, composed into one Catalyst expression per column."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tamis.functions.text import count_matches

TABLE_OPEN = "<MARKDOWN_TABLE>"
TABLE_CLOSE = "</MARKDOWN_TABLE>"
TABLE_SPAN = f"(?s){TABLE_OPEN}.*?{TABLE_CLOSE}"


@dataclass(frozen=True)
class Rule:
    """One rewrite: a Java regex with its replacement, or any ``Column -> Column`` function.

    ``pattern`` is also what substitution counts are taken from, so a rule with a
    function may still carry one.  ``needs`` lists literals of which any match must
    contain one: texts without them skip the regex.
    """

    name: str
    pattern: str | None = None
    replacement: str = ""
    function: Callable[[Column], Column] | None = None
    protect_tables: bool = False
    needs: tuple[str, ...] = ()

    def guarded(self, c: Column) -> Column:
        """The rewrite behind a plain substring test.  Mentions ``c`` twice: give it a column."""
        if not self.needs:
            return self.rewrite(c)
        present = reduce(lambda a, b: a | b, [c.contains(x) for x in self.needs])
        return F.when(present, self.rewrite(c)).otherwise(c)

    def rewrite(self, c: Column) -> Column:
        if self.function is not None:
            return self.function(c)
        return F.regexp_replace(c, self.pattern, self.replacement)

    def __call__(self, c: Column) -> Column:
        return outside_spans(c, TABLE_SPAN, self.rewrite, TABLE_OPEN) if self.protect_tables else self.rewrite(c)

    def hits(self, c: Column) -> Column:
        """How many places the rule would touch."""
        if self.pattern is None:
            return (self(c) != c).cast("long")
        searched = F.regexp_replace(c, TABLE_SPAN, TABLE_OPEN + TABLE_CLOSE) if self.protect_tables else c
        return count_matches(searched, self.pattern)


def outside_spans(c: Column, span: str, fn: Callable[[Column], Column], marker: str) -> Column:
    """Apply ``fn`` between the matches of ``span``; the matches stay as they are.

    ``split`` drops the spans, so they are extracted once more and zipped back in.
    Texts without ``marker`` take the plain path, free of array work.
    """
    between = F.transform(F.split(c, span, -1), fn)
    kept = F.array_append(F.regexp_extract_all(c, F.lit(span), F.lit(0)), F.lit(""))
    woven = F.array_join(F.zip_with(between, kept, lambda a, b: F.concat(a, b)), "")
    return F.when(c.contains(marker), woven).otherwise(fn(c))


def _folded(rules: Sequence[Rule]) -> Callable[[Column], Column]:
    return lambda c: reduce(lambda acc, r: r.rewrite(acc), rules, c)


def apply_rules(c: Column, rules: Sequence[Rule]) -> Column:
    """Fold the rules left to right.

    Neighbouring protected rules share one split into table and text segments.  Rules
    whose function mentions its input several times multiply the work of all rules
    before them in one expression; use ``rewrite_column`` for those.
    """
    groups: list[tuple[bool, list[Rule]]] = []
    for rule in rules:
        if groups and groups[-1][0] == rule.protect_tables:
            groups[-1][1].append(rule)
        else:
            groups.append((rule.protect_tables, [rule]))
    for protected, members in groups:
        fold = _folded(members)
        c = outside_spans(c, TABLE_SPAN, fold, TABLE_OPEN) if protected else fold(c)
    return c


def rewrite_column(df: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    """Apply a rule set to a column, one projection per guarded rule.

    A regex turns the text into a Java string and back; a substring test on the bytes
    costs a fraction of that and spares it for most rules and texts.  Texts with
    protected tables take the folded form.
    """
    tabled = any(r.protect_tables for r in rules)
    work = "_work" if tabled else name
    out = df
    if tabled:
        out = out.withColumn(work, F.when(~F.col(name).contains(TABLE_OPEN), F.col(name)))
    for rule in rules:
        out = out.withColumn(work, rule.guarded(F.col(work)))
    if tabled:
        folded = F.when(F.col(name).contains(TABLE_OPEN), apply_rules(F.col(name), rules))
        out = out.withColumn(name, F.coalesce(F.col(work), folded)).drop(work)
    return out
