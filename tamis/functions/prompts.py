"""Prompts, tagged records and answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tamis.functions.text import replace_literal, strip

TAGGED = r"(?s)<(?!response_format\b)([^>]+)>(.*?)</\1>"

# Answer letters and digits by position.
ANSWER_INDEX = {"A": 0, "B": 1, "C": 2, "D": 3, "1": 0, "2": 1, "3": 2, "4": 3, "0": 0}
# Answer letters in Hebrew.
HEBREW_LABELS = {"A": "א", "B": "ב", "C": "ג", "D": "ד", "E": "ה", "1": "1", "2": "2", "3": "3", "4": "4"}
# Cause and effect in Hebrew, and the words that connect them.
CAUSE_EFFECT_LABELS = {"cause": "סיבה", "effect": "תוצאה"}
CONNECTORS = {"en": {"cause": "because", "effect": "therefore"}, "he": {"cause": "כי", "effect": "לכן"}}
# Prompt wording.
HEBREW_INSTRUCTION = "להלן שאלות רב-ברירה (עם תשובות)\n\n"
COPA_INSTRUCTION = "ענה על השאלות הבאות על ידי בחירת האות המתאימה (A או B).\n"
ENGLISH_INSTRUCTION = "The following are multiple choice questions (with answers) about  {}.\n\n"
STOP_SEQUENCE = "שאלה:"
INVALID_ANSWER = "[invalid]"


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def render_tags(fields: list[str], skip: tuple[str, ...] = ("translation_status",)) -> Column:
    """Record columns as ``<name>value</name>`` lines."""
    parts = [F.concat(F.lit(f"<{f}>"), F.coalesce(F.col(f).cast("string"), F.lit("None")), F.lit(f"</{f}>")) for f in fields if f not in skip]
    return F.array_join(F.array(*parts), "\n")


def parse_tags(c: Column) -> Column:
    """``<name>value</name>`` pairs as a map; a repeated name keeps its last value."""
    names = F.regexp_extract_all(c, F.lit(TAGGED), F.lit(1))
    values = F.transform(F.regexp_extract_all(c, F.lit(TAGGED), F.lit(2)), strip)
    pairs = F.arrays_zip(names.alias("k"), values.alias("v"))
    return F.map_from_entries(
        F.transform(
            F.array_distinct(names),
            lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]),
        )
    )


def tag_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(TAGGED), F.lit(1))).cast("long")


def missing_tags(tags: Column, wanted: list[str]) -> Column:
    return F.array_except(F.array(*[F.lit(w) for w in wanted]), F.map_keys(tags))


def one_line(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def lettered(choices: Column) -> Column:
    """``A. first`` and so on, one choice per line."""
    return F.array_join(F.transform(choices, lambda c, i: F.concat(F.char(i + 65), F.lit(". "), c)), "\n")


def letters(choices: Column, few_shot: bool = False) -> Column:
    lead = " " if few_shot else ""
    return F.transform(choices, lambda _, i: F.concat(F.lit(lead), F.char(i + 65)))


def multiple_choice_hebrew(query: Column, choices: Column) -> Column:
    return strip(
        F.concat(F.lit(HEBREW_INSTRUCTION + "שאלה: "), one_line(query), F.lit("\n"), lettered(choices), F.lit("\nתשובה:"))
    )


def multiple_choice_english(question: Column, choices: Column, topic: Column) -> Column:
    head, tail = ENGLISH_INSTRUCTION.split("{}")
    return F.concat(
        F.lit(head), F.replace(topic, F.lit("_"), F.lit(" ")), F.lit(tail), question, F.lit("\n"), lettered(choices), F.lit("\nAnswer:")
    )


def copa_prompt(query: Column, choices: Column) -> Column:
    return F.concat(
        F.lit(COPA_INSTRUCTION + "\n        שאלה: "), one_line(query), F.lit("\n"), lettered(choices), F.lit("\nתשובה:")
    )


def connected_premise(premise: Column, relation: Column, language: str = "en") -> Column:
    """Premise without its last character, followed by the connector of the relation."""
    body = strip(premise)
    return F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(" "), F.try_element_at(literal_map(CONNECTORS[language]), relation))


def word_problem_hebrew(query: Column) -> Column:
    return F.concat(F.lit("שאלה: "), one_line(query), F.lit("\nתשובה:"))


def word_problem_english(question: Column) -> Column:
    return F.concat(F.lit("Question: "), question, F.lit("\nAnswer:"))


def valid_gold_index(index: Column, choices: Column) -> Column:
    """The gold index, or 0 where it is missing or out of range."""
    return F.when((index >= 0) & (index < F.size(choices)), index).otherwise(F.lit(0)).cast("long")


def answer_index(label: Column) -> Column:
    return F.try_element_at(literal_map(ANSWER_INDEX), label.cast("string")).cast("long")


def normalize_answer(c: Column) -> Column:
    """Lower case, ASCII punctuation and articles removed, single blanks."""
    body = F.lower(strip(replace_literal(c, ("<pad>", ""), ("</s>", ""))))
    bare = F.regexp_replace(body, r"\p{Punct}", "")
    return strip(F.regexp_replace(F.regexp_replace(bare, r"\b(?:a|an|the)\b", " "), r"\s+", " "))


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def final_answer(c: Column) -> Column:
    """What follows the last ``####``; else a number at the end; else the last number; else all of it."""
    body = strip(replace_literal(c, ("<pad>", ""), ("</s>", ""), ("[ANSWER_END]", "")))
    marked = F.when(body.contains("####"), strip(F.substring_index(body, "####", -1)))
    at_end = _found(body, r"\b(\d+(?:\.\d+)?)\s*$")
    last = F.try_element_at(F.regexp_extract_all(body, F.lit(r"\b\d+(?:\.\d+)?\b"), F.lit(0)), F.lit(-1))
    return normalize_answer(F.coalesce(marked, at_end, last, body))


def strict_final_answer(c: Column) -> Column:
    """The number after ``#### ``, without thousands commas; a fixed mark where there is none."""
    answer = F.substring_index(c, STOP_SEQUENCE, 1)
    return F.coalesce(F.replace(_found(answer, r"#### (-?[0-9.,]+)"), F.lit(","), F.lit("")), F.lit(INVALID_ANSWER))
