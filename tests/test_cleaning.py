import hashlib
import time

import pytest
from pyspark.sql import Row, functions as F

from tamis.functions import cleaning as cl, text as tx, wikitext as w
from tamis.functions.rules import Rule, apply_rules
from tamis.operators import cleaning as op


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t")).alias("o")).first()["o"]


def web(spark, value, *names):
    rules = [cl.WEB_RULES_BY_NAME[n] for n in names]
    return one(spark, value, lambda c: apply_rules(c, rules))


@pytest.mark.parametrize("before, after", [
    ("   x", "x"), ("    x", "    x"), ("       x", "    x"), ("        x", "        x"), (" " * 10 + "x", " " * 8 + "x"),
    (" " * 28 + "x", " " * 16 + "x"), ("a  b   c" + " " * 20 + "d", "a b c d"), ("a  ", "a"), ("a \n  b", "a\nb"), ("a\n x", "a\nx"),
])
def test_spaces(spark, before, after):
    assert web(spark, before, "spaces") == after
    staged = op.clean_text(spark.createDataFrame([("|" + before,)], "text string"), [cl.WEB_RULES_BY_NAME["spaces"]]).first()["text"]
    assert staged == web(spark, "|" + before, "spaces").strip()


@pytest.mark.parametrize("before, after", [
    ("127.0.0.1", "127.0.0.1"), ("0.0.0.0", "0.0.0.0"), ("127.5.6.7", "<IP>"), ("8.8.8.8", "<IP>"), ("999.1.1.1", "<IP>"),
    ("at 8.8.8.8\n1.2.3.4", "at <IP>\n<IP>"), ("1.2.3", "1.2.3"),
])
def test_ip(spark, before, after):
    assert web(spark, before, "ip_address") == after


def test_email(spark):
    assert web(spark, "user@example.com bob@mit.edu x@y", "email") == "<EMAIL> <EMAIL> x@y"


def test_hebrew_marks(spark):
    assert web(spark, "שָׁלוֹם־עוֹלָם", "vowel_points") == "שלום־עולם"
    assert web(spark, "a\u00a0b", "no_break_space") == "a b"
    assert web(spark, "\u200fa\u200e\u202ab\u202c", "direction_mark") == "ab"


@pytest.mark.parametrize("line, gone", [("-----", True), ("=====", True), ("•", True), ("-=-=", True), ("• text", False), ("--- a", False)])
def test_separator_lines(spark, line, gone):
    assert web(spark, f"a\n{line}\nb", "separator_line") == ("a\n\nb" if gone else f"a\n{line}\nb")


@pytest.mark.parametrize("text", [
    "x &quot;a&quot;  b<MARKDOWN_TABLE>| &quot;c&quot;  d |</MARKDOWN_TABLE>&quot;e&quot;",
    "<MARKDOWN_TABLE>&quot;  </MARKDOWN_TABLE><MARKDOWN_TABLE>  &quot;</MARKDOWN_TABLE>",
    "<MARKDOWN_TABLE>open &quot;",
])
def test_tables_are_protected(spark, text):
    rules = [cl.WEB_RULES_BY_NAME["double_quote_entity"]]
    got = one(spark, text, lambda c: apply_rules(c, rules))
    import re
    tables = re.findall(r"(?s)<MARKDOWN_TABLE>.*?</MARKDOWN_TABLE>", text)
    rest = re.split(r"(?s)<MARKDOWN_TABLE>.*?</MARKDOWN_TABLE>", text)
    expected = "".join(a.replace("&quot;", '"') + b for a, b in zip(rest, tables + [""]))
    assert got == expected


def test_staged_and_folded_rules_agree(spark):
    texts = ["a &quot;b&quot;  c\r\n-----\n   \n\n\n\n x@y.org", "t<MARKDOWN_TABLE> a  &quot; </MARKDOWN_TABLE>  &quot;x", "", None, "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    staged = op.clean_text(df, cl.WEB_RULES).orderBy("id").collect()
    folded = df.select("id", tx.strip(apply_rules(F.col("text"), cl.WEB_RULES)).alias("text")).orderBy("id").collect()
    assert [r["text"] for r in staged] == [r["text"] for r in folded]


def test_callable_rule(spark):
    upper = Rule("upper", pattern="[a-z]", function=F.upper)
    assert one(spark, "ab", upper) == "AB"
    assert one(spark, "ab", upper.hits) == 2


def test_wiki_spaces(spark):
    for n, expected in [(1, 1), (2, 1), (3, 1), (4, 4), (5, 1), (8, 8), (12, 12), (16, 16), (20, 16), (21, 1), (40, 16)]:
        assert one(spark, "a" + " " * n + "b", w.shrink_space_runs) == "a" + " " * expected + "b", n


@pytest.mark.parametrize("before, after", [
    ("== H ==", "## H"), ("=== H ===", "### H"), ("====== H ======", "###### H"), ("== H ===", "## H"), ("==H==", "## H"), ("= H =", "= H ="),
])
def test_headings(spark, before, after):
    assert one(spark, f"x\n{before}\ny", w.headings_to_markdown) == f"x\n{after}\ny"


def test_markup(spark):
    assert one(spark, "a{{x{{y}}z}}b [[p|q]] [[r]] <i>s</i>", lambda c: apply_rules(c, w.UNWRAP_MARKUP)) == "ab q r s"
    assert one(spark, 'a<ref name="x"/>b', lambda c: apply_rules(c, w.CITATIONS)) == "ab"
    # An opening without a closing of its own runs to the next closing tag.
    assert one(spark, 'a<ref name="x"/>b<ref>c</ref>d', lambda c: apply_rules(c, w.CITATIONS)) == "ad"
    assert one(spark, "a [[File:x.png|thumb|left|cap]] b", lambda c: apply_rules(c, w.MEDIA)) == "a b"
    assert one(spark, "text (thumb image) end 300px", lambda c: apply_rules(c, w.MEDIA)) == "text end"
    assert one(spark, "|thumb|left|caption text", lambda c: apply_rules(c, w.MEDIA)) == "caption text"


def test_tables(spark):
    table = "{|\n|-\n| aa || bb\n|-\n| cc || 30px || d\n|}"
    assert one(spark, f"x\n{table}\ny", w.tables_to_markdown) == "x\n| aa | bb |\n| cc |\ny"
    assert one(spark, "{| aa || bb\n|-\n| cc\n|}", w.tables_to_markdown) == "| aa | bb |\n|---|---|\n| cc |"
    assert one(spark, table, w.tables_to_lists) == f"{w.LIST_HEADING}\n- aa\n- bb\n- cc\n"
    assert one(spark, "{| aa || bb |}", w.tables_to_lists) == "aa bb"


def test_loopback_survives(spark):
    got = one(spark, "127.5.6.7 8.8.8.8 999.1.1.1 a@b.org", lambda c: apply_rules(c, w.MASK_PERSONAL_DATA))
    assert got == "127.5.6.7 [IP_REMOVED] [IP_REMOVED] [EMAIL_REMOVED]"


def test_articles(spark):
    from tamis.operators.articles import clean_articles

    rows = [(0, "#REDIRECT [[x]]" + "a" * 200), (1, "a" * 99), (2, "a" * 100), (3, " #הפניה [[y]]")]
    got = {r["id"]: r["reject_reason"] for r in clean_articles(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert got == {0: "redirect", 1: "too_short", 2: None, 3: "redirect"}


def test_books(spark):
    assert one(spark, "a\n\nb\n\n\nc\nפרויקט בן־יהודה\nd", cl.repair_book_lines) == "a\nb\n\nc\nd"
    assert one(spark, "\ufb2c a  b &nbsp;c", lambda c: apply_rules(c, cl.BOOK_RULES)) == "ש a b c"


def test_insertions(spark):
    rows = [("abcd", [(1, "-", False), (3, "+", False), (2, "x", True), (9, "!", None)]), ("", [(0, "a", False)])]
    df = spark.createDataFrame(rows, "t string, i array<struct<char_index:int,char:string,should_ignore:boolean>>")
    assert [r[0] for r in df.select(cl.insert_at(F.col("t"), F.col("i"))).collect()] == ["a-bc+d!", "a"]


def test_accepted_insertions(spark):
    rows = [("שלום", 1, "LABEL_1", 0.95), ("שלום", 2, "LABEL_1", 0.5), ("שaום", 2, "LABEL_1", 0.99), ("שלום", 0, "LABEL_1", 0.99), ("שלום", 3, "LABEL_0", 0.99)]
    df = spark.createDataFrame(rows, "text string, char_index int, label string, score double")
    assert [r["char_index"] for r in op.accepted_insertions(df).collect()] == [1]


def test_ocr_elements(spark):
    good = '[{"type":"Text","content":"a"},{"type":"Table","content":"|b|"}]'
    assert one(spark, good, cl.ocr_elements_to_text) == "a\n<MARKDOWN_TABLE>|b|</MARKDOWN_TABLE>\n\n\n"
    assert one(spark, "oops", cl.ocr_elements_to_text) is None


@pytest.mark.parametrize("a, b", [("", ""), ("abc", ""), ("", "abc"), ("kitten", "sitting"), ("abcdef", "azced"), ("aaaa", "bbbb"), ("intention", "execution")])
def test_edit_script(spark, a, b):
    def brute(x, y):
        cost = {(0, 0): (0, 0)}
        for i in range(len(x) + 1):
            for j in range(len(y) + 1):
                options = [cost[0, 0]] if i == j == 0 else []
                if i: options.append((cost[i - 1, j][0] + 1, cost[i - 1, j][1]))
                if j: options.append((cost[i, j - 1][0] + 1, cost[i, j - 1][1]))
                if i and j:
                    same = x[i - 1] == y[j - 1]
                    options.append((cost[i - 1, j - 1][0] + (not same), cost[i - 1, j - 1][1] - (not same)))
                cost[i, j] = min(options)
        return cost[len(x), len(y)]

    total, minus_subs = brute(a, b)
    row = spark.createDataFrame([(a, b)], "a string, b string").select(tx.edit_shares("a", "b").alias("s"), tx.edit_distance_ratio(F.col("a"), F.col("b")).alias("r")).first()
    longest = max(len(a), len(b))
    assert row["r"] == (total / longest if longest else 0)
    deletions, insertions = row["s"]["deletions"] * (longest or 1), row["s"]["insertions"] * (longest or 1)
    assert round(deletions + insertions) == total + minus_subs
    assert round(deletions - insertions) == len(a) - len(b)


def test_chunks(spark):
    text = ("word " * 30 + "\n\n" + "x" * 50 + ". ") * 5
    df = spark.createDataFrame([(1, text)], "id int, text string")
    chunks = [r["chunk"] for r in op.chunk_text(df, 100).orderBy("chunk_id").collect()]
    assert "".join(chunks) == text and max(map(len, chunks)) <= 100


def test_insertions_take_one_walk_along_a_text(spark):
    text, n = "abcdefghij" * 100_000, 100_000
    places = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct((i * 10).alias("char_index"), F.lit("|").alias("char"), F.lit(False).alias("should_ignore")))
    df = spark.createDataFrame([(text,)], "t string")
    started = time.monotonic()
    assert df.select(cl.insert_at(F.col("t"), places).alias("o")).first()["o"] == "abcdefghij|" * n
    assert time.monotonic() - started < 20


@pytest.mark.parametrize("text, at, chars, made", [
    ("abc", [1, 1, 9], ["x", "y", "z"], "axybcz"), ("aé𝄞b", [2, 3], [" ", "-"], "aé 𝄞-b"), ("", [0], ["x"], "x"), ("abc", [], [], "abc"), (None, [0], ["x"], ""),
])
def test_splice(text, at, chars, made):
    assert cl.splice(text, at, chars) == made


def test_rule_examples_choose_by_id(spark):
    rows = [(i, f"a{i}" if i % 2 else f"b{i}") for i in range(200)] + [(1, "a1"), (1, "a1"), (None, "a"), (None, "b")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    rules = [Rule("a", "a", "A"), Rule("b", "b", "B"), Rule("never", "zzz", "")]
    found = op.rule_examples(df, rules, "id", 7)
    # The texts of chosen ids alone reach the last window.
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    key = lambda i: (hashlib.md5("|".join(["42"] + ([] if i is None else [str(i)])).encode()).hexdigest(), i is not None, i or 0)
    expected = [(r, i, t) for r in "ab" for i, t in sorted((x for x in rows if r in x[1]), key=lambda x: key(x[0]))[:7]]
    assert sorted(map(str, found.select("rule", "id", "before").collect())) == sorted(str(Row(rule=r, id=i, before=t)) for r, i, t in expected)


def test_article_rules_touch_the_ends_and_the_lines_that_need_it(spark):
    from tamis.functions.rules import rewrite_column

    rows = [(" \t a b \n", "a b"), ("a  ", "a "), ("a ", "a "), ("", ""), (None, None), ("\n \n", "")]
    df = spark.createDataFrame(rows, "text string, wanted string")
    out = rewrite_column(df, "text", w.ARTICLE_RULES["start_end_white_space"])
    assert out.where("NOT (text <=> wanted)").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" in plan
    lines = "• a\n •• \n-----\n ----x\n=== t ==\ta  b"
    rules = [r for g in ("empty_line_with_bullet", "multiple_hyphens", "wiki_headers") for r in w.ARTICLE_RULES[g]]
    assert one(spark, lines + "\n=== t ==", lambda c: apply_rules(c, rules)) == "• a\n ----x\n=== t ==\ta  b\n## t"
    assert one(spark, "a\tb   c d", w.BLANK_RUN.guarded) == "a b c d"
    headings = [r for r in w.ARTICLE_RULES["wiki_headers"] if r.needs]
    assert [r.needs for r in headings] == [("=" * n,) for n in (6, 5, 4, 3, 2)]
