"""Guards only skip work: with and without them every rule set gives the same texts."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tamis.functions.cleaning import WEB_RULES
from tamis.functions.rules import rewrite_column
from tamis.operators.articles import ARTICLE_STEPS
from tamis.plans.derive import DIRTY, TABLED, WIKI
from tamis.plans.registry import Tables


@pytest.mark.parametrize("noise, rules", [(WIKI, ARTICLE_STEPS), ("text", ARTICLE_STEPS), (DIRTY, WEB_RULES), (TABLED, WEB_RULES), ("text", WEB_RULES)])
def test_guards_change_nothing(spark, noise, rules):
    docs = Tables(spark, "/root/testdata/sf0.001").docs.select("doc_id", F.expr(noise).alias("text"))
    guarded = {r[0]: r[1] for r in rewrite_column(docs, "text", rules).select("doc_id", "text").collect()}
    plain = {r[0]: r[1] for r in rewrite_column(docs, "text", [replace(r, needs=()) for r in rules]).select("doc_id", "text").collect()}
    assert guarded == plain and len(guarded) == docs.count()
