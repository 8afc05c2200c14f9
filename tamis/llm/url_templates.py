"""URL verdicts from rules, and from a tree of path templates where no rule fits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """When a segment is variable, when branches are alike, and how purity is smoothed.

    Below one node, segments become a wildcard if there are at least ``least_children`` of them
    and one in ``rows_per_child`` rows or more is new.  Neighbouring branches merge while their
    shares of blocked urls differ by at most ``alike`` and by less than ``z`` standard errors;
    branches without a labelled url stay apart.  A template's share counts
    ``prior`` urls at its parent's share; from ``reject`` on the template is blocked.
    """

    least_children: int = 16
    rows_per_child: float = 20.0
    alike: float = 0.1
    z: float = 1.96
    prior: float = 4.0
    reject: float = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise("")
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")
    return F.coalesce(rest, F.lit(""))


def ruling(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as ``rule, verdict``; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


# A run of hex signs with a digit before its last seven; each run is looked at once, from its first sign.
HEX_RUN = r"(?<![0-9a-fA-F])(?=[a-fA-F]*+[0-9][0-9a-fA-F]{7})[0-9a-fA-F]++"


def segment_class(segment: Column) -> Column:
    """A segment with its digits and long hex runs as placeholders; others stay."""
    return F.regexp_replace(F.regexp_replace(segment, HEX_RUN, "{x}"), r"[0-9]+", "{n}")


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))


def template_tree(urls: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``host, path, template`` for each row of ``urls(host, path, n, labelled, blocked)``, one row per path.

    Level by level below each host: the segments of all nodes are counted, variable ones become
    ``*``, and branches whose labels are alike share a name, ``{a|b}`` after its first and last
    member.  Rows are distinct paths with counts, and each level joins two counted tables, so a host with most of the urls is a matter of its distinct paths.
    """
    segments = F.filter(F.split("path", "/", -1), lambda x: x != "")
    todo = urls.withColumn("segments", F.transform(segments, segment_class)).withColumn("node", F.lit(""))
    todo = cut_lineage(todo)
    deepest = todo.agg(F.max(F.size("segments"))).first()[0] or 0
    done = []
    for level in range(deepest):
        done.append(todo.where(F.size("segments") == level).select("host", "path", F.col("node").alias("template")))
        todo = todo.where(F.size("segments") > level).withColumn("segment", F.element_at("segments", level + 1))
        children = cut_lineage(_counts(todo, "host", "node", "segment"))
        nodes = children.groupBy("host", "node").agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("rows"))
        variable = (F.col("children") >= settings.least_children) & (F.col("children") * settings.rows_per_child >= F.col("rows"))
        joined = cut_lineage(children.join(cut_lineage(nodes), ["host", "node"]).withColumn("variable", variable))
        # Few children or many rows for each: their number below one node is at most rows / rows_per_child.
        literal = joined.where(~F.col("variable"))
        share = (F.col("blocked") + 1) / (F.col("labelled") + 2)
        error = share * (1 - share) / (F.col("labelled") + 2)
        order = Window.partitionBy("host", "node").orderBy("share", "segment")
        literal = literal.withColumn("share", share).withColumn("error", error)
        gap = F.abs(F.col("share") - F.lag("share").over(order))
        unknown = (F.col("labelled") == 0) | (F.lag("labelled").over(order) == 0)
        apart = unknown | (gap > settings.alike) | (gap >= settings.z * F.sqrt(F.col("error") + F.lag("error").over(order)))
        literal = literal.withColumn("cut", F.coalesce(apart, F.lit(True)).cast("int"))
        literal = literal.withColumn("branch", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        names = literal.groupBy("host", "node", "branch").agg(F.min("segment").alias("a"), F.max("segment").alias("b"))
        name = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.concat(F.lit("{"), "a", F.lit("|"), "b", F.lit("}")))
        literal = literal.join(names, ["host", "node", "branch"]).select("host", "node", "segment", name.alias("name"))
        steps = literal.union(joined.where("variable").select("host", "node", "segment", F.lit("*").alias("name")))
        todo = todo.join(cut_lineage(steps), ["host", "node", "segment"])
        todo = cut_lineage(todo.withColumn("node", F.concat("node", F.lit("/"), "name")).select("host", "path", "n", "labelled", "blocked", "segments", "node"))
    done.append(todo.select("host", "path", F.col("node").alias("template")))
    out = done[0]
    for df in done[1:]:
        out = out.union(df)
    return out


def judge_urls(
    df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", labels: DataFrame | None = None, settings: Settings = Settings(),
) -> DataFrame:
    """``<id>, host, path, rule, verdict, template, purity``: a verdict for every row.

    A rule decides where one fits, the longest first.  Elsewhere the url's template does: its
    smoothed share of blocked urls, whose parent is the same template over all hosts, whose parent
    is the share over all urls.  Labelled urls are those that a rule decides, and those of
    ``labels(host, path, blocked 0/1)`` if given.

    Null urls and urls without ``://`` have empty host and path and are judged like others; no
    labelled url at all gives the share one half to all, so nothing is allowed unseen.
    """
    seen = df.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    seen = seen.withColumn("ruling", ruling(F.col("host"), F.col("path"), rules))
    known = F.col("ruling").isNotNull().cast("long")
    urls = seen.select("host", "path", known.alias("labelled"), (known * F.coalesce((F.col("ruling.verdict") == "block").cast("long"), F.lit(0))).alias("blocked"))
    if labels is not None:
        given = labels.select("host", "path", F.lit(1).cast("long").alias("labelled"), F.col("blocked").cast("long").alias("blocked"))
        urls = urls.union(given.where("host IS NOT NULL AND path IS NOT NULL AND blocked IS NOT NULL"))
    urls = cut_lineage(urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    templates = cut_lineage(template_tree(urls, settings))
    counted = cut_lineage(urls.join(templates, ["host", "path"]))
    total = counted.agg(F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("labelled"), F.lit(0))).first()
    overall = (total[0] + settings.prior / 2) / (total[1] + settings.prior)

    def smoothed(parent: Column) -> Column:
        return (F.col("blocked") + settings.prior * parent) / (F.col("labelled") + settings.prior)

    everywhere = _counts(counted, "template").select("template", smoothed(F.lit(overall)).alias("parent"))
    own = _counts(counted, "host", "template").join(cut_lineage(everywhere), "template")
    purity = cut_lineage(own.select("host", "template", smoothed(F.col("parent")).alias("purity")))
    judged = cut_lineage(templates.join(purity, ["host", "template"]))
    method = F.when(F.col("purity") >= settings.reject, "block").otherwise("allow")
    out = seen.join(judged, ["host", "path"])
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("ruling.rule").alias("rule"),
        F.coalesce("ruling.verdict", method).alias("verdict"), "template", F.round("purity", 9).alias("purity"),
    )
