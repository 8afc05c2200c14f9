"""Human annotations: parsing, gold selection, agreement, MQM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tamis.functions.text import strip

# Severity weights, severities and categories of the annotation form.
SEVERITY_SCORE = {"": 0, "minor": 1, "major": 5, "critical": 25}
SEVERITIES = ["minor", "major", "critical"]
CATEGORIES = [
    "Adequacy - Mistranslation", "Adequacy - Omission", "Adequacy - Addition", "Adequacy - TerminologyNamedEntity",
    "Adequacy - CulturalReference", "Fluency - Agreement", "Fluency - MorphologyFunction", "Fluency - WordOrderSyntax",
    "Fluency - OrthographyPunct", "LocaleStyle - Register", "LocaleStyle - Conventions",
]
SLOTS = {"model_1": (1, 2, 3), "model_2": (4, 5, 6)}


def parse_labelled_blocks(files: DataFrame, value: str = "value") -> DataFrame:
    """One row per block of a labelled text file; the part after the last rule is dropped."""
    parts = F.split(F.col(value), "-" * 50, -1)
    blocks = files.select(*[c for c in files.columns if c != value], F.posexplode(F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("block", "_b"))
    b = F.col("_b")

    def field(pattern: str) -> Column:
        return strip(F.regexp_extract(b, pattern, 1))

    return blocks.select(
        *[c for c in blocks.columns if c != "_b"],
        F.nullif(F.regexp_extract(b, r"Example (\d+):", 1), F.lit("")).cast("int").alias("example_index"),
        field(r"(?s)English:\n(.*?)(?=\nOption 1:)").alias("english"),
        field(r"(?s)Option 1:\n(.*?)(?=\nOption 2:)").alias("option_1"),
        field(r"(?s)Option 2:\n(.*?)(?=\nRating:)").alias("option_2"),
        field(r"(?d)Rating:(.*)").alias("rating"),
        field(r"(?s)Gold:\s*(.*)").alias("gold"),
    )


def split_options(c: Column) -> tuple[Column, Column]:
    """Texts of ``Option 1:`` and ``Option 2:``."""
    first = F.regexp_replace(F.regexp_extract(c, r"(?s)^(.*?)Option 2:", 1), r"(?:\n\n|\n    \n)\z", "")
    second = F.regexp_extract(c, r"(?s)Option 2:\n?(.*)\z", 1)
    return F.regexp_replace(first, r"\AOption 1:\n", ""), second


def clean_labels(df: DataFrame) -> DataFrame:
    """Nulls to '', ratings ``1.0`` to ``1``, SKIP dropped, empty gold replaced by the model text."""
    filled = df.na.fill("")
    rating = F.regexp_replace("rating", r"^([12])\.0$", "$1")
    gold = F.when(F.col("gold") == "", F.col("new_text_column")).otherwise(F.col("gold"))
    return filled.withColumn("rating", rating).where("rating <> 'SKIP'").withColumn("gold", gold)


def rated(df: DataFrame) -> DataFrame:
    return df.where(~F.col("rating").isin("", "SKIP"))


def winning_model(rating: Column) -> Column:
    """Name of the chosen model; BOTH, SKIP and '' stay."""
    return F.when(rating == "1", F.col("model_1")).when(rating == "2", F.col("model_2")).otherwise(rating)


def gold_text(preferred: str = "gemini") -> Column:
    """Gold where given; BOTH takes the preferred model's option, else the chosen one; null for SKIP."""
    won = F.col("rating_model")
    given = F.replace(F.replace(F.col("gold"), F.lit("Option 1:\n"), F.lit("")), F.lit("Option 2:\n"), F.lit(""))
    both = F.when(F.col("model_1").contains(preferred), F.col("option_1")).otherwise(F.col("option_2"))
    return (
        F.when(won == "SKIP", F.lit(None))
        .when(F.col("gold") != "", given)
        .when(won == "BOTH", both)
        .when(won == F.col("model_1"), F.col("option_1"))
        .when(won == F.col("model_2"), F.col("option_2"))
    )


def update_from(base: DataFrame, saved: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Base rows with the non-null values of ``saved`` on top; the key must be unique in both."""
    for df in (base, saved):
        if df.groupBy(key).count().where("count > 1").limit(1).count():
            raise ValueError(f"'{key}' is not unique")
    right = saved.select(key, *[F.col(c).alias(f"_s_{c}") for c in columns])
    out = base.join(right, key, "left")
    merged = {c: F.coalesce(F.col(f"_s_{c}"), F.col(c)) if c in base.columns else F.coalesce(F.col(f"_s_{c}"), F.lit("")) for c in columns}
    return out.withColumns(merged).drop(*[f"_s_{c}" for c in columns])


def mismatches(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, column, left_value, right_value`` wherever two tables disagree or a row is missing."""
    a = left.select(key, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    b = right.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_in_b"))
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").cast("string").alias("left_value"), F.col(f"_b_{c}").cast("string").alias("right_value"))
        for c in columns
    ])
    joined = a.join(b, key, "full_outer")
    rows = joined.select(key, F.inline(entries), (F.col("_in_a").isNull() | F.col("_in_b").isNull()).alias("_missing"))
    return rows.where(F.col("_missing") | ~F.col("left_value").eqNullSafe(F.col("right_value"))).drop("_missing")


def mqm_long(df: DataFrame, key: str) -> DataFrame:
    """``key, model, slot, category, severity``: the six annotation slots as rows."""
    slots = [
        F.struct(
            F.col(model).alias("model"), F.lit(i).alias("slot"),
            F.coalesce(F.col(f"category_annotation_{i}"), F.lit("")).alias("category"),
            F.coalesce(F.col(f"severity_annotation_{i}"), F.lit("")).alias("severity"),
        )
        for model, numbers in SLOTS.items() for i in numbers
    ]
    return df.select(key, F.inline(F.array(*slots)))


def severity_score(severity: Column) -> Column:
    score = F.lit(0)
    for name, weight in SEVERITY_SCORE.items():
        score = F.when(severity == name, weight).otherwise(score)
    return score.cast("long")


def mqm_scores(long: DataFrame, key: str) -> DataFrame:
    return long.groupBy(key, "model").agg(F.sum(severity_score(F.col("severity"))).alias("score"))


def mqm_means(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(F.count(F.lit(1)).alias("items"), F.round(F.avg("score"), 6).alias("mean_score"))


def score_correlation(scores: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Pearson correlation of two models' scores on the same items."""
    wide = scores.groupBy(key).pivot("model", [a, b]).agg(F.first("score"))
    return wide.agg(F.round(F.corr(a, b), 6).alias("correlation"))


def _fixed(df: DataFrame, values: dict[str, list], keys: list[str], counts: DataFrame, count: str) -> DataFrame:
    """Every (key, value ...) combination with its count, zero where none; the lists are short and fixed."""
    frame = df.select(*keys).distinct()
    for name, items in values.items():
        frame = frame.withColumn(name, F.explode(F.array(*[F.lit(v) for v in items])))
    return frame.join(counts, [*keys, *values], "left").na.fill(0, [count])


def severity_distribution(long: DataFrame) -> DataFrame:
    """Annotated slots by model and severity, with percentages; absent severities count 0."""
    marked = long.where("category <> ''")
    counts = marked.groupBy("model", "severity").agg(F.count(F.lit(1)).alias("n"))
    full = _fixed(marked, {"severity": SEVERITIES}, ["model"], counts, "n")
    whole = F.sum("n").over(Window.partitionBy("model"))
    return full.withColumn("percent", F.round(F.try_divide(F.col("n") * 100.0, whole), 6))


def category_distribution(long: DataFrame) -> DataFrame:
    """Share of each category in a model's annotated slots; absent categories count 0."""
    marked = long.where("category <> ''")
    counts = marked.groupBy("model", "category").agg(F.count(F.lit(1)).alias("n"))
    totals = marked.groupBy("model").agg(F.count(F.lit(1)).alias("_all"))
    full = _fixed(marked, {"category": CATEGORIES}, ["model"], counts, "n")
    return full.join(totals, "model").withColumn("share", F.round(F.col("n") / F.col("_all"), 6)).drop("_all")


def category_by_severity(long: DataFrame) -> DataFrame:
    """Categories as rows, severities as columns, by model."""
    marked = long.where("category <> ''")
    wide = marked.groupBy("model", "category").pivot("severity", SEVERITIES).agg(F.count(F.lit(1)))
    full = _fixed(marked, {"category": CATEGORIES}, ["model"], wide, SEVERITIES[0])
    return full.na.fill(0, SEVERITIES)


def severity_bin(total: Column) -> Column:
    """Summed severities back to a single label."""
    return F.when(total == 0, "0").when(total < 5, "minor").when(total < 25, "major").otherwise("critical")


def preference_counts(df: DataFrame) -> DataFrame:
    """Choices by winning model, already good against fixed, with percentages."""
    fixed = F.col("gold") != ""
    counts = df.where("rating_model <> 'SKIP'").groupBy("rating_model").agg(
        F.count_if(~fixed).alias("already_gold"), F.count_if(fixed).alias("was_fixed")
    )
    whole = F.col("already_gold") + F.col("was_fixed")
    return counts.withColumns({
        "total": whole, "already_gold_percent": F.round(F.col("already_gold") * 100.0 / whole, 6),
        "was_fixed_percent": F.round(F.col("was_fixed") * 100.0 / whole, 6),
    })


def confusion_matrix(df: DataFrame, a: str, b: str, labels: list) -> DataFrame:
    """``a, b, n`` for every pair of the fixed labels, zeros included."""
    known = df.where(F.col(a).isin(labels) & F.col(b).isin(labels))
    counts = known.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array(*[F.struct(F.lit(x).alias(a), F.lit(y).alias(b)) for x in labels for y in labels])
    grid = df.sparkSession.range(1).select(F.inline(pairs))
    return grid.join(counts, [a, b], "left").na.fill(0, ["n"])


def cohens_kappa(df: DataFrame, a: str, b: str, labels: list, keys: list[str] | None = None) -> DataFrame:
    """Observed agreement, chance agreement and kappa, all from one aggregation; null when undefined."""
    known = df.where(F.col(a).isin(labels) & F.col(b).isin(labels))
    cols = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(a) == F.col(b)).alias("_same")]
    for i, label in enumerate(labels):
        cols += [F.count_if(F.col(a) == F.lit(label)).alias(f"_a{i}"), F.count_if(F.col(b) == F.lit(label)).alias(f"_b{i}")]
    sums = known.groupBy(*(keys or [])).agg(*cols)
    n = F.col("n").cast("double")
    p0 = F.try_divide(F.col("_same"), n)
    chance = sum((F.col(f"_a{i}") * F.col(f"_b{i}") for i in range(len(labels))), F.lit(0))
    pe = F.try_divide(F.try_divide(chance.cast("double"), n), n)
    return sums.select(
        *(keys or []), "n", F.round(p0, 6).alias("p0"), F.round(pe, 6).alias("pe"),
        F.round(F.try_divide(p0 - pe, 1 - pe), 6).alias("kappa"),
    )


def category_agreement(left: DataFrame, right: DataFrame, by_category: bool = True) -> DataFrame:
    """Pairs of equal annotations of two annotators; the n-th of a kind meets the n-th.

    Input ``item, slot, category``; a super-category is the part before `` - ``.
    """
    kind = ["item", "category", "sup_cat"] if by_category else ["item", "sup_cat"]

    def numbered(df: DataFrame) -> DataFrame:
        sup = df.where("category <> ''").withColumn("sup_cat", F.substring_index("category", " - ", 1))
        # A kind within one item has at most as many rows as the form has slots.
        w = Window.partitionBy(*kind).orderBy("slot")
        return sup.withColumn("occurrence", F.row_number().over(w) - 1).select(*kind, "occurrence")

    return numbered(left).join(numbered(right), [*kind, "occurrence"])


def remaining_quota(full: DataFrame, labelled: DataFrame, subject: str, quota: int = 20) -> DataFrame:
    """Items still needed per subject."""
    done = labelled.groupBy(subject).agg(F.count(F.lit(1)).alias("_done"))
    need = F.lit(quota) - F.coalesce(F.col("_done"), F.lit(0))
    return full.select(subject).distinct().join(done, subject, "left").select(subject, need.alias("need")).orderBy(F.desc("need"), subject)


def cap_per_subject(df: DataFrame, quotas: DataFrame, subject: str, order: str, spare: int = 5, max_rank: int | None = None) -> DataFrame:
    """The first ``need + spare`` items of each subject.

    Quotas are bounded by the full quota, so ``max_rank`` cuts each subject to a short
    list ahead of the join.
    """
    w = Window.partitionBy(subject).orderBy(order)
    ranked = df.withColumn("_n", F.row_number().over(w) - 1)
    if max_rank is not None:
        ranked = ranked.where(F.col("_n") < max_rank)
    return ranked.join(quotas, subject).where(F.col("_n") < F.col("need") + spare).drop("_n", "need")


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, keys: list[str] | None = None) -> DataFrame:
    """Counts per bin of ``[low, high]``; values outside are left out."""
    inside = df.where(F.col(value).between(low, high))
    # The right edge belongs to the last bin.
    number = F.least(F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)), F.lit(bins))
    return inside.groupBy(*(keys or []), number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_whole(df: DataFrame, value: str, ranges: dict[str, tuple[float, float, int]], keys: list[str] | None = None) -> DataFrame:
    """Counts per ``<range> <bin>`` of ascending ranges, and of what lies under, between and over them; they add up to all rows.

    A missing value counts as ``missing``.
    """
    v = F.col(value).cast("double")
    name = F.when(v.isNull(), "missing").when(v < min(low for low, _, _ in ranges.values()), "under")
    for range_name, (low, high, bins) in ranges.items():
        number = F.least(F.width_bucket(v, F.lit(float(low)), F.lit(float(high)), F.lit(bins)), F.lit(bins))
        name = name.when(v < low, "between").when(v <= high, F.concat_ws(" ", F.lit(range_name), number.cast("string")))
    return df.groupBy(*(keys or []), name.otherwise("over").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
