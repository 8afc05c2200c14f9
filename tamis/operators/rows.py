"""Row numbers and running totals over groups of any size, by keys of any type.

A plain window sends a whole group to one task.  Here the order key is cut into
ranges first: totals per (group, range) are small, their running sums are the
offsets, and the window runs inside one range of one group.

An order key is a column or several; it should tell the rows of a group apart, else
ties are numbered in any order and stay in one range.  Nulls come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

Keys = str | list[str]
ROWS_PER_RANGE, MOST_RANGES, SAMPLES_PER_RANGE = 500_000, 4096, 32


def _columns(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _orderable(keys: Keys) -> Column:
    """One value that sorts as the keys do; never null, so that null keys have a place too."""
    return F.struct(*_columns(keys))


def cut_points(df: DataFrame, keys: Keys, buckets: int | None = None) -> list[tuple]:
    """Ascending keys that cut ``df`` into ranges of about equal size; by default as many as its size asks for.

    The distinct keys whose hash is smallest are a sample that no order and no layout can bias, and
    merging it over tasks is adding counts.  About ``SAMPLES_PER_RANGE`` keys per range reach the driver.
    Any cut points give the same numbers in the end.
    """
    names = _columns(keys)
    key = _orderable(keys)
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(key)).alias("distinct")).first()
    if buckets is None:
        buckets = max(16, min(MOST_RANGES, -(-size["rows"] // ROWS_PER_RANGE)))
    wanted = SAMPLES_PER_RANGE * buckets
    sampled = df.select(*names)
    if size["distinct"] > wanted:
        sampled = sampled.where(F.shiftrightunsigned(F.xxhash64(key), 1) < int(wanted / size["distinct"] * 2**63))
    rows = sampled.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).orderBy(*names).collect()
    total, seen, cuts = sum(r["_n"] for r in rows), 0, []
    for row in rows:
        # A key closes a range as soon as another share of the rows lies up to it.
        if (seen + row["_n"]) * buckets // total > seen * buckets // total:
            cuts.append(tuple(row[c] for c in names))
        seen += row["_n"]
    return cuts[:-1]


def _literals(df: DataFrame, keys: Keys, cuts: list[tuple]) -> Column:
    kinds = {f.name: f.dataType for f in df.schema}
    names = _columns(keys)
    return F.array(*[F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(names, cut)]) for cut in cuts])


def _range_of(df: DataFrame, keys: Keys, cuts: list[tuple]) -> Column:
    """How many cut points lie before a row, by halving."""
    if not cuts:
        return F.lit(0)
    points, key = _literals(df, keys, cuts), _orderable(keys)
    steps = F.array(*[F.lit(1 << i) for i in range(len(cuts).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.try_element_at(points, at + step) < key, at + step).otherwise(at))


def _joined_back(placed: DataFrame, by: list[str], right: DataFrame) -> DataFrame:
    """``placed`` with the columns of the row of ``right`` for its group and range; null groups are groups too."""
    right = right.withColumnsRenamed({c: f"_o_{c}" for c in by})
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return placed.join(right, condition).drop(*[f"_o_{c}" for c in by])


def running_total(df: DataFrame, key: Keys, value: Column, name: str, groups: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group up to and including this one."""
    groups = groups or []
    placed = df.withColumn("_range", _range_of(df, key, cut_points(df, key, buckets))).withColumn("_value", value)
    by = [*groups, "_range"]
    totals = placed.groupBy(*by).agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by).orderBy(*_columns(key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _joined_back(placed, by, offsets).withColumn(name, F.sum("_value").over(inside) + F.col("_offset")).drop("_range", "_value", "_offset")


def previous_value(df: DataFrame, key: Keys, value: str, name: str, groups: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Add ``name``: the value of the row before in the group.

    Inside a range the window looks back; the first row of a range takes the last
    value of the nearest earlier range.
    """
    groups = groups or []
    placed = df.withColumn("_range", _range_of(df, key, cut_points(df, key, buckets)))
    by = [*groups, "_range"]
    ends = placed.groupBy(*by).agg(F.max_by(F.struct(F.col(value).alias("v")), _orderable(key)).alias("_end"))
    carried = ends.select(*by, F.lag("_end").over(Window.partitionBy(*groups).orderBy("_range")).alias("_carried"))
    inside = Window.partitionBy(*by).orderBy(*_columns(key))
    before = F.when(F.row_number().over(inside) == 1, F.col("_carried.v")).otherwise(F.lag(value).over(inside))
    return _joined_back(placed, by, carried).withColumn(name, before).drop("_range", "_carried")


def row_numbers(df: DataFrame, key: Keys, name: str = "row_number", groups: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Add 1-based row numbers by ``key`` inside each group."""
    return running_total(df, key, F.lit(1).cast("long"), name, groups, buckets)


def every_kth(df: DataFrame, key: Keys, k: int) -> DataFrame:
    """Rows 0, k, 2k, .. in key order."""
    return row_numbers(df, key, "_n").where((F.col("_n") - 1) % k == 0).drop("_n")


def positions(df: DataFrame, key: Keys, start: int, stop: int, buckets: int | None = None) -> DataFrame:
    """Rows ``start`` (inclusive) to ``stop`` (exclusive) in key order, counted from 0.

    Counting the ranges shows which of them the slice touches; only their rows are numbered.
    """
    cuts = cut_points(df, key, buckets)
    place = _range_of(df, key, cuts)
    counts = {r["_range"]: r["n"] for r in df.select(place.alias("_range")).groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, {}
    for i in range(len(cuts) + 1):
        n = counts.get(i, 0)
        if n and before < stop and before + n > start:
            offsets[i] = before
        before += n
    if not offsets:
        return df.limit(0)
    # The bounds of a single key can reach the scan.
    touched = df
    if isinstance(key, str):
        first, last = min(offsets), max(offsets)
        if first > 0 and cuts[first - 1][0] is not None:
            touched = touched.where(F.col(key) > F.lit(cuts[first - 1][0]))
        if last < len(cuts) and first > 0:
            touched = touched.where(F.col(key) <= F.lit(cuts[last][0]))
    placed = touched.withColumn("_range", place).where(F.col("_range").isin(list(offsets)))
    first_of = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*_columns(key))) + F.element_at(first_of, F.col("_range"))
    return placed.withColumn("_n", number).where((F.col("_n") > start) & (F.col("_n") <= stop)).drop("_n", "_range")


def tail(df: DataFrame, key: Keys, n: int) -> DataFrame:
    """The last n rows in key order; a top-n, so nothing is numbered."""
    return df.orderBy(*[F.desc(c) for c in _columns(key)]).limit(n)


# Up to this many rows of a group Spark turns a rank filter into a limit inside every task.
WINDOW_LIMIT = 1000


def first_n(df: DataFrame, groups: list[str], order: list, n: int, rank: str | None = None, buckets: int | None = None) -> DataFrame:
    """Up to n rows per group in the given order, with their place as ``rank`` if named.

    Few rows: each task keeps n per group ahead of the exchange.  More, by columns in ascending
    order: the order key is cut into ranges, counts per (group, range) tell which ranges hold the
    first n, the rest goes before anything moves, and rows are ranked inside their range only.
    """
    name = rank or "_n"
    if n <= WINDOW_LIMIT or not all(isinstance(c, str) for c in order):
        w = Window.partitionBy(*groups).orderBy(*order)
        picked = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
        return picked if rank else picked.drop(name)
    placed = df.withColumn("_range", _range_of(df, order, cut_points(df, order, buckets)))
    by = [*groups, "_range"]
    counts = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.select(*by, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < n)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) + F.col("_before")
    picked = _joined_back(placed, by, needed).withColumn(name, place.cast("int")).where(F.col(name) <= n).drop("_range", "_before")
    return picked if rank else picked.drop(name)


def exclude(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    return df.join(ids.select(id_col), id_col, "left_anti")


def select_ids(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    return df.join(ids.select(id_col), id_col, "left_semi")


def size_chunks(df: DataFrame, key: Keys, size: Column, limit: int, groups: list[str]) -> DataFrame:
    """Number output chunks of about ``limit`` bytes per group, by where a row's bytes start."""
    total = running_total(df, key, size, "_end", groups)
    return total.withColumn("chunk", F.floor((F.col("_end") - size) / F.lit(limit)).cast("long")).drop("_end")
