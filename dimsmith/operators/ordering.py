"""Exact row numbers, ranks, running totals and carried values that never put a large group into one task.

A window over one huge group (or over no group at all) sorts all its rows in one task.  Here
Spark first range-partitions the rows by ``(group, order)``, as for a global sort, and each row is
written with the number of its range; so a re-run task reads the same ranges, their number has no
limit, and groups of any size are cut evenly.  The window runs inside each range; groups that
reach over a cut get what their earlier ranges carry over.  A range has at most two such groups,
its first and its last, so that table grows with the ranges only, and Spark broadcasts it or not by
its size.

Small inputs (checked by counting) take the plain window. Values and their types are the same on
both ways.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.session import settle

ROWS_PER_RANGE = 500_000
RANGE = "__range"
CARRY = "__carry"


@dataclass(frozen=True)
class OrderTerm:
    column: str
    descending: bool = False

    @classmethod
    def parse(cls, text: str) -> "OrderTerm":
        """``"amount desc"`` or ``"customer_id"``."""
        column, _, direction = text.strip().partition(" ")
        if direction.strip().lower() not in ("", "asc", "desc"):
            raise ValueError(f"unknown direction in {text!r}")
        return cls(column, direction.strip().lower() == "desc")

    def sort(self) -> Column:
        return F.col(self.column).desc() if self.descending else F.col(self.column).asc()


@dataclass(frozen=True)
class Measure:
    """One window result: how it looks inside a range and what a whole range contributes."""

    local: Column  # applied over the ordered window
    total: Column  # aggregate of a whole range that later ranges carry on
    by_rows: bool = False  # frame: rows up to this one
    carry: Callable[[Column], Column] = F.sum  # the totals of all earlier ranges, as one
    join: Callable[[Column, Column], Column] = lambda here, earlier: F.coalesce(here + earlier, here, earlier)


def row_number() -> Measure:
    return Measure(F.row_number(), F.count(F.lit(1)))


def rank() -> Measure:
    return Measure(F.rank(), F.count(F.lit(1)))


def dense_rank(order_by: Sequence[str]) -> Measure:
    terms = [OrderTerm.parse(t) for t in order_by]
    return Measure(F.dense_rank(), F.count_distinct(F.struct(*[t.column for t in terms])))


def running_sum(column: str) -> Measure:
    return Measure(F.sum(column), F.sum(column), by_rows=True)


def last_known(column: str, order_by: Sequence[str]) -> Measure:
    """The last value so far that is not NULL; ``order_by`` ascends and identifies a row within its group."""
    at = F.struct(*[OrderTerm.parse(t).column for t in order_by])
    total = F.max_by(column, F.when(F.col(column).isNotNull(), at))
    return Measure(F.last(column, ignorenulls=True), total, True, lambda c: F.last(c, ignorenulls=True), F.coalesce)


def ordered(
    df: DataFrame,
    order_by: Sequence[str],
    measures: dict[str, Measure],
    partition_by: Sequence[str] = (),
    ranges: int | None = None,
    size_of: DataFrame | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add ``measures`` over the rows of each ``partition_by`` group in ``order_by`` order.

    ``order_by`` should identify a row within its group, for repeatable numbers and even
    ranges; rows that tie on it always stay in one range, so ranks are exact as well (for many
    ties use :func:`rank_with_heavy_ties`).  ``size_of`` is a frame with at least as many rows
    as ``df`` that is cheap to count, such as the table ``df`` was grouped from; without it
    ``df`` itself is counted.  A large ``df`` is run twice, for a sample and for its ranges, and
    written once; a frame that is costly to run and not ``stored`` is settled first.
    """
    terms = [OrderTerm.parse(t) for t in order_by]
    if ranges is None:
        ranges = range_count(df if size_of is None else size_of)
    if ranges <= 1:
        return _windowed(df, list(partition_by), terms, measures)

    by = list(partition_by)
    marked = in_ranges(df if stored else settle(df), [OrderTerm(c) for c in by] + terms, ranges)
    local = _windowed(marked, [RANGE, *by], terms, measures)
    carried = settle(_carried(marked, by, measures))
    return _add_carried(local, carried, by, measures).select(*df.columns, *measures)


def in_ranges(df: DataFrame, keys: Sequence[OrderTerm], ranges: int) -> DataFrame:
    """``df``, written once, with the number of each row's range in the order of ``keys``; equal keys share a range."""
    return settle(df.repartitionByRange(ranges, *[k.sort() for k in keys]).withColumn(RANGE, F.spark_partition_id()))


def range_count(rows: DataFrame) -> int:
    """How many ranges the rows are cut into; 1 means the plain window."""
    return max(1, -(-rows.count() // ROWS_PER_RANGE))


def spread(df: DataFrame, by: Sequence[str], size_of: DataFrame | None = None) -> DataFrame:
    """``df`` with rows of equal ``by`` in one partition, in as many partitions as there are ranges of its rows.

    Grouping, distinct and joins on ``by`` need no other shuffle, and adaptive execution, which merges
    partitions by their compressed bytes, leaves them as they are; so a task's tables stay as small
    however many rows there are. Frames of one range stay as they are.
    """
    parts = range_count(df if size_of is None else size_of)
    return df if parts <= 1 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *by)


def with_previous(
    df: DataFrame,
    order_by: Sequence[str],
    values: dict[str, str],
    partition_by: Sequence[str],
    ranges: int | None = None,
) -> DataFrame:
    """Add, under new names, the values that columns have in the row before; NULL in the first row of a group.

    ``order_by`` identifies a row within its group. Beyond one range, rows meet by their number
    within the group, so a group of any size is spread like other rows.
    """
    if ranges is None:
        ranges = range_count(df)
    if ranges <= 1:
        window = Window.partitionBy(*partition_by).orderBy(*[OrderTerm.parse(t).sort() for t in order_by])
        return df.select("*", *[F.lag(c).over(window).alias(n) for n, c in values.items()])
    placed = settle(ordered(df, order_by, {"__place": row_number()}, partition_by, ranges))
    before = placed.select(*partition_by, (F.col("__place") + 1).alias("__place"), *[F.col(c).alias(n) for n, c in values.items()])
    return _null_safe_join(placed, before, [*partition_by, "__place"], "left").select(*df.columns, *values)


def rank_with_heavy_ties(
    df: DataFrame,
    value: str,
    partition_by: Sequence[str] = (),
    descending: bool = True,
    rank_name: str = "value_rank",
    dense_name: str = "value_dense_rank",
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """RANK and DENSE_RANK by ``value`` where one value may hold a large part of the rows.

    The distinct values are ranked with their row counts, so ties collapse before the shuffle,
    and the ranks are joined back (an ordinary equi-join that adaptive execution can split).
    """
    order = [f"{value} desc" if descending else value]
    by = [*partition_by, value]
    levels = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    measures = {dense_name: row_number(), "__through": running_sum("__rows")}
    placed = ordered(levels, order, measures, partition_by, ranges, size_of=df if size_of is None else size_of)
    ranks = placed.select(*by, (F.col("__through") - F.col("__rows") + 1).alias(rank_name), dense_name)
    return _null_safe_join(df, ranks, by, "inner")


def _windowed(
    df: DataFrame, partition_by: list[str], terms: list[OrderTerm], measures: dict[str, Measure]
) -> DataFrame:
    window = Window.partitionBy(*partition_by).orderBy(*[t.sort() for t in terms])
    rows = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.select(
        "*", *[m.local.over(rows if m.by_rows else window).alias(name) for name, m in measures.items()]
    )
    # Numbers and ranks are long, however few rows there are now.
    return out.withColumns({n: F.col(n).cast("long") for n in measures if out.schema[n].dataType == T.IntegerType()})


def _carried(marked: DataFrame, partition_by: list[str], measures: dict[str, Measure]) -> DataFrame:
    """What earlier ranges of the same group carry over, for the groups that reach over a cut."""
    rows = marked
    if partition_by:
        group = F.struct(*partition_by)
        edges = marked.groupBy(RANGE).agg(F.array(F.min(group), F.max(group)).alias("edges")).select(F.explode(F.array_distinct("edges")).alias("edge"))
        # a group at the edge of two ranges or more reaches over a cut
        split_groups = settle(edges.groupBy("edge").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("edge.*"))
        rows = _null_safe_join(marked, split_groups, partition_by, "left_semi")
    totals = rows.groupBy(RANGE, *partition_by).agg(*[m.total.alias(f"__t_{n}") for n, m in measures.items()])
    earlier = Window.partitionBy(*partition_by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        RANGE, *partition_by, *[m.carry(f"__t_{n}").over(earlier).alias(f"{CARRY}_{n}") for n, m in measures.items()]
    )


def _add_carried(
    local: DataFrame, carried: DataFrame, partition_by: list[str], measures: dict[str, Measure]
) -> DataFrame:
    joined = _null_safe_join(local, carried, [RANGE, *partition_by], "left")
    for name, measure in measures.items():
        total = measure.join(F.col(name), F.col(f"{CARRY}_{name}"))
        joined = joined.withColumn(name, total.cast(local.schema[name].dataType))
    return joined


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])
