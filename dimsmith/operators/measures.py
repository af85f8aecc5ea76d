"""Measures: ratios, balances, exact percentiles, running totals, shares and nested children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.operators import ordering


def ratio(df: DataFrame, by: Sequence[str], numerator: Column, denominator: Column, name: str) -> DataFrame:
    """A non-additive ratio recomputed from its parts at the asked grain, with both parts kept."""
    parts = df.groupBy(*by).agg(F.sum(numerator).alias(f"{name}_num"), F.sum(denominator).alias(f"{name}_den"))
    value = F.col(f"{name}_num").cast("double") / F.nullif(F.col(f"{name}_den").cast("double"), F.lit(0.0))
    return parts.withColumn(name, value)


def closing_balance(
    df: DataFrame, period: Column, member: Sequence[str], at: Sequence[str], balance: str, by: Sequence[str] = ()
) -> DataFrame:
    """A semi-additive measure: each member's last balance in a period, summed over members.

    ``at`` orders the readings of a member; ``by`` are further grouping columns of the result.
    """
    last = F.max_by(F.col(balance), F.struct(*at))
    per_member = df.groupBy(period.alias("period"), *by, *member).agg(last.alias("__last"))
    return per_member.groupBy("period", *by).agg(
        F.sum("__last").alias("total_balance"), F.count(F.lit(1)).alias("num_members")
    )


def share_of_total(df: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Add each row's part of the grand total. The total is one value put into the plan, not a
    window over all rows."""
    total = df.agg(F.sum(measure).cast("double")).scalar()
    return df.withColumn(name, F.col(measure).cast("double") / total)


def exact_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Interpolated percentiles per group, one column ``p<percent>`` each, without holding a group.

    Equal values are counted before the shuffle; running counts over the distinct values then
    show which one covers each wanted position.
    """
    by = list(by)
    known = df.filter(F.col(value).isNotNull())
    levels = known.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__rows"))
    placed = ordering.ordered(
        levels, [value], {"__through": ordering.running_sum("__rows")}, by, ranges=ranges, size_of=df
    )
    sizes = levels.groupBy(*by).agg(F.sum("__rows").alias("__n"))
    if by:
        condition = F.lit(True)
        for c in by:
            condition = condition & F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}"))
        joined = placed.alias("p").join(sizes.alias("s"), condition).select("p.*", "__n")
    else:
        joined = placed.withColumn("__n", sizes.select("__n").scalar())

    def value_at(position: Column) -> Column:
        covers = (F.col("__through") - F.col("__rows") <= position) & (position < F.col("__through"))
        return F.max(F.when(covers, F.col(value)))

    columns = []
    for p in probabilities:
        exact = F.lit(float(p)) * (F.col("__n") - 1)
        low, high = value_at(F.floor(exact)), value_at(F.ceil(exact))
        fraction = F.max(exact - F.floor(exact))
        columns.append((low + (high - low) * fraction).alias(f"p{round(p * 100)}"))
    return joined.groupBy(*by).agg(F.max("__n").alias("num_values"), *columns)


def nest_children(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    fields: Sequence[str],
    name: str = "children",
    chunk_rows: int = 10_000,
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Denormalise: the children of each parent as arrays of structs, in order.

    Ordinary parents fill chunk 0 only; a parent with more than ``chunk_rows`` children gets
    several rows, so no task ever has to build one unbounded array.
    """
    numbered = ordering.ordered(df, order_by, {"__n": ordering.row_number()}, by, ranges, size_of)
    chunked = numbered.withColumn("chunk", F.floor((F.col("__n") - 1) / chunk_rows).cast("int"))
    packed = chunked.groupBy(*by, "chunk").agg(F.sort_array(F.collect_list(F.struct("__n", *fields))).alias("__a"))
    children = F.transform("__a", lambda child: F.struct(*[child[f].alias(f) for f in fields]))
    return packed.select(*by, "chunk", children.alias(name))


def list_chunks(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    separator: str = ", ",
    name: str = "listed",
    chunk_rows: int = 100_000,
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Ordered text lists of the distinct values per group, for groups of any size.

    Ordinary groups fill chunk 0 only.  A group with more than ``chunk_rows`` values gets several
    rows, in order, so no task has to hold one unbounded list; joining the chunks with the
    separator gives the whole list.
    """
    by = list(by)
    values = df.select(*by, value).filter(F.col(value).isNotNull()).distinct()
    size_of = df if size_of is None else size_of
    numbered = ordering.ordered(values, [value], {"__n": ordering.row_number()}, by, ranges, size_of)
    chunked = numbered.withColumn("chunk", F.floor((F.col("__n") - 1) / chunk_rows).cast("int"))
    text = F.expr(f"listagg({value}, '{separator}') WITHIN GROUP (ORDER BY {value})")
    return chunked.groupBy(*by, "chunk").agg(F.count(F.lit(1)).alias("num_values"), text.alias(name))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin; bin 0 lies below ``low`` and bin ``bins + 1`` at or above ``high``."""
    bucket = F.width_bucket(F.col(value), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.groupBy(bucket.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("num_rows"))
