"""Joins with a hot key, dimension lookups, point-in-time lookups and join profiling.

Equi-joins carry no broadcast hint: Spark broadcasts a side only when its statistics or its
measured shuffle size are below the session threshold, and otherwise sort-merges, where
adaptive execution splits hot partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.operators import ordering
from dimsmith.session import settle

SALT = "__salt"


def hot_keys(df: DataFrame, key: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys holding at least ``share`` of the rows: never more than ``1 / share`` of them."""
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    total = counts.agg(F.sum("__rows")).scalar()
    return counts.filter(F.col("__rows") >= total * F.lit(share)).select(*key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    salts: int = 32,
) -> DataFrame:
    """Join where some keys of ``left`` hold a large part of its rows and ``right`` is too big to broadcast.

    Left rows of a hot key are spread over ``salts`` tasks; right rows of a hot key are repeated
    once per salt.  Other keys keep salt 0.  Left rows with a NULL key match nothing and are
    spread as well.  A row's salt comes from its values and the number of the task that reads it:
    the first spreads different rows, the second exact copies, and neither changes when the
    task runs again.  The result is that of the
    plain join.  The hot-key table has at most ``1 / share`` rows, so broadcasting it is safe.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting the left side cannot keep the rows of a {how} join")
    on = list(on)
    hot = F.broadcast(hot_keys(left, on, share).withColumn("__hot", F.lit(True)))
    row_hash = F.pmod(F.xxhash64(*left.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    spread = left.join(hot, on, "left").withColumn(SALT, F.when(F.col("__hot") | no_key, row_hash).otherwise(0))
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(hot, on, "left").withColumn(SALT, F.explode(copies))
    joined = spread.drop("__hot").join(repeated.drop("__hot"), [*on, SALT], how)
    return joined.drop(SALT)


def splittable(grouped: DataFrame) -> DataFrame:
    """Prepare a frame grouped by a key for a join on that key with rows in which the key may be hot.

    Adaptive execution splits a hot partition only when both join inputs come straight from a
    shuffle.  A grouped side would be joined as it lies, without one; spreading it evenly first
    (it is narrow, one row per key) makes the join shuffle it again and keeps splitting possible.
    """
    return grouped.hint("rebalance")


def unique_lookup(dim: DataFrame, natural_key: Sequence[str], surrogate: str, active: Column | None = None) -> DataFrame:
    """Natural key to surrogate key, one row per natural key (the lowest surrogate when several match)."""
    rows = dim if active is None else dim.filter(active)
    return splittable(rows.groupBy(*natural_key).agg(F.min(surrogate).alias(surrogate)))


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    surrogate: str,
    active: Column | None = None,
    keep_misses: bool = False,
    hot_key_salts: int | None = None,
) -> DataFrame:
    """Add the surrogate key of the matching dimension row to every fact.

    ``on`` maps fact columns to the dimension's natural-key (or descriptive) columns.  Facts
    without a match are dropped unless ``keep_misses``; see :func:`lookup_rejects`.  A NULL in a
    fact column never matches.  The dimension is reduced to keys first, so the fact is never
    multiplied and only narrow rows move.
    """
    table = unique_lookup(dim, list(on.values()), surrogate, active)
    table = table.select(*[F.col(d).alias(f) for f, d in on.items()], surrogate)
    how = "left" if keep_misses else "inner"
    if hot_key_salts:
        joined = salted_join(facts, table, list(on), how, salts=hot_key_salts)
    else:
        joined = facts.join(table, list(on), how)
    return joined.select(*facts.columns, surrogate)


def lookup_rejects(facts: DataFrame, dim: DataFrame, on: Mapping[str, str], active: Column | None = None) -> DataFrame:
    """The facts a lookup drops, whole."""
    rows = dim if active is None else dim.filter(active)
    table = rows.select(*[F.col(d).alias(f) for f, d in on.items()])
    return facts.join(table, list(on), "left_anti").select(*facts.columns)


def point_in_time_lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    take: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    slice_by_year: bool = False,
) -> DataFrame:
    """Join each fact to the dimension version valid on the fact's date (both ends included).

    An equi-join on the natural key with the validity range as an extra condition.  For members
    with very many versions ``slice_by_year`` also joins on the calendar year: versions are
    repeated for each year they cover within the facts' own span of years, which splits a hot
    member over years and compares a fact with the versions of its year only.
    """
    versions = dim.select(key, *[c for c in take if c != key], valid_from, valid_to).withColumnRenamed(key, "__key")
    rows = facts.withColumn("__at", F.to_date(at))
    condition = (F.col(key) == F.col("__key")) & F.col("__at").between(F.col(valid_from), F.col(valid_to))
    if slice_by_year:
        span = facts.agg(F.min(F.year(at)).alias("lo"), F.max(F.year(at)).alias("hi"))
        low = F.greatest(F.year(valid_from), span.select("lo").scalar())
        high = F.least(F.year(valid_to), span.select("hi").scalar())
        versions = versions.withColumn("__lo", low).withColumn("__hi", high).filter("__lo <= __hi")
        versions = versions.withColumn("__year", F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")
        rows = rows.withColumn("__fact_year", F.year(at))
        condition = condition & (F.col("__fact_year") == F.col("__year"))
    joined = rows.join(versions, condition, "inner")
    return joined.select(*facts.columns, *[c for c in take if c != key])


def product_with_list(df: DataFrame, values: DataFrame, max_values: int = 10_000) -> DataFrame:
    """Every row of ``df`` combined with every row of a short list (small dimensions only).

    The list travels as one array inside the plan and is exploded next to each row, so nothing is
    shuffled.  The query fails on a list longer than ``max_values`` rather than cutting it; see
    :func:`product` for longer ones.
    """
    rows = values.limit(max_values + 1).agg(F.sort_array(F.collect_list(F.struct(*values.columns))).alias("rows"))
    refusal = F.raise_error(F.lit(f"the list has more than {max_values} rows; large products are not offered"))
    checked = rows.select(F.when(F.size("rows") > max_values, refusal).otherwise(F.col("rows")))
    exploded = df.select("*", F.explode(checked.scalar()).alias("__item"))
    return exploded.select(*df.columns, *[F.col(f"__item.{c}").alias(c) for c in values.columns])


#: Rows of the other side that meet one block after the other in a task.
ROWS_PER_TILE = 5_000
#: Rows of the product that one task makes, as far as whole blocks allow.
ROWS_PER_TASK = 100_000_000


def product(df: DataFrame, values: DataFrame, block_rows: int = 10_000, ranges: int | None = None) -> DataFrame:
    """Every row of ``df`` combined with every row of ``values``, whatever the sizes of both.

    ``values`` are packed into blocks of at most ``block_rows`` rows and the rows of ``df`` dealt into
    tiles. A task takes one tile, which Spark holds and spills if need be, and unpacks a share of the
    blocks, one after the other, next to it; neither side is repeated on its way there. Larger sides
    make more tasks, not longer ones. The result has as many rows as the sizes multiplied; there is no
    way around that.
    """
    order = list(values.columns)
    numbered = ordering.ordered(values, order, {"__n": ordering.row_number()}, ranges=ranges)
    block = F.floor((F.col("__n") - 1) / block_rows).cast("int").alias("__its")
    blocks = settle(numbered.groupBy(block).agg(F.collect_list(F.struct(*order)).alias("__rows"))).select("__rows")
    rows = settle(df)
    num_rows, num_blocks = rows.count(), blocks.count()
    tiles = max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-num_rows // ROWS_PER_TILE))
    shares = min(num_blocks, -(-num_rows * num_blocks * block_rows // (tiles * ROWS_PER_TASK)))
    if shares > 1:
        blocks = blocks.repartition(shares)
    met = blocks.crossJoin(rows.repartition(tiles).hint("shuffle_replicate_nl"))
    unpacked = met.select(*df.columns, F.explode("__rows").alias("__item"))
    return unpacked.select(*df.columns, *[F.col(f"__item.{c}").alias(c) for c in order])


def join_sizes(
    left: DataFrame, right: DataFrame, on: Sequence[str], row_key: str, right_rows: str | None = None
) -> DataFrame:
    """What an inner join on ``on`` would produce, without producing it.

    ``joined_rows`` is the row count, ``distinct_left`` the number of distinct ``row_key`` values
    of ``left`` that survive, ``max_fan_out`` the most rows one left row would turn into.  Both
    sides are counted per key first, so a hot key on both sides costs two numbers, not their
    product.  ``right_rows`` names a column of ``right`` that says how many rows a row stands
    for, when ``right`` is counted already.
    """
    on = list(on)
    rows = F.count(F.lit(1)) if right_rows is None else F.sum(right_rows)
    right_counts = right.groupBy(*on).agg(rows.alias("__right"))
    left_counts = left.groupBy(*dict.fromkeys([*on, row_key])).agg(F.count(F.lit(1)).alias("__left"))
    both = left_counts.join(right_counts, on, "inner")
    return both.agg(
        F.coalesce(F.sum(F.col("__left") * F.col("__right")), F.lit(0)).cast("long").alias("joined_rows"),
        F.count_distinct(row_key).alias("distinct_left"),
        F.max("__right").alias("max_fan_out"),
    )


def not_in(df: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """Rows whose ``column`` is NOT IN the values, with SQL's three-valued logic.

    A NULL among the values leaves no rows, and a NULL in ``column`` is kept only when there are
    no values at all.  Written as an ordinary anti-join, which shuffles when the list is large;
    the built-in null-aware form would have to broadcast it.
    """
    facts = values.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(value).isNull()).alias("nulls"))
    num_values, num_nulls = facts.select("n").scalar(), facts.select("nulls").scalar()
    listed = splittable(values.select(F.col(value).alias("__value")).filter("__value is not null").distinct())
    missing = df.join(listed, F.col(column) == F.col("__value"), "left_anti")
    return missing.filter((num_values == 0) | ((num_nulls == 0) & F.col(column).isNotNull()))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
