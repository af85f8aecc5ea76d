"""Slowly changing dimensions of type 1, 2 and 3.

A version is valid from ``valid_from`` through ``valid_to``, both included.  The open version of
a member ends on 9999-12-31 and has ``dim_active = 1``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.compare import any_changed
from dimsmith.operators import ordering
from dimsmith.operators.keys import assign_surrogate_keys, continue_keys
from dimsmith.session import settle

OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class VersionColumns:
    """Names of the bookkeeping columns of a type 2 dimension."""

    surrogate: str
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    active: str = "dim_active"


def scd1_upsert(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Overwrite: incoming values replace stored ones, new members are added, missing ones stay.

    Both inputs hold one row per key.  A stored column that ``incoming`` lacks keeps its value.
    """
    pair = stored.alias("s").join(incoming.alias("i"), F.col(f"s.{key}") == F.col(f"i.{key}"), "full")
    arrived = F.col(f"i.{key}").isNotNull()
    columns = []
    for c in stored.columns:
        if c not in incoming.columns:
            columns.append(F.col(f"s.{c}").alias(c))
        else:
            columns.append(F.when(arrived, F.col(f"i.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return pair.select(*columns)


def scd2_initial(
    members: DataFrame,
    key: str,
    columns: VersionColumns,
    valid_from: Column,
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """First load: one open version per member, surrogate keys in natural-key order."""
    rows = members.withColumn(columns.valid_from, valid_from.cast("date"))
    rows = rows.withColumn(columns.valid_to, F.lit(OPEN_END).cast("date")).withColumn(columns.active, F.lit(1))
    return assign_surrogate_keys(rows, [key], columns.surrogate, ranges=ranges, size_of=size_of)


def scd2_upsert(
    stored: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective_date: str,
    columns: VersionColumns,
    reactivate: bool = False,
    ranges: int | None = None,
    settle_delta: bool = True,
) -> DataFrame:
    """All versions after applying one batch that takes effect on ``effective_date``.

    ``incoming`` holds one row per natural key (see ``latest_per_key``) with the columns of
    ``stored`` apart from the bookkeeping ones.

    * a member whose tracked columns changed: its open version is closed the day before, and a
      new open version starts; an open version that started on ``effective_date`` itself takes the
      incoming values instead, as no day is left for it;
    * a changed member whose open version started later than ``effective_date``: the job fails and
      names it (:func:`scd2_back_dated` lists them all beforehand);
    * a member in no stored version: a first version starts;
    * every other stored version, and every member missing from the batch, stays as it is;
    * a member that has closed versions only is left alone unless ``reactivate``.

    New versions get the next surrogate keys in natural-key order.  Closed versions bypass every
    join, and both joined sides have one row per key, so long histories cause no skew.  Applying
    the same batch again changes nothing.
    """
    c = columns
    open_now = stored.filter(F.col(c.active) == 1)
    history = stored.filter(~F.col(c.active).eqNullSafe(F.lit(1)))
    delta = scd2_delta(open_now, history, incoming, key, tracked, effective_date, c, reactivate)
    if settle_delta:
        delta = settle(delta)  # read by the key numbering and by both branches below

    kept = closed_or_replaced(open_now, delta, effective_date, key, c)
    opened = opened_on(delta, stored, effective_date, key, c, ranges)
    return history.unionByName(kept).unionByName(opened)


def scd2_delta(
    open_now: DataFrame,
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective_date: str,
    c: VersionColumns,
    reactivate: bool = False,
) -> DataFrame:
    """The incoming rows that change something, marked by whether they meet an open version
    (``__changed``) and whether that one started on the same day (``__same_day``)."""
    known = open_now.select(key, *tracked, F.col(c.valid_from).alias("__since")).withColumn("__stored", F.lit(True))
    arrived = incoming.alias("n").join(known.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"), "left")
    is_new = F.col("__stored").isNull()
    delta = arrived.filter(is_new | any_changed("o", "n", tracked, open_now.schema))
    starts = F.lit(effective_date).cast("date")
    refused = F.concat(F.lit(f"the batch of {effective_date} comes before the open version of {key} "), F.col(f"n.{key}").cast("string"))
    same_day = F.when(F.col("__since") > starts, F.raise_error(refused)).otherwise(F.coalesce(F.col("__since") == starts, F.lit(False)))
    delta = delta.select("n.*", (~is_new).alias("__changed"), same_day.alias("__same_day"))
    if reactivate:
        return delta
    closed_only = history.select(key).distinct()
    first_seen = delta.filter(~F.col("__changed")).join(closed_only, key, "left_anti")
    return delta.filter("__changed").unionByName(first_seen.select(*delta.columns))


def scd2_back_dated(
    stored: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], effective_date: str, columns: VersionColumns
) -> DataFrame:
    """The incoming rows that change a member whose open version started after ``effective_date``."""
    c = columns
    later = (F.col(c.active) == 1) & (F.col(c.valid_from) > F.lit(effective_date).cast("date"))
    pair = incoming.alias("n").join(stored.filter(later).alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"))
    return pair.filter(any_changed("o", "n", tracked, stored.schema)).select("n.*")


def closed_or_replaced(open_now: DataFrame, delta: DataFrame, effective_date: str, key: str, c: VersionColumns) -> DataFrame:
    """The open versions after a batch: changed ones closed, or with the new values if they started that day."""
    values = [x for x in delta.columns if x in open_now.columns and x != key]
    changes = delta.filter("__changed").select(F.col(key).alias("__key"), "__same_day", *[F.col(x).alias(f"__new_{x}") for x in values])
    same_day = F.coalesce("__same_day", F.lit(False))
    rows = open_now.join(changes, F.col(key) == F.col("__key"), "left")
    rows = rows.withColumns({x: F.when(same_day, F.col(f"__new_{x}")).otherwise(F.col(x)).cast(open_now.schema[x].dataType) for x in values})
    return closed_on(rows, effective_date, c, F.col("__key").isNotNull() & ~same_day).select(*open_now.columns)


def closed_on(rows: DataFrame, effective_date: str, c: VersionColumns, which: Column) -> DataFrame:
    """``rows`` with those that satisfy ``which`` closed the day before ``effective_date``."""
    last_day = F.date_sub(F.lit(effective_date).cast("date"), 1)
    flag = rows.schema[c.active].dataType
    return rows.withColumns(
        {
            c.valid_to: F.when(which, last_day).otherwise(F.col(c.valid_to)),
            c.active: F.when(which, F.lit(0).cast(flag)).otherwise(F.col(c.active)),
        }
    )


def opened_on(
    delta: DataFrame, stored: DataFrame, effective_date: str, key: str, c: VersionColumns, ranges: int | None = None
) -> DataFrame:
    """A version open from ``effective_date`` for every row of ``delta`` but those of ``__same_day``,
    keyed after the keys of ``stored``."""
    rows = delta.filter(~F.col("__same_day")).drop("__changed", "__same_day").withColumn(c.valid_from, F.lit(effective_date).cast("date"))
    rows = rows.withColumn(c.valid_to, F.lit(OPEN_END).cast("date")).withColumn(c.active, F.lit(1))
    rows = continue_keys(rows, stored, c.surrogate, [key], ranges=ranges, size_of=delta)
    return rows.select(*[F.col(x).cast(stored.schema[x].dataType).alias(x) for x in stored.columns])


def scd3_upsert(
    stored: DataFrame, incoming: DataFrame, key: str, tracked: str, previous: str | None = None
) -> DataFrame:
    """Keep the current and the one previous value of ``tracked``.

    When the value changes, the current one moves to ``previous`` (default ``previous_<tracked>``)
    and the new one takes its place.  Other columns are overwritten; new members start without a
    previous value.
    """
    previous = previous or f"previous_{tracked}"
    pair = stored.alias("o").join(incoming.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    known, arrived = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    moved = known & arrived & any_changed("o", "n", [tracked], stored.schema)
    out = []
    for x in stored.columns:
        if x == previous:
            value = F.when(moved, F.col(f"o.{tracked}")).otherwise(F.col(f"o.{previous}"))
        elif x in incoming.columns:
            value = F.when(arrived, F.col(f"n.{x}")).otherwise(F.col(f"o.{x}"))
        else:
            value = F.col(f"o.{x}")
        out.append(value.alias(x))
    return pair.select(*out)


def scd2_violations(dim: DataFrame, key: str, columns: VersionColumns) -> DataFrame:
    """How many rows break each rule of a type 2 dimension; all counts are 0 when it is sound."""
    c = columns
    repeated_keys = dim.groupBy(c.surrogate).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    open_rows = dim.filter(F.col(c.active) == 1)
    several_open = open_rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wrong_end = dim.filter((F.col(c.active) == 1) != (F.col(c.valid_to) == F.lit(OPEN_END).cast("date")))
    inverted = dim.filter(F.col(c.valid_from) > F.col(c.valid_to))
    # Neighbouring versions meet through their place in the member's history, so a member with
    # very many versions is spread like any other rows.
    places = ordering.ordered(
        dim.select(key, c.valid_from, c.valid_to, c.surrogate),
        [c.valid_from, c.valid_to, c.surrogate],
        {"__place": ordering.row_number()},
        [key],
        size_of=dim,
    )
    following = places.select(key, (F.col("__place") - 1).alias("__place"), F.col(c.valid_from).alias("__next"))
    overlaps = places.join(following, [key, "__place"]).filter(F.col("__next") <= F.col(c.valid_to))
    rules = {
        "repeated_surrogate_key": repeated_keys,
        "several_open_versions": several_open,
        "open_flag_and_end_disagree": wrong_end,
        "start_after_end": inverted,
        "overlapping_versions": overlaps,
    }
    counted = [
        rows.agg(F.count(F.lit(1)).alias("num_violations")).select(F.lit(name).alias("rule_name"), "num_violations")
        for name, rows in rules.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result
