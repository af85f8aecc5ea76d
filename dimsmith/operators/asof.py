"""Point-in-time lookup in one pass: facts and versions in one line, the last version carried forward.

A join on the member compares every fact of a member with all its versions. Here both are put in
one order of (member, time), a version before the facts of its day, and each fact takes the last version
before it. Work grows with facts plus versions, whatever a single member holds: beyond one range
the line is cut anywhere, also within a member, and a range gets the version that was last before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.operators import ordering


def carry_forward_lookup(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    take: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Each fact with the columns ``take`` of the version valid on its date, both ends included.

    The versions of a member do not overlap, as those of a type 2 dimension; then this equals
    :func:`joins.point_in_time_lookup`. ``how="left"`` keeps facts without a version. Facts without
    a member or a date have none. ``size_of`` is as for :func:`ordering.ordered`.
    """
    taken = [c for c in take if c != key]
    kind = facts.schema[key].dataType
    version = F.struct(F.col(valid_to).cast("date").alias("__to"), *taken).alias("__version")
    fact = F.struct(*facts.columns).alias("__fact")
    starts = versions.where(F.col(key).isNotNull()).select(F.col(key).cast(kind).alias("__key"), F.col(valid_from).cast("date").alias("__at"), F.lit(0).alias("__rank"), F.lit(0).cast("long").alias("__tie"), version)
    asked = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("__key"), F.to_date(at).alias("__at"), F.lit(1).alias("__rank"), F.xxhash64(*facts.columns).alias("__tie"), fact)
    line = starts.unionByName(asked, allowMissingColumns=True)
    # Facts of one day may stand in any order; a hash of their values lets a busy day be cut.
    order = ["__at", "__rank", "__tie"]
    carried = ordering.ordered(line, order, {"__last": ordering.last_known("__version", order)}, ["__key"], ranges, size_of)
    valid = F.col("__at") <= F.col("__last.__to")
    found = carried.where(F.col("__rank") == 1).where(valid if how == "inner" else F.lit(True))
    out = found.select("__fact.*", *[F.when(valid, F.col(f"__last.{c}")).alias(c) for c in taken])
    if how == "left":
        nameless = facts.where(F.col(key).isNull() | F.col(at).isNull())
        out = out.unionByName(nameless, allowMissingColumns=True)
    return out
