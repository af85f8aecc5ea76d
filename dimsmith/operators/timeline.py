"""Type 2 maintenance by change points: batches of many dates, and of dates long past.

What a member was like is a line of points, each a date and the values that hold from then on. The
stored versions of a member are such points, and so are the rows of a batch, each with its own
date. Both are put in one line, a batch row in place of a stored version of its day; points that
change nothing are dropped, and every version ends the day before the next one starts. So a
back-dated row is placed between stored versions, its neighbours close anew, equal neighbours
become one, and a batch takes the same steps however many dates it holds. Members without a row in
the batch are never read beyond the join that sets them aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.compare import any_changed
from dimsmith.operators import ordering
from dimsmith.operators.keys import continue_keys
from dimsmith.operators.scd import OPEN_END, VersionColumns
from dimsmith.session import settle

GONE, STORED, ARRIVED = 0, 1, 2


def splice(
    versions: DataFrame,
    arrivals: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: str,
    columns: VersionColumns,
    ranges: int | None = None,
) -> DataFrame:
    """The versions of some members after a batch, in the columns of ``versions``; new ones have no surrogate key yet.

    ``versions`` holds every version that the batch may move: of members with a row before their
    open version all, of others the open one. ``arrivals`` holds at most one row per member and
    date ``effective``. A version that stays keeps its key, also where it now starts earlier; where
    several become one, the earliest one's key stays. Days that no version covered stay so.
    """
    c = columns
    attributes = [x for x in versions.columns if x not in (key, c.surrogate, c.valid_from, c.valid_to, c.active)]
    kind = versions.schema[c.surrogate].dataType
    row = F.struct(*[F.col(x).cast(versions.schema[x].dataType).alias(x) for x in attributes]).alias("__row")
    none = F.lit(None).cast(kind).alias(c.surrogate)
    stored = versions.select(key, F.col(c.valid_from).alias("__start"), c.surrogate, F.lit(STORED).alias("__rank"), row)
    # After its last day a version is gone, unless something starts that day.
    ended = versions.filter(F.col(c.valid_to) < F.lit(OPEN_END).cast("date"))
    gone = ended.select(key, F.date_add(c.valid_to, 1).alias("__start"), none, F.lit(GONE).alias("__rank"), F.when(F.lit(False), row).alias("__row"))
    arrived = arrivals.select(F.col(key).cast(versions.schema[key].dataType).alias(key), F.col(effective).cast("date").alias("__start"), none, F.lit(ARRIVED).alias("__rank"), row)
    every = stored.unionByName(gone).unionByName(arrived)
    of = lambda rank: F.first(F.when(F.col("__rank") == rank, F.col("__row")), ignorenulls=True)
    points = every.groupBy(key, "__start").agg(F.max(c.surrogate).alias(c.surrogate), of(STORED).alias("__old"), of(ARRIVED).alias("__new"))
    replaced = F.col("__new").isNotNull() & (F.col("__old").isNull() | any_changed("__old", "__new", tracked, versions.schema))
    points = settle(points.select(key, "__start", c.surrogate, F.when(replaced, F.col("__new")).otherwise(F.col("__old")).alias("__row")))
    if ranges is None:
        ranges = ordering.range_count(points)
    lined = ordering.with_previous(points, ["__start"], {"__before": "__row"}, [key], ranges)
    changed = F.col("__before").isNull() | F.col("__row").isNull() | any_changed("__before", "__row", tracked, versions.schema)
    lined = lined.select(*points.columns, changed.cast("int").alias("__changed"))
    runs = ordering.ordered(lined, ["__start"], {"__run": ordering.running_sum("__changed")}, [key], ranges)
    first_stored = F.struct(F.col(c.surrogate).isNull(), F.col("__start"))
    kept = runs.groupBy(key, "__run").agg(F.min("__start").alias("__start"), F.min_by(F.struct(c.surrogate, "__row"), first_stored).alias("__kept"))
    following = kept.select(F.col(key).alias("__key"), (F.col("__run") - 1).alias("__at"), F.col("__start").alias("__next"))
    pair = kept.join(following, (F.col(key) == F.col("__key")) & (F.col("__run") == F.col("__at")), "left").filter("__kept.__row is not null")
    made = {
        key: F.col(key),
        c.surrogate: F.col(f"__kept.{c.surrogate}"),
        c.valid_from: F.col("__start"),
        c.valid_to: F.coalesce(F.date_sub("__next", 1), F.lit(OPEN_END).cast("date")),
        c.active: F.col("__next").isNull().cast("int"),
        **{x: F.col(f"__kept.__row.{x}") for x in attributes},
    }
    return pair.select(*[made[x].cast(versions.schema[x].dataType).alias(x) for x in versions.columns])


def numbered(spliced: DataFrame, stored: DataFrame, key: str, columns: VersionColumns, ranges: int | None = None) -> DataFrame:
    """``spliced`` with keys after those of ``stored`` for its new versions, by start and natural key."""
    c = columns
    known, new = spliced.filter(F.col(c.surrogate).isNotNull()), spliced.filter(F.col(c.surrogate).isNull()).drop(c.surrogate)
    new = continue_keys(new, stored, c.surrogate, [c.valid_from, key], ranges=ranges, size_of=spliced)
    return known.unionByName(new.select(*[F.col(x).cast(stored.schema[x].dataType).alias(x) if x in stored.columns else F.col(x) for x in spliced.columns]))


def scd2_splice(
    stored: DataFrame,
    arrivals: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: str,
    columns: VersionColumns,
    ranges: int | None = None,
) -> DataFrame:
    """All versions after a batch whose rows each take effect on their own date, past ones included.

    ``arrivals`` holds at most one row per member and date. A row holds from its date to the start
    of the member's next version, stored or of the same batch. A row with the values that held on
    its date changes nothing. Members with closed versions only are left alone, as by
    :func:`scd.scd2_upsert`. Applying the same batch again changes nothing.
    """
    c = columns
    current = stored.groupBy(F.col(key).alias("__key")).agg(F.max(F.col(c.active).eqNullSafe(F.lit(1))).alias("__open"))
    batch = arrivals.join(current.filter(~F.col("__open")), F.col(key) == F.col("__key"), "left_anti")
    touched = batch.select(F.col(key).alias("__key")).distinct()
    concerned = stored.join(touched, F.col(key) == F.col("__key"), "left_semi")
    others = stored.join(touched, F.col(key) == F.col("__key"), "left_anti")
    out = settle(splice(concerned, batch, key, tracked, effective, c, ranges))
    return others.unionByName(numbered(out, stored, key, c, ranges))


def merged_keys(before: DataFrame, after: DataFrame, key: str, columns: VersionColumns) -> DataFrame:
    """Surrogate keys that a batch merged away, each with the key that now covers its first day.

    Facts that were looked up before the batch move to the second key.
    """
    c = columns
    left = after.select(F.col(c.surrogate).alias("__kept"))
    lost = before.join(left, F.col(c.surrogate) == F.col("__kept"), "left_anti").select(F.col(c.surrogate).alias("merged_key"), F.col(key).alias("__key"), F.col(c.valid_from).alias("__start"))
    covers = (F.col(key) == F.col("__key")) & F.col("__start").between(F.col(c.valid_from), F.col(c.valid_to))
    return lost.join(after, covers).select("merged_key", F.col(c.surrogate).alias("kept_key"))
