"""Walking a parent-child table from its roots, by pointer doubling.

Each row starts as a link from a member to its parent. A round joins the links with themselves, so
links reach twice as far, and with the members that have met their root. The number of rounds
grows with the logarithm of the depth, not with the depth, and the table is read once. A parent of very
many children is a hot key on one side of a join whose other side has one row for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.session import settle

#: Links that doubling takes as they are.
DOUBLED = 500_000


def descend(edges: DataFrame, child: str, parent: str, max_levels: int | None = None) -> DataFrame:
    """All members with their level (roots have 0) and root.

    Roots are rows whose parent is NULL. A member has one row for each path to a root, as in a recursive
    query, so one row where each has one parent. Members whose parent is no member, and those on or
    below a cycle, reach no root and do not appear; see :func:`unrooted`. There is no limit to the
    depth; a hierarchy deeper than ``max_levels``, if given, is a ValueError.
    """
    pairs = _pairs(edges, child, parent)
    rooted = (_contracted(pairs) if _many(pairs) else _doubled(pairs)[0]).withColumn("level", F.col("level").cast("int"))
    if max_levels is not None and not rooted.filter(F.col("level") > max_levels).isEmpty():
        raise ValueError(f"hierarchy is deeper than {max_levels} levels")
    return rooted


def unrooted(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(member, on_cycle): members of a table with one parent each that reach no root.

    ``on_cycle`` is false of members below a cycle, or below a parent that is no member.
    """
    reached, endless = _doubled(_pairs(edges, child, parent))
    members = edges.select(F.col(child).alias("member")).distinct()
    missing = members.join(reached.select(F.col("member").alias("__its")).hint("merge"), F.col("member") == F.col("__its"), "left_anti")
    # Steps beyond the number of members end on a cycle, and from a cycle they reach all of it.
    cycle = endless.select(F.col("up").alias("__its")).distinct().withColumn("__cycle", F.lit(True))
    return missing.join(cycle.hint("merge"), F.col("member") == F.col("__its"), "left").select("member", F.coalesce("__cycle", F.lit(False)).alias("on_cycle"))


def _pairs(edges: DataFrame, child: str, parent: str) -> DataFrame:
    return settle(edges.select(F.col(child).alias("member"), F.col(parent).alias("up")))


def _many(pairs: DataFrame) -> bool:
    """Whether there are many links, and members have one row each."""
    return pairs.filter("up is not null").count() > DOUBLED and pairs.groupBy("member").count().filter("count > 1").isEmpty()


def _starts(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Roots as rooted members, and links of one step."""
    rooted = pairs.filter("up is null").select("member", F.lit(0).cast("long").alias("level"), F.col("member").alias("root"))
    return rooted, settle(pairs.filter("up is not null").select("member", "up", F.lit(1).cast("long").alias("steps")))


def _met(links: DataFrame, rooted: DataFrame) -> DataFrame:
    """The links whose end is rooted, as rooted members."""
    ends = rooted.select(F.col("member").alias("__its"), F.col("level").alias("__level"), "root")
    return links.join(ends.hint("merge"), F.col("up") == F.col("__its")).select("member", (F.col("steps") + F.col("__level")).alias("level"), "root")


def _doubled(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rooted members (member, level, root), and links (member, up, steps) that are longer than any path without a cycle."""
    return _double(*_starts(pairs), pairs.count())


def _double(rooted: DataFrame, links: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    reach = 1
    while not links.isEmpty() and reach <= members:
        further = links.select(F.col("member").alias("__its"), F.col("up").alias("__up"), F.col("steps").alias("__steps"))
        on = links.join(further.hint("merge"), F.col("up") == F.col("__its")).select("member", F.col("__up").alias("up"), (F.col("steps") + F.col("__steps")).alias("steps"))
        rooted, links = settle(rooted.unionByName(_met(links, rooted))), settle(on)
        reach *= 2
    return rooted, links


def _contracted(pairs: DataFrame) -> DataFrame:
    """Rooted members (member, level, root) of a table with one row for each member."""
    rooted, links = _starts(pairs)
    kind = links.schema["member"].dataType
    taken: list[DataFrame] = []
    while (left := links.count()) > DOUBLED:
        heads = lambda c: F.pmod(F.xxhash64(F.col(c).cast(kind), F.lit(len(taken))), F.lit(2)) == 1  # noqa: B023, E731
        out = heads("member") & ~heads("up")
        own, others = links.filter(out), links.filter(~out)
        taken.append(own)
        further = own.select(F.col("member").alias("__its"), F.col("up").alias("__up"), F.col("steps").alias("__steps"), F.lit(None).cast(rooted.schema["root"].dataType).alias("root"))
        ends = rooted.select(F.col("member").alias("__its"), F.lit(None).cast(links.schema["up"].dataType).alias("__up"), F.col("level").alias("__steps"), "root")
        gone_on = others.join(further.unionByName(ends).hint("merge"), F.col("up") == F.col("__its"), "left")
        steps: Column = F.col("steps") + F.coalesce("__steps", F.lit(0))
        state = settle(gone_on.select("member", F.coalesce("__up", "up").alias("up"), steps.alias("steps"), "root"))
        rooted = rooted.unionByName(state.filter("root is not null").select("member", F.col("steps").alias("level"), "root"))
        # a member that leads to itself has no root; links to it end there
        links = state.filter("root is null and not (member <=> up)").select("member", "up", "steps")
    ups = links.select(F.col("up").alias("__its")).distinct()
    ends = settle(rooted.join(ups.hint("merge"), F.col("member") == F.col("__its"), "left_semi"))
    # doubling hands back the ends it was given too
    known = rooted.unionByName(_double(ends, links, left)[0].join(ends.select(F.col("member").alias("__its")).hint("merge"), F.col("member") == F.col("__its"), "left_anti"))
    for own in reversed(taken):
        known = known.unionByName(settle(_met(own, known)))
    return known
