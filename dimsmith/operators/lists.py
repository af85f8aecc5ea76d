"""Ordered lists per group that no task has to gather in one piece.

A list of a whole group is one cell of one row, by definition. What can be avoided is to gather and
sort its values in one task: rows are cut into even ranges of (group, value), each range is listed
apart, and a group's cell is put together from the finished lists of its ranges, in their order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.operators import ordering

PIECE = "__piece"


def ordered_text(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    separator: str = ", ",
    name: str = "listed",
    distinct: bool = False,
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """One text per group: its values in order, NULLs left out, ``distinct`` ones once. Groups with NULLs only have no row.

    ``ranges`` and ``size_of`` are as for :func:`ordering.ordered`.
    """
    values = _values(df, by, value, distinct)
    piece = F.array_join(F.sort_array(F.collect_list(value)), separator)
    return _in_pieces(values, by, value, piece, lambda pieces: F.array_join(pieces, separator), name, ranges, df if size_of is None else size_of)


def ordered_array(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str = "listed",
    distinct: bool = False,
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """As :func:`ordered_text`, as an array."""
    values = _values(df, by, value, distinct)
    return _in_pieces(values, by, value, F.sort_array(F.collect_list(value)), F.flatten, name, ranges, df if size_of is None else size_of)


def _values(df: DataFrame, by: Sequence[str], value: str, distinct: bool) -> DataFrame:
    values = df.select(*by, value).where(F.col(value).isNotNull())
    return values.distinct() if distinct else values


def _in_pieces(values: DataFrame, by: Sequence[str], value: str, piece: Column, joined, name: str, ranges: int | None, size_of: DataFrame) -> DataFrame:
    if ranges is None:
        ranges = ordering.range_count(size_of)
    if ranges <= 1:
        return values.groupBy(*by).agg(piece.alias(name))
    # Equal values stay together, so a range holds whole runs of them; a group may have many.
    keys = [ordering.OrderTerm(c) for c in (*by, value)]
    pieces = ordering.in_ranges(values, keys, ranges).groupBy(ordering.RANGE, *by).agg(piece.alias(PIECE))
    parts = F.sort_array(F.collect_list(F.struct(ordering.RANGE, PIECE)))
    return pieces.groupBy(*by).agg(joined(F.transform(parts, lambda p: p[PIECE])).alias(name))
