"""Change predicates between two versions of a row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def any_changed(
    old: str, new: str, columns: Sequence[str], schema: T.StructType, blank_is_null: bool = True
) -> Column:
    """True when any of ``columns`` differs between the rows aliased ``old`` and ``new``.

    Text compares with NULL equal to the empty string (``blank_is_null``); every other type
    compares null-safely.  The result is never NULL.
    """
    if not columns:
        raise ValueError("at least one tracked column is needed")
    return reduce(lambda a, b: a | b, [_differs(old, new, c, schema[c].dataType, blank_is_null) for c in columns])


def _differs(old: str, new: str, column: str, kind: T.DataType, blank_is_null: bool) -> Column:
    before, after = F.col(f"{old}.{column}"), F.col(f"{new}.{column}")
    if blank_is_null and isinstance(kind, T.StringType):
        return F.coalesce(before, F.lit("")) != F.coalesce(after, F.lit(""))
    return ~before.eqNullSafe(after)
