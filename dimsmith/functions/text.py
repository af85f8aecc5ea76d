"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimsmith.functions._columns import ColumnLike, as_column

MONEY_TYPE = "decimal(18,2)"


def money(text: ColumnLike, symbol: str = "$") -> Column:
    """``'$3.99'`` or ``'$1,234.50'`` as a decimal. Text that is no amount becomes NULL instead of failing the job.

    Commas count as separators only where they part groups of three digits.
    """
    plain = F.replace(as_column(text), F.lit(symbol), F.lit(""))
    grouped = plain.contains(",") & plain.rlike(r"^\s*[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]*)?\s*$")
    return F.when(grouped, F.replace(plain, F.lit(","), F.lit(""))).otherwise(plain).try_cast(MONEY_TYPE)


def unreadable_money(text: ColumnLike, symbol: str = "$") -> Column:
    """Whether a text that is there is no amount, so that :func:`money` loses it. Never NULL."""
    return as_column(text).isNotNull() & money(text, symbol).isNull()


def clean_key(value: ColumnLike) -> Column:
    """Comparable text form of a key that one source keeps as text and another as a number."""
    return F.trim(as_column(value).cast("string"))


def name_case(value: ColumnLike) -> Column:
    """First letter upper case, the rest lower case."""
    c = as_column(value)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def full_name(first: ColumnLike, last: ColumnLike) -> Column:
    return F.concat(as_column(first), F.lit(" "), as_column(last))


def search_tokens(*texts: ColumnLike) -> Column:
    """Distinct lower-case words of the given texts, sorted."""
    joined = F.lower(F.concat_ws(" ", *[as_column(t) for t in texts]))
    words = F.split(joined, r"[^\p{L}\p{N}]+")
    return F.sort_array(F.array_distinct(F.filter(words, lambda word: word != "")))


def text_array(literal: ColumnLike) -> Column:
    """A database array literal such as ``{Trailers,"Deleted Scenes"}`` as an array of strings.

    Quoted elements may hold commas, braces and escaped characters; a bare ``NULL`` is a null element.
    """
    parts = F.regexp_extract_all(as_column(literal), F.lit(r'"(?:[^"\\]|\\.)*"|[^,{}"]+'), F.lit(0))
    quoted = lambda part: F.regexp_replace(F.substring(part, F.lit(2), F.length(part) - 2), r"(?s)\\(.)", "$1")
    return F.transform(parts, lambda part: F.when(part.startswith('"'), quoted(part)).when(part != "NULL", part))
