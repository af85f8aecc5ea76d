"""Spans of pattern matches, with built-in functions only.

``split`` and ``regexp_extract_all`` walk a text alike (leftmost, non-overlapping), so the pieces
between matches and the matches together give every match its place. Starts and ends count code
points; the end is exclusive. Work is linear in the text, and for n matches another n times the
square root of n short steps, as places are added up in blocks (see :func:`scan`); patterns given here
must be linear too, which is why callers guard runs with lookbehinds and possessive quantifiers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A span: kind, its place in the list of kinds, start, end, matched text, text shortly before and after.
SPAN = "struct<kind:string,rank:int,start:long,end:long,value:string,near:string>"
NEAR = 40


def walked(text: Column, pattern: str) -> Column:
    """The text as an array of struct<piece, found, next>: a piece, the match after it (null at the end), the next piece."""
    pieces = F.split(text, pattern, -1)
    return F.arrays_zip(
        pieces.alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("next"),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(count: Column) -> Column:
    """The size of blocks of which an array of so many elements has as many as elements in each."""
    return F.greatest(F.ceil(F.sqrt(count)), F.lit(1)).cast("int")


def scan(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What ``add`` makes, from 0, of all elements (long) before each one.

    An array that grows is copied with every element, so it grows in blocks only.
    """
    none = F.array().cast("array<bigint>")
    start = lambda at: F.struct(at.cast("long").alias("at"), none.alias("all"))
    step = lambda s, v: F.struct(add(s["at"], v).alias("at"), F.array_append(s["all"], s["at"]).alias("all"))

    def of(values: Column, size: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.size(values), size), lambda s: F.slice(values, s, size))
        sums = lambda parts: F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, b: add(a, b)))
        before = lambda parts: F.aggregate(sums(parts), start(F.lit(0)), step)["all"]
        inside = lambda parts, at: F.flatten(F.transform(parts, lambda p, k: F.aggregate(p, start(F.get(at, k)), step)["all"]))
        return let(cut, lambda parts: let(before(parts), lambda at: inside(parts, at)))

    return let(values, lambda v: F.when(F.size(v) > 0, of(v, blocks(F.size(v)))).otherwise(none))


def spans(text: Column, kind: str, rank: int, pattern: str, holds: Callable[[Column], Column] | None = None, may: Column | None = None) -> Column:
    """Spans of the matches for which ``holds``. ``may``: a cheap test that texts with a match pass."""

    def located(pieces: Column, at: Column) -> Column:
        def span(x: Column, i: Column) -> Column:
            start = F.get(at, i) + F.length(x["piece"])
            near = F.concat(F.right(x["piece"], F.lit(NEAR)), F.lit(" "), F.left(F.coalesce(x["next"], F.lit("")), F.lit(NEAR)))
            return F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), start.alias("start"), (start + F.length(x["found"])).alias("end"), x["found"].alias("value"), near.alias("near"))

        every = F.transform(pieces, span)
        return F.filter(every, lambda s: s["value"].isNotNull() if holds is None else s["value"].isNotNull() & holds(s["value"]))

    sizes = lambda pieces: F.transform(pieces, lambda x: (F.length(x["piece"]) + F.coalesce(F.length(x["found"]), F.lit(0))).cast("long"))
    found = let(walked(text, pattern), lambda pieces: let(scan(sizes(pieces), lambda a, b: a + b), lambda at: located(pieces, at)))
    none = F.array().cast(f"array<{SPAN}>")
    return found if may is None else F.when(may, found).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def digit_array(value: Column) -> Column:
    """The digits of a value as numbers."""
    return F.transform(F.filter(F.split(value, ""), lambda c: c.rlike("^[0-9]$")), lambda c: c.cast("int"))


def luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check."""

    def add(total: Column, d: Column, i: Column) -> Column:
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    numbered = F.transform(F.reverse(digit_array(value)), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(numbered, F.lit(0), lambda total, x: add(total, x["d"], x["i"])) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, give 1 modulo 97 (letters count from 10)."""
    plain = F.upper(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def listed(all_spans: Column, *order: str) -> Column:
    """kind:start:end of each span, comma-joined, sorted by the named fields."""
    sorted_by = F.array_sort(F.transform(all_spans, lambda s: F.struct(*[s[o].alias(o) for o in order], s["end"].alias("end_"), s["kind"].alias("kind_"), s["start"].alias("start_"))))
    return F.array_join(F.transform(sorted_by, lambda s: F.concat_ws(":", s["kind_"], s["start_"].cast("string"), s["end_"].cast("string"))), ",")
