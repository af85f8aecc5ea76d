"""What each filter of a set removes in every order: a Gray-code walk over the subsets of the filters.

Documents fail any of the filters; the filters a document fails are its mask. All that orders of
filters have in common is how many documents each mask has, so the texts are read once, whatever
the number of orders: documents become cells (part, mask, counts), by partial sums in each task.

The walk goes through all subsets of the filters, one toggled at a time. Each mask keeps a counter
of its failing filters that are active; where the counter leaves zero the mask's documents leave
the survivors, where it returns to zero they come back. The survivors of each subset are stored, 32
states for five filters, and a step of any order is the difference of two of them.

A part is a value of a column, null and the empty string are one part. A null text is empty. A
document is a copy if a row with a smaller id has the same text (by SHA-256) anywhere in the table;
rows of one id are no copies of each other, rows without an id are never copies nor originals.
Repeated rows count each. A document is good or toxic if any of its labels says so. An empty table
gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import narrowed, once, whole

MEASURES = ("n", "good", "toxic")
COPY = "E"


def text_conditions() -> dict[str, Column]:
    """Failure of a text, by letter: too short, too few different words, too many capitals, symbols."""
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 3 * F.col("n_chars"),
        "D": F.col("has_symbol"),
    }


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, part, text_key, mask): the filters that each whole text fails by itself, as bits."""
    rows = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), whole("text").alias("text"))
    rows = once(rows, "words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    rows = rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("text_key"),
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.length("text").alias("n_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))).alias("n_upper"),
        F.col("text").rlike("[#$%&*|]").alias("has_symbol"),
    )
    mask = sum((F.when(fails, F.lit(1 << k)).otherwise(0) for k, fails in enumerate(text_conditions().values())), F.lit(0))
    return rows.select("doc_id", "part", "text_key", mask.alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` (0 or 1), one row for each of them."""
    marks = labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
    marks = marks.groupBy(F.col("doc_id").alias("its")).agg(*[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    joined = rows.join(marks, F.col("doc_id") == F.col("its"), "left")
    return joined.select(*rows.columns, F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """(part, mask, good, toxic, n): rows counted, with ``bit`` set in the masks of copies.

    Rows of a text meet as partial sums by (text, part, labels), so a text that a third of all rows
    repeats is a handful of rows when its parts are compared.
    """
    key = ["text_key", "part", "mask", "good", "toxic"]
    each = rows.groupBy(*key, "doc_id").agg(F.count("*").alias("n"))
    own = each.groupBy(*key).agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
    )
    firsts = own.groupBy(F.col("text_key").alias("its")).agg(F.min("least.doc_id").alias("first"))
    own = own.join(firsts, F.col("text_key") == F.col("its"))
    originals = F.col("without_id") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = F.explode(F.array(F.struct(F.col("mask"), originals.alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(1 << bit)).alias("mask"), (F.col("n") - originals).alias("n"))))
    return own.select("part", "good", "toxic", both.alias("cell")).select("part", "cell.mask", "good", "toxic", "cell.n")


def cells(counted: DataFrame) -> DataFrame:
    """(part, cells): one row a part, with an entry for each mask that occurs."""
    sums = counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return sums.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))


def survivors(counts: dict[int, tuple[int, ...]], filters: int) -> list[tuple[int, ...]]:
    """For each subset of the filters, as bits, what is left of the ``counts`` by mask."""
    width = len(next(iter(counts.values()), ()))
    left = [sum(c[k] for c in counts.values()) for k in range(width)]
    active = dict.fromkeys(counts, 0)
    states: list[tuple[int, ...]] = [()] * (1 << filters)
    states[0] = tuple(left)
    subset = 0
    for step in range(1, 1 << filters):
        toggled = step & -step
        subset ^= toggled
        on = bool(subset & toggled)
        for mask, own in counts.items():
            if mask & toggled:
                active[mask] += 1 if on else -1
                if active[mask] == on:  # from zero to one, or from one to zero
                    for k in range(width):
                        left[k] += -own[k] if on else own[k]
        states[subset] = tuple(left)
    return states


def orders(states: list[tuple[int, ...]], letters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of each step of each order."""
    size, full = len(letters), (1 << len(letters)) - 1
    shapley = [0] * size
    for subset, state in enumerate(states):
        for k in range(size):
            if not subset >> k & 1:
                before = subset.bit_count()
                shapley[k] += factorial(before) * factorial(size - before - 1) * (state[0] - states[subset | 1 << k][0])
    for order in permutations(range(size)):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            removed, good, toxic = (a - b for a, b in zip(states[before], states[after]))
            failing = states[0][0] - states[1 << k][0]
            alone = states[full ^ 1 << k][0] - states[full][0]
            yield "".join(letters[i] for i in order), step, states[after][0], removed, failing - removed, alone, good, toxic, shapley[k]
            before = after


def walked(by_part: DataFrame, letters: str) -> DataFrame:
    """A row for each part, order and step. ``by_part``: :func:`cells`; ``letters`` name the bits of the masks."""
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, own in zip(batch["part"], batch["cells"]):
                states = survivors({c["mask"]: tuple(int(c[m]) for m in MEASURES) for c in own}, len(letters))
                yield pd.DataFrame([(part, *row) for row in orders(states, letters)], columns=names)

    return by_part.mapInPandas(walk, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names[3:]))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Five filters over whole texts, in all 120 orders, for each language."""
    rows = labelled(measured(narrowed(documents, "doc_id", "text", "lang")), narrowed(labels, "doc_id", "quality", "toxic"))
    letters = "".join(text_conditions()) + COPY
    return walked(cells(with_copies(rows, letters.index(COPY))), letters)


def sql() -> str:
    """The same rows by counting the documents of each step of each order, without subsets."""
    return r"""
WITH rows AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
marks AS (
    SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
    SELECT r.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
        (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT
        + 16 * coalesce(r.doc_id > min(r.doc_id) OVER (PARTITION BY text), false)::INT AS mask
    FROM rows r LEFT JOIN marks m ON r.doc_id = m.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
filters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM filters a, filters b, filters c, filters d, filters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (
    SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM orders, range(1, 6) AS r(step)),
counted AS (
    SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted"""
