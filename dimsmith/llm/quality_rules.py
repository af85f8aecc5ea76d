"""Quality rules: a decision list learned by sequential covering from labelled text statistics.

``text_stats`` measures each whole text. ``learn`` covers the labelled rows of the rejected class
rule by rule: a rule grows on two thirds of the rows by adding the threshold with the largest
information gain, is pruned on the other third by dropping last conditions while that does not
lower its precision, and is kept if its precision on either part is high enough; the rows it covers then
leave. ``verdict`` turns the ordered rules into one Spark conditional expression.

Learning uses at most ``max_labelled`` labelled rows (those with the least hash of their id, so
the same rows whatever the partitioning); statistics and verdicts cover all rows.

A null text counts as empty. Empty texts have only zeros. Repeated rows each get their result. An
id labelled several times takes the majority, a tie counts as good; null ids and null labels are
not learned from. Without labels of both classes the list is empty and its verdict is "keep".
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import narrowed

#: Labelled rows that learning reads at most.
MAX_LABELLED = 20_000
WINDOW = 5
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
UPPER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks", "n_same_next")
STATS_TYPE = ", ".join(f"{c} long" for c in COUNTS)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    if len(words) <= width:
        return 0
    windows = list(zip(*(words[k:] for k in range(width))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total = reached = 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + width - max(i, reached)
            reached = i + width
    return total


def stats_of(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        len(raw) - len(raw.translate(None, UPPER)),
        len(raw) - len(raw.translate(None, DIGITS)),
        sum(map(text.count, "!?")),
        sum(map(bytes.__eq__, words, words[1:])),
    )


def text_stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([stats_of(t) for t in texts], columns=list(COUNTS), dtype="int64")


def with_stats(df: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    return df.withColumn(into, F.pandas_udf(text_stats, STATS_TYPE)(F.col(f"`{text}`")))


def _share(part: str, of: str, stats: str) -> Column:
    return F.col(f"{stats}.{part}") / F.greatest(F.col(f"{stats}.{of}"), F.lit(1))


def features(stats: str = "stats") -> dict[str, Column]:
    """What rules may test; doubles, never null."""
    return {
        "n_words": F.col(f"{stats}.n_words").cast("double"),
        "mean_word": _share("word_chars", "n_words", stats),
        "symbol_share": _share("n_symbols", "word_chars", stats),
        "dup_line_share": _share("n_dup_lines", "n_lines", stats),
        "repeat_share": _share("n_repeat_words", "n_words", stats),
        "line_words": _share("n_words", "n_lines", stats),
        "distinct_share": _share("n_distinct_words", "n_words", stats),
        "upper_share": _share("n_upper", "word_chars", stats),
        "digit_share": _share("n_digits", "word_chars", stats),
        "mark_share": _share("n_marks", "word_chars", stats),
        "same_next_share": _share("n_same_next", "n_words", stats),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def of(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, values: dict[str, Column]) -> Column:
        return values[self.feature] > self.threshold if self.above else values[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: dict[str, np.ndarray], rows: int) -> np.ndarray:
    held = np.ones(rows, bool)
    for condition in rule:
        held &= condition.of(table)
    return held


def _cuts(values: np.ndarray, most: int) -> np.ndarray:
    """Middles between neighbouring values, ``most`` of them at equal ranks if there are more."""
    distinct = np.unique(values)
    middles = (distinct[1:] + distinct[:-1]) / 2
    return middles if len(middles) <= most else np.unique(middles[np.linspace(0, len(middles) - 1, most).astype(int)])


def _grown(table: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], longest: int) -> Rule:
    rule: Rule = ()
    held = np.ones(len(bad), bool)
    while len(rule) < longest and held.any() and not bad[held].all():
        p0, n0 = bad[held].sum(), (~bad[held]).sum()
        base, best = np.log2(p0 / (p0 + n0)) if p0 else 0.0, (1e-9, None)
        for name, values in table.items():
            if not len(cuts[name]):
                continue
            own = np.searchsorted(cuts[name], values[held], side="left")  # value > cut k exactly if own > k
            p, n = (np.bincount(own[bad[held] == want], minlength=len(cuts[name]) + 1) for want in (True, False))
            low_p, low_n = p.cumsum()[:-1], n.cumsum()[:-1]
            for above, ps, ns in ((True, p0 - low_p, n0 - low_n), (False, low_p, low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - base), -1.0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], Condition(name, above, float(cuts[name][k])))
        if best[1] is None:
            break
        rule += (best[1],)
        held &= best[1].of(table)
    return rule


def _hits(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> tuple[int, int]:
    """Rows of the rejected class that the rule covers, and all that it covers."""
    held = _covered(rule, table, len(bad))
    return int(bad[held].sum()), int(held.sum())


def _worth(hits: tuple[int, int]) -> float:
    return (hits[0] + 1) / (hits[1] + 2)


def cover(table: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray, precision: float = 0.9, least: int = 3, longest: int = 4, rules: int = 32, cuts: int = 200) -> list[Rule]:
    """Ordered rules for the rows of ``bad``. ``part``: which rows grow rules; the others prune them.

    A rule stays if it covers ``least`` bad rows and has the ``precision`` on either part.
    """
    found: list[Rule] = []
    at = {name: _cuts(values, cuts) for name, values in table.items()}
    left = np.ones(len(bad), bool)
    while len(found) < rules and (left & part & bad).any():
        pick = lambda rows: ({name: values[rows] for name, values in table.items()}, bad[rows])
        grow, prune = pick(left & part), pick(left & ~part)
        rule = _grown(*grow, at, longest)
        while len(rule) > 1 and _worth(_hits(rule[:-1], *prune)) >= _worth(_hits(rule, *prune)):
            rule = rule[:-1]
        halves = [_hits(rule, *half) for half in (grow, prune)]
        if not rule or sum(p for p, _ in halves) < least or any(p < precision * n for p, n in halves):
            break
        found.append(rule)
        left &= ~_covered(rule, table, len(bad))
    return found


def learn(labelled: DataFrame, id_column: str, label: str, stats: str = "stats", max_labelled: int = MAX_LABELLED, **options) -> list[Rule]:
    """Rules from rows with statistics and a label (0: reject, else keep); ``options`` go to ``cover``."""
    values = features(stats)
    order = F.xxhash64(F.col(id_column))
    usable = labelled.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
    # hashes are even, so the lowest share of them holds the rows wanted, and tasks send no more than about twice as many
    share = 2 * max_labelled / max(1, usable.select(order).distinct().count())
    if share < 1:
        usable = usable.where(order.cast("double") <= 2.0**64 * share - 2.0**63)
    rows = (
        usable.groupBy(F.col(id_column))
        .agg(F.max(F.struct(*[v.alias(n) for n, v in values.items()])).alias("f"), (F.avg((F.col(label) == 0).cast("double")) > 0.5).alias("bad"))
        .select("f.*", "bad", order.alias("order"))
        .orderBy("order", *values)
        .limit(max_labelled)
        .toPandas()
    )
    bad = rows["bad"].to_numpy(bool)
    if not bad.any() or bad.all():
        return []
    table = {name: rows[name].to_numpy(float) for name in values}
    return cover(table, bad, rows["order"].to_numpy("int64") % 3 != 0, **options)


def verdict(rules: list[Rule], stats: str = "stats") -> Column:
    """True to keep: the first rule that holds decides, and without one the row stays."""
    values, out = features(stats), None
    for rule in rules:
        held = rule[0].column(values)
        for condition in rule[1:]:
            held = held & condition.column(values)
        out = F.when(held, False) if out is None else out.when(held, False)
    return F.lit(True) if out is None else out.otherwise(True)


def apply_rules(df: DataFrame, rules: list[Rule], stats: str = "stats", into: str = "good") -> DataFrame:
    return df.withColumn(into, verdict(rules, stats))


def judged(documents: DataFrame, labels: DataFrame, settle, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Statistics, the fixed base rules and the learned verdict of every document.

    ``settle`` writes the statistics (a few numbers a row) once: learning and judging both read them.
    """
    measured = settle(with_stats(narrowed(documents, "doc_id", "text")).select("doc_id", "stats"))
    marked = narrowed(labels, "doc_id", "quality").join(measured, "doc_id")
    rules = learn(marked, "doc_id", "quality", max_labelled=max_labelled)
    n = F.col("stats.n_words")
    failed = (n < 10) | (100 * F.col("stats.n_repeat_words") > 20 * n)
    return apply_rules(measured, rules).select(
        "doc_id",
        *[F.col(f"stats.{c}").alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        (~failed & F.col("good")).alias("kept"),
    )
