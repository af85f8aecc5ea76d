"""What several operators share: whitespace words, bounded chunks, stable hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that separate words: space and tab to carriage return, as ``bytes.split()`` does.
WORD = r"[^\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)


def chunked(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to ``limit`` or to one item beyond it."""
    start = total = at = -1
    start, total = 0, 0
    for at, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield start, at + 1
            start, total = at + 1, 0
    if at >= start:
        yield start, at + 1


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word, remembered; forgets all beyond ``most`` words."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of the whole sequence if it is shorter, none if it is empty."""
    if not len(words):
        return words
    width = min(width, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            total = mixed(total * MIX + words[k : len(words) - width + 1 + k])
    return total


def whole(column: str) -> Column:
    """The text of a column, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def narrowed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others, clashing names included, never reach an operator."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def once(df: DataFrame, into: str, value: Column) -> DataFrame:
    """``df`` with a column whose expression is evaluated once a row, however often it is used.

    The optimizer may copy a projected expression to each place that uses it, into lambdas too,
    where it would be evaluated for each element; it does not copy what a generator yields.
    """
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != into], F.explode_outer(F.array(value)).alias(into))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name
