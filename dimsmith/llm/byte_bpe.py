"""Byte-level BPE: encoding by a segment tree of pair ranks, and decoding.

Texts are split by the vocabulary's pattern. Within a piece, a segment tree over byte positions
holds the rank and place of the pair that starts at each live position; its root is the least rank
at the leftmost place that has it. A merge changes two leaves and removes one, each in logarithmic
time, so a piece of n bytes costs O(n log n) however long it is. Most pieces are words of a few
bytes, for which a plain list of pair ranks is faster than a tree. Pieces recur, so each worker
remembers those it has seen, within a bound.

Ids are stored as consecutive little-endian unsigned 32-bit integers (``binary``); ``unpacked``
turns them into an array column. Null texts give no ids and empty bytes; an empty text likewise.
Every row, repeated ones included, gives one result; other columns are passed through.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import unused

NONE = 1 << 62
#: Pieces remembered by a task, and the longest that is worth remembering.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64
#: Bytes up to which a piece is merged in a list.
SHORT = 48
#: Texts encoded and decoded before their results leave a task.
TEXTS = 1_000
#: By vocabulary path and pattern; a worker process serves many tasks.
_encoders: dict[tuple[str, str], Encoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one piece: merge the leftmost pair of least rank until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    if n <= SHORT:
        return merge_short(piece, ranks)
    leaves = 1 << (n - 1).bit_length()
    shift, mask = leaves.bit_length(), (1 << leaves.bit_length()) - 1
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    get = ranks.get
    tree = [NONE] * (2 * leaves)
    for i in range(n - 1):
        if (rank := get(piece[i : i + 2])) is not None:
            tree[leaves + i] = rank << shift | i
    for i in range(leaves - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right

    def put(at: int, value: int) -> None:
        node = at + leaves
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
            if tree[node] == value:
                return
            tree[node] = value

    while (least := tree[1]) != NONE:
        at = least & mask
        gone = end[at]
        stop = end[at] = end[gone]
        put(gone, NONE)
        rank = None
        if stop < n:
            before[stop] = at
            rank = get(piece[at : end[stop]]) if end[stop] - at <= longest else None
        put(at, NONE if rank is None else rank << shift | at)
        if (left := before[at]) >= 0:
            rank = get(piece[left:stop]) if stop - left <= longest else None
            put(left, NONE if rank is None else rank << shift | left)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As :func:`merge`, by lists of the parts and of the ranks of neighbouring ones."""
    get = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], NONE) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) != NONE:
        at = pairs.index(least)
        del pairs[at]
        joined = parts[at] = parts[at] + parts.pop(at + 1)
        if at:
            pairs[at - 1] = get(parts[at - 1] + joined, NONE)
        if at < len(pairs):
            pairs[at] = get(joined + parts[at + 1], NONE)
    return [ranks[part] for part in parts]


class Encoder(dict):
    """Packed ids by piece of text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.longest = ranks, max(map(len, ranks), default=0)
        self.pieces = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        ids = merge(piece.encode(), self.ranks, self.longest)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text))) if text else b""


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I"))) if packed else b""


def remembered(path: str, pattern: str, sent: Broadcast) -> Encoder:
    """The worker's encoder, which it keeps from task to task."""
    own = _encoders.get((path, pattern))
    if own is None:
        own = _encoders[path, pattern] = Encoder(sent.value, pattern)
    return own


def encoder(spark, path: str, pattern: str):
    """A column function: text to packed ids. The vocabulary, whose size its file bounds, goes to each executor once."""
    sent = spark.sparkContext.broadcast(read_ranks(path))

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = remembered(path, pattern, sent)
        for texts in batches:
            yield pd.Series([own.encode(t) for t in texts], dtype=object)

    return encode


def decoder(spark, path: str):
    """A column function: packed ids to the bytes they stand for."""
    sent = spark.sparkContext.broadcast(read_ranks(path))

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Decoder(sent.value)
        for packed in batches:
            yield pd.Series([own.decode(p) for p in packed], dtype=object)

    return decode


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the packed ids of its whole texts."""
    return df.withColumn(into, encoder(df.sparkSession, path, pattern)(F.col(f"`{text}`")))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its packed ids stand for."""
    return df.withColumn(into, decoder(df.sparkSession, path)(F.col(f"`{ids}`")))


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids", back: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` with one Python worker for each task.

    One after the other they are two workers a task, each with a vocabulary and remembered pieces of
    its own, and executors keep such workers for the steps that follow.
    """
    sent = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("ids binary, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = remembered(path, pattern, sent)
        decoder = Decoder(own.ranks)
        for texts in batches:
            for at in range(0, len(texts), TEXTS):
                ids = [own.encode(t) for t in texts.slice(at, TEXTS).to_pylist()]
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array([decoder.decode(x) for x in ids], pa.binary())], ["ids", "decoded"])

    name = unused(df, "both")
    others = [F.col(f"`{c}`") for c in df.columns if c not in (into, back)]
    rows = df.withColumn(name, both(F.col(f"`{text}`")))
    return rows.select(*others, F.col(f"{name}.ids").alias(into), F.col(f"{name}.decoded").alias(back))


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of integers."""
    digits = F.hex(ids)
    at = lambda i, k: F.substring(digits, i * 8 + 2 * k + 1, F.lit(2))
    number = lambda i: F.conv(F.concat(*[at(i, k) for k in (3, 2, 1, 0)]), 16, 10).cast("long")
    count = (F.octet_length(ids) / 4).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), number)).otherwise(F.array().cast("array<long>"))
