"""Near-duplicates by MinHash: an inverted join of signature coordinates, confirmed on full sets.

Documents whose shingle sets are equal form a class; a class is compared once, whatever its size.
A class's signature has ``MINIMA`` minima; each is a coordinate, and a coordinate with its minimum is
a value of 64 bits, so that the corpus may grow without values meeting by chance. All values have one order, the rarest first, and each class is posted under the first
``PREFIX`` of its own. Two classes with ``MATCHES`` equal minima share a value there: of all they share
the first one is followed by ``MATCHES - 1`` others in both. So no such pair is lost. Values that no
other class has come first and are not posted, so a class with ``PREFIX`` of them is in no list.

Lists are joined in two steps, so that a list of thousands of copies never yields all its pairs:

1. each member is paired with the list's head, the member that meets most others in all its lists;
   what is confirmed is contracted to components
2. only lists that still hold several components are joined with themselves, and only members of
   different components are paired, unless two exact bounds rule a link out: the shingles that one
   of them shares with no other component, and the parities of both. A class has ``PARITIES`` bits,
   each telling whether an odd number of its shingles falls in that bucket; bits that differ are at
   most the shingles that only one of two classes has. So a crowd of copies just below the
   threshold gives few pairs, and of those that are left the full sets decide

Every pair that shares a posted value is thus either in one component already or compared. Its
collisions are counted on both signatures, minimum by minimum, instead of by merging the lists with
skips: the counts are those of all lists. Pairs with fewer than ``MATCHES`` equal minima are dropped
(at 0.8 four in 100,000 would be), the others are confirmed on the full shingle sets of their whole
texts. Nothing is capped and nothing is collected.

A document without words has an empty set and is linked with nothing. Null ids are kept: they are
no candidates for a component's least id unless it has no other. Repeated rows each get their row.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import MIX, WordHashes, mixed, narrowed, shingle_hashes
from dimsmith.llm.components import components

MINIMA = 64
#: Of 64 minima, 51 agree on average at a similarity of 0.8, with a deviation of 3.2.
MATCHES = 38
#: Two classes with MATCHES equal minima share one of so many first values.
PREFIX = MINIMA - MATCHES + 1
PERCENT = 80
PARITIES = 512
#: Documents signed at once, and words and classes that a task remembers meanwhile.
SIGNED, WORDS, TOLD = 500, 150_000, 250_000
_random = np.random.default_rng(20)
FACTORS = _random.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
MASKS = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
PLACES = np.arange(1, MINIMA + 1, dtype=np.uint64) * MIX

Settle = Callable[[DataFrame], DataFrame]


def shingle_set(text: str | None, width: int, known: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles of a text, A to Z in lower case, sorted."""
    return np.unique(shingle_hashes(known.of(text.encode().lower().split()), width)) if text else np.empty(0, np.uint64)


def class_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def minima(shingles: np.ndarray) -> np.ndarray:
    """Of each coordinate the least shingle in its order, hashed with its place."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least, where = np.full(MINIMA, 0xFFFFFFFF, np.uint32), np.zeros(MINIMA, np.int64)
    for at in range(0, len(short), 4096):
        ranks = (short[at : at + 4096] ^ MASKS[:, None]) * FACTORS[:, None]
        here = ranks.argmin(axis=1)
        rank = ranks[np.arange(MINIMA), here]
        where = np.where(rank < least, here + at, where)
        least = np.minimum(rank, least)
    with np.errstate(over="ignore"):
        return mixed(shingles[where] + PLACES)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each of ``PARITIES`` buckets, whether an odd number of shingles falls in it, in words of 64 bits."""
    odd = np.bincount((shingles % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def close(a: str, b: str, percent: int) -> Column:
    """Whether the parities of two classes leave a link possible; true of every link."""
    differ = sum((F.bit_count(F.get(f"parities_{a}", F.lit(k)).bitwiseXOR(F.get(f"parities_{b}", F.lit(k)))) for k in range(PARITIES // 64)), F.lit(0))
    total = F.col(f"n_shingles_{a}") + F.col(f"n_shingles_{b}")
    return 100 * (total - differ) >= percent * (total + differ)


def signatures(documents: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, cid, coordinates, minima, parities, packed) of every document.

    The last five are null without words; ``packed``, the compressed text, is given once a class in a task.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, told, packer = WordHashes(WORDS), set(), zstandard.ZstdCompressor(3)
        numbers = pa.list_(pa.int64())
        kinds = {"n_shingles": pa.int64(), "cid": pa.binary(), "coordinates": numbers, "minima": pa.binary(), "parities": numbers, "packed": pa.binary()}
        for batch in (b.slice(a, SIGNED) for b in batches for a in range(0, b.num_rows, SIGNED)):
            rows = []
            for text in batch.column("text").to_pylist():
                own = shingle_set(text, width, known)
                if not len(own):
                    rows.append((0, None, None, None, None, None))
                    continue
                cid, least = class_id(own), minima(own)
                packed = None if cid in told else packer.compress(text.encode())
                if len(told) > TOLD:
                    told.clear()
                told.add(cid)
                rows.append((len(own), cid, least.view(np.int64), least.astype(np.uint8).tobytes(), parities(own), packed))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *kinds])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(sign, f"doc_id {kind}, n_shingles long, cid binary, coordinates array<long>, minima binary, parities array<long>, packed binary")


def alike(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets confirm the link."""

    def agree(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) for a, b in zip(first, second)], dtype="int32")

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, unpacker = WordHashes(WORDS), zstandard.ZstdDecompressor()
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def full(cid: bytes, packed: bytes) -> np.ndarray:
            if cid not in recent:
                recent[cid] = shingle_set(unpacker.decompress(packed).decode(), width, known)
                if len(recent) > 64:
                    recent.popitem(last=False)
            recent.move_to_end(cid)
            return recent[cid]

        for batch in batches:
            held = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["packed_a"], batch["packed_b"]):
                first, second = full(a, x), full(b, y)
                both = len(np.intersect1d(first, second, assume_unique=True))
                held.append(100 * both >= percent * (len(first) + len(second) - both))
            yield batch.loc[held, ["a", "b"]]

    side = lambda df, name, *more: df.select(F.col("cid").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in more])
    near = pairs.join(side(classes, "a", "minima", "n_shingles", "parities"), "a").join(side(classes, "b", "minima", "n_shingles", "parities"), "b")
    small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    near = near.where((100 * small >= percent * large) & close("a", "b", percent)).where(F.pandas_udf(agree, "int")(F.col("minima_a"), F.col("minima_b")) >= MATCHES).select("a", "b")
    full_pairs = near.join(side(texts, "a", "packed"), "a").join(side(texts, "b", "packed"), "b")
    return full_pairs.mapInPandas(confirm, "a binary, b binary")


def alone_in(classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(member, alone): how many shingles of each class (cid, root) no class of another component has."""

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, unpacker = WordHashes(WORDS), zstandard.ZstdDecompressor()
        for batch in batches:
            for cid, root, raw in zip(batch["cid"], batch["root"], batch["packed"]):
                own = shingle_set(unpacker.decompress(raw).decode(), width, known)
                yield pd.DataFrame({"cid": [cid] * len(own), "root": [root] * len(own), "shingle": own.view(np.int64)})

    named = classes.select(F.col("cid").alias("its"), "root")
    each = texts.join(named, F.col("cid") == F.col("its")).select("cid", "root", "packed").mapInPandas(shingles, "cid binary, root binary, shingle long")
    spread = each.groupBy(F.col("shingle").alias("its")).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    each = each.join(spread, F.col("shingle") == F.col("its"))
    return each.groupBy(F.col("cid").alias("member")).agg(F.count_if(F.col("low") == F.col("high")).alias("alone"))


def prefixes(classes: DataFrame, settle: Settle) -> DataFrame:
    """(value, cid, size): the first ``PREFIX`` values of each class, the rarest first, without those of one class only."""
    each = classes.select("cid", F.explode("coordinates").alias("value"))
    counts = each.groupBy(F.col("value").alias("its")).agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = settle(each.join(counts, F.col("value") == F.col("its")).select("value", "cid", "size"))
    # the others of a class are its alone and come first
    own = shared.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("size", "value"))).alias("own")).where(F.size("own") > MINIMA - PREFIX)
    return own.select("cid", F.explode(F.slice("own", F.lit(1), F.size("own") - (MINIMA - PREFIX))).alias("one")).select("one.value", "cid", "one.size")


def near_duplicates(documents: DataFrame, settle: Settle, width: int = 4, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document. ``settle`` writes intermediate tables once."""
    documents = narrowed(documents, "doc_id", "text")
    signed = settle(signatures(documents, width))
    classes = signed.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("coordinates").alias("coordinates"), F.first("minima").alias("minima"), F.first("parities").alias("parities"))
    lists = settle(prefixes(classes, settle))
    # a text that others were copied from meets most of them: such members head their lists
    weight = lists.groupBy(F.col("cid").alias("member")).agg(F.sum("size").alias("weight"))
    lists = lists.join(weight, F.col("cid") == F.col("member")).select("value", "cid", "weight")
    heads = lists.groupBy(F.col("value").alias("its")).agg(F.max(F.struct("weight", "cid")).alias("head"), F.count("*").alias("size")).where(F.col("size") > 1)
    lists = settle(lists.join(heads, F.col("value") == F.col("its")).select("value", "cid", F.col("head.cid").alias("head")))
    members = lists.select("cid").distinct().withColumnRenamed("cid", "member")
    own = settle(classes.select("cid", "n_shingles", "minima", "parities").join(members, F.col("cid") == F.col("member"), "left_semi"))
    packed = signed.where(F.col("packed").isNotNull()).select("cid", "packed")
    texts = settle(packed.join(own.select(F.col("cid").alias("member")), F.col("cid") == F.col("member"), "left_semi").groupBy("cid").agg(F.first("packed").alias("packed")))

    pairs = lists.where(F.col("cid") != F.col("head")).select(F.col("cid").alias("a"), F.col("head").alias("b")).distinct()
    edges = settle(alike(pairs, own, texts, width, percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = components(edges, settle)

    placed = lists.join(roots.select(F.col("u").alias("member"), F.col("v").alias("root")), F.col("cid") == F.col("member"), "left").select("value", "cid", "head", F.coalesce("root", "cid").alias("root"))
    mixed = placed.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") != F.col("high")).select(F.col("value").alias("its"))
    open_lists = settle(placed.join(mixed, F.col("value") == F.col("its"), "left_semi"))
    bounds = own.select(F.col("cid").alias("member"), "n_shingles", "parities").join(alone_in(open_lists.select("cid", "root").distinct(), texts, width), "member")
    open_lists = settle(open_lists.join(bounds, F.col("cid") == F.col("member")).where(100 * (F.col("n_shingles") - F.col("alone")) >= percent * F.col("n_shingles")).drop("member"))
    left, right = (open_lists.select(*[F.col(c).alias(f"{c}_{side}") for c in open_lists.columns]) for side in "ab")
    # shingles that no other component has are in no intersection, and in every union
    fits = lambda x, y: 100 * (F.col(f"n_shingles_{x}") - F.col(f"alone_{x}")) >= percent * (F.col(f"n_shingles_{y}") + F.col(f"alone_{x}"))
    apart = (F.col("cid_a") > F.col("cid_b")) & (F.col("root_a") != F.col("root_b"))
    # pairs with the head have been compared
    new = (F.col("cid_a") != F.col("head_b")) & (F.col("cid_b") != F.col("head_b"))
    rest = left.join(right, (F.col("value_a") == F.col("value_b")) & apart & new & fits("a", "b") & fits("b", "a") & close("a", "b", percent)).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct()
    more = settle(alike(rest, own, texts, width, percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not more.isEmpty():
        roots = components(roots.unionByName(more), settle)

    rows = classes.select("cid", "first_id").join(roots.select(F.col("u").alias("member"), F.col("v").alias("root")), F.col("cid") == F.col("member"), "left").select("cid", "first_id", F.coalesce("root", "cid").alias("root"))
    least = rows.groupBy(F.col("root").alias("its")).agg(F.min("first_id").alias("component_id"))
    named = rows.join(least, F.col("root") == F.col("its")).select(F.col("cid").alias("member"), "component_id")
    out = signed.where(F.col("cid").isNotNull()).select("doc_id", "n_shingles", "cid").join(named, F.col("cid") == F.col("member")).select("doc_id", "n_shingles", "component_id")
    alone = signed.where(F.col("cid").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
