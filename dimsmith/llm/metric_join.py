"""Exact similarity join of word n-gram sets in the metric space of the Jaccard distance.

Documents whose shingle sets are equal form a class; a class is one point, whatever its size. Two
classes link when their distance is at most a radius r = 1 - percent / 100. Points are brought together
in regions that shrink until they can be compared, and no link is lost on the way:

1. *Outermost regions.* Most documents are at distance 1 from nearly all others, where no pivot
   document tells them apart, so the first pivots are contents of sub-spaces. Hashes cut the shingle
   universe into buckets; what a set has in a bucket is its place there, each place is a region, and
   the window is 0: in all buckets together two linked sets differ by at most ``differences(size)``
   shingles, so of one more buckets that are not empty at least one holds the same in both. A set
   is replicated to its first ``differences + 1`` buckets that are not empty, over the bucket widths of
   its size and, at the boundary, of the next size that a link reaches. Sets with fewer such buckets
   are also posted under their least shingles, as many as a link cannot all miss
2. *Heads.* Each region's members are compared with its head, the one that meets most others. Links
   become components; regions of one component are done, and copies of a text end here
3. *Voronoi regions.* Regions beyond ``LEAF`` members that share some are one crowd. It gets ``PIVOTS``
   pivots, each member its exact distance to each; it is at home with the nearest and, by the triangle
   inequality, also in every region whose pivot is at most 2 r farther: a link of a point at home there
   can be no farther out. Regions go on recursively with pivots of their own, unless the windows
   overlap so much that no work is saved; such a crowd stays whole
4. *Leaves.* Members of different components are paired in a leaf or a small outermost region (in a crowd
   that stayed whole, where they share an outermost region) if sizes, distances to the pivots (apart by at most r) and the
   parities of their sets leave a link possible. These are bounds of links, not caps. Full sets decide

Every link is thus confirmed or within one component. Ties of distances go to the lower pivot. Nothing
is sampled or dropped; a hot region meets partial sums and joins that adaptive execution can split.

A document without words has an empty set and is linked with nothing. Null ids are kept: they are no
candidates for a component's least id unless it has no other. Repeated rows each get their row. An
empty table gives no rows, other columns are never read. The sets of a text of any length are whole.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimsmith.llm.common import MIX, WordHashes, mixed, narrowed
from dimsmith.llm.components import components
from dimsmith.llm.minhash_dedup import class_id, close, parities, shingle_set

WIDTH, PERCENT = 4, 85
PIVOTS, LEAF = 8, 64
#: Buckets of the finer parities, which pairs meet before their texts do.
FINE = 2048
#: Distances are quotients of integers; what rounding may add to a difference of two.
ROUNDING = 1e-9

Settle = Callable[[DataFrame], DataFrame]


def differences(size: int, percent: int) -> int:
    """The most shingles that only one of two linked sets has, one of them of this size and the other not smaller than a link allows."""
    return size * (100 - percent) // percent


def places(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the outermost regions of a set (sorted hashes). Sets that link only with equal ones have none."""
    size, found = len(shingles), []
    most = differences(size, percent)
    if not most:
        return np.empty(0, np.int64)
    # Sizes of a level differ by less than the square root of 2: wide buckets hold few sets alike by chance.
    own, reached = ((n * n).bit_length() for n in (size, size * 100 // percent))
    with np.errstate(over="ignore"):
        for level in range(own, reached + 1):
            largest = isqrt(1 << level)
            buckets = differences(largest, percent) + 1 + largest // 100
            at = ((shingles >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            held = np.add.reduceat(mixed(shingles ^ MIX), starts)[: most + 1]
            found.append(mixed(held + mixed(at[starts[: most + 1]] * MIX + np.uint64(level))))
            if len(starts) <= most:  # every bucket may differ: fall back on single shingles
                least = size - -(-size * percent // 100) + 1
                found.append(mixed(shingles[:least] + np.uint64(level)))
    return np.concatenate(found).view(np.int64)


def fine_parities(shingles: np.ndarray) -> bytes:
    return np.packbits(np.bincount((shingles % np.uint64(FINE)).astype(np.int64), minlength=FINE) & 1).tobytes()


def placed(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, cid, places, parities, fine, packed) of every document; the last four from the first of each class in a task only."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, told, packer = WordHashes(), set(), zstandard.ZstdCompressor(3)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                own = shingle_set(text, width, known)
                cid = class_id(own) if len(own) else None
                if cid is None or cid in told:
                    rows.append((len(own), cid, None, None, None, None))
                    continue
                if len(told) > 1_000_000:
                    told.clear()
                told.add(cid)
                posts = places(own, percent)
                rows.append((len(own), cid, posts, parities(own), fine_parities(own), packer.compress(text.encode())) if len(posts) else (len(own), cid, None, None, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "cid", "places", "parities", "fine", "packed"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInPandas(place, f"doc_id {kind}, n_shingles long, cid binary, places array<long>, parities array<long>, fine binary, packed binary")


def outermost(rows: DataFrame, settle: Settle) -> tuple[DataFrame, DataFrame]:
    """(region, cid) of regions that several classes share, and (cid, n_shingles, parities, fine, packed) of those classes."""
    key = F.xxhash64("cid").alias("key")  # half the size of a class id; what collides is compared
    posts = rows.where(F.col("places").isNotNull()).select(key, F.explode("places").alias("region"))
    same = Window.partitionBy("region")
    posts = posts.withColumns({"low": F.min("key").over(same), "high": F.max("key").over(same)})
    posts = settle(posts.where(F.col("low") != F.col("high")).select("region", "key"))
    keys = posts.select(F.col("key").alias("its")).distinct()
    own = rows.where(F.col("places").isNotNull()).select("cid", "n_shingles", "parities", "fine", "packed").withColumn("key", F.xxhash64("cid"))
    own = own.join(keys, F.col("key") == F.col("its"), "left_semi").groupBy("key", "cid").agg(*[F.first(c).alias(c) for c in ("n_shingles", "parities", "fine", "packed")])
    own = settle(own)
    regions = posts.distinct().join(own.select(F.col("key").alias("its"), "cid"), F.col("key") == F.col("its")).select("region", "cid")
    return settle(regions), own.drop("key")


def side(df: DataFrame, name: str, *columns: str) -> DataFrame:
    return df.select(F.col("cid").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


class Sets(OrderedDict):
    """Shingle sets of packed texts, the last ``most`` kept."""

    def __init__(self, width: int, most: int = 64):
        super().__init__()
        self.width, self.most = width, most
        self.known, self.unpacker = WordHashes(), zstandard.ZstdDecompressor()

    def of(self, packed: bytes, key: bytes | None = None) -> np.ndarray:
        """The set of a text; one with a ``key`` is looked up and kept."""
        if key is not None and key in self:
            self.move_to_end(key)
            return self[key]
        own = shingle_set(self.unpacker.decompress(packed).decode(), self.width, self.known)
        if key is not None:
            self[key] = own
            if len(self) > self.most:
                self.popitem(last=False)
        return own


def common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def possible(percent: int) -> Column:
    """Bounds that every link keeps: of the sizes, and of the parities of both sets."""
    small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    return (100 * small >= percent * large) & close("a", "b", percent)


def confirmed(pairs: DataFrame, own: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v) of the pairs (a, b) that are links."""

    def differ(first: pd.Series, second: pd.Series) -> pd.Series:
        odd = [np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64) for x, y in zip(first, second)]
        return pd.Series(np.bitwise_count(np.stack(odd)).sum(axis=1) if odd else [], dtype="int64")

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Sets(width)
        for batch in batches:
            held = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["packed_a"], batch["packed_b"]):
                first, second = sets.of(x, a), sets.of(y, b)
                both = common(first, second)
                held.append(100 * both >= percent * (len(first) + len(second) - both))
            yield batch.loc[held, ["a", "b"]].rename(columns={"a": "u", "b": "v"})

    near = pairs.join(side(own, "a", "n_shingles", "parities", "fine"), "a").join(side(own, "b", "n_shingles", "parities", "fine"), "b").where(possible(percent))
    total, apart = F.col("n_shingles_a") + F.col("n_shingles_b"), F.pandas_udf(differ, "long")(F.col("fine_a"), F.col("fine_b"))
    near = near.select("a", "b", total.alias("total"), apart.alias("apart")).where(100 * (F.col("total") - F.col("apart")) >= percent * (F.col("total") + F.col("apart"))).select("a", "b")
    full = near.join(side(own, "a", "packed"), "a").join(side(own, "b", "packed"), "b")
    return full.mapInPandas(confirm, "u binary, v binary")


def distances(crowd: DataFrame, pivots: DataFrame, own: DataFrame, width: int) -> DataFrame:
    """(crowd, cid, root, near): each member's distances to the pivots (crowd, slot, pivot) of its crowd, nearest first.

    The pivots of a crowd travel together, so each member's text is read once.
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Sets(width)
        for batch in batches:
            near = []
            for packed, ones in zip(batch["packed"], batch["pivots"]):
                own = sets.of(packed)
                found = []
                for one in ones:
                    other = sets.of(one["packed"], one["pivot"])
                    both = common(own, other)
                    found.append((1 - both / (len(own) + len(other) - both), one["slot"]))
                near.append([{"d": d, "slot": slot} for d, slot in sorted(found)])
            yield batch[["crowd", "cid", "root"]].assign(near=near)

    texts = own.select(F.col("cid").alias("its"), "packed")
    together = pivots.join(texts, F.col("pivot") == F.col("its")).groupBy(F.col("crowd").alias("of")).agg(F.collect_list(F.struct("slot", "pivot", "packed")).alias("pivots")).hint("rebalance")
    rows = crowd.join(texts, F.col("cid") == F.col("its")).select("crowd", "cid", "root", "packed")
    rows = rows.join(together, F.col("crowd") == F.col("of")).select("crowd", "cid", "root", "packed", "pivots")
    return rows.mapInPandas(measure, "crowd long, cid binary, root binary, near array<struct<d: double, slot: int>>")


def rooted(df: DataFrame, roots: DataFrame, column: str = "root") -> DataFrame:
    """``df`` with the least class of each class's component."""
    return df.join(roots.select(F.col("u").alias("its"), F.col("v").alias("of")), F.col("cid") == F.col("its"), "left").select(*df.columns, F.coalesce("of", "cid").alias(column))


def unfinished(members: DataFrame, by: str) -> DataFrame:
    """The members (by, root, ...) of groups that still hold several components."""
    mixed_up = members.groupBy(F.col(by).alias("its")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") != F.col("high"))
    return members.join(mixed_up.select("its"), F.col(by) == F.col("its"), "left_semi")


def crowds(regions: DataFrame, settle: Settle) -> DataFrame:
    """(crowd, cid, root): the members of regions, those of regions that share one in the same crowd."""
    if regions.isEmpty():
        return regions.select(F.col("region").alias("crowd"), "cid", "root")
    firsts = regions.groupBy(F.col("region").alias("its")).agg(F.min("cid").alias("first"))
    joined = regions.join(firsts, F.col("region") == F.col("its")).select(F.col("cid").alias("u"), F.col("first").alias("v")).distinct()
    together = components(settle(joined), settle)
    return rooted(regions.select("cid", "root").distinct(), together, "first").select(F.xxhash64("first").alias("crowd"), "cid", "root")


def voronoi(crowd: DataFrame, own: DataFrame, settle: Settle, width: int, percent: int, pivots: int, leaf: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """One level of regions: those that go on, and those that stay whole, of members (crowd, cid, root) beyond a leaf.

    The first result is (crowd, cid, root), the second has also ``away``, the distances to the pivots.
    """
    slot = F.pmod(F.xxhash64("root", F.lit(depth)), F.lit(pivots)).cast("int")
    chosen = crowd.groupBy("crowd", slot.alias("slot")).agg(F.min_by("cid", F.xxhash64("cid", F.lit(depth))).alias("pivot"))
    away = settle(distances(crowd, chosen, own, width))
    reach = F.col("near")[0]["d"] + 2 * (100 - percent) / 100 + ROUNDING
    inside = away.select("crowd", "cid", "root", F.explode(F.filter("near", lambda p: p["d"] <= reach)).alias("one"))
    inside = inside.select("crowd", "cid", "root", "one.slot")
    sizes = inside.groupBy("crowd", "slot").agg(F.count("*").cast("double").alias("n")).groupBy(F.col("crowd").alias("its")).agg(F.sum(F.col("n") * F.col("n")).alias("work"))
    wholes = away.groupBy(F.col("crowd").alias("of")).agg(F.count("*").cast("double").alias("n"))
    split = settle(sizes.join(wholes, F.col("its") == F.col("of")).select("its", (2 * F.col("work") <= F.col("n") * F.col("n")).alias("splits")))
    on = inside.join(split.where("splits"), F.col("crowd") == F.col("its"), "left_semi").select(F.xxhash64("crowd", "slot", F.lit(depth)).alias("crowd"), "cid", "root")
    by_slot = F.transform(F.array_sort(F.transform("near", lambda p: F.struct(p["slot"], p["d"]))), lambda p: p["d"])
    whole = away.join(split.where(~F.col("splits")), F.col("crowd") == F.col("its"), "left_semi").select("crowd", "cid", "root", by_slot.alias("away"))
    return on, whole


def paired(members: DataFrame, own: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b) of members of different components that meet under the same keys and may be links. ``away`` are distances to common pivots."""
    bounds = own.select(F.col("cid").alias("its"), "n_shingles", "parities")
    rows = members.join(bounds, F.col("cid") == F.col("its")).drop("its")
    left, right = (rows.select(*[F.col(c).alias(f"{c}_{name}") for c in rows.columns]) for name in "ab")
    meet = F.lit(True)
    for key in keys:
        meet = meet & (F.col(f"{key}_a") == F.col(f"{key}_b"))
    ring = (100 - percent) / 100 + ROUNDING
    near = F.forall(F.zip_with("away_a", "away_b", lambda x, y: F.abs(x - y)), lambda d: d <= ring)
    rest = (F.col("cid_a") > F.col("cid_b")) & (F.col("root_a") != F.col("root_b")) & possible(percent) & near
    return left.join(right, meet & rest).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct()


def links(regions: DataFrame, own: DataFrame, settle: Settle, width: int, percent: int, pivots: int = PIVOTS, leaf: int = LEAF) -> DataFrame:
    """(u, v) of each class u that is not the least of its component v."""
    sizes = regions.groupBy(F.col("region").alias("its")).agg(F.count("*").alias("size"))
    weight = regions.join(sizes, F.col("region") == F.col("its")).groupBy(F.col("cid").alias("member")).agg(F.sum("size").alias("weight"))
    weighed = regions.join(weight, F.col("cid") == F.col("member")).select("region", "cid", "weight")
    heads = weighed.groupBy(F.col("region").alias("its")).agg(F.max(F.struct("weight", "cid")).alias("head"))
    to_heads = settle(regions.join(heads, F.col("region") == F.col("its")).where(F.col("cid") != F.col("head.cid")).select(F.col("cid").alias("a"), F.col("head.cid").alias("b")).distinct())
    roots = components(settle(confirmed(to_heads, own, width, percent)), settle)

    open_regions = settle(unfinished(rooted(regions, roots), "region"))
    if open_regions.isEmpty():
        return roots
    nowhere = F.array().cast("array<double>").alias("away")
    counts = open_regions.groupBy(F.col("region").alias("its")).agg(F.count("*").alias("n"))
    small = open_regions.join(counts.where(F.col("n") <= leaf), F.col("region") == F.col("its"), "left_semi")
    found = [paired(small.select("region", "cid", "root", nowhere), own, ["region"], percent)]
    large_regions = settle(open_regions.join(counts.where(F.col("n") > leaf), F.col("region") == F.col("its"), "left_semi"))
    depth, crowd = 0, settle(crowds(large_regions, settle))
    while not crowd.isEmpty():
        counts = crowd.groupBy(F.col("crowd").alias("its")).agg(F.count("*").alias("n"))
        small = crowd.join(counts.where(F.col("n") <= leaf), F.col("crowd") == F.col("its"), "left_semi")
        found.append(paired(small.select("crowd", "cid", "root", nowhere), own, ["crowd"], percent))
        large = settle(unfinished(crowd.join(counts.where(F.col("n") > leaf), F.col("crowd") == F.col("its"), "left_semi"), "crowd"))
        if large.isEmpty():
            break
        depth += 1
        crowd, whole = voronoi(large, own, settle, width, percent, pivots, leaf, depth)
        crowd = settle(crowd)
        again = whole.join(large_regions.select(F.col("cid").alias("its"), "region"), F.col("cid") == F.col("its")).drop("its")
        found.append(paired(again, own, ["crowd", "region"], percent))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    new = settle(confirmed(pairs.distinct(), own, width, percent))
    return roots if new.isEmpty() else components(roots.unionByName(new), settle)


def joined(documents: DataFrame, settle: Settle, width: int = WIDTH, percent: int = PERCENT, pivots: int = PIVOTS, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document. ``settle`` writes intermediate tables once."""
    rows = settle(placed(narrowed(documents, "doc_id", "text"), width, percent))
    regions, own = outermost(rows, settle)
    roots = links(regions, own, settle, width, percent, pivots, leaf)
    named = rooted(rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("doc_id").alias("first_id")), roots)
    least = named.groupBy(F.col("root").alias("its")).agg(F.min("first_id").alias("component_id"))
    named = settle(named.join(least, F.col("root") == F.col("its")).select(F.col("cid").alias("member"), "component_id"))
    out = rows.where(F.col("cid").isNotNull()).select("doc_id", "n_shingles", "cid").join(named, F.col("cid") == F.col("member")).select("doc_id", "n_shingles", "component_id")
    return out.unionByName(rows.where(F.col("cid").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
