"""Product codes of vectors by Lloyd's method, with trees over both the parts and the entries.

A vector of integers is cut into equal parts; each part position has a codebook of a few entries.
Tasks cut their rows into blocks and build, for each block and position, a balanced tree over the
block's parts: each node has its bounding box, its number of parts and their sum. The trees are
written once and serve all rounds. The entries of a codebook get a tree of boxes as well.

A round descends both trees together. A pair of nodes has a least and a greatest squared distance
between their boxes. An entry node whose least distance is beyond the smallest greatest one that the
part node has met cannot hold the nearest entry of any of its parts, and the pair is dropped. A part
node that is left with one entry is assigned whole, by its stored sum and count. Leaves that are
uncertain compare their parts with the entries left, in integers. Bounds are integers too and only a
strictly greater one drops a pair, so ties go to the lower index and results are those of comparing
every part with every entry, whatever the blocks.

Tasks return sums and counts by (position, entry, component), added up by Spark before the driver
reads one row for each; a codebook has a fixed size. Blocks survive lost executors, being files.

Nulls: rows whose vector is null or holds null or non-finite components are dropped; so are empty
vectors and those of another length than the vector of the least id (ties: the least vector; rows
without an id come last). Rows without an id or label are coded; null labels are one label.
Repeated rows are each coded, and each is a seed by its own. Fewer rows than entries give smaller
codebooks; no row gives no row. A length that the number of parts does not divide, or a component
beyond ``WIDEST`` once scaled (squared distances would not fit a long), is an error. Other columns are
never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.common import narrowed

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
WIDEST = 1 << 27
#: Vectors of a block, and parts of a leaf at most.
BLOCK, LEAF = 4096, 32
NONE = np.iinfo(np.int64).max

Settle = Callable[[DataFrame], DataFrame]


def scaled(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))


def usable(vectors: DataFrame, scale: int, parts: int) -> DataFrame:
    """(id, label, values) of the vectors that are kept."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    kept = vectors.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(finite)
    first = kept.select(F.size("vector").alias("size"), "id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).first()
    size = first["size"] if first else parts
    if size % parts:
        raise ValueError(f"{parts} equal parts of a vector of {size} components")
    wide = F.exists("vector", lambda x: F.abs(x.cast("double") * scale) > WIDEST)
    values = F.when(wide, F.raise_error(F.lit(f"a component is beyond {WIDEST} / {scale}"))).otherwise(scaled("vector", scale))
    return kept.where(F.size("vector") == size).select("id", "label", values.alias("values"))


def layout(count: int, leaf: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Nodes of a tree over ``count`` rows: (start, end) of each by level, and each one's first child, -1 at leaves.

    A node of more than ``leaf`` rows is halved; its second child follows its first.
    """
    levels, children, total = [np.array([[0, count]])], [], 1
    while True:
        start, end = levels[-1].T
        split = end - start > leaf
        children.append(np.where(split, total + 2 * (np.cumsum(split) - 1), -1))
        if not split.any():
            return levels, np.concatenate(children)
        start, end = start[split], end[split]
        middle = (start + end) // 2
        levels.append(np.stack([start, middle, middle, end], axis=1).reshape(-1, 2))
        total += len(levels[-1])


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of consecutive runs, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Tree:
    """Boxes, sums and sizes of the nodes of a balanced tree; ``order`` lists the rows as leaves hold them."""

    def __init__(self, points: np.ndarray, leaf: int):
        count = len(points)
        levels, self.children = layout(count, leaf)
        self.order = np.arange(count)
        for level in levels:
            level = level[level[:, 1] - level[:, 0] > leaf]
            if len(level):
                sizes = level[:, 1] - level[:, 0]
                at = spans(level[:, 0], sizes)
                own, firsts = points[self.order[at]], np.cumsum(sizes) - sizes
                widths = np.maximum.reduceat(own, firsts) - np.minimum.reduceat(own, firsts)
                node = np.repeat(np.arange(len(level)), sizes)
                self.order[at] = self.order[at][np.lexsort((own[np.arange(len(own)), widths.argmax(axis=1)[node]], node))]
        self.points = points[self.order]
        nodes = np.concatenate(levels)
        self.starts, self.sizes = nodes[:, 0], nodes[:, 1] - nodes[:, 0]
        ended = np.concatenate([self.points, self.points[:1]])  # reduceat takes no end beyond the last row
        self.low, self.high, self.sums = (f.reduceat(ended, nodes.ravel())[::2] for f in (np.minimum, np.maximum, np.add))

    def packed(self) -> dict[str, bytes]:
        return {"order": self.order.astype(np.int32).tobytes(), "points": self.points.astype(np.int32).tobytes(), "boxes": np.concatenate([self.low, self.high, self.sums], axis=1).tobytes()}

    @classmethod
    def unpacked(cls, order: bytes, points: bytes, boxes: bytes, width: int, leaf: int) -> Tree:
        tree = cls.__new__(cls)
        tree.order = np.frombuffer(order, np.int32)
        tree.points = np.frombuffer(points, np.int32).reshape(-1, width).astype(np.int64)
        tree.low, tree.high, tree.sums = np.split(np.frombuffer(boxes, np.int64).reshape(-1, 3 * width), 3, axis=1)
        levels, tree.children = layout(len(tree.order), leaf)
        nodes = np.concatenate(levels)
        tree.starts, tree.sizes = nodes[:, 0], nodes[:, 1] - nodes[:, 0]
        return tree


def pruned(tree: Tree, entries: Tree, nodes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (part node, entry node), sorted by part node, whose distances leave the nearest entry possible."""
    low, high, lower, upper = tree.low[nodes], tree.high[nodes], entries.low[others], entries.high[others]
    gap = np.maximum(np.maximum(lower - high, low - upper), 0)
    reach = np.maximum(high - lower, upper - low)
    least, greatest = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
    starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
    bound = np.repeat(np.minimum.reduceat(greatest, starts), np.diff(np.r_[starts, len(nodes)]))
    left = least <= bound
    return nodes[left], others[left]


def assigned(tree: Tree, entries: np.ndarray, whole: Callable, single: Callable) -> None:
    """Nearest entries of all parts, by descending both trees.

    ``whole(nodes, entries)`` gets nodes assigned as one, ``single(rows, entries, distances)`` places
    in the tree's order, their entries and squared distances.
    """
    of = Tree(entries, 1)
    nodes, others = np.array([0]), np.array([0])
    while len(nodes):
        nodes, others = pruned(tree, of, nodes, others)
        starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        count = np.diff(np.r_[starts, len(nodes)])
        entry = of.children[others] < 0
        sole = (count == 1) & entry[starts]
        if sole.any():
            whole(nodes[starts[sole]], of.order[of.starts[others[starts[sole]]]])
        leaf = tree.children[nodes] < 0
        ready = np.logical_and.reduceat(entry, starts) & leaf[starts] & ~sole
        if ready.any():
            at = np.repeat(ready, count)
            _compared(tree, entries, nodes[at], of.order[of.starts[others[at]]], single)
        on = np.repeat(~sole & ~ready, count)
        nodes, others, entry, leaf = nodes[on], others[on], entry[on], leaf[on]
        # the entries first: boxes of parts shrink slowly, those of entries are few
        down = ~entry
        if down.any():
            nodes, others = _both(nodes, others, of.children, down)
        else:
            others, nodes = _both(others, nodes, tree.children, ~leaf)
            order = np.lexsort((others, nodes))
            nodes, others = nodes[order], others[order]


def _both(kept: np.ndarray, split: np.ndarray, children: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with the second of each replaced by its two children where ``down``."""
    times = np.where(down, 2, 1)
    at = np.repeat(np.arange(len(kept)), times)
    second = np.r_[False, at[1:] == at[:-1]]
    return kept[at], np.where(down[at], children[split[at]] + second, split[at])


def _compared(tree: Tree, entries: np.ndarray, nodes: np.ndarray, others: np.ndarray, single: Callable) -> None:
    """Distances of the parts of leaves to the entries left for each leaf."""
    count = len(entries)
    owners = np.unique(nodes)
    possible = np.zeros((len(owners), count), bool)
    possible[np.searchsorted(owners, nodes), others] = True
    sizes = tree.sizes[owners]
    rows = spans(tree.starts[owners], sizes)
    which = np.repeat(np.arange(len(owners)), sizes)
    best, distance = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
    for k in range(count):
        at = np.flatnonzero(possible[which, k])
        away = tree.points[rows[at]] - entries[k]
        away = (away * away).sum(axis=1)
        nearer = away < distance[at]
        distance[at[nearer]], best[at[nearer]] = away[nearer], k
    single(rows, best, distance)


def totals(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """For each entry: the sum of the parts nearest to it, by component, and their number."""
    out = np.zeros((len(entries), entries.shape[1] + 1), np.int64)

    def whole(nodes, nearest):
        np.add.at(out, nearest, np.concatenate([tree.sums[nodes], tree.sizes[nodes, None]], axis=1))

    def single(rows, nearest, _):
        np.add.at(out, nearest, np.concatenate([tree.points[rows], np.ones((len(rows), 1), np.int64)], axis=1))

    assigned(tree, entries, whole, single)
    return out


def nearest(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row, in the order of the rows."""
    codes, errors = np.zeros(len(tree.order), np.int64), np.zeros(len(tree.order), np.int64)

    def whole(nodes, entry):
        sizes = tree.sizes[nodes]
        rows = spans(tree.starts[nodes], sizes)
        entry = np.repeat(entry, sizes)
        away = tree.points[rows] - entries[entry]
        single(rows, entry, (away * away).sum(axis=1))

    def single(rows, entry, distance):
        codes[tree.order[rows]], errors[tree.order[rows]] = entry, distance

    assigned(tree, entries, whole, single)
    return codes, errors


def blocked(rows: DataFrame, parts: int) -> DataFrame:
    """(members, trees): a row for each block of at most ``BLOCK`` rows of a task, with a tree for each position."""
    tree = pa.list_(pa.struct([(n, pa.binary()) for n in ("order", "points", "boxes")]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                points = block.column("values").flatten().to_numpy().reshape(block.num_rows, -1).astype(np.int64)
                members = pa.StructArray.from_arrays([block.column("id"), block.column("label")], ["id", "label"])
                members = pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), members)
                trees = pa.array([[Tree(part, LEAF).packed() for part in np.split(points, parts, axis=1)]], tree)
                yield pa.RecordBatch.from_arrays([members, trees], ["members", "trees"])

    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    kind = f"members array<struct<id: {id_kind}, label: {label_kind}>>, trees array<struct<order: binary, points: binary, boxes: binary>>"
    return rows.select("id", "label", "values").mapInArrow(build, kind)


def _trees(column: pa.Array, width: int) -> Iterator[list[Tree]]:
    for own in column:
        yield [Tree.unpacked(t["order"], t["points"], t["boxes"], width, LEAF) for t in own.as_py()]


def rounds(blocks: DataFrame, books: np.ndarray, times: int) -> np.ndarray:
    """Codebooks (position, entry, component) after so many assignments of all parts."""
    width = books.shape[2]
    for _ in range(times):

        def add(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            total = np.zeros((*books.shape[:2], width + 1), np.int64)
            for batch in batches:
                for own in _trees(batch.column("trees"), width):
                    for k, tree in enumerate(own):
                        total[k] += totals(tree, books[k])
            at = np.indices(total.shape, np.int32).reshape(3, -1)
            yield pa.RecordBatch.from_arrays([*map(pa.array, at), pa.array(total.ravel())], ["position", "entry", "component", "total"])

        sums = blocks.select("trees").mapInArrow(add, "position int, entry int, component int, total long")
        found = sums.groupBy("position", "entry", "component").agg(F.sum("total").alias("total")).collect()
        total = np.zeros((*books.shape[:2], width + 1), np.int64)
        for r in found:
            total[r["position"], r["entry"], r["component"]] = r["total"]
        count = total[:, :, width:]
        books = np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)
    return books


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, codes, errors) of each row: its entries and squared distances by position."""
    width = books.shape[2]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, own in zip(batch.column("members"), _trees(batch.column("trees"), width)):
                found = [nearest(tree, books[k]) for k, tree in enumerate(own)]
                lists = [np.stack(column, axis=1) for column in zip(*found)]
                offsets = pa.array(np.arange(len(members.values) + 1) * len(own), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in lists]
                yield pa.RecordBatch.from_arrays([*(members.values.field(n) for n in ("id", "label")), *lists], ["id", "label", "codes", "errors"])

    member = blocks.schema["members"].dataType.elementType
    id_kind, label_kind = (member[c].dataType.simpleString() for c in ("id", "label"))
    return blocks.mapInArrow(code, f"id {id_kind}, label {label_kind}, codes array<long>, errors array<long>")


def compressed(vectors: DataFrame, settle: Settle, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, times: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(id, label, codes, errors) of the kept rows of ``vectors`` (id, vector, label), and the codebooks (none without rows)."""
    rows = settle(usable(vectors, scale, parts))
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "values").limit(entries).collect()
    if not seeds:
        return rows.select("id", "label", F.array().cast("array<long>").alias("codes"), F.array().cast("array<long>").alias("errors")), None
    books = np.stack(np.split(np.array([r["values"] for r in seeds], np.int64), parts, axis=1))
    blocks = settle(blocked(rows, parts))
    books = rounds(blocks, books, times)
    return coded(blocks, books), books


def digests(embeddings: DataFrame, settle: Settle) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept row."""
    vectors = narrowed(embeddings, "vec_id", "embedding", "label").toDF("id", "vector", "label")
    rows, books = compressed(vectors, settle)
    text = ",".join(map(str, books.ravel())) if books is not None else ""
    code = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    rows = settle(rows.select("id", "label", code.alias("code"), F.aggregate("errors", F.lit(0).cast("long"), lambda a, b: a + b).alias("error")))
    sums = rows.groupBy(F.col("label").alias("its")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("its")))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
