"""Vector codes against plain nearest entries, with ties, repeats, nulls and non-finite components."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimsmith.llm import catalog, vector_codes
from dimsmith.session import settle

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, label_error int"


def brute(rows, entries=16, parts=8, rounds=6):
    """rows: (vec_id, embedding, label), by (vec_id, embedding); results in the same order."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    points = [[math.floor(float(np.float32(x)) * 4096) for x in r[1]] for r in kept]
    width = len(points[0]) // parts
    cut = [[p[k * width : (k + 1) * width] for p in points] for k in range(parts)]
    books = [[list(p) for p in own[:entries]] for own in cut]

    def nearest(p, book):
        away = [sum((x - y) ** 2 for x, y in zip(p, e)) for e in book]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        for own, book in zip(cut, books):
            groups = [[] for _ in book]
            for p in own:
                groups[nearest(p, book)[0]].append(p)
            book[:] = [[sum(x) // len(g) for x in zip(*g)] if g else e for g, e in zip(groups, book)]
    found = [[nearest(p, book) for p in own] for own, book in zip(cut, books)]
    errors = [sum(f[i][1] for f in found) for i in range(len(kept))]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{f[i][0]:02x}" for f in found), errors[i], by_label[r[2]], digest) for i, r in enumerate(kept))


def got(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [x if x is not None else -math.inf for x in r[1] or []]))


@pytest.mark.parametrize("count", [0, 5, 16, 700])
def test_codes_of_small_tables(spark, count):
    draw = np.random.default_rng(count)
    rows = [(int(i), [float(x) for x in np.float32(draw.integers(-3, 4, 16) / 8)], [1, 2, None][i % 3]) for i in draw.permutation(count)]
    odd = [(900, None, 1), (901, [None] + [0.5] * 15, 1), (902, [math.nan] * 16, 1), (903, [math.inf] * 16, 2), (904, [], 1), (905, [0.0] * 8, 1)]
    if count:
        odd += [(3, [0.25] * 16, 1), (3, [0.25] * 16, 1), (None, [-0.0001] * 16, None)]
    df = spark.createDataFrame([(*r, "x", "y", 7) for r in rows + odd], SCHEMA)
    if not count:
        assert vector_codes.digests(df.where("vec_id < 905"), settle).collect() == []
        return
    assert got(vector_codes.digests(df, settle)) == brute(ordered([r for r in rows + odd if r[0] != 905]))


def test_codes_of_the_table(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(catalog.op13_vector_codes(spark, data_dir)) == brute(ordered(rows))


def test_uneven_parts_and_wide_components_are_errors(spark):
    wide = spark.createDataFrame([(1, [1e30] * 16, 1, "", "", 1)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        vector_codes.digests(wide, settle)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.digests(wide.withColumn("embedding", F.slice("embedding", 1, 9)), settle)


@pytest.mark.parametrize("seed", range(6))
def test_trees_assign_as_comparing_everything(seed):
    draw = np.random.default_rng(seed)
    centres = draw.integers(-4000, 4000, (6, 4))
    points = centres[draw.integers(0, 6, 3000)] + draw.integers(-20, 21, (3000, 4)) // (1 + seed * 4)
    entries = np.concatenate([centres, points[:5], points[:2]])
    away = ((points[:, None] - entries) ** 2).sum(axis=2)
    tree = vector_codes.Tree(points, vector_codes.LEAF)
    tree = vector_codes.Tree.unpacked(**tree.packed(), width=4, leaf=vector_codes.LEAF)
    codes, errors = vector_codes.nearest(tree, entries)
    assert (codes == away.argmin(axis=1)).all() and (errors == away.min(axis=1)).all()
    total = vector_codes.totals(tree, entries)
    assert total[:, -1].tolist() == np.bincount(codes, minlength=len(entries)).tolist()
    assert (total[:, :4] == [points[codes == k].sum(axis=0) for k in range(len(entries))]).all()


def test_clusters_are_assigned_whole():
    draw = np.random.default_rng(1)
    centres = draw.integers(-4000, 4000, (8, 4))
    points = centres[draw.integers(0, 8, 4096)] + draw.integers(-20, 21, (4096, 4))
    whole, single = [], []
    tree = vector_codes.Tree(points, vector_codes.LEAF)
    vector_codes.assigned(tree, centres, lambda nodes, _: whole.append(tree.sizes[nodes].sum()), lambda rows, *_: single.append(len(rows)))
    assert sum(whole) + sum(single) == 4096 and sum(whole) > 3000


@pytest.mark.parametrize("count, leaf", [(1, 1), (2, 1), (5, 1), (16, 1), (33, 32), (65, 32), (4096, 32)])
def test_children_halve_their_node(count, leaf):
    levels, children = vector_codes.layout(count, leaf)
    nodes = np.concatenate(levels)
    for (start, end), child in zip(nodes, children):
        if child < 0:
            assert 1 <= end - start <= leaf
        else:
            assert nodes[child, 0] == start and nodes[child, 1] == nodes[child + 1, 0] and nodes[child + 1, 1] == end
