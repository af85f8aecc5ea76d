"""The metric join against comparing all pairs: crowds around the threshold, repeats, nulls, clashing names."""

import numpy as np
import pytest

from dimsmith.llm import catalog, metric_join
from dimsmith.session import settle
from tests.llm import brute
from tests.llm.test_operators import frame


def crowd(draw, size, words, most, vocabulary=5000):
    """Copies of one text, each with up to ``most`` words replaced."""
    base = [f"w{x}" for x in draw.integers(0, vocabulary, words)]
    out = []
    for _ in range(size):
        own = list(base)
        for at in draw.integers(0, words, draw.integers(0, most + 1)):
            own[at] = f"x{draw.integers(0, vocabulary)}"
        out.append(" ".join(own))
    return out


def fixture(seed):
    draw = np.random.default_rng(seed)
    texts = [t for size, words, most in ((60, 90, 6), (40, 30, 2), (30, 300, 12), (25, 9, 1), (12, 1200, 60)) for t in crowd(draw, size, words, most)]
    texts += [t for _ in range(30) for t in crowd(draw, 2, 40, 2)]
    passage = texts[0]
    texts += [f"{passage} {' '.join(f'y{x}' for x in draw.integers(0, 5000, n))}" for n in (1, 2, 5, 10, 13, 15, 20, 200) for _ in range(4)]
    texts += ["", " \t\n", "one", "ONE", "one two", "a b c d", "A b C d", "a b c d e", None]
    rows = [(int(i), texts[k]) for i, k in enumerate(draw.permutation(len(texts)))]
    return [*rows, rows[3], rows[3], (9000, texts[0].upper().replace("W", "w"))]


@pytest.mark.parametrize("pivots, leaf", [(8, 64), (3, 2)])
def test_components_equal_comparing_all_pairs(spark, pivots, leaf):
    rows = fixture(leaf)
    want = brute.near(rows, 4, 85)
    got = metric_join.joined(frame(spark, rows), settle, pivots=pivots, leaf=leaf).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert sum(top != d for d, (_, top) in want.items()) > 80


def test_null_ids_and_empty_table(spark):
    rows = [(None, "one two three four five"), (7, "one two three four five"), (8, "one two three four five"), (None, "alone in the world it is"), (None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in metric_join.joined(frame(spark, rows), settle).collect()), key=repr)
    assert got == sorted([(None, 2, 7), (7, 2, 7), (8, 2, 7), (None, 3, None), (None, 0, None)], key=repr)
    assert metric_join.joined(frame(spark, rows).limit(0), settle).collect() == []


def test_components_of_the_table(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.op12_metric_join(spark, data_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near(rows, 4, 85)


@pytest.mark.parametrize("clumped", [False, True])
def test_linked_sets_share_an_outermost_region(clumped):
    draw = np.random.default_rng(11)
    top = 1 << (20 if clumped else 63)  # clumped: all in one bucket
    met = 0
    for _ in range(1500):
        size = int(draw.integers(2, 400))
        most = metric_join.differences(size, 85)
        base = np.unique(draw.integers(0, top, size, dtype=np.uint64))
        gone = draw.integers(0, most + 1)
        other = np.unique(np.r_[draw.permutation(base)[gone:], draw.integers(0, top, most - gone, dtype=np.uint64)])
        both = len(np.intersect1d(base, other))
        if 100 * both >= 85 * (len(base) + len(other) - both) and both < max(len(base), len(other)):
            assert set(metric_join.places(base, 85)) & set(metric_join.places(other, 85))
            met += 1
    assert met > 200


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_bound_of_differences(percent):
    for a in range(1, 120):
        for b in range(a, a * 100 // percent + 1):
            both = -(-percent * (a + b) // (100 + percent))
            if both <= a:
                assert a + b - 2 * both <= min(metric_join.differences(a, percent), metric_join.differences(b, percent))
