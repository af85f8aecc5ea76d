"""Every order of the filters, applied one after the other to each document."""

from itertools import permutations

from dimsmith.llm import filter_audit
from tests.llm.brute import WORD

SCHEMA = "doc_id long, text string, lang string, mask int, part string, n_words int, cells string"


def fails(rows):
    out = []
    for d, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        copy = d is not None and any(e is not None and e < d and (t or "") == text for e, t, _ in rows)
        bad = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text), copy]
        out.append((d, lang or "", {x for x, b in zip("ABCDE", bad) if b}))
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    docs, want = fails(rows), {}
    for part in {p for _, p, _ in docs}:
        own = [(d, f) for d, p, f in docs if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(gone)
                failing = sum(x in f for _, f in own)
                alone = sum(f == {x} for _, f in own)
                want[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), x]
        for key, row in want.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in want.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)
    marks = spark.createDataFrame([(*m, "extra") for m in labels], "doc_id long, quality int, toxic int, text string")
    got = filter_audit.audit(docs, marks).collect()
    assert len({tuple(r)[:3] for r in got}) == len(got)
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}


def test_all_orders_equal_applying_them(spark):
    long = " ".join(f"word{i}" for i in range(250))
    texts = [long, long + " $", long.upper(), "same " * 300, long + " same" * 300, "", None, "short", "SHORT #", long + " A" * 20, "é " + long, "\x0bshort\x0c", " \t\n"]
    rows = [(i, texts[i % len(texts)], ["de", "", None, "en"][i % 4]) for i in range(60)]
    rows += [rows[5], rows[5], (None, long, "de"), (None, long, "de"), (0, "short", "en")]
    labels = [(i, i % 2, i % 3) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (6, None, 1), (None, 1, 1), (999, 1, 1)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [(1, None, None)], []) == brute([(1, None, None)], [])


def test_a_very_long_text(spark):
    text = "Aa bb$ " * 300_000
    assert audited(spark, [(1, text, "en"), (2, text, "en")], [(2, 1, 1)]) == brute([(1, text, "en"), (2, text, "en")], [(2, 1, 1)])


def test_survivors_of_every_subset():
    counts = {mask: (mask * 7 % 11 + 1, mask % 3) for mask in range(0, 32, 3)}
    states = filter_audit.survivors(counts, 5)
    assert len(states) == 32
    for subset, state in enumerate(states):
        assert state == tuple(sum(c[k] for m, c in counts.items() if not m & subset) for k in range(2))
