"""The registered queries over whole tables against plain versions and SQL."""

import duckdb
import pytest

from dimsmith.llm import catalog, chat_format
from tests.llm import brute


@pytest.fixture(scope="module")
def documents(data_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{data_dir}/documents.parquet'").fetchall()


def test_near_duplicates_of_the_table(spark, data_dir, documents):
    want = brute.near([(d, t) for d, t, _ in documents])
    got = catalog.op8_minhash_dedup(spark, data_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_repeats_of_the_table(spark, data_dir, documents):
    got = catalog.op7_repeats(spark, data_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeats([(d, t) for d, t, _ in documents])


def test_held_out_languages(spark, data_dir, documents):
    langs = {d: lang for d, _, lang in documents}
    held = [r for r in catalog.op4_language_id(spark, data_dir).collect() if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_licenses_equal_sql(spark, data_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data_dir}/documents.parquet'")
    got = [tuple(r) for r in catalog.op6_license_scan(spark, data_dir).collect()]
    assert sorted(got) == sorted(con.execute(catalog.oracles()["op6_license_scan"]).fetchall())


def test_pipeline(spark, data_dir, documents):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "personal_data", "byte_bpe"]
    rows = corpus_pipeline.run(spark, data_dir).collect()
    kept = {r.doc_id for r in rows}
    groups = {d: top for d, (_, top) in brute.near([(d, t) for d, t, _ in documents], 5).items()}
    items = [t for (t,) in duckdb.sql(f"SELECT text FROM '{data_dir}/benchmark.parquet'").fetchall()]
    leaks = {d for d, t, _ in documents if any(i in t for i in items)}
    first = {d for d, top in groups.items() if d == top}
    assert kept == first - leaks and all(r.round_trip for r in rows)


def test_chats_of_the_table(spark, data_dir):
    """The digests come out of the fold of drafts, deltas, edits and regenerations."""
    rows = duckdb.sql(f"SELECT conv_id, turn, role, coalesce(text, '') FROM '{data_dir}/conversations.parquet' ORDER BY conv_id, turn").fetchall()
    rows += [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    chats = {}
    for conv, _, role, text in rows:
        chats.setdefault(conv, []).append((role, text))
    want = {}
    for conv, turns in chats.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want[conv] = (len(turns), brute.sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), brute.sha(loss))
    got = catalog.op10_chat_format(spark, data_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    types = {r.type for r in chat_format.turns_as_events(catalog.table(spark, data_dir, "conversations")).select("type").distinct().collect()}
    assert types == {"message", "delta", "regenerate", "edit"}


def test_filter_audit_equals_sql(spark, data_dir):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    got = catalog.op11_filter_audit(spark, data_dir)
    want = con.execute(catalog.oracles()["op11_filter_audit"])
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())
