"""What a task's Python holds at once, and that results do not depend on it."""

import random

import numpy as np
import pandas as pd
import public_tokenizers

from dimsmith.llm import byte_bpe, minhash_dedup, repeats


def test_texts_are_taken_apart_in_slices():
    sizes = [len(b) for b in repeats.in_slices(iter([pd.DataFrame({"a": range(3 * repeats.TEXTS + 1)})]))]
    assert sizes == [repeats.TEXTS] * 3 + [1]


def test_common_prefixes_do_not_depend_on_how_many_are_compared_at_once(monkeypatch):
    draw = random.Random(3)
    passage = bytes(draw.choices(b"ab", k=160))
    texts = [passage[draw.randrange(20) :] for _ in range(12)]
    whole = repeats.suffixes(texts, 100)
    monkeypatch.setattr(repeats, "COMPARED", 7)
    assert len(whole[3]) > 7 and all(np.array_equal(a, b) for a, b in zip(whole, repeats.suffixes(texts, 100)))


def test_documents_are_signed_in_slices(spark):
    rows = [(i, f"one two three four five {i % 700}") for i in range(2 * minhash_dedup.SIGNED + 5)]
    signed = minhash_dedup.signatures(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 4)
    assert signed.count() == len(rows) and signed.select("cid").distinct().count() == 700


def test_short_pieces_merge_as_long_ones(monkeypatch):
    draw = random.Random(5)
    ranks = {bytes([c]): c for c in range(256)}
    for _ in range(400):
        ranks.setdefault(bytes(draw.choices(b"abc", k=draw.randint(2, 6))), len(ranks))
    pieces = [bytes(draw.choices(b"abcd", k=draw.randint(2, byte_bpe.SHORT))) for _ in range(400)]
    short = [byte_bpe.merge(p, ranks, 6) for p in pieces]
    monkeypatch.setattr(byte_bpe, "SHORT", 0)
    assert short == [byte_bpe.merge(p, ranks, 6) for p in pieces]


def test_round_trip_is_encode_and_decode(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = [None, "", "a", "naïve  日本 \n\n don't", *(f"word{i} and {i * i}" for i in range(2 * byte_bpe.TEXTS))]
    rows = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, both string").coalesce(1)
    plain = byte_bpe.decode(byte_bpe.encode(rows, path, public_tokenizers.PATTERN), path)
    found = byte_bpe.round_trip(rows, path, public_tokenizers.PATTERN)
    assert found.columns == plain.columns and found.orderBy("doc_id").collect() == plain.orderBy("doc_id").collect()
    assert byte_bpe.round_trip(rows.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_the_pipeline_encodes_and_decodes_in_one_worker(spark):
    import corpus_pipeline

    rows = spark.createDataFrame([(1, "en", "web", "some text")], "doc_id long, lang string, source string, text string")
    out = corpus_pipeline.tokens(spark, rows, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and [r.round_trip for r in out.collect()] == [True]
