import random

import pytest

from loomgate.llm import mixing as M

SIZES = "doc_id bigint, source string, tokens bigint"
TARGETS = "source string, target_share double, max_repeats int"


def test_rounding_keeps_the_sum_and_is_unbiased():
    r = random.Random(1)
    w = [r.randrange(1, 500) for _ in range(200)]
    p = [r.random() for _ in w]
    mean = [0.0] * len(w)
    for seed in range(300):
        q = M.round_pairs(p, w, seed)
        assert sum(0 < x < 1 for x in q) <= 1 and all(0 <= x <= 1 for x in q)
        assert sum(a * b for a, b in zip(q, w)) == pytest.approx(sum(a * b for a, b in zip(p, w)), rel=1e-6)
        mean = [m + x / 300 for m, x in zip(mean, q)]
    assert sum(abs(a - b) for a, b in zip(mean, p)) / len(p) < 0.05
    assert M.round_pairs([], [], 0) == [] and M.round_pairs([0.0, 1.0], [1, 1], 0) == [0.0, 1.0]


def test_shares_and_caps(spark):
    r = random.Random(2)
    rows = [(i, "big" if i % 3 else "small", r.randrange(50, 400)) for i in range(6000)] + [(10_000, "tiny", 300), (10_001, "tiny", 0), (10_002, "other", 50), (10_003, None, 9)]
    sizes = spark.createDataFrame(rows, SIZES)
    targets = spark.createDataFrame([("Big", 0.5, 1), ("small ", 0.47, 3), ("tiny", 0.001, 1000), ("absent", 0.02, 2), (None, 0.1, 1)], TARGETS)
    M.BUCKET_DOCS, kept = 500, M.BUCKET_DOCS
    try:
        planned = M.plan(sizes, targets)
        got = M.copies(sizes, planned).collect()
        again = M.copies(sizes, planned).collect()
    finally:
        M.BUCKET_DOCS = kept
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    total = sum(x.tokens * x.copies for x in got)
    for s, share, cap in (("big", 0.5, 1), ("small", 0.47, 3), ("tiny", 0.001, 1000)):
        mine = [x for x in got if x.source == s]
        assert sum(x.tokens * x.copies for x in mine) / total == pytest.approx(share / 0.971, abs=0.0015)
        assert max(x.copies for x in mine) <= cap
    assert {x.source for x in got} == {"big", "small", "tiny"} and all(x.doc_id != 10_001 for x in got)


def test_total_beyond_the_caps(spark):
    sizes = spark.createDataFrame([(1, "a", 100), (2, "b", 100)], SIZES)
    planned = M.plan(sizes, spark.createDataFrame([("a", 0.9, 2), ("b", 0.1, 5)], TARGETS), total=1000)
    assert {x.source: x.copies for x in M.copies(sizes, planned).collect()} == {"a": 2, "b": 1}


def test_nothing_to_mix(spark):
    sizes = spark.createDataFrame([], SIZES)
    assert M.copies(sizes, M.plan(sizes, spark.createDataFrame([("a", 1.0, 1)], TARGETS))).count() == 0
    some = spark.createDataFrame([(1, "a", 5)], SIZES)
    assert M.copies(some, M.plan(some, spark.createDataFrame([], TARGETS))).count() == 0


def test_long_text_is_cut_without_loss(monkeypatch):
    """Pieces give the text back, and the tokens of the whole; a stretch without a boundary is not cut."""
    monkeypatch.setattr(M, "PIECE_CHARS", 50)
    r = random.Random(4)
    texts = ["word " * 40 + "x" * 450 + " end", "\n\n  two   blanks\t" * 30, "it's 12 o'clock -- don't " * 30, "".join(r.choice("ab 'é1\n.") for _ in range(3_000)), "", "y" * 500]
    assert all("".join(M.pieces(t)) == t for t in texts) and len(list(M.pieces(texts[2]))) > 5
    encode = M.encoder(M.TOKENIZER)
    assert [[t for p in M.pieces(text) for t in encode(p)] for text in texts] == [encode(text) for text in texts]


def test_found_tables(spark, tables, small, rows):
    names = ["documents", "mix_targets"]
    want = rows(M.mix(spark, small))
    assert rows(M.mix(spark, tables.clashing(names))) == want and rows(M.mix(spark, tables.repeated(names))) == want
    assert M.mix(spark, tables.empty(names)).count() == 0
    M.mix(spark, tables.one_null_each(names)).count()
    assert sum(r.reached_share for r in M.shares(spark, small).collect()) == pytest.approx(1)
