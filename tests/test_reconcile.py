import random

import pytest

from loomgate.operators import reconcile

SCHEMA = "k1 string, k2 string, a bigint, b string"


def sides(seed, n=3000):
    r = random.Random(seed)
    base = {("hot" if r.random() < 0.34 else f"r{r.randrange(200)}", f"t{i}"): (r.randrange(9), r.choice(["x", None, "y"])) for i in range(n)}
    left, right = dict(base), dict(base)
    for k in r.sample(sorted(base), 60):
        what = r.randrange(4)
        if what == 0:
            left.pop(k)
        elif what == 1:
            right.pop(k)
        elif what == 2:
            right[k] = (right[k][0] + 1, right[k][1])
        else:
            left[k] = (None, "z")
    return left, right


def brute(left, right):
    out = {(*k, "only_left") for k in left.keys() - right.keys()} | {(*k, "only_right") for k in right.keys() - left.keys()}
    for k in left.keys() & right.keys():
        out |= {(*k, n) for n, x, y in zip("ab", left[k], right[k]) if x != y}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    left, right = sides(seed)
    frame = lambda d: spark.createDataFrame([(*k, *v) for k, v in d.items()], SCHEMA)
    got = reconcile.differences(frame(left), frame(right), ["k1", "k2"], ["a", "b"])
    assert {tuple(r) for r in got.collect()} == brute(left, right)


def test_only_changed_chunks_are_compared(spark):
    rows = [("r", f"t{i:05d}", i, "x") for i in range(20_000)]
    left = spark.createDataFrame(rows, SCHEMA)
    right = spark.createDataFrame([(a, b, c + (b == "t00777"), d) for a, b, c, d in rows], SCHEMA)
    a, b = (reconcile.chunked(x, ["k1", "k2"], ["a", "b"], 1) for x in (left, right))
    rest = a.join(b.select("bucket", "chunk").distinct(), ["bucket", "chunk"], "left_anti").count()
    assert 1 <= rest < 2_000


def test_an_added_row_disturbs_its_own_chunk_only(spark):
    rows = [("r", f"t{i:05d}", i, "x") for i in range(20_000)]
    left = spark.createDataFrame(rows, SCHEMA)
    right = spark.createDataFrame([*rows, ("r", "t00500a", 1, None)], SCHEMA)
    a, b = (reconcile.chunked(x, ["k1", "k2"], ["a", "b"], 1) for x in (left, right))
    assert a.join(b.select("bucket", "chunk").distinct(), ["bucket", "chunk"], "left_anti").count() < 2_000


def test_one_side_empty(spark):
    left = spark.createDataFrame([("a", "b", None, None), (None, "x", 1, "y")], SCHEMA)
    right = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in reconcile.differences(left, right, ["k1", "k2"], ["a", "b"]).collect()] == [("a", "b", "only_left")]


def test_latest_attempt_and_spellings(spark):
    results = spark.createDataFrame(
        [(1, "run", "dbo.tLayer", 5, " AB ", "2025-01-01"), (2, "run", "[dbo].[TLAYER]", 6, "cd", "2025-01-02"), (3, "run", "tX", None, None, None), (4, "run", None, 1, "q", None)],
        "result_id bigint, run_id string, table_name string, rows_extracted bigint, table_checksum string, finished_at string")
    got = {(r.table_key, r.rows, r.checksum) for r in reconcile.result_figures(results).collect()}
    assert got == {("tlayer", 6, "cd"), ("tx", None, None)}
