"""One key with a third of all rows: no group, range or salt holds more than a task's rows, and results stay whole."""

import random

import pytest
from pyspark.sql import functions as F

from loomgate import runtime
from loomgate.operators import jobs, usage
from loomgate.operators.rekey import mapping, rewrite

TASK = 50


@pytest.fixture(scope="module")
def hot(spark):
    """600 rows: 200 of one key, 100 without a key, the rest spread."""
    r = random.Random(1)
    rows = [(i, 7 if i % 3 == 0 else None if i % 6 == 1 else 100 + r.randrange(80), r.randrange(1, 9)) for i in range(600)]
    return spark.createDataFrame(rows, "id bigint, k bigint, v bigint")


def test_hot_keys_get_salts_by_their_count(hot):
    assert {tuple(r) for r in runtime.hot_keys(hot, "k", TASK).collect()} == {(7, 4)}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_join(spark, hot, how):
    index = spark.createDataFrame([(k, f"n{k}") for k in [7, *range(100, 160)]], "k bigint, name string")
    want = sorted(tuple(r) for r in hot.join(index, "k", how).select("id", "k", "v", "name").collect())
    got = sorted(tuple(r) for r in runtime.salted_join(hot, index, "k", how, TASK).select("id", "k", "v", "name").collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_running_sum_over_ranges(hot):
    rows = sorted((r.k, r.id, r.v) for r in hot.where("k is not null").collect())
    want, at = {}, {}
    for k, i, v in rows:
        at[k] = want[i] = at.get(k, 0) + v
    got = runtime.running_sum(hot.where("k is not null"), ["k"], ["id"], "v", "s", TASK)
    assert {r.id: r.s for r in got.collect()} == want
    ranged, n = runtime.in_ranges(hot, ["k"], ["id"], TASK)
    assert n == 12 and max(r["count"] for r in ranged.groupBy("__range").count().collect()) <= 3 * TASK


def test_mapping_and_rewrite_by_shuffle(spark, hot, monkeypatch):
    m = mapping(hot, "k", 1_000, TASK)
    keys = sorted(r.k for r in hot.where("k is not null").collect())
    want = {k: 1_000 + i for i, k in enumerate(keys)}  # the last index of a key holds
    assert {r.old_sid: r.new_sid for r in m.collect()} == want
    expected = sorted((r.id, want.get(r.k)) for r in hot.collect())
    assert sorted((r.id, r.k) for r in rewrite(hot, {"k": m}).collect()) == expected
    import loomgate.operators.rekey as rekey

    monkeypatch.setattr(rekey, "bounded_broadcast", lambda df: (df, False))
    assert sorted((r.id, r.k) for r in rewrite(hot, {"k": m}, TASK).collect()) == expected


def test_last_state_across_ranges(spark):
    r = random.Random(2)
    rows = [(1 if r.random() < 0.5 else r.randrange(2, 9), i, r.choice(["state", "fail", "other"]), f"s{i}") for i in range(500)] + [(None, 999, "fail", "x")]
    frame = spark.createDataFrame(rows, "g int, id bigint, kind string, s string")
    want, last = {}, {}
    for g, i, kind, s in rows[:-1]:
        if kind == "fail":
            want[i] = last.get(g)
        if kind == "state":
            last[g] = s
    got = jobs.last_state_before(frame, "g", "id", F.col("kind") == "fail", F.col("kind") == "state", "s", TASK)
    assert {x.id: x.state for x in got.collect()} == want


def test_sweep_over_ranges_of_one_day(spark):
    r = random.Random(3)
    rows = [(i, r.randrange(0, 40_000), r.randrange(1, 5_000), r.randrange(1, 17)) for i in range(300)] * 2
    runs = spark.createDataFrame(rows, "run bigint, a bigint, n bigint, cores bigint").selectExpr("run", "timestamp_seconds(a) started_at", "if(run % 10 = 0, null, timestamp_seconds(a + n)) stopped_at", "cores")
    one = sorted(tuple(x) for x in usage.concurrency(runs).collect())
    many = sorted(tuple(x) for x in usage.concurrency(runs, task_rows=TASK).collect())
    assert one == many and len(one) == 2 * 300 + 2 * 270


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(runtime.NoSharedFolder):
        runtime.shared_root(Session)
