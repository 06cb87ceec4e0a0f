"""The ledger against a direct reading of the definition."""

import random
from datetime import datetime, timedelta

import pytest

from loomgate.operators import orphans

T0 = datetime(2025, 1, 1)
REF = "ref_field string, record_id bigint, ref_key string, parent_key string, at timestamp_ntz, table_key string"
FACT = "parent_key string, live_from timestamp_ntz, live_to timestamp_ntz"


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def make(seed, n=300):
    r = random.Random(seed)
    key = lambda: "hot" if r.random() < 0.34 else f"k{r.randrange(40)}"
    refs = [("f", i, k, k, day(r.randrange(100)), "t") for i in range(n) for k in [key()]]
    facts = []
    for _ in range(60):
        a = r.randrange(100)
        facts.append((key(), day(a), day(a + r.randrange(1, 40)) if r.random() < 0.5 else None))
    facts = [f for f in facts if f[0] != "k7"]
    return refs, facts


def brute(refs, facts):
    out = set()
    for f, i, k, _, at, _ in refs:
        mine = [x for x in set(facts) if x[0] == k]
        if any(a <= at and (b is None or b > at) for _, a, b in mine):
            continue
        out.add((f, i, k, "missing" if not mine else "late" if all(a > at for _, a, _ in mine) else "deleted"))
    return out


def opened(ledger):
    return {(r.ref_field, r.record_id, r.ref_key, r.orphan_kind) for r in ledger.pending.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_definition(spark, seed):
    refs, facts = make(seed)
    ledger = orphans.replay(spark, spark.createDataFrame(refs, REF), spark.createDataFrame(facts, FACT))
    assert opened(ledger) == brute(refs, facts)


def test_any_batch_order_gives_the_same_state(spark):
    """References first, parents later, deletions last: waiting resolve, settled reopen."""
    refs, facts = make(3)
    events = orphans.parent_events(spark.createDataFrame(facts, FACT)).collect()
    frame = lambda rows: spark.createDataFrame(rows, "parent_key string, t timestamp_ntz, d bigint")
    ledger = orphans.OrphanLedger(spark)
    ledger.apply(spark.createDataFrame(refs, REF), None)
    assert {r.orphan_kind for r in ledger.pending.collect()} == {"missing"} and ledger.pending.count() == len(refs)
    ledger.apply(spark.createDataFrame([], REF), frame([tuple(e) for e in events if e["d"] > 0]))
    between = ledger.pending.count()
    ledger.apply(spark.createDataFrame([], REF), frame([tuple(e) for e in events if e["d"] < 0]))
    assert ledger.pending.count() > between
    assert opened(ledger) == brute(refs, facts)


def test_replay_resolves_and_reopens(spark, tmp_path):
    """Parents come one batch after the references: orphans wait, resolve and reopen."""
    refs = [("f", 1, "a", "a", day(1), "t"), ("f", 2, "b", "b", day(35), "t"), ("f", 3, "c", "c", day(99), "t"), ("f", 4, "b", "b", day(70), "t")]
    facts = [("a", day(0), None), ("b", day(5), day(34.5)), ("c", day(98), None)]
    path = str(tmp_path / "ledger")
    ledger = orphans.replay(spark, spark.createDataFrame(refs, REF), spark.createDataFrame(facts, FACT), 3, path)
    seen = {}
    for r in ledger.history().collect():
        seen[r.batch] = seen.get(r.batch, 0) + r.orphans
    # 1 waits, then resolves; 2 is settled and reopens when its parent's deletion is known; 3 waits for its parent.
    assert seen == {1: 1, 3: 3, 4: 2}
    assert opened(ledger) == {("f", 2, "b", "deleted"), ("f", 4, "b", "deleted")}
    again = orphans.OrphanLedger.load(spark, path)
    assert again.batch == 4 and opened(again) == opened(ledger)
    again.apply(None, orphans.parent_events(spark.createDataFrame([("b", day(60), None)], FACT)))
    assert opened(again) == {("f", 2, "b", "deleted")} and orphans.OrphanLedger.load(spark, path).batch == 5


def test_a_batch_cut_off_did_not_happen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "l")
    ledger = orphans.OrphanLedger(spark, path)
    ledger.apply(spark.createDataFrame([("f", 1, "a", "a", day(1), "t")], REF), None)
    monkeypatch.setattr(orphans, "replace_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ledger.apply(None, orphans.parent_events(spark.createDataFrame([("a", day(0), None)], FACT)))
    monkeypatch.undo()
    ledger = orphans.OrphanLedger.load(spark, path)
    assert ledger.batch == 1 and opened(ledger) == {("f", 1, "a", "missing")}
    ledger.apply(None, orphans.parent_events(spark.createDataFrame([("a", day(0), None)], FACT)))
    assert opened(ledger) == set()


def test_nulls_and_odd_times(spark):
    refs = [("f", 1, None, None, day(1), "t"), ("f", 2, "a", "a", None, "t"), ("f", 3, "b", "b", day(5), "t"), ("f", 4, "c", "c", day(5), "t")]
    facts = [("a", day(50), None), ("b", None, None), ("c", day(9), day(2)), (None, day(1), None)]
    ledger = orphans.replay(spark, spark.createDataFrame(refs, REF), spark.createDataFrame(facts, FACT), 1)
    assert opened(ledger) == {("f", 3, "b", "late"), ("f", 4, "c", "late")}


def test_snapshot_counts(spark, small):
    counts = orphans.counts(spark, small)
    last = counts.where(counts.batch == counts.agg({"batch": "max"}).first()[0])
    assert last.agg({"orphans": "sum"}).first()[0] == orphans.found(spark, small).count()
