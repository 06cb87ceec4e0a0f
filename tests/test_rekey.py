import random

import pytest

from loomgate.operators.filters import join_sql, path_count, path_filter, select_names
from loomgate.operators.rekey import RangeAllocator, Rekeyer, mapping, speedup
from loomgate.operators.state import Checkpoint
from loomgate.plans.hierarchy import Hierarchy

H = Hierarchy.family()


def cascade(spark):
    f = spark.createDataFrame
    return {
        "tCompany": f([(1, "a", 9), (2, "b", 9), (3, "c", 8)], "CompanySID bigint, CompanyName string, BusinessUnitSID bigint"),
        "tExposureSet": f([(10, 1), (20, 1), (30, 2), (40, 3)], "ExposureSetSID bigint, CompanySID bigint"),
        "tContract": f([(100, 10), (101, 10), (102, 20), (103, None), (104, 999)], "ContractSID bigint, ExposureSetSID bigint"),
        "tLayer": f([(7, 100), (8, 101), (9, 104)], "LayerSID bigint, ContractSID bigint"),
    }


def ids(df, c):
    return [r[c] for r in df.collect()]


def test_cascade(spark):
    r = Rekeyer(H, RangeAllocator(500))
    out = r.run(cascade(spark))
    assert list(out) == ["tCompany", "tExposureSet", "tContract", "tLayer"]
    assert sorted(ids(out["tCompany"], "CompanySID")) == [500, 501, 502]
    assert sorted(ids(out["tCompany"], "BusinessUnitSID")) == [8, 9, 9]  # external
    assert set(ids(out["tExposureSet"], "CompanySID")) <= set(ids(out["tCompany"], "CompanySID"))
    assert sorted(ids(out["tContract"], "ExposureSetSID"), key=str) == [500, 500, 501, 999, None]
    assert set(ids(out["tLayer"], "ContractSID")) <= set(ids(out["tContract"], "ContractSID"))
    assert r.results["tContract"].first == 500 and r.results["tContract"].last == 504


def test_duplicates_nulls_and_density(spark):
    df = spark.createDataFrame([(5,), (5,), (None,), (3,), (9,), (5,)], "k bigint")
    assert {tuple(x) for x in mapping(df, "k", 100).collect()} == {(3, 100), (5, 103), (9, 104)}
    big = spark.range(0, 5000).selectExpr("id * 7 as k")
    got = sorted(tuple(x) for x in mapping(big, "k", 0).collect())
    assert got == [(i * 7, i) for i in range(5000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_trees_stay_trees(spark, seed):
    r = random.Random(seed)
    n = 60
    parent = [None] + [r.randrange(i) if r.random() < 0.8 else None for i in range(1, n)]
    keys = r.sample(range(10_000), n)
    df = spark.createDataFrame([(keys[i], f"L{i}", None if p is None else keys[p]) for i, p in enumerate(parent)], "LocationSID bigint, LocationName string, ParentLocationSID bigint")
    k = Rekeyer(H, RangeAllocator())
    out = {x.LocationName: x for x in k.run({"tLocation": df})["tLocation"].collect()}
    new = {n_: x.LocationSID for n_, x in out.items()}
    assert len(set(new.values())) == n and k.results["tLocation"].self_reference
    for i, p in enumerate(parent):
        assert out[f"L{i}"].ParentLocationSID == (None if p is None else new[f"L{p}"])


def test_key_that_is_a_reference_follows_its_parent(spark):
    t = {
        "tLocation": spark.createDataFrame([(4,), (6,)], "LocationSID bigint"),
        "tLocFeature": spark.createDataFrame([(4, "x"), (4, "y"), (6, "z")], "LocationSID bigint, f string"),
    }
    assert sorted(ids(Rekeyer(H, RangeAllocator(10)).run(t)["tLocFeature"], "LocationSID")) == [10, 10, 11]
    literal = Rekeyer(H, RangeAllocator(10), legacy=True).run(t)["tLocFeature"]
    assert sorted(ids(literal, "LocationSID")) == [11, 11, 12]


def test_forward_reference(spark):
    t = {"tCompany": spark.createDataFrame([(1, 30)], "CompanySID bigint, DefaultExposureSetSID bigint"), "tExposureSet": spark.createDataFrame([(30, 1)], "ExposureSetSID bigint, CompanySID bigint")}
    assert ids(Rekeyer(H, RangeAllocator(500)).run(t)["tCompany"], "DefaultExposureSetSID") == [500]
    assert ids(Rekeyer(H, RangeAllocator(500), legacy=True).run(t)["tCompany"], "DefaultExposureSetSID") == [30]


def test_errors_override_and_empty(spark):
    t = {
        "tExposureSet": spark.createDataFrame([(10,), (20,)], "ExposureSetSID bigint"),
        "tContract": spark.createDataFrame([(1, 10), (2, 20)], "ContractSID bigint, ExposureSetSID bigint"),
        "tLayer": spark.createDataFrame([], "LayerSID bigint, ContractSID bigint"), "tStepFunction": spark.createDataFrame([(1,)], "nokey bigint"), "zzz": spark.createDataFrame([(1,)], "a bigint"),
    }
    r = Rekeyer(H, RangeAllocator(), {"tExposureSet": 777})
    out = r.run(t)
    assert ids(out["tContract"], "ExposureSetSID") == [777, 777] and list(out)[-1] == "zzz"
    assert r.results["tLayer"].rows == 0 and r.results["tLayer"].error is None
    assert "missing" in r.results["tStepFunction"].error and r.results["zzz"].error == "unknown table"


def test_allocator(tmp_path):
    a = RangeAllocator(10, str(tmp_path / "c.json"))
    assert a.allocate("t", 5) == (10, 5) and a.allocate("t", 1) == (15, 1)
    assert RangeAllocator(10, str(tmp_path / "c.json")).allocate("t", 1) == (16, 1)
    with pytest.raises(ValueError):
        a.allocate("t", 0)


def test_resume_uses_stored_mappings(spark, tmp_path):
    t = cascade(spark)
    first = Rekeyer(H, RangeAllocator(500))
    first.build(t)
    c = Checkpoint(spark, str(tmp_path), "job")
    for n in ("tCompany", "tExposureSet"):
        c.save(first, n)
    again = Rekeyer(H, RangeAllocator(90_000))
    assert c.restore(again) == ["tCompany", "tExposureSet"]
    out = again.run(t)
    assert set(ids(out["tContract"], "ExposureSetSID")) == {500, 501, 999, None}
    c.delete()
    assert c.completed() == []


def test_paths(spark):
    t = cascade(spark)
    path = H.path("tLayer", {"tExposureSet"})
    assert [e.parent for e in path] == ["tContract", "tExposureSet"]
    assert ids(path_filter(t, path, "CompanySID", [1]), "LayerSID") == [7, 8]
    assert path_count(t, path, "CompanySID", [1]).first().cnt == 2
    assert join_sql(path, "CompanySID", [1, 2]) == "JOIN tContract j0 ON t.ContractSID = j0.ContractSID JOIN tExposureSet j1 ON j0.ExposureSetSID = j1.ExposureSetSID WHERE j1.CompanySID IN (1, 2)"
    assert H.path("tSIDControl", {"tExposureSet"}) is None
    g = Hierarchy.discover({"tcontract": ["contractsid", "exposuresetsid"], "tlayer": ["layersid", "contractsid", "othersid"]})
    assert g["tlayer"].parents == {"contractsid": "tcontract"} and g["tlayer"].level == 1
    assert len(H.tables) == 52 and sum(x.key_is_reference for x in H.tables.values()) == 25 and speedup(H, 4) > 3


def test_selection():
    names = ["ns.a", "ns.b"]
    assert select_names(names, "all") == names and select_names(names, '["a"]') == ["ns.a"] and select_names(names, "ns.b, zz") == ["ns.b"] and select_names(names, None) == names
