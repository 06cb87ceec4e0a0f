import random

import pytest
from pyspark.sql import functions as F

from loomgate.llm import canonical as C

CATALOG = "catalog_id bigint, column_name string, extra string"


@pytest.fixture(scope="module")
def catalog(spark):
    names = ["ContractSID", "ContractName", "CountyName", "LayerLimit", "LayerName", "StandardDeviation", "CauseOfLoss", "UnderwriterInitials", "StateProvince"]
    return spark.createDataFrame([(i + 1, n, None) for i, n in enumerate(names)] + [(99, None, "x")], CATALOG)


def resolve(spark, catalog, values, evidence=None):
    cases = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "record_id bigint, value string")
    names = {r.catalog_id: r.column_name for r in catalog.collect()}
    said = None if evidence is None else spark.createDataFrame([(a, b, str(i)) for i, (a, b) in enumerate(evidence)], "a string, b string, place string")
    got = C.map_values(cases, catalog, "catalog_id", "column_name", said).collect()
    assert len(got) == len(values)
    return [names.get(r.id) for r in sorted(got, key=lambda r: r.record_id)]


def test_spellings_by_likeness(spark, catalog):
    given = {
        "contract_sid": "ContractSID", "CNTRCT_NM": "ContractName", "name of county": "CountyName", "[layer limt]": "LayerLimit", "layer-imit": "LayerLimit", "STANDARDDEVIATOIN": "StandardDeviation",
        "Loss Of Cause": "CauseOfLoss", "conty_name": "CountyName", '"State  Province" (req.)': "StateProvince", "cause_of_ls": "CauseOfLoss", "sigma": None, "aquarium_sign": None,
        "?": None, "F12": None, "uq": None, "x" * 100_000: None, "": None, "layername": "LayerName",
    }
    assert dict(zip(given, resolve(spark, catalog, list(given)))) == given


def test_aliases_are_learned_from_names_typed_side_by_side(spark, catalog):
    said = [("sigma", "StandardDeviation"), ("STD_DEV", "standard-deviatoin"), ("sigma", "std dev"), ("std dev", "sigma"), ("sigma", "StandardDeviation"), ("STD_DEV", "StandardDeviation"),
            ("why damaged", "CauseOfLoss"), ("Why_Damaged", "Loss of Cause"), ("once", "LayerName"), ("torn", "LayerName"), ("torn", "LayerName"), ("torn", "CountyName"), ("torn", "CountyName"), (None, "LayerName"), ("far", None)]
    given = {"Sigma": "StandardDeviation", "std_dev": "StandardDeviation", "whydamagd": "CauseOfLoss", "once": None, "torn": None, "far": None, "LayerName": "LayerName"}
    assert dict(zip(given, resolve(spark, catalog, list(given), said))) == given


def test_second_round_reaches_what_only_aliases_vouch_for(spark, catalog):
    said = [("sigma", "StandardDeviation"), ("sigma", "StandardDeviation"), ("spread", "sigma"), ("spread", "Sigma")]
    assert resolve(spark, catalog, ["spread"], said) == ["StandardDeviation"]


def test_affixes_are_learned(spark):
    names = ["AlarmGrade", "RoofAge", "FloodZone", "SoilClass", "PaidLoss", "LossDate", "LayerName", "CityName", "CountyName", "PerilGroup", "FloorArea", "LedgerCode"]
    catalog = spark.createDataFrame(list(enumerate(names)), "catalog_id bigint, column_name string")
    values = [f"src_{n}" for n in names[:10]] + ["SRC.flor area", "dst_LedgerCode", "src_"]
    assert resolve(spark, catalog, values) == names[:10] + ["FloorArea", None, None]


def test_repeated_values_and_hot_value(spark, catalog):
    assert resolve(spark, catalog, ["layerlimt"] * 400 + ["zz"] * 300) == ["LayerLimit"] * 400 + [None] * 300


def test_empty_list_and_empty_cases(spark, catalog):
    assert resolve(spark, catalog.limit(0), ["layerlimit", "a"]) == [None, None]
    assert resolve(spark, catalog, []) == []


def brute(value, refs, k):
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    return {s for s in refs if lev(value, s) <= k}


def test_pigeonhole_join_loses_no_candidate(spark):
    """Every reference within k edits shares a segment: same pairs as all-pairs Levenshtein."""
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abcd") for _ in range(n))
    refs = sorted({word(r.randrange(C.ONE_EDIT_FROM, 15)) for _ in range(60)})
    values = sorted({word(r.randrange(2, 15)) for _ in range(40)} | {w[:2] + w[3:] for w in refs[:20]} | {w[1] + w[0] + w[2:] + "a" for w in refs[20:40]})
    seg = C.segments(spark.createDataFrame([(i, s) for i, s in enumerate(refs)], "id bigint, s string"))
    got = C.probes(spark.createDataFrame([(v,) for v in values], "v string")).join(seg, ["len", "no", "seg"]).where(F.levenshtein("v", "s") <= 2)
    assert {(x.v, x.s) for x in got.select("v", "s").distinct().collect()} == {(v, s) for v in values for s in brute(v, refs, 2)}


def test_short_strings_must_be_equal(spark):
    refs = spark.createDataFrame([(1, "uw"), (2, "tiv"), (3, "code"), (4, "codes")], "id bigint, s string")
    values = spark.createDataFrame([(v,) for v in ("uw", "uv", "tiv", "ti", "code", "cod", "coded", "codes", "odes")], "v string")
    assert {r.v: r.best.id for r in C.nearest(values, refs).collect()} == {"uw": 1, "tiv": 2, "code": 3, "codes": 4, "coded": 4, "odes": 4}


def test_shuffled_join_equals_broadcast_join(spark, monkeypatch):
    refs = spark.createDataFrame([(1, "layerlimit"), (2, "countyname"), (3, "contractname")], "id bigint, s string")
    values = spark.createDataFrame([(v,) for v in ("layerlimt", "cuontyname", "contractnme", "zzz")], "v string")
    want = C.nearest(values, refs).collect()
    monkeypatch.setattr(C, "bounded_broadcast", lambda df: (df, False))
    assert sorted(C.nearest(values, refs).collect()) == sorted(want) and len(want) == 3


def test_found_on_changed_tables(spark, tables, small, rows):
    names = ["column_mappings", "column_plans", "column_catalog"]
    want = rows(C.found(spark, small))
    assert len(want) == len({x[:2] for x in want})
    assert rows(C.found(spark, tables.clashing(names))) == want
    assert rows(C.found(spark, tables.repeated(names))) == want
    assert C.found(spark, tables.empty(names)).count() == 0
    assert set(want) <= set(rows(C.found(spark, tables.one_null_each(["column_mappings", "column_plans", "column_catalog"]))))
