"""Schema matching, coercion, lake, pipeline, reports and expressions."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgate.functions import expressions as X
from loomgate.functions.sqltypes import insert_batch_rows, read_batch_rows, sql_server_type
from loomgate.operators import coerce, estimate, jobs, state, usage, validate
from loomgate.operators.rekey import RangeAllocator
from loomgate.plans import mapping, pipeline
from loomgate.plans.hierarchy import Hierarchy
from loomgate.plans.matching import camel, inverted, match_columns, match_tables, pascal, rename, squeeze, upper_snake
from loomgate.sources.lake import Lake, delimited_rows, upserted
from loomgate.streaming.incremental import load_new_files


def test_match_layers(spark):
    m = match_columns(
        [("ID", "int64"), ("id", "int64"), ("first_name", "string"), ("cust_nm", "string"), ("qty", "int32"), ("amuont", "double"), ("zzzz", "string")],
        [("ID", "BIGINT"), ("Id", "BIGINT"), ("FirstName", "VARCHAR"), ("CustomerName", "NVARCHAR"), ("Quantity", "INT"), ("Amount", "FLOAT"), ("Left", "INT")])
    assert [(x.source, x.target, x.strategy) for x in m.matched] == [
        ("ID", "ID", "exact"), ("id", "Id", "case-insensitive"), ("first_name", "FirstName", "normalized"), ("cust_nm", "CustomerName", "abbreviation"),
        ("qty", "Quantity", "abbreviation"), ("amuont", "Amount", "fuzzy+type")]
    assert m.unmatched_source == ["zzzz"] and m.unmatched_target == ["Left"]
    assert m.inverted().matched[0].strategy == "inverted_exact" and m.inverted().unmatched_source == ["Left"]


def test_match_many_tables_at_once(spark):
    """Tables do not mix; repeated and null names; a table without a target; pairs by either contraction."""
    source = spark.createDataFrame([("a", 1, "dt", "date32"), ("a", 2, "dt", "int"), ("a", 3, None, "int"), ("b", 1, "Number", "int32"), ("c", 1, "x", "int")], "table_key string, at int, name string, kind string")
    target = spark.createDataFrame([("a", 1, "Date", "DATE"), ("b", 1, "no", "INT"), ("b", 2, "x", "INT")], "table_key string, at int, name string, kind string")
    got = {(r.table_key, r.source, r.target, r.strategy, r.confidence) for r in match_tables(source, target).collect()}
    assert got == {("a", "dt", "Date", "abbreviation", 0.9), ("b", "Number", "no", "abbreviation", 0.9), ("b", None, "x", "unmatched", 0.0), ("c", "x", None, "unmatched", 0.0)}
    assert {(r.source, r.target, r.strategy) for r in inverted(match_tables(source, target)).collect()} >= {("Date", "dt", "inverted_abbreviation"), ("x", None, "unmatched")}
    assert match_tables(source.limit(0), target.limit(0)).count() == 0


def test_auto_insert(spark):
    df = spark.createDataFrame([(1, "x")], spark.createDataFrame([], "user_id int, note string").schema)
    wrote, made = [], []
    mapping.auto_insert(df, "t", None, lambda rows, name, empty: wrote.append((rows.columns, name, empty)), made.append)
    assert wrote == [(["UserId", "Note"], "dbo.t", False)] and made == ["CREATE TABLE [dbo].[t] ([UserId] INT NULL, [Note] NVARCHAR(MAX) NULL)"]
    mapping.auto_insert(df, "t", [("USER_ID", "INT"), ("Zeit", "DATE")], lambda rows, name, empty: wrote.append((rows.columns, name, empty)), made.append, truncate=True)
    assert wrote[-1] == (["USER_ID"], "dbo.t", True) and len(made) == 1
    with pytest.raises(ValueError):
        mapping.auto_insert(df, "t", [("Zeit", "DATE")], lambda *a: wrote.append(a), made.append)
    strict = mapping.make_entry("ns", "t", df.select(F.lit(1).alias("k"), "note"), None)
    assert "[K] INT NOT NULL" in mapping.create_table_ddl(strict)


def test_names():
    assert pascal("user_name") == "UserName" and pascal("ContractSID") == "Contractsid" and camel("user-name") == "userName"
    assert upper_snake("HTTPServerId") == "HTTP_SERVER_ID" and rename(["a_b"], "nope") == ["AB"] and squeeze("A_b -C") == "abc"


def test_mapping_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2.0)], "user_id int, user_name string, v double")
    e = mapping.make_entry("ns", "t", df, None)
    assert [c["target"] for c in e["columns"]] == ["UserId", "UserName", "V"] and e["create_table_if_missing"]
    assert "[UserId] INT NULL" in mapping.create_table_ddl(e)
    p = str(tmp_path / "m.json")
    mapping.save(p, {mapping.entry_key(e): e})
    mapping.save(p, {"other": e})
    assert set(mapping.load(p)) == {"ns_t", "other"}
    (tmp_path / "m.json").write_text("{broken")
    mapping.save(p, {"x": e})
    assert set(mapping.load(p)) == {"x"}
    with pytest.raises(FileNotFoundError):
        mapping.load(str(tmp_path / "none.json"))
    merged = mapping.merge_overrides(e, {"row_filter": "v > 1", "columns": [{"source": "v", "include": False}, {"source": "nope"}]})
    assert mapping.project(df, merged).columns == ["UserId", "UserName"] and merged["row_filter"] == "v > 1"
    assert mapping.needed_columns(df, merged) == ["user_id", "user_name"] and mapping.needed_columns(df, e) is None
    with pytest.raises(ValueError):
        mapping.create_table_ddl(e | {"columns": []})
    m = mapping.make_entry("ns", "t", df, [("USER_ID", "INT"), ("other", "INT")])
    assert [(c["source"], c["include"]) for c in m["columns"]] == [("user_id", True), ("user_name", False), ("v", False)]
    assert mapping.project(df, mapping.manual_entry("ns", "t", df, [("v", "w")])).columns == ["w"]


def test_coerce(spark):
    df = spark.createDataFrame([(300, "7", datetime(2025, 1, 2, 3, 4, 5), None), (2, "x", datetime(2025, 1, 2, 3, 4, 5, 60), None)], "A int, b string, ts timestamp_ntz, n void")
    want = T._parse_datatype_string("B int, a tinyint, TS string, n double, missing date")
    assert [tuple(r) for r in coerce.align(df, want).collect()] == [(7, None, "2025-01-02T03:04:05", None, None), (None, 2, "2025-01-02T03:04:05.000060", None, None)]
    assert [r.a for r in coerce.align(df, want, wrap=True).collect()] == [44, 2]
    assert {r.column_name: r.nulled for r in coerce.nulled(df, want).collect()} == {"B": 1, "a": 1, "TS": 0, "n": 0}
    assert [f.name for f in coerce.new_columns(df, T._parse_datatype_string("a int"))] == ["b", "ts", "n"]
    nested = spark.createDataFrame([([1, 2], bytearray(b"\x0a"))], "l array<int>, h binary")
    assert tuple(coerce.align(nested, T._parse_datatype_string("l string, h string")).first()) == ("[1,2]", "0a")


def test_batch_sizes():
    assert read_batch_rows(T.StructType([])) == 100_000 and insert_batch_rows(0) == 50_000 and insert_batch_rows(10) == 10_485
    s = T._parse_datatype_string("a bigint, s string, d decimal(10,2)")
    assert read_batch_rows(s) == 100_000 and read_batch_rows(s, target_mb=1) == 1024 * 1024 // 130
    assert sql_server_type(T.DecimalType(9, 3)) == "DECIMAL(9,3)" and sql_server_type(T.ArrayType(T.IntegerType())) == "NVARCHAR(MAX)"


def test_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    schema = T._parse_datatype_string("k bigint, v string")
    df = lambda *r: spark.createDataFrame(list(r), schema)
    lake.create("ns.t", schema)
    assert lake.list_tables("ns") == ["ns.t"] and lake.version("ns.t") is None and lake.scan("ns.t").columns == ["k", "v"]
    assert lake.append("ns.t", df((1, "a"), (2, "b"))) == 2
    v1 = lake.version("ns.t")
    lake.append("ns.t", spark.createDataFrame([("c", 3, 0)], "V string, K int, extra int"))
    assert sorted(r.k for r in lake.incremental("ns.t", v1).collect()) == [3] and lake.incremental("ns.t", lake.version("ns.t")).count() == 0
    assert lake.read("ns.t", "incremental").count() == 3 and lake.scan("ns.t", ["v"], "k > 1", 1).count() == 1 and lake.scan("ns.t", version=v1).count() == 2
    assert lake.overwrite("ns.t", df()) == 0 and lake.scan("ns.t").count() == 3
    lake.upsert("ns.t", df((2, "B"), (None, "n")), ["k"])
    assert sorted(lake.scan("ns.t").collect(), key=repr) == sorted(df((1, "a"), (3, "c"), (2, "B"), (None, "n")).collect(), key=repr)
    assert lake.incremental("ns.t", v1).count() == 4  # replaced since
    assert lake.has_rows("ns.t", "k = 1") == (True, 1) and lake.has_rows("ns.none") == (False, 0) and lake.has_rows("ns.t", "nope = 1") == (True, -1)
    assert lake.first_with_rows(["ns.none", "ns.t"]) == "ns.t" and lake.file_stats("ns.t").first().rows == 4
    lake.add_columns("ns.t", [T.StructField("w", T.IntegerType())])
    assert lake.scan("ns.t").where("w is null").count() == 4
    lake.drop("ns.t")
    assert not lake.exists("ns.t")
    assert upserted(df((1, "a")), df(), ["k"]).count() == 1


def test_delimited(spark):
    out = delimited_rows(spark.createDataFrame([(1, None), (2, "a|b")], "k int, v string"), "|").collect()
    assert [tuple(r) for r in out] == [("1|", False), ("2|a|b", True)]
    with pytest.raises(ValueError):
        delimited_rows(spark.createDataFrame([([1],)], "l array<int>"))


def test_both_directions(spark, tmp_path):
    h, lake = Hierarchy.family(), Lake(spark, str(tmp_path / "lake"))
    data = {
        "tExposureSet": spark.createDataFrame([(10, 1), (20, 1)], "ExposureSetSID bigint, CompanySID bigint"),
        "tContract": spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "ContractSID bigint, ExposureSetSID bigint"),
        "tLayer": spark.createDataFrame([(7, 1), (8, 3)], "LayerSID bigint, ContractSID bigint"),
    }
    for n, df in data.items():
        lake.create(f"src.{n}", df.schema)
        lake.append(f"src.{n}", df)
    out = str(tmp_path / "artifact")
    done = pipeline.extract(lake, "src", out, [20], hierarchy=h, roots={"tExposureSet": "ExposureSetSID", "tContract": "ExposureSetSID"})
    assert done.rows == {"tContract": 2, "tExposureSet": 1, "tLayer": 1} and done.report.passed and done.status == "SUCCEEDED"
    assert spark.read.json(f"{out}/_manifest").where("length(sha256) = 64").count() >= 3
    got = pipeline.ingest(spark, out, lake, "dst", h, RangeAllocator(900))
    assert sorted(got.skipped) == ["tContract", "tExposureSet", "tLayer"]
    c = state.Checkpoint(spark, str(tmp_path / "cp"), "j")
    got = pipeline.ingest(spark, out, lake, "dst", h, RangeAllocator(900), create_missing=True, checkpoint=c)
    assert got.summary()["total_rows"] == 4 and got.status == "SUCCEEDED"
    assert {r.ContractSID for r in lake.scan("dst.tLayer").collect()} <= {r.ContractSID for r in lake.scan("dst.tContract").collect()}
    pipeline.write_summary(str(tmp_path / "s.json"), got)
    assert json.loads((tmp_path / "s.json").read_text())["success"] == 3


def test_plans():
    p = pipeline.build_plan(["ns.table1", "ns.table2"], {"ns_table1": {"target_table": "x", "row_filter": "a = 1"}})
    assert [(x.target_table, x.row_filter) for x in p] == [("x", "a = 1"), ("table2", None)]


def sweep(rows):
    events = sorted([(a, w) for a, b, w in rows if a is not None] + [(b, -w) for a, b, w in rows if a is not None and b is not None])
    now = top = 0
    for _, w in events:
        now += w
        top = max(top, now)
    return top


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sweep_equals_plain_python(spark, seed):
    r = random.Random(seed)
    at = lambda h: datetime(2025, 1, 1 + h // 24, h % 24)
    rows = []
    for i in range(150):
        a = r.randrange(600)
        rows.append((i, None if r.random() < 0.03 else at(a), None if r.random() < 0.05 else at(a + r.randrange(1, 60)), r.choice([4, 8, 16])))
    df = spark.createDataFrame(rows, "run_id int, started_at timestamp_ntz, stopped_at timestamp_ntz, cores int")
    assert usage.peak(df).first().peak == sweep([x[1:] for x in rows])
    assert {x.running for x in usage.peak_events(df).collect()} == {sweep([x[1:] for x in rows])}


def test_sweep_ties(spark):
    t = lambda h: datetime(2025, 1, 1, h)
    s = "run_id int, started_at timestamp_ntz, stopped_at timestamp_ntz, cores int"
    assert usage.peak(spark.createDataFrame([(1, t(1), t(2), 4), (2, t(2), t(3), 4)], s)).first().peak == 4
    assert usage.peak(spark.createDataFrame([(1, t(1), t(3), 4), (2, t(2), t(4), 4), (3, t(2), None, 2)], s)).first().peak == 10
    assert usage.peak(spark.createDataFrame([], s), least=4).first().peak == 4


def test_checks(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    assert validate.checksum(a).first()[0] == validate.checksum(a.orderBy(F.desc("k"))).first()[0] != validate.checksum(a.distinct()).first()[0]
    assert validate.checksum(a.limit(0)).first()[0] == "EMPTY"
    r = validate.validate({"a": a}, {"a": 2, "b": 1})
    assert not r.passed and r.warnings == ["a: 3 rows, 2 expected"] and r.errors == ["b: missing"]
    a.coalesce(1).write.parquet(str(tmp_path / "p"))
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 nothing PAR1")
    good = str(next((tmp_path / "p").glob("*.parquet")))
    assert [x.path for x in validate.unreadable_files(spark, [good, str(tmp_path / "bad.parquet")]).collect()] == [str(tmp_path / "bad.parquet")]
    sums = validate.file_checksums(spark, str(tmp_path / "p")).where("path like '%.parquet'")
    assert validate.checksum_mismatches(sums, sums.withColumn("sha256", F.upper("sha256"))).count() == 0
    assert validate.checksum_mismatches(sums, sums.withColumn("sha256", F.lit("0"))).count() == 1


def test_estimate(spark):
    s = spark.createDataFrame([("a", 0, 100, 1000, 3, None, True), ("b", 5, 10, 500, 3, "a", False)], "table_name string, matched bigint, total_rows bigint, total_bytes bigint, columns int, parent string, direct boolean")
    assert {r.table_name: r.matched for r in estimate.with_child_fraction(s).collect()} == {"a": 50, "b": 5}
    one = estimate.estimate(s.limit(0)).first()
    assert (one.total_rows, one.estimated_bytes, one.route) == (0, 1 << 20, "EXPRESS") and estimate.without_statistics(10) == 6_250_000


def test_expressions(spark):
    texts = ['{"a":{"Records-Ingested":"12"}}', '{"recordsIngested":"x","b":[{"ingested":3}]}', '{"out":"{\\"rowsIngested\\": 5}"}', "[]", "oops", None, '{"ingested": true}', '{"ingested": 99999999999}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.deep_counter(F.col("t"), X.INGESTED)).collect()] == [12, 3, 5, None, None, None, None, None]
    line = spark.createDataFrame([("x Records Ingested : 42 y",), ("ingested_record=7",), ("nothing",), ("records ingested: 99999999999",)], "t string")
    assert [r[0] for r in line.select(X.log_counter(F.col("t"), "ingested")).collect()] == [42, 7, None, None]
    assert spark.createDataFrame([("1 a-b",)], "n string").select(X.safe_name(F.col("n"))).first()[0] == "_1_a_b"


def test_jobs(spark):
    e = spark.createDataFrame([(1, 1, "s", "A"), (1, 2, "f", None), (1, 3, "s", "B"), (1, 4, "x", None), (1, 5, "f", None), (2, 1, "f", None), (None, 9, "f", None)], "g int, id int, kind string, name string")
    got = jobs.last_state_before(e, "g", "id", F.col("kind") == "f", F.col("kind") == "s", "name")
    assert sorted((r.g, r.id, r.state) for r in got.collect()) == [(1, 2, "A"), (1, 5, "B"), (2, 1, None)]
    assert [r.id for r in jobs.top_recent([e.where("g = 1"), e.where("g = 2")], "id", 2, "g", where=F.col("kind") == "f").collect()] == [5, 2]


def test_state(spark, tmp_path):
    c = state.Cursors(str(tmp_path / "c.json"))
    assert c.get("t") is None
    c.set("t", 3), c.set("u", 4)
    assert c.get("t") == 3
    m = spark.createDataFrame([(1, 100), (2, 101)], "old_sid bigint, new_sid bigint")
    state.write_audit(state.audit_records(m, "tContract", "ContractSID", "j", "ten", "2025-01-02 00:00:00"), str(tmp_path / "audit"))
    a = spark.read.parquet(str(tmp_path / "audit"))
    assert state.audit_lookup(a, "TCONTRACT", new_sid=101).first().original_id == 2 and state.audit_lookup(a, "tContract", "other").count() == 0
    assert state.write_progress(str(tmp_path / "p.json"), 1, 2)["percent"] == 45


def test_streaming_takes_each_file_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.createDataFrame([(1,), (2,)], "k int").coalesce(1).write.parquet(src)
    assert load_new_files(spark, src, T._parse_datatype_string("k int"), out, cp) == 1
    assert load_new_files(spark, src, T._parse_datatype_string("k int"), out, cp) == 0
    spark.createDataFrame([(3,)], "k int").coalesce(1).write.mode("append").parquet(src)
    load_new_files(spark, src, T._parse_datatype_string("k int"), out, cp)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3]
