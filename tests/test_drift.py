import json

from pyspark.sql import functions as F

from loomgate.functions.types import spark_type
from loomgate.operators import drift

PLANS = "column_plan_id bigint, plan_id bigint, feed_key string, file_seq int, ordinal int, source_name string, target_name string, source_type string, target_type string"
ROWS = "plan_id bigint, row_no int, row_key string, payload string"


def feed(spark, *files, rows=()):
    out, n = [], 0
    for seq, cols in enumerate(files, 1):
        for o, (name, target, st, tt) in enumerate(cols, 1):
            n += 1
            out.append((n, seq, "f", seq, o, name, target, st, tt))
    return spark.createDataFrame(out, PLANS), spark.createDataFrame(list(rows), ROWS)


def found(spark, plans, rows):
    return sorted(tuple(r) for r in drift.changes(plans, rows).collect())


def test_case_and_order_are_no_change(spark):
    a = [("Loss", "L", "int", "int32"), ("Fee", "F", "decimal(18,2)", "decimal128(18, 2)")]
    b = [("FEE", "F", "Numeric(18, 2)", "decimal128(18,2)"), ("loss", "L", "INT", "int32")]
    assert found(spark, *feed(spark, a, b)) == []


def test_renamed_by_values_not_by_target(spark):
    a = [("x", "A", "int", "int32"), ("y", "B", "nvarchar(50)", "string"), ("k", "K", "int", "int32")]
    b = [("p", "B", "int", "int32"), ("q", "A", "bigint", "int64"), ("k", "K", "int", "int32")]
    rows = [(1, i, f"r{i}", f'{{"row_key":"r{i}","x":{i + 100},"y":"t{i}","k":1}}') for i in range(5)]
    rows += [(2, i, f"r{i}", f'{{"row_key":"r{i}","q":{i + 100}.0,"p":{i + 7},"k":1}}') for i in range(5)]
    assert found(spark, *feed(spark, a, b, rows=rows)) == [
        (2, "added", "", "p"), (2, "removed", "y", ""), (2, "renamed", "x", "q"), (2, "source_type", "x", "q"), (2, "target_type", "x", "q")]


def test_renamed_by_target_where_no_record_is_shared(spark):
    a, b = [("x", "A", "int", "int32")], [("q", "A", "int", "int32"), ("z", "Z", "int", "int32")]
    assert found(spark, *feed(spark, a, b)) == [(2, "added", "", "z"), (2, "renamed", "x", "q")]


def test_renamed_with_date_and_time_retypes(spark):
    """Dates and time stamps are equal by value, whatever type they come as; other times of one day are not."""
    a = [("d", "A", "date", "date32"), ("t", "B", "datetime2", "timestamp[us]"), ("n", "C", "datetime2", "timestamp[us]"), ("o", "O", "datetime2", "timestamp[us]")]
    b = [("p", "P", "datetime2", "timestamp[us]"), ("q", "B", "datetimeoffset", "timestamp[us, tz=UTC]"), ("r", "R", "date", "date32"), ("s", "S", "datetime2", "timestamp[us]")]
    rows = [(1, i, f"r{i}", f'{{"d":"2004-07-0{i}","t":"2014-11-2{i}T03:01:05","n":"2015-01-0{i}T09:30:00","o":"2016-01-0{i}T01:00:00"}}') for i in range(1, 6)]
    rows += [(2, i, f"r{i}", f'{{"p":"2004-07-0{i}T00:00:00","q":"2014-11-2{i} 04:01:05.000 +01:00","r":"2015-01-0{i}","s":"2016-01-0{i}T02:00:00"}}') for i in range(1, 6)]
    got = [r for r in found(spark, *feed(spark, a, b, rows=rows)) if not r[1].endswith("_type")]
    assert got == [(2, "added", "", "s"), (2, "removed", "o", ""), (2, "renamed", "d", "p"), (2, "renamed", "n", "r"), (2, "renamed", "t", "q")]


def test_renames_of_equal_values_are_all_matched(spark):
    a = [("a", "A", "bit", "bool"), ("b", "B", "bit", "bool")]
    b = [("x", "X", "bit", "bool"), ("y", "Y", "bit", "bool")]
    rows = [(1, i, f"r{i}", '{"a":true,"b":true}') for i in range(5)] + [(2, i, f"r{i}", '{"x":true,"y":true}') for i in range(5)]
    assert found(spark, *feed(spark, a, b, rows=rows)) == [(2, "renamed", "a", "x"), (2, "renamed", "b", "y")]


def test_first_file_and_blank_names(spark):
    assert found(spark, *feed(spark, [("x", "A", None, "int32"), (None, "B", "int", "int32"), (" ", "C", "int", "int32")])) == []


def test_unknown_types_are_no_evidence(spark):
    assert found(spark, *feed(spark, [("x", "A", None, "int32")], [("x", "A", "int", "int32")])) == []


def test_type_spellings(spark):
    cases = {
        "NVARCHAR(MAX)": "string", "large_string": "string", "decimal": "decimal(38,0)", "decimal128": "decimal(38,18)", "DECIMAL(10)": "decimal(10,0)", "money": "decimal(19,4)",
        "float": "double", "real": "float", "float64": "double", "date32[day]": "date", "ts[us]": "timestamp_ntz", "timestamp[us, tz=UTC]": "timestamp", "datetime2(7)": "timestamp_ntz",
        "datetimeoffset": "timestamp", "tinyint": "smallint", "int16": "smallint", "Int64": "bigint", "uint64": "decimal(20,0)", "bit": "boolean", "who knows": "string", None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "d string").select("d", spark_type(F.col("d")).alias("t"))
    assert {r.d: r.t for r in df.collect()} == cases


def test_rescue_and_replay(spark):
    a = [("Amount", "PaidLoss", "decimal(18,2)", "decimal128(18, 2)")]
    b = [("Betrag", "PaidLoss", "decimal(18,2)", "decimal128(18, 2)"), ("Extra", "what", "int", "int32")]
    rows = [(1, 1, "a", '{"row_key":"a","Amount":1.5}'), (1, 2, "b", '{"row_key":"b","Amount":"x"}'), (2, 1, "a", '{"row_key":"a","Betrag":1.5,"Extra":9}'), (2, 2, "c", "broken"), (2, 3, "d", None)]
    plans, frame = feed(spark, a, b, rows=rows)
    files = drift.headers(plans)
    read = {(r.plan_id, r.row_no): r for r in drift.rescue(frame, files).collect()}
    assert json.loads(read[(2, 1)]._rescued) == {"Betrag": "1.5", "Extra": "9"} and read[(2, 2)]._rescued == "broken"
    assert [e.key for e in read[(1, 1)].kept] == ["Amount"] and read[(1, 2)]._rescued == '{"Amount":"x"}'
    catalog = spark.createDataFrame([(1, "PaidLoss", "DECIMAL(18,2)")], "catalog_id bigint, column_name string, sql_type string")
    got = {(r.plan_id, r.row_no): (None if r.PaidLoss is None else float(r.PaidLoss), r._rescued) for r in drift.consistent_table(plans, frame, catalog).collect()}
    assert got[(1, 1)] == (1.5, None) and got[(1, 2)] == (None, '{"Amount":"x"}')
    assert got[(2, 1)] == (1.5, '{"Extra":"9"}') and got[(2, 2)] == (None, "broken") and got[(2, 3)] == (None, None)


def test_a_field_written_twice_and_one_that_no_longer_casts(spark):
    a = [("Amount", "PaidLoss", "int", "int32"), ("zz", "LossDate", "date", "date32")]
    rows = [(1, 1, "a", '{"zz":"2024-01-02","zz":"2024-01-03","Amount":7}'), (1, 2, "b", '{"AMOUNT":1,"amount":2,"zz":null}'), (1, 3, "c", '{"Amount":"many","q":{"x":[1,"\\"}"]}}'), (7, 1, "d", '{"Amount":1}')]
    plans, frame = feed(spark, a, rows=rows)
    catalog = spark.createDataFrame([(1, "PaidLoss", "DECIMAL(18,2)"), (2, "LossDate", "DATE")], "catalog_id bigint, column_name string, sql_type string")
    got = {(r.plan_id, r.row_no): (str(r.LossDate), None if r.PaidLoss is None else float(r.PaidLoss), r._rescued) for r in drift.consistent_table(plans, frame, catalog).collect()}
    assert got[(1, 1)] == ("2024-01-02", 7.0, '{"zz":"2024-01-03"}')
    assert got[(1, 2)] == ("None", 1.0, '{"amount":"2"}')
    assert got[(1, 3)][:2] == ("None", None) and json.loads(got[(1, 3)][2]) == {"Amount": "many", "q": '{"x":[1,"\\"}"]}'}
    assert got[(7, 1)] == ("None", None, '{"Amount":"1"}')


def test_no_value_is_lost_or_doubled(spark, small):
    """Brute force over the whole small tables: each field of each row is in one typed column or in the rescue column."""
    rows = spark.read.parquet(f"{small}/file_rows.parquet")
    out = drift.table(spark, small).collect()
    want = {(r.plan_id, r.row_no, r.row_key, r.payload) for r in rows.collect()}
    assert len(out) == len(want)
    held = {}
    for r in out:
        d = r.asDict()
        rest = d.pop("_rescued")
        try:
            extra = json.loads(rest) if rest else {}
        except ValueError:
            extra = {}
        n = sum(d[c] is not None for c in d if c not in ("plan_id", "row_no", "row_key")) + sum(v is not None for v in extra.values())
        held.setdefault((r.plan_id, r.row_no, r.row_key), []).append(n)
    for plan, no, key, payload in want:
        try:
            fields = json.loads(payload) if payload else {}
        except ValueError:
            continue
        assert sum(v is not None for k, v in fields.items() if k.lower() != "row_key") in held[(plan, no, key)]


def test_large_schemas_are_joined_by_shuffle(spark, small, monkeypatch, rows):
    want = rows(drift.found(spark, small))
    monkeypatch.setattr(drift, "bounded_broadcast", lambda df: (df, False))
    assert rows(drift.found(spark, small)) == want
