import json

import pytest

from loomgate.operators import compact

FILES = "file_id bigint, target_table string, commit_state string"
ROWS = "file_id bigint, row_no int, row_key bigint, payload string"


def test_canonical_forms():
    same = ['{"a":1.50,"b":"é","c":null}', '{ "c": null, "b": "\\u00e9", "a": 1.5 }', '{"a":15e-1,"c":null,"b":"é"}']
    assert len({compact.canonical(x) for x in same}) == 1
    assert compact.canonical('{"a":null}') != compact.canonical("{}")
    assert compact.canonical('{"a":"1"}') != compact.canonical('{"a":1}')
    assert compact.canonical('{"a":true}') != compact.canonical('{"a":1}')
    assert compact.canonical('{"a":-0.0}') == compact.canonical('{"a":0}')
    assert compact.canonical("not json").endswith("not json") and compact.canonical(None) is None


def test_canonical_never_merges_different_numbers_or_objects():
    c = compact.canonical
    assert c('{"a":123456789012345678901234567890}') != c('{"a":123456789012345678901234567891}')
    assert c('{"a":123456789012345678901234567890}') == c('{"a":12345678901234567890123456789.0e1}')
    assert c('{"a":1}') != c('{"a":{"#":"1"}}') and c('{"a":1}') != c('{"a":"#1e0"}')
    assert c('{"a":1e9999999999}') != c('{"a":1e9999999998}') and c('{"a":10e9999999998}') == c('{"a":1e9999999999}')
    assert c('{"a":1,"a":2}') not in (c('{"a":2}'), c('{"a":1}'), c('{"a":2,"a":1}'))
    assert c("[" * 100_000 + "]" * 100_000) == "\x00" + "[" * 100_000 + "]" * 100_000
    assert c("[1e" + "9" * 5000 + "]").startswith("\x00") and c('{"a":NaN}').startswith("\x00")
    assert c('{"a":"\\ud800"}') == c('{"a" : "\\uD800"}')


def test_odd_rows_are_kept(spark, tmp_path):
    """No row number, one position for two records, numbers of 30 digits, a lone surrogate."""
    files = spark.createDataFrame([(1, "t", "committed"), (2, "t", "committed")], FILES)
    rows = [(1, None, 1, "{}"), (1, None, 2, "{}"), (1, 1, 1, "{}"), (2, 5, 7, '{"a":1}'), (2, 5, 7, '{"a":2}'), (2, 6, 7, '{"a":123456789012345678901234567890}'),
            (2, 7, 7, '{"a":123456789012345678901234567891}'), (2, 8, 7, '{"a":"\\ud800"}'), (2, 8, 7, '{"a":"\\ud800"}')]
    compact.consolidate(files, spark.createDataFrame(rows, ROWS), str(tmp_path / "o"))
    kept = sorted((r.file_id, r.row_no or 0, r.row_key, r.payload) for r in spark.read.parquet(str(tmp_path / "o/data")).collect())
    assert kept == [(1, 0, 2, "{}"), (1, 1, 1, "{}"), *[(f, n, k, p) for f, n, k, p in rows[3:8]]]


def lake(spark):
    files = [(1, "tA", "committed"), (1, "tA", "committed"), (2, "TA", "committed"), (3, "tB", "staged"), (4, "tB", None), (5, "tB", "committed"), (6, "tA", "committed"), (6, "tA", "aborted")]
    rows = [
        (1, 1, 10, '{"x":1.0}'), (2, 1, 10, '{"x": 1}'), (2, 2, 11, '{"x":1}'), (2, 3, 10, '{"x":2}'), (3, 1, 10, "{}"), (4, 1, 1, "{}"), (5, 1, 10, '{"x":1}'),
        (5, 2, None, None), (5, 3, None, None), (6, 1, 77, "{}"), (9, 1, 5, "{}"), (1, 2, 12, "x" * 300_000),
    ]
    return spark.createDataFrame(files, FILES), spark.createDataFrame(rows, ROWS)


def test_each_committed_record_once(spark, tmp_path):
    manifest = compact.consolidate(*lake(spark), str(tmp_path / "out"), target_bytes=200_000)
    back = spark.read.parquet(str(tmp_path / "out/data"))
    assert sorted((r.file_id, r.row_no) for r in back.collect()) == [(1, 1), (1, 2), (2, 2), (2, 3), (5, 1), (5, 2)]
    assert max(len(r.payload or "") for r in back.collect()) == 300_000
    assert sum(r.rows for r in manifest.collect()) == 6
    name = (tmp_path / "out/CURRENT").read_text()
    assert spark.read.parquet(str(tmp_path / "out" / name)).count() == manifest.count()
    assert not list((tmp_path / "out/data").glob(".*.tmp"))


def test_a_second_publication_replaces_the_pointer(spark, tmp_path):
    files, rows = lake(spark)
    compact.consolidate(files, rows, str(tmp_path / "o"))
    before = (tmp_path / "o/CURRENT").read_text()
    compact.consolidate(files, rows, str(tmp_path / "o"))
    assert (tmp_path / "o/CURRENT").read_text() != before


def test_verification_sees_a_changed_file(spark, tmp_path, monkeypatch):
    files, rows = lake(spark)
    real = compact.write_groups
    monkeypatch.setattr(compact, "write_groups", lambda s, f, n: real(s.limit(2), f, n))
    with pytest.raises(compact.CompactionError):
        compact.consolidate(files, rows, str(tmp_path / "o"))
    assert not (tmp_path / "o/CURRENT").exists()


def test_groups_are_balanced(spark):
    pieces = spark.createDataFrame([("t", i, 0, 100 + i % 7) for i in range(200)], "target string, file_id bigint, piece bigint, bytes bigint")
    loads = {}
    for r in compact.assign_groups(pieces, 3_000).collect():
        loads[r.group] = loads.get(r.group, 0) + r.bytes
    assert len(loads) == 7 and max(loads.values()) - min(loads.values()) < 110


def test_payload_as_written(spark, tmp_path):
    compact.consolidate(*lake(spark), str(tmp_path / "o"))
    kept = {(r.file_id, r.row_no): r.payload for r in spark.read.parquet(str(tmp_path / "o/data")).collect()}
    assert kept[(1, 1)] == '{"x":1.0}' and json.loads(kept[(2, 3)]) == {"x": 2}
