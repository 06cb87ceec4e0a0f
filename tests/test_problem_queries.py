"""Each problem's query on changed tables: what must stay, what must not crash."""

import pytest

from loomgate.operators import compact, drift, orphans, reconcile

CASES = {
    "orphans": (orphans.found, ["allocation_records", "transform_results", "tcontract", "tlocation"]),
    "compact": (compact.found, ["lake_files", "lake_rows"]),
    "drift": (drift.found, ["column_plans", "file_rows"]),
    "reconcile": (reconcile.found, ["table_results", "validation_reports"]),
}


@pytest.mark.parametrize("name", CASES)
def test_empty_tables_give_empty_results(name, spark, tables):
    query, names = CASES[name]
    assert query(spark, tables.empty(names)).count() == 0


@pytest.mark.parametrize("name", CASES)
def test_nulls_do_not_crash_and_rows_are_distinct(name, spark, tables, rows):
    query, names = CASES[name]
    got = rows(query(spark, tables.one_null_each(names)))
    assert len(got) == len(set(got))


@pytest.mark.parametrize("name", CASES)
def test_rows_of_nulls_only_change_nothing(name, spark, tables, small, rows):
    query, names = CASES[name]
    want = rows(query(spark, small))
    got = [r for r in rows(query(spark, tables.all_null(names))) if r[0] is not None]
    assert got == want


@pytest.mark.parametrize("name", CASES)
def test_extra_columns_and_repeated_rows_change_nothing(name, spark, tables, small, rows):
    query, names = CASES[name]
    want = rows(query(spark, small))
    assert rows(query(spark, tables.clashing(names))) == want
    assert rows(query(spark, tables.repeated(names))) == want


def test_consistent_table_keeps_every_row(spark, small, rows):
    table = drift.table(spark, small)
    source = spark.read.parquet(f"{small}/file_rows.parquet").dropDuplicates()
    assert table.count() == source.count()
    assert table.where("_rescued is not null").count() < source.count() / 2
