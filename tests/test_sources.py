"""Catalogs, statistics, files and option parsing of the sources."""

import duckdb
import pytest
from pyspark.sql import functions as F

from loomgate import store
from loomgate.functions.expressions import parse_flag, parse_ids
from loomgate.operators.usage import billing_month, usage_rows
from loomgate.plans import pipeline
from loomgate.sources import lake as sources


@pytest.fixture
def relational(spark):
    """A relational source that knows INFORMATION_SCHEMA, read through its own SQL."""
    con = duckdb.connect()
    con.execute("create table tLayer(LayerSID bigint not null, Label varchar); create table tNote(x int); insert into tLayer values (1, 'a'), (2, null)")

    def query(sql):
        frame = con.execute(sql).fetchdf()
        return spark.createDataFrame(frame)

    return query


def test_relational_catalog_and_counts(relational):
    tables, columns = sources.relational_catalog(relational, "main")
    assert {r.table_name for r in tables.collect()} == {"tLayer", "tNote"}
    got = {(r.table_name, r.column_name): (r.data_type, r.nullable) for r in columns.collect()}
    assert got[("tLayer", "LayerSID")] == ("BIGINT", False) and got[("tLayer", "Label")] == ("VARCHAR", True)
    assert {r.table_name: r.cnt for r in sources.relational_counts(relational, ["tLayer", "tNote"]).collect()} == {"tLayer": 2, "tNote": 0}


def test_catalog_statistics(spark, tmp_path):
    spark.range(7).withColumn("x", F.lit("a")).write.mode("overwrite").option("path", str(tmp_path / "s")).saveAsTable("stats_probe")
    try:
        before = sources.catalog_statistics(spark, "stats_probe")
        assert before["columns"] == 2
        spark.sql("ANALYZE TABLE stats_probe COMPUTE STATISTICS")
        after = sources.catalog_statistics(spark, "stats_probe")
        assert after["rows"] == 7 and after["bytes"] > 0
    finally:
        spark.sql("DROP TABLE stats_probe")


def test_footers(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "a b=1"))
    got = sources.footer_stats(spark.read.parquet(str(tmp_path / "a b=1"))).collect()
    assert len(got) == 3 and sum(r.rows for r in got) == 100 and all(r.bytes > 0 for r in got)
    assert sources.footer_stats(spark.createDataFrame([], "x int")).count() == 0


def test_sizes(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"x" * 3_000)
    assert sources.prefix_bytes(spark, str(tmp_path), 10) == 3_000 and sources.prefix_bytes(spark, str(tmp_path)) == 1 << 20
    assert sources.prefix_bytes(spark, str(tmp_path / "none")) == 1 << 20 and sources.prefix_bytes(spark, "nowhere://x/y") == 1 << 20


def test_small_files_are_replaced_or_refused(spark, tmp_path):
    path = str(tmp_path / "x.json")
    assert store.read_text(spark, path) is None and store.create_text(spark, path, "1") and not store.create_text(spark, path, "2")
    assert store.read_text(spark, path) == "1"
    store.replace_text(spark, path, "3é")
    assert store.read_text(spark, path) == "3é" and store.names(spark, str(tmp_path)) == ["x.json"]


def test_two_writers_of_one_version(spark, tmp_path):
    lake = sources.Lake(spark, str(tmp_path))
    lake.create("ns.t", spark.createDataFrame([], "k int").schema)
    lake._commit("ns.t", 1, lake._state("ns.t"))
    with pytest.raises(FileExistsError):
        lake._commit("ns.t", 1, lake._state("ns.t"))


def test_fallback_scan(spark, tmp_path):
    lake = sources.Lake(spark, str(tmp_path))
    lake.create("ns.t", spark.createDataFrame([], "k bigint, v string").schema)
    lake.append("ns.t", spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"))
    assert lake.scan_with_fallback("ns.t", "k > 1", ["v"]).collect() == [("b",)]
    spark.createDataFrame([("3", "c"), ("x", "d")], "k string, v string").write.parquet(f"{lake._dir('ns.t')}/odd")
    state = lake._state("ns.t")
    lake._commit("ns.t", 2, state | {"folders": [*state["folders"], "odd"]})
    assert sorted(r.v for r in lake.scan_with_fallback("ns.t", "k > 1").collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        lake.scan_with_fallback("ns.t", "k > 1", most_bytes=1)


def test_damaged_backup(spark, tmp_path):
    out = str(tmp_path / "b c=1")
    spark.range(5).coalesce(1).write.parquet(f"{out}/tA")
    sources_of = pipeline.file_checksums(spark, out).where("path like '%.parquet'")
    sources_of.coalesce(1).write.json(f"{out}/_manifest")
    pipeline.verify_backup(spark, out)
    file = next((tmp_path / "b c=1/tA").glob("*.parquet"))
    file.write_bytes(file.read_bytes() + b"!")
    with pytest.raises(pipeline.DamagedBackup):
        pipeline.verify_backup(spark, out)


def test_options(spark):
    df = spark.createDataFrame([(x,) for x in ("true", " YES", "0", None, "x")], "f string")
    assert [r[0] for r in df.select(parse_flag(F.col("f"))).collect()] == [True, True, False, False, False]
    df = spark.createDataFrame([(x,) for x in ("[1, \"2\", \"x\"]", "3,,4 ", "", None)], "f string")
    assert [r[0] for r in df.select(parse_ids(F.col("f"))).collect()] == [[1, 2], [3, 4], [], []]


def test_usage_rows(spark):
    runs = spark.sql("select * from values (1, 'STANDARD', timestamp_ntz'2025-01-31 23:00:00', timestamp_ntz'2025-02-01 01:00:00', 1.5BD), (2, 'EXPRESS', null, null, 2BD), (3, null, timestamp_ntz'2025-02-02 00:00:00', null, 3BD) t(run, route, started_at, stopped_at, d)")
    got = {r.run: (r.path, r.cores, r.liable, r.billing_month, r.duration_seconds) for r in usage_rows(runs).collect()}
    assert got == {1: ("PATH2", 16, True, "2025-01", 7200), 2: ("PATH1", 0, False, None, None), 3: ("PATH1", 0, False, "2025-02", None)}
    month = billing_month(usage_rows(runs), "2025-01")
    assert month.count() == 1 and dict(month.dtypes)["d"] == "double"
