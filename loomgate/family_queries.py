"""Queries of the key, filter, coercion, validation and reporting operators on the supplied tables.

The order tables stand in for the family: customer is the entity, orders the
contract, lineitem the child without a unique key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgate.functions.expressions import EXTRACTED, INGESTED, TOTAL, counters, deep_counter, first_key, hex_text, iso_timestamp, json_counter, log_counter, parse_flag, parse_ids, safe_name, squeezed, table_key_name
from loomgate.functions.types import spark_type
from loomgate.operators import coerce, estimate, filters, jobs, state, usage, validate
from loomgate.operators.rekey import RangeAllocator, Rekeyer, created_mapping, entity_metadata, mapping, rewrite
from loomgate.plans.hierarchy import Edge, Hierarchy, Table
from loomgate.plans.matching import match_tables
from loomgate.plans import mapping as map_files
from loomgate.runtime import shared_path
from loomgate.sources.lake import Lake, delimited_rows, footer_stats, upserted

ORDER_FAMILY = Hierarchy([
    Table("region", 0, "r_regionkey"),
    Table("part", 0, "p_partkey"),
    Table("nation", 1, "n_nationkey", {"n_regionkey": "region"}),
    Table("customer", 2, "c_custkey", {"c_nationkey": "nation"}),
    Table("supplier", 2, "s_suppkey", {"s_nationkey": "nation"}),
    Table("orders", 3, "o_orderkey", {"o_custkey": "customer"}),
    Table("lineitem", 4, "l_orderkey", {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"}),
])
IDS = [3, 14, 15, 92, 65, 35, 89, 79]
IDS_SQL = ", ".join(map(str, IDS))
NATIONS = [2, 7]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def family(spark: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    return {n: t(spark, d, n) for n in (names or ORDER_FAMILY.order())}


# ---- filters and counts


@query(f"SELECT count(*) AS cnt FROM orders WHERE o_custkey IN ({IDS_SQL})")
def filter_direct_count(spark, d):
    return filters.entity_filter(t(spark, d, "orders"), IDS, ("o_custkey",)).agg(F.count(F.lit(1)).alias("cnt"))


@query(f"SELECT l.* FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({IDS_SQL}))")
def fk_path_filter_rows(spark, d):
    tables = family(spark, d)
    return filters.reachable_filter(ORDER_FAMILY, tables, "lineitem", {"customer": "c_custkey", "orders": "o_custkey"}, IDS)


@query(f"SELECT count(*) AS cnt FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey IN ({IDS_SQL})")
def fk_path_count_1hop(spark, d):
    return filters.path_count(family(spark, d), ORDER_FAMILY.path("orders", {"customer"}), "c_custkey", IDS)


@query(f"SELECT count(*) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_custkey IN ({IDS_SQL})")
def fk_path_count_2hop(spark, d):
    return filters.path_count(family(spark, d), ORDER_FAMILY.path("lineitem", {"customer"}), "c_custkey", IDS)


@query("SELECT count(*) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey IN (2, 7)")
def fk_path_count_3hop(spark, d):
    path = [*ORDER_FAMILY.path("lineitem", {"customer"}), *ORDER_FAMILY.path("customer", {"nation"})]
    return filters.path_count(family(spark, d), path, "n_nationkey", NATIONS)


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM {n}" for n in ORDER_FAMILY.order()))
def count_all_tables(spark, d):
    return filters.count_all(family(spark, d))


@query("SELECT count(*) AS cnt FROM tlocation WHERE locationsid BETWEEN 2500 AND 6000")
def key_range_count(spark, d):
    return filters.key_count(t(spark, d, "tlocation"), "locationsid", low=2500, high=6000)


@query("SELECT count(*) AS cnt FROM tlocation WHERE parentlocationsid IS NULL")
def key_null_count(spark, d):
    return filters.key_count(t(spark, d, "tlocation"), "parentlocationsid")


@query("SELECT l.* FROM tlocation l WHERE contractsid IN (SELECT contractsid FROM tcontract WHERE exposuresetsid IN (501, 506, 511))")
def discovered_path_rows(spark, d):
    tables = {"tcontract": t(spark, d, "tcontract"), "tlocation": t(spark, d, "tlocation")}
    graph = Hierarchy.discover({n: f.columns for n, f in tables.items()})
    return filters.path_filter(tables, graph.path("tlocation", {"tcontract"}), "exposuresetsid", [501, 506, 511])


# ---- re-keying

_MAP = "SELECT {k} AS old_sid, {s} + row_number() OVER (ORDER BY {k}) - 1 AS new_sid FROM {t}"


def _rekeyed(spark, d, names, overrides=None, starts=None):
    first = starts or {}
    r = Rekeyer(ORDER_FAMILY, RangeAllocator(lambda n: first.get(n, 1_000_000)), overrides)
    return r.run(family(spark, d, *names)), r


@query(_MAP.format(k="o_orderkey", s=1_000_000, t="orders"))
def rekey_mapping_orders(spark, d):
    return mapping(t(spark, d, "orders"), "o_orderkey", 1_000_000)


@query(f"""WITH o AS ({_MAP.format(k='o_orderkey', s=1_000_000, t='orders')}), c AS ({_MAP.format(k='c_custkey', s=5_000_000, t='customer')})
SELECT o.new_sid AS o_orderkey, coalesce(c.new_sid, o_custkey) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders JOIN o ON o_orderkey = o.old_sid LEFT JOIN c ON o_custkey = c.old_sid""")
def rekey_orders(spark, d):
    return _rekeyed(spark, d, ["customer", "orders"], starts={"customer": 5_000_000})[0]["orders"]


@query("SELECT l_orderkey AS old_sid, max(1000000 + rn - 1) AS new_sid FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) AS rn FROM lineitem) GROUP BY 1")
def rekey_duplicates_last_wins(spark, d):
    return mapping(t(spark, d, "lineitem"), "l_orderkey", 1_000_000)


@query(f"""WITH o AS ({_MAP.format(k='o_orderkey', s=1_000_000, t='orders')}), p AS ({_MAP.format(k='p_partkey', s=1_000_000, t='part')}), s AS ({_MAP.format(k='s_suppkey', s=1_000_000, t='supplier')})
SELECT o.new_sid AS l_orderkey, p.new_sid AS l_partkey, s.new_sid AS l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem LEFT JOIN o ON l_orderkey = o.old_sid LEFT JOIN p ON l_partkey = p.old_sid LEFT JOIN s ON l_suppkey = s.old_sid""")
def rekey_child_of_three(spark, d):
    """The child's key is itself a reference: it follows the parent."""
    return _rekeyed(spark, d, ["orders", "part", "supplier", "lineitem"])[0]["lineitem"]


@query(f"""WITH o AS ({_MAP.format(k='o_orderkey', s=1_000_000, t='orders')})
SELECT o.new_sid AS o_orderkey, CAST(77 AS BIGINT) AS o_custkey FROM orders JOIN o ON o_orderkey = o.old_sid""")
def rekey_override(spark, d):
    return _rekeyed(spark, d, ["customer", "orders"], {"customer": 77})[0]["orders"].select("o_orderkey", "o_custkey")


@query("""WITH c AS (SELECT c_custkey AS old_sid, 5000000 + row_number() OVER (ORDER BY c_custkey) - 1 AS new_sid FROM customer WHERE c_custkey % 3 <> 0)
SELECT o_orderkey, coalesce(c.new_sid, o_custkey) AS o_custkey FROM orders LEFT JOIN c ON o_custkey = c.old_sid""")
def rekey_missing_parent(spark, d):
    m = mapping(t(spark, d, "customer").where("c_custkey % 3 <> 0"), "c_custkey", 5_000_000)
    return rewrite(t(spark, d, "orders").select("o_orderkey", "o_custkey"), {"o_custkey": m})


@query("""WITH loc AS (SELECT * FROM tlocation), n AS (SELECT locationsid, max(1000000 + rn - 1) AS new_sid FROM (SELECT locationsid, row_number() OVER (ORDER BY locationsid) AS rn FROM loc) GROUP BY 1),
c AS (SELECT contractsid, max(1000000 + rn - 1) AS new_sid FROM (SELECT contractsid, row_number() OVER (ORDER BY contractsid) AS rn FROM tcontract) GROUP BY 1)
SELECT n.new_sid AS locationsid, coalesce(c.new_sid, loc.contractsid) AS contractsid, coalesce(p.new_sid, loc.parentlocationsid) AS parentlocationsid, geographysid
FROM loc JOIN n USING (locationsid) LEFT JOIN c ON loc.contractsid = c.contractsid LEFT JOIN n p ON loc.parentlocationsid = p.locationsid""")
def rekey_self_reference(spark, d):
    """The family's own tables: tree kept, external column untouched."""
    r = Rekeyer(Hierarchy.family(), RangeAllocator())
    out = r.run({"tcontract": t(spark, d, "tcontract"), "tlocation": t(spark, d, "tlocation")})
    return out["tlocation"].select("locationsid", "contractsid", "parentlocationsid", "geographysid")


@query("SELECT min(1000000 + rn - 1) AS first_sid, max(1000000 + rn - 1) AS last_sid, count(*) AS ids FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS rn FROM customer)")
def mapping_range(spark, d):
    return state.id_range(mapping(t(spark, d, "customer"), "c_custkey", 1_000_000))


@query("SELECT contractsid AS old_sid, contractname AS name, (SELECT count(*) FROM tcontract) AS total FROM tcontract WHERE contractname IS NOT NULL")
def entity_names(spark, d):
    return entity_metadata(t(spark, d, "tcontract"), "contractsid", "contractname")


@query("SELECT n_name AS name, CAST(n_nationkey AS BIGINT) AS old_sid, 900 + row_number() OVER (ORDER BY n_name) - 1 AS new_sid FROM nation")
def created_by_name(spark, d):
    entities = entity_metadata(t(spark, d, "nation"), "n_nationkey", "n_name")
    return created_mapping(entities, lambda names: {n: 900 + i for i, n in enumerate(names)}).select("name", "old_sid", "new_sid")


# ---- validation


@query("""SELECT 'orders.o_custkey' AS edge, count(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)
UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def fk_orphans(spark, d):
    tables = family(spark, d)
    tables["customer"] = tables["customer"].where("c_custkey % 5 <> 0")
    return validate.orphan_counts(tables, [Edge("orders", "o_custkey", "customer", "c_custkey"), Edge("lineitem", "l_orderkey", "orders", "o_orderkey")])


_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM {n}" for n in ORDER_FAMILY.order())


@query(f"""WITH a AS ({_COUNTS}), e AS (SELECT table_name, cnt + CASE table_name WHEN 'region' THEN 1 ELSE 0 END AS expected FROM a WHERE table_name <> 'nation' UNION ALL SELECT 'lost', 1)
SELECT coalesce(e.table_name, a.table_name) AS table_name, CAST(expected AS BIGINT) AS expected, cnt AS actual,
CASE WHEN cnt IS NULL THEN 'ERROR' WHEN expected IS NULL THEN 'EXTRA' WHEN cnt = expected THEN 'OK' ELSE 'WARNING' END AS status FROM e FULL JOIN a ON e.table_name = a.table_name""")
def rowcount_validation(spark, d):
    """Counts of all tables against those of a copy that misstates one, lacks one and has one too many."""
    actual = filters.count_all(family(spark, d))
    expected = actual.where("table_name <> 'nation'").withColumn("cnt", F.col("cnt") + F.when(F.col("table_name") == "region", 1).otherwise(0))
    lost = spark.createDataFrame([("lost", 1)], "table_name string, cnt bigint")
    return validate.row_counts(expected.unionByName(lost), actual)


@query("""SELECT s AS source_rows, CASE WHEN e > 0 THEN e ELSE r END AS lake_rows, CASE WHEN s = CASE WHEN e > 0 THEN e ELSE r END THEN 'OK' WHEN CASE WHEN e > 0 THEN e ELSE r END > s THEN 'EXTRA ROWS' ELSE 'DIFF' END AS note
FROM (SELECT count(*) AS s FROM tcontract WHERE exposuresetsid = 506), (SELECT count(*) FILTER (WHERE exposuresetsid = 506) AS e, count(*) FILTER (WHERE contractsid BETWEEN 1000 AND 1200) AS r FROM tcontract)""")
def entity_reconciliation(spark, d):
    c = t(spark, d, "tcontract")
    return validate.set_reconciliation(c.where("exposuresetsid = 506"), c, "contractsid", 1000, 1200, "exposuresetsid", 506)


@query()
def table_checksums(spark, d):
    out = None
    for n in ORDER_FAMILY.order():
        one = validate.checksum(t(spark, d, n)).select(F.lit(n).alias("table_name"), "checksum")
        out = one if out is None else out.unionAll(one)
    return out


@query()
def file_checksums(spark, d):
    return validate.file_checksums(spark, d).withColumn("path", F.element_at(F.split("path", "/"), -1))


# ---- coercion, upsert, delta

_CUSTOMER = "C_NATIONKEY bigint, c_name string, c_custkey int, c_acctbal decimal(18,2), c_segment string, C_MKTSEGMENT string, opened date"


@query("""SELECT CAST(c_nationkey AS BIGINT) AS C_NATIONKEY, c_name, CAST(c_custkey AS INT) AS c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_segment,
c_mktsegment AS C_MKTSEGMENT, CAST(NULL AS DATE) AS opened FROM customer""")
def coerce_customer(spark, d):
    return coerce.align(t(spark, d, "customer"), spark.createDataFrame([], _CUSTOMER).schema)


@query("SELECT 'c_name' AS column_name, count(c_name) AS nulled FROM customer UNION ALL SELECT 'c_nationkey', 0 FROM range(1)")
def coerce_nulled(spark, d):
    return coerce.nulled(t(spark, d, "customer"), spark.createDataFrame([], "c_name double, c_nationkey bigint").schema)


@query("SELECT o_orderkey, CAST(((o_orderkey * 7919 + 128) % 256 + 256) % 256 - 128 AS INT) AS wrapped FROM orders")
def coerce_wrapped(spark, d):
    src = t(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 7919).alias("wrapped"))
    return coerce.align(src, spark.createDataFrame([], "o_orderkey bigint, wrapped tinyint").schema, wrap=True).withColumn("wrapped", F.col("wrapped").cast("int"))


@query("""SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events""")
def timestamp_iso(spark, d):
    return t(spark, d, "events").select("event_id", iso_timestamp(F.col("ts")).alias("iso"))


@query("""WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 100 = 1)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s""")
def upsert_orders(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    s = o.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2).unionByName(o.where("o_orderkey % 100 = 1").withColumn("o_orderkey", F.col("o_orderkey") + 10000000))
    return upserted(o, s, ["o_orderkey"])


@query("SELECT concat_ws('|', p_partkey, coalesce(p_name, ''), coalesce(p_brand, ''), coalesce(p_type, ''), p_size) AS value, contains(concat(p_name, p_brand, p_type), '|') AS collides FROM part")
def delimited_export(spark, d):
    return delimited_rows(t(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), "|")


# ---- usage

_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS tenant, o_orderdate AS a, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INT)) END AS b, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS cores FROM orders),
ev AS (SELECT a AS ts, cores AS delta, run_id FROM runs UNION ALL SELECT b, -cores, run_id FROM runs WHERE b IS NOT NULL),
s AS (SELECT ts, delta, run_id, CAST(sum(delta) OVER (ORDER BY ts, delta, run_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM ev)"""


def runs(spark, d):
    o = t(spark, d, "orders")
    stop = F.when(F.col("o_orderkey") % 97 != 0, F.expr("o_orderdate + make_dt_interval(cast(o_orderkey % 30 as int))"))
    return o.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), stop.alias("stopped_at"), F.substring("o_orderpriority", 1, 1).cast("bigint").alias("cores"))


@query(f"WITH {_RUNS} SELECT max(running) AS peak FROM s")
def sweep_peak(spark, d):
    return usage.peak(runs(spark, d))


@query(f"WITH {_RUNS} SELECT * FROM s")
def sweep_running(spark, d):
    return usage.concurrency(runs(spark, d))


@query(f"WITH {_RUNS} SELECT * FROM s WHERE running = (SELECT max(running) FROM s)")
def sweep_peak_events(spark, d):
    return usage.peak_events(runs(spark, d))


@query(f"WITH {_RUNS} SELECT * FROM s WHERE running = (SELECT max(running) FROM s) AND running > 0 ORDER BY ts, delta, run_id LIMIT 5")
def sweep_first_peak_events(spark, d):
    return usage.peak_events(runs(spark, d), usage.PEAK_EVENTS)


@query(f"WITH {_RUNS} SELECT greatest(4, coalesce(max(running), 0)) AS peak FROM s WHERE run_id < 0")
def sweep_floor(spark, d):
    return usage.peak(runs(spark, d).where("run_id < 0"), usage.FLOOR)


@query("""SELECT event_id, route, CASE route WHEN 'STANDARD' THEN 'PATH2' WHEN 'BATCH' THEN 'PATH3' ELSE 'PATH1' END AS path, CASE WHEN route IN ('STANDARD', 'BATCH') THEN 16 ELSE 0 END AS cores,
coalesce(route IN ('STANDARD', 'BATCH'), false) AS liable, user_id % 7200 AS duration_seconds FROM (SELECT *, CASE event_id % 4 WHEN 0 THEN 'STANDARD' WHEN 1 THEN 'BATCH' WHEN 2 THEN 'EXPRESS' END AS route FROM events) WHERE strftime(ts, '%Y-%m') = '2024-01'""")
def usage_of_month(spark, d):
    """Usage rows of one billing month, with what their route implies."""
    e = t(spark, d, "events").select("event_id", F.expr("case event_id % 4 when 0 then 'STANDARD' when 1 then 'BATCH' when 2 then 'EXPRESS' end").alias("route"), F.col("ts").alias("started_at"),
                                    F.expr("ts + make_dt_interval(0, 0, 0, user_id % 7200)").alias("stopped_at"))
    return usage.billing_month(usage.usage_rows(e), "2024-01").drop("started_at", "stopped_at", "billing_month")


@query(f"WITH {_RUNS} SELECT CAST(sum(cores) AS BIGINT) AS cores FROM runs WHERE b IS NULL")
def running_cores(spark, d):
    return usage.running_now(runs(spark, d))


@query("""SELECT coalesce(tenant_id, 'unknown') AS tenant_id, min(CASE WHEN r <> '' THEN r END) AS tenant_resource_id, count(*) AS total_runs, count(*) FILTER (WHERE path = 'PATH1') AS path1_runs, count(*) FILTER (WHERE path = 'PATH2') AS path2_runs,
count(*) FILTER (WHERE path = 'PATH3') AS path3_runs, round(sum(s / 3600.0), 4) AS total_duration_hours, round(sum(cores * (s / 3600.0)), 4) AS total_core_hours
FROM (SELECT 'u' || user_id AS tenant_id, CASE WHEN event_id % 2 = 0 THEN 'res' || user_id ELSE '' END AS r, 'PATH' || (event_id % 3 + 1) AS path, event_id % 7200 AS s, event_id % 16 AS cores FROM events) GROUP BY 1""")
def usage_per_tenant(spark, d):
    e = t(spark, d, "events").selectExpr("concat('u', user_id) tenant_id", "if(event_id % 2 = 0, concat('res', user_id), '') tenant_resource_id", "concat('PATH', event_id % 3 + 1) path", "event_id % 7200 duration_seconds", "event_id % 16 cores")
    return usage.per_tenant(e)


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS runs FROM orders GROUP BY 1")
def usage_by_month(spark, d):
    return usage.by_month(t(spark, d, "orders"), "o_orderdate", F.count(F.lit(1)).alias("runs"))


@query("SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS month_before FROM orders")
def previous_months(spark, d):
    return t(spark, d, "orders").select("o_orderkey", usage.previous_month(F.to_date("o_orderdate")).alias("month_before"))


@query("SELECT c.contractsid, CAST(floor(epoch(deleted_at) - epoch(loaded_at)) AS BIGINT) AS seconds FROM tcontract c WHERE deleted_at IS NOT NULL")
def durations(spark, d):
    return t(spark, d, "tcontract").where("deleted_at is not null").select("contractsid", usage.duration_seconds(F.col("loaded_at"), F.col("deleted_at")).alias("seconds"))


# ---- jobs


@query("SELECT event_type AS kind, count(*) FILTER (WHERE user_id % 3 = 0) AS running, count(*) FILTER (WHERE user_id % 3 = 1) AS failed, count(*) FILTER (WHERE user_id % 3 = 2) AS succeeded, count(*) AS total FROM events GROUP BY 1")
def status_pivot(spark, d):
    e = t(spark, d, "events").withColumn("status", F.element_at(F.array(F.lit("RUNNING"), F.lit("FAILED"), F.lit("SUCCEEDED")), (F.col("user_id") % 3 + 1).cast("int")))
    return jobs.status_pivot(e, "event_type", "status", ["RUNNING", "FAILED", "SUCCEEDED"])


@query("SELECT event_id, ts, user_id FROM events WHERE event_type IN ('click', 'error') ORDER BY ts DESC, event_id LIMIT 50")
def top_recent(spark, d):
    e = t(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return jobs.top_recent([e.where("event_type = 'click'"), e.where("event_type = 'error'")], "ts", 50, "event_id").drop("event_type")


@query("""SELECT e.user_id, e.event_id, max(s.event_id) AS state_event_id, arg_max(s.event_type, s.event_id) AS state FROM events e
LEFT JOIN events s ON s.user_id = e.user_id AND s.event_id < e.event_id AND s.event_type IN ('signup', 'view') WHERE e.event_type = 'error' GROUP BY 1, 2""")
def last_state_before_failure(spark, d):
    return jobs.last_state_before(t(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "error", F.col("event_type").isin("signup", "view"), "event_type")


@query("SELECT min(target_table) AS target_table FROM lake_files WHERE target_table IS NOT NULL GROUP BY lower(target_table)")
def distinct_without_case(spark, d):
    return jobs.distinct_ids(t(spark, d, "lake_files").select("target_table"), "target_table")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_counter_path(spark, d):
    return t(spark, d, "events").select("event_id", json_counter(F.col("props"), "$.k").alias("k"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS v FROM events")
def first_present_key(spark, d):
    return t(spark, d, "events").select("event_id", first_key(F.col("props"), ["$.missing", "$.k"]).alias("v"))


@query("SELECT event_id, CAST(event_id AS INT) AS ingested, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS INT) END AS extracted FROM events")
def json_deep_counter(spark, d):
    """Counters nested in objects, arrays and JSON held as text."""
    e = t(spark, d, "events")
    doc = F.concat(F.lit('{"run":[{"Records_Ingested":"'), F.col("event_id"), F.lit('"},{"detail":"{\\"rows-extracted\\": '), F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise("null"), F.lit('}"}]}'))
    found = e.select("event_id", counters({"ingested": INGESTED, "extracted": EXTRACTED}, doc).alias("c"))
    return found.select("event_id", "c.ingested", "c.extracted")


@query("SELECT event_id, CAST(event_id AS INT) AS total, CAST(NULL AS INT) AS ingested FROM events")
def log_regex_counter(spark, d):
    e = t(spark, d, "events").withColumn("line", F.concat(F.lit("INFO done, total record-count = "), F.col("event_id")))
    return e.select("event_id", log_counter(F.col("line"), "total").alias("total"), log_counter(F.col("line"), "ingested").alias("ingested"))


@query("SELECT event_id, CAST(event_id AS INT) AS ingested, CAST(user_id AS INT) AS extracted FROM events")
def enriched_counts(spark, d):
    e = t(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.format_string('{"recordsIngested": %d}', "event_id")).alias("progress"),
        F.when(F.col("event_id") % 2 == 1, F.format_string('{"output": {"ingestedCount": "%d"}}', "event_id")).alias("output"), F.format_string("records_extracted: %d", "user_id").alias("log"))
    return jobs.enriched_counts(e, "progress", "output", "log").select("event_id", "ingested", "extracted")


# ---- size estimate

_STATS = [("contract", 0, 1000, 5_000_000, 12, None, True), ("layer", 250, 500, 2_000_000, 8, "contract", False), ("term", 10, 0, 0, 6, "contract", False), ("note", 40, 0, 0, 0, None, False), ("location", 900_000, 1_000_000, 800_000_000, 30, "contract", True)]
_STATS_SQL = "st(table_name, matched, total_rows, total_bytes, columns, parent, direct) AS (VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() for v in r) + ")" for r in _STATS) + "), ch AS (SELECT parent, max(matched / total_rows) AS share FROM st WHERE parent IS NOT NULL AND matched > 0 AND total_rows > 0 GROUP BY 1), fx AS (SELECT table_name, CASE WHEN matched = 0 AND direct AND total_rows > 0 AND share IS NOT NULL THEN CAST(floor(share * total_rows) AS BIGINT) ELSE matched END AS matched, total_rows, total_bytes, columns FROM st LEFT JOIN ch ON ch.parent = table_name), sz AS (SELECT table_name, matched, CAST(CASE WHEN matched = 0 THEN 0 WHEN total_rows > 0 AND total_bytes > 0 THEN floor(matched / total_rows * total_bytes * 28) WHEN columns > 0 THEN matched * columns * 2 * 28 ELSE matched * 500 END AS BIGINT) AS estimated_bytes FROM fx)"


def stats(spark):
    return spark.createDataFrame(_STATS, "table_name string, matched bigint, total_rows bigint, total_bytes bigint, columns int, parent string, direct boolean")


@query(f"WITH {_STATS_SQL} SELECT CAST(sum(matched) AS BIGINT) AS total_rows, CAST(sum(estimated_bytes) AS BIGINT) AS estimated_bytes, CASE WHEN sum(estimated_bytes) <= 9663676416 THEN 'EXPRESS' WHEN sum(estimated_bytes) <= 85899345920 THEN 'STANDARD' ELSE 'BATCH' END AS route FROM sz")
def size_estimate(spark, d):
    return estimate.estimate(stats(spark))


@query(f"WITH {_STATS_SQL} SELECT * FROM sz")
def child_fraction_fallback(spark, d):
    return estimate.table_bytes(estimate.with_child_fraction(stats(spark)))


@query("SELECT o_orderkey, CASE WHEN o_totalprice * 1e6 <= 9663676416 THEN 'EXPRESS' WHEN o_totalprice * 1e6 <= 85899345920 THEN 'STANDARD' ELSE 'BATCH' END AS route FROM orders")
def route(spark, d):
    return t(spark, d, "orders").select("o_orderkey", estimate.route(F.col("o_totalprice") * 1e6).alias("route"))


# ---- audit, names, types


@query("SELECT * FROM allocation_records WHERE lower(table_name) = 'tcontract' AND original_id = 1500")
def audit_lookup(spark, d):
    return state.audit_lookup(t(spark, d, "allocation_records"), "tContract", original_id=1500)


@query("SELECT date_part('year', finished_at) AS level, count(*) AS tables, CAST(sum(rows_processed) AS BIGINT) AS rows, round(sum(result_id % 100 / 10.0), 3) AS seconds FROM transform_results GROUP BY 1")
def level_metrics(spark, d):
    r = t(spark, d, "transform_results").select(F.year("finished_at").cast("bigint").alias("level"), "table_name", F.col("rows_processed").alias("rows"), (F.col("result_id") % 100 / 10).alias("seconds"))
    return state.level_metrics(r)


@query(r"SELECT p_partkey, lower(regexp_replace(p_name, '[_\-\s]+', '', 'g')) AS plain, substr(CASE WHEN regexp_matches(p_name, '^[0-9]') THEN '_' ELSE '' END || regexp_replace(p_name, '[^a-zA-Z0-9_]', '_', 'g'), 1, 128) AS safe FROM part")
def name_normalise(spark, d):
    return t(spark, d, "part").select("p_partkey", squeezed(F.col("p_name")).alias("plain"), safe_name(F.col("p_name")).alias("safe"))


@query("SELECT DISTINCT table_name, lower(regexp_replace(table_name, '^[tT]', '')) || 'sid' AS key_name FROM allocation_records")
def key_names(spark, d):
    return t(spark, d, "allocation_records").select("table_name", table_key_name(F.col("table_name")).alias("key_name")).distinct()


@query()
def declared_types(spark, d):
    c = t(spark, d, "column_plans")
    return c.select(F.explode(F.array("source_type", "target_type")).alias("declared")).groupBy("declared", spark_type(F.col("declared")).alias("spark_type")).agg(F.count(F.lit(1)).alias("columns"))


@query()
def matched_columns(spark, d):
    """The columns each feed delivers against the catalog."""
    plans, catalog = t(spark, d, "column_plans"), t(spark, d, "column_catalog")
    source = plans.groupBy(F.col("feed_key").alias("table_key"), F.col("source_name").alias("name")).agg(F.min(F.struct("file_seq", "ordinal", F.col("source_type").alias("kind"))).alias("x"))
    source = source.select("table_key", (F.col("x.file_seq") * 10_000 + F.coalesce("x.ordinal", F.lit(9_999))).alias("at"), "name", "x.kind")
    entries = catalog.agg(F.collect_list(F.struct(F.col("catalog_id").cast("int").alias("at"), F.col("column_name").alias("name"), F.col("sql_type").alias("kind"))).alias("entries"))
    target = source.select("table_key").distinct().crossJoin(F.broadcast(entries)).select("table_key", F.inline("entries"))  # one row: the fixed catalog
    return match_tables(source, target).drop("source_at", "target_at")


# ---- the lake, through its operators


def _lake(spark):
    return Lake(spark, shared_path(spark, "lake"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 1")
def lake_incremental(spark, d):
    """The rows of the second of two appends."""
    lake, o = _lake(spark), t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lake.create("ns.orders", o.schema)
    lake.append("ns.orders", o.where("o_orderkey % 3 = 0"))
    since = lake.version("ns.orders")
    lake.append("ns.orders", o.where("o_orderkey % 3 = 1"))
    return lake.read("ns.orders", "incremental", since)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -1 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'late' END AS note FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey + 10000000, o_custkey, 'new' FROM orders WHERE o_orderkey % 500 = 1""")
def lake_lifecycle(spark, d):
    """Create, append, overwrite, add a column, upsert; then a full scan."""
    lake, o = _lake(spark), t(spark, d, "orders").select("o_orderkey", "o_custkey")
    lake.create_namespace("ns")
    lake.create("ns.orders", o.schema)
    lake.append("ns.orders", o)
    lake.overwrite("ns.orders", o.where("o_orderkey % 2 = 0"))
    lake.overwrite("ns.orders", o.limit(0))  # an empty input leaves the old rows
    lake.add_columns("ns.orders", [T.StructField("note", T.StringType())])
    changed = o.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit(-1).cast("bigint").alias("o_custkey"), F.lit("late").alias("note"))
    added = o.where("o_orderkey % 500 = 1").select((F.col("o_orderkey") + 10_000_000).alias("o_orderkey"), "o_custkey", F.lit("new").alias("note"))
    lake.upsert("ns.orders", changed.unionByName(added), ["o_orderkey"])
    return lake.read("ns.orders")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN (2, 7)")
def lake_filtered_scan(spark, d):
    lake, c = _lake(spark), t(spark, d, "customer")
    lake.create("ns.customer", c.schema, ["c_mktsegment"])
    lake.append("ns.customer", c)
    return lake.scan("ns.customer", ["c_custkey", "c_name"], "c_mktsegment = 'BUILDING' and c_nationkey in (2, 7)")


@query("SELECT 'ns.customer' AS table_name, true AS found, 1 AS probe UNION ALL SELECT 'ns.empty', false, 0 UNION ALL SELECT 'ns.none', false, 0")
def lake_probe(spark, d):
    """Which tables have rows, among those listed and one that does not exist."""
    lake, c = _lake(spark), t(spark, d, "customer")
    lake.create("ns.customer", c.schema)
    lake.create("ns.empty", c.schema)
    lake.append("ns.customer", c)
    return spark.createDataFrame([(n, *lake.has_rows(n)) for n in [*lake.list_tables("ns"), "ns.none"]], "table_name string, found boolean, probe int")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey < 1000")
def lake_scan_with_fallback(spark, d):
    """One folder's key is text: the filtered scan fails, the casting one does not."""
    lake, o = _lake(spark), t(spark, d, "orders").select("o_orderkey", "o_custkey")
    lake.create("ns.orders", o.schema)
    lake.append("ns.orders", o.where("o_orderkey % 2 = 0"))
    folder = f"v-{uuid.uuid4().hex}"
    o.where("o_orderkey % 2 = 1").withColumn("o_orderkey", F.col("o_orderkey").cast("string")).write.parquet(f"{lake._dir('ns.orders')}/{folder}")
    state = lake._state("ns.orders")
    lake._commit("ns.orders", lake._last("ns.orders") + 1, state | {"folders": [*state["folders"], folder]})
    return lake.scan_with_fallback("ns.orders", "o_orderkey < 1000")


@query(" UNION ALL ".join(f"SELECT '{n}.parquet' AS file, count(*) AS rows FROM {n}" for n in ORDER_FAMILY.order()))
def file_footers(spark, d):
    out = None
    for n in ORDER_FAMILY.order():
        one = footer_stats(t(spark, d, n)).groupBy(F.lit(f"{n}.parquet").alias("file")).agg(F.sum("rows").alias("rows"))
        out = one if out is None else out.unionAll(one)
    return out


@query(f"""SELECT 'customer' AS table_name, 'direct' AS strategy, count(*) AS cnt FROM customer WHERE c_custkey IN ({IDS_SQL}) UNION ALL SELECT 'orders', 'path', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey IN ({IDS_SQL})
UNION ALL SELECT 'lineitem', 'path', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_custkey IN ({IDS_SQL})
UNION ALL SELECT 'region', 'reference', count(*) FROM region UNION ALL SELECT 'nation', 'reference', count(*) FROM nation UNION ALL SELECT 'part', 'skip', 0 UNION ALL SELECT 'supplier', 'skip', 0""")
def picked_counts(spark, d):
    return filters.picked_counts(ORDER_FAMILY, family(spark, d), {"customer": "c_custkey"}, IDS, ("region", "nation"))


@query(f"""WITH m(table_name, matched, columns) AS (SELECT 'customer', count(*), 5 FROM customer WHERE c_custkey IN ({IDS_SQL}) UNION ALL SELECT 'orders', count(*), 6 FROM orders WHERE o_custkey IN ({IDS_SQL})
UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IN ({IDS_SQL}) UNION ALL SELECT 'part', 0, 6)
SELECT table_name, matched, CAST(matched * columns * 2 * 28 AS BIGINT) AS estimated_bytes FROM m""")
def estimate_from_tables(spark, d):
    """Bytes per table from counts over the real tables and their columns."""
    tables = family(spark, d, "customer", "orders", "lineitem", "part")
    counted = filters.picked_counts(ORDER_FAMILY, tables, {"customer": "c_custkey"}, IDS)
    widths = spark.createDataFrame([(n, len(f.columns)) for n, f in tables.items()], "table_name string, columns int")
    stats = counted.join(widths, "table_name").select("table_name", F.col("cnt").alias("matched"), F.lit(0).cast("bigint").alias("total_rows"), F.lit(0).cast("bigint").alias("total_bytes"), "columns")
    return estimate.table_bytes(stats)


# ---- mapping and text helpers


@query("SELECT c_custkey AS CUST_KEY, c_name AS CName, c_acctbal AS \"C_AcctBal\" FROM customer")
def mapped_customer(spark, d):
    """Columns matched to a target's names and projected."""
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").withColumnRenamed("c_custkey", "cust_key")
    entry = map_files.make_entry("lake", "customer", c, [("C_AcctBal", "FLOAT"), ("CName", "NVARCHAR(50)"), ("CUST_KEY", "BIGINT"), ("Zeitraum", "DATE")])
    return map_files.project(c, entry)


@query("SELECT 'region' AS table_name, 'CREATE TABLE [dbo].[region] ([RRegionkey] INT NULL, [RName] NVARCHAR(MAX) NULL)' AS ddl UNION ALL SELECT 'supplier', 'CREATE TABLE [dbo].[supplier] ([SSuppkey] BIGINT NULL, [SName] NVARCHAR(MAX) NULL, [SNationkey] INT NULL, [SAcctbal] FLOAT NULL)'")
def create_statements(spark, d):
    one = lambda n: map_files.create_table_ddl(map_files.make_entry("lake", n, t(spark, d, n), None))
    return spark.createDataFrame([(n, one(n)) for n in ("region", "supplier")], "table_name string, ddl string")


@query("SELECT p_partkey, sha256(p_name) AS digest, lower(hex(p_name)) AS hex FROM part")
def text_digests(spark, d):
    return t(spark, d, "part").select("p_partkey", F.sha2("p_name", 256).alias("digest"), hex_text(F.col("p_name").cast("binary")).alias("hex"))


@query("SELECT event_id, lower(trim(f)) IN ('true', '1', 'yes', 'on') AS flag, [event_id, user_id] AS ids FROM (SELECT *, CASE event_id % 5 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'On ' ELSE '' END AS f FROM events)")
def parsed_options(spark, d):
    """Flags and id lists (JSON and comma text) as they come in as options."""
    e = t(spark, d, "events")
    flag = F.expr("case event_id % 5 when 0 then ' TRUE' when 1 then 'no' when 2 then '1' when 3 then 'On ' else '' end")
    ids = F.when(F.col("event_id") % 2 == 0, F.format_string("[%d, \"%d\", \"x\"]", "event_id", "user_id")).otherwise(F.format_string("%d, ,%d", "event_id", "user_id"))
    return e.select("event_id", parse_flag(flag).alias("flag"), parse_ids(ids).alias("ids"))


@query("SELECT event_id, CAST(event_id AS INT) AS total FROM events")
def json_total_counter(spark, d):
    doc = F.format_string('{"a": {"total_records": true, "list": [{"Record-Count": "%d"}]}}', "event_id")
    return t(spark, d, "events").select("event_id", deep_counter(doc, TOTAL).alias("total"))


@query("SELECT event_id FROM events WHERE user_id % 2 = 0")
def same_tenant_rows(spark, d):
    e = t(spark, d, "events").withColumn("a", F.concat(F.lit(" Tnt-"), "user_id")).withColumn("b", F.concat(F.lit("TNT-"), F.col("user_id") + F.col("user_id") % 2))
    return e.where(jobs.same_tenant(F.col("a"), F.col("b"))).select("event_id")


@query("SELECT o_orderkey, CAST(NULL AS DOUBLE) AS gone, o_custkey, CAST(NULL AS VARCHAR) AS extra FROM orders")
def coerce_all_null(spark, d):
    """A column without any value, of unknown type, and one the rows lack."""
    src = t(spark, d, "orders").select("o_custkey", F.lit(None).alias("gone"), "o_orderkey")
    return coerce.align(src, spark.createDataFrame([], "o_orderkey bigint, gone double, o_custkey bigint, extra string").schema)
