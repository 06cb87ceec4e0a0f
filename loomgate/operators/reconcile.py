"""Differences between two copies of one dataset, by content-defined chunks.

Both copies are spread over buckets by a hash of their key, sorted by key
inside a bucket, and cut where a rolling hash over the last rows' keys meets a
condition. Cuts depend on content only, so a row present on one side disturbs
its own chunk and no other. Chunks whose fingerprints stand on both sides are
equal and drop out by anti-join; only rows of unmatched chunks are compared
field by field.

Keys must be unique per side (the callers reduce attempts to the latest).
Edge cases: rows with a null key part cannot be paired and are ignored; null
equals null or an absent value only; an empty side reports every row of the
other; columns other than keys and values are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgate.runtime import prefer, stage

#: Rows per bucket aimed at, and mean rows per chunk.
BUCKET_ROWS, CHUNK_ROWS, ROLL = 50_000, 32, 4


def chunked(side: DataFrame, keys: list[str], values: list[str], buckets: int) -> DataFrame:
    """Rows of one copy with ``bucket`` and ``chunk``, a fingerprint of their chunk."""
    rows = side.where(" and ".join(f"`{k}` is not null" for k in keys)).select(
        *keys, *values, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        F.xxhash64(*keys, F.lit(7)).alias("kh"), F.xxhash64(*keys, *[F.coalesce(F.col(v).cast("string"), F.lit("\x00")) for v in values]).alias("rh"),
        F.hash(*[F.coalesce(F.col(v).cast("string"), F.lit("\x00")) for v in values], *keys).cast("long").alias("rh2"),
    )
    order = W.partitionBy("bucket").orderBy(*keys)
    roll = F.col("kh")
    for i in range(1, ROLL):  # rolling hash over the last ROLL keys
        roll = roll.bitwiseXOR(F.shiftleft(F.coalesce(F.lag("kh", i).over(order), F.lit(0).cast("long")), i))
    cut = (F.pmod(roll, F.lit(CHUNK_ROWS)) == 0).cast("int")
    rows = rows.withColumn("cut", cut).withColumn("no", F.sum("cut").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = W.partitionBy("bucket", "no")
    # Order-free sums of two row hashes over disjoint bits, with the count.
    mark = F.struct(
        F.count(F.lit(1)).over(whole).alias("n"),
        F.sum(F.shiftrightunsigned("rh", 24)).over(whole).alias("a"),
        F.sum(F.col("rh").bitwiseAND(F.lit((1 << 40) - 1))).over(whole).alias("b"),
        F.sum("rh2").over(whole).alias("c"),
    )
    return rows.withColumn("chunk", mark).select("bucket", "chunk", *keys, *values)


def differences(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys…, difference): ``only_left``, ``only_right`` or the name of a differing value."""
    left, right = stage(left.select(*keys, *values), "copy-left"), stage(right.select(*keys, *values), "copy-right")
    buckets = prefer(max(left.count(), right.count()), BUCKET_ROWS, 8)
    a, b = (stage(chunked(x, keys, values, buckets), "copy-chunks") for x in (left, right))
    marks = lambda x: x.select("bucket", "chunk").distinct()
    a_left = a.join(marks(b), ["bucket", "chunk"], "left_anti").select(*keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("in_a"))
    b_left = b.join(marks(a), ["bucket", "chunk"], "left_anti").select(*keys, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("in_b"))
    pairs = a_left.join(b_left, keys, "full")
    which = F.when(F.col("in_b").isNull(), F.array(F.lit("only_left"))).when(F.col("in_a").isNull(), F.array(F.lit("only_right"))).otherwise(
        F.array_compact(F.array(*[F.when(~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}")), F.lit(v)) for v in values]))
    )
    return pairs.select(*keys, F.explode(which).alias("difference"))


# ---------------------------------------------------------------- this project's tables


def table_key(name):
    """Lower case, without brackets and schema or namespace prefix."""
    plain = F.regexp_replace(F.lower(F.trim(name)), r"[\[\]\"`]", "")
    return F.trim(F.element_at(F.split(plain, r"\."), -1))


def result_figures(results: DataFrame) -> DataFrame:
    """Latest result per run and table."""
    r = results.select("run_id", table_key(F.col("table_name")).alias("table_key"), "rows_extracted", "table_checksum", "finished_at", "result_id")
    latest = r.where("table_key <> ''").groupBy("run_id", "table_key").agg(F.max(F.struct("finished_at", "result_id", "rows_extracted", "table_checksum")).alias("x"))
    return latest.select("run_id", "table_key", F.col("x.rows_extracted").alias("rows"), F.lower(F.trim("x.table_checksum")).alias("checksum"))


def report_figures(reports: DataFrame) -> DataFrame:
    """Tables of the latest report per run, from both maps."""
    latest = reports.where("run_id is not null").groupBy("run_id").agg(
        F.max(F.struct("checked_at", "report_id", F.map_entries("row_counts").alias("r"), F.map_entries("checksums").alias("c"))).alias("x")
    )
    part = lambda entries, v: latest.select("run_id", F.explode(entries).alias("e")).select(
        "run_id", table_key(F.col("e.key")).alias("table_key"),
        *[(F.col("e.value") if v == k else F.lit(None).cast(t)).alias(k) for k, t in (("rows", "bigint"), ("checksum", "string"))],
    )
    both = part("x.r", "rows").unionByName(part("x.c", "checksum")).where("table_key <> ''")
    return both.groupBy("run_id", "table_key").agg(F.max("rows").alias("rows"), F.max(F.lower(F.trim("checksum"))).alias("checksum"))


def found(spark: SparkSession, d: str) -> DataFrame:
    out = differences(
        result_figures(spark.read.parquet(f"{d}/table_results.parquet")),
        report_figures(spark.read.parquet(f"{d}/validation_reports.parquet")),
        ["run_id", "table_key"], ["rows", "checksum"],
    )
    named = F.create_map(*[F.lit(x) for x in ("only_left", "only_in_results", "only_right", "only_in_reports", "rows", "rows", "checksum", "checksum")])
    return out.select("run_id", "table_key", named[F.col("difference")].alias("difference"))
