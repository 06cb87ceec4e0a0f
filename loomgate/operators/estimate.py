"""Size of an extraction from counts and table statistics, as column arithmetic.

``stats``: table_name, matched, total_rows, total_bytes, columns, parent
(null for none), direct (whether the table is filtered directly).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Expansion from columnar files, bytes per column and per record, limits.
EXPANSION, BYTES_PER_COLUMN, BYTES_PER_RECORD, FLOOR = 28, 2, 500, 1 << 20
SMALL_GIB, MEDIUM_GIB = 9, 80
ROWS_PER_ENTITY, MARGIN = 1_000, 1.25


def with_child_fraction(stats: DataFrame) -> DataFrame:
    """A direct table counted 0 though it has rows takes the best share among its children."""
    children = stats.where("parent is not null and matched > 0 and total_rows > 0").groupBy(F.col("parent").alias("table_name")).agg(F.max(F.col("matched") / F.col("total_rows")).alias("share"))
    guess = F.floor(F.col("share") * F.col("total_rows")).cast("bigint")
    use = (F.col("matched") == 0) & F.col("direct") & (F.col("total_rows") > 0) & F.col("share").isNotNull()
    return stats.join(children, "table_name", "left").withColumn("matched", F.when(use, guess).otherwise(F.col("matched"))).drop("share")


def table_bytes(stats: DataFrame) -> DataFrame:
    """(table_name, matched, estimated_bytes)"""
    from_stats = F.floor(F.col("matched") / F.col("total_rows") * F.col("total_bytes") * EXPANSION)
    from_columns = F.floor(F.col("matched") * F.col("columns") * BYTES_PER_COLUMN * EXPANSION)
    size = F.when(F.col("matched") == 0, 0).when((F.col("total_rows") > 0) & (F.col("total_bytes") > 0), from_stats).when(F.col("columns") > 0, from_columns).otherwise(F.col("matched") * BYTES_PER_RECORD)
    return stats.select("table_name", "matched", size.cast("bigint").alias("estimated_bytes"))


def route(size):
    """Route by estimated bytes."""
    gib = 1 << 30
    return F.when(size <= SMALL_GIB * gib, "EXPRESS").when(size <= MEDIUM_GIB * gib, "STANDARD").otherwise("BATCH")


def estimate(stats: DataFrame) -> DataFrame:
    """One row: total_rows, estimated_bytes (at least 1 MiB), route."""
    total = table_bytes(with_child_fraction(stats)).agg(F.coalesce(F.sum("matched"), F.lit(0)).alias("total_rows"), F.greatest(F.coalesce(F.sum("estimated_bytes"), F.lit(0)), F.lit(FLOOR)).alias("estimated_bytes"))
    return total.withColumn("route", route(F.col("estimated_bytes")))


def without_statistics(entities: int) -> int:
    """Estimated bytes when nothing but the number of entities is known."""
    return max(FLOOR, int(entities * ROWS_PER_ENTITY * BYTES_PER_RECORD * MARGIN))
