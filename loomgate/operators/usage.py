"""Concurrency and usage over run intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgate.runtime import TASK_ROWS, running_sum, stage


# Path label and cores per route; routes without cores are not liable.
PATHS = {"EXPRESS": "PATH1", "STANDARD": "PATH2", "BATCH": "PATH3"}
LIABLE_CORES = {"STANDARD": 16, "BATCH": 16}
#: Least peak that is reported, and how many of the events at the peak.
FLOOR, PEAK_EVENTS = 4, 5


def usage_rows(runs: DataFrame, route: str = "route", start: str = "started_at", stop: str = "stopped_at") -> DataFrame:
    """Runs with ``path``, ``cores``, ``liable``, ``billing_month`` and ``duration_seconds`` of their route and times.

    An unknown or null route is the first path without cores; a null start has
    no month, a null stop no duration.
    """
    table = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col(route)]
    return runs.withColumns({
        "path": F.coalesce(table(PATHS), F.lit(PATHS["EXPRESS"])), "cores": F.coalesce(table(LIABLE_CORES), F.lit(0)), "liable": F.coalesce(F.col(route).isin(*LIABLE_CORES), F.lit(False)),
        "billing_month": F.date_format(start, "yyyy-MM"), "duration_seconds": duration_seconds(F.col(start), F.col(stop)),
    })


def billing_month(rows: DataFrame, month: str) -> DataFrame:
    """The usage rows of a month, numbers as integers and doubles; the filter reaches the scan."""
    kept = rows.where(F.col("billing_month") == month)
    plain = {f.name: F.col(f"`{f.name}`").cast("bigint" if f.dataType.scale == 0 else "double") for f in rows.schema.fields if f.dataType.typeName() == "decimal"}
    return kept.withColumns(plain) if plain else kept


def concurrency(runs: DataFrame, start: str = "started_at", stop: str = "stopped_at", weight: str = "cores", task_rows: int = TASK_ROWS) -> DataFrame:
    """(ts, delta, run columns, running) at each event, in order of time with ends before starts.

    The running sum is made inside ranges of time and offset by the ranges
    before, so no task holds the whole history, nor all of a busy day. Runs
    without a start are skipped, without an end stay open.
    """
    rest = [c for c in runs.columns if c not in (start, stop, weight)]
    opened = runs.where(F.col(start).isNotNull()).withColumn("__w", F.col(weight).cast("bigint"))
    edges = F.array(F.struct(F.col(start).alias("ts"), F.col("__w").alias("delta")), F.struct(F.col(stop).alias("ts"), (-F.col("__w")).alias("delta")))
    events = opened.select(F.inline(edges), *rest).where("ts is not null")
    return running_sum(events, [], ["ts", "delta", *rest], "delta", "running", task_rows, row_by_row=True)


def peak(runs: DataFrame, least: int = 0, **columns) -> DataFrame:
    """One row ``peak``: most weight at one moment, 0 without runs, at least ``least``."""
    return concurrency(runs, **columns).agg(F.greatest(F.coalesce(F.max("running"), F.lit(0)), F.lit(least)).cast("bigint").alias("peak"))


def peak_events(runs: DataFrame, most: int | None = None, **columns) -> DataFrame:
    """The events at which the peak stands, or the first so many of them."""
    c = stage(concurrency(runs, **columns), "usage-events")
    top = c.agg(F.max("running").alias("__peak"))
    at = c.join(F.broadcast(top), F.col("running") == F.col("__peak")).where("running > 0").drop("__peak")  # one row
    return at if most is None else at.orderBy("ts", "delta", *[x for x in at.columns if x not in ("ts", "delta", "running")]).limit(most)


def per_tenant(runs: DataFrame) -> DataFrame:
    """Runs, runs per path, hours and core hours per tenant, rounded once at the end."""
    hours = F.col("duration_seconds") / 3600
    path = lambda p: F.count_if(F.col("path") == p).alias(f"{p.lower()}_runs")
    return runs.groupBy(F.coalesce("tenant_id", F.lit("unknown")).alias("tenant_id")).agg(
        F.min(F.when(F.col("tenant_resource_id") != "", F.col("tenant_resource_id"))).alias("tenant_resource_id"),
        F.count(F.lit(1)).alias("total_runs"), path("PATH1"), path("PATH2"), path("PATH3"),
        F.round(F.sum(hours), 4).alias("total_duration_hours"), F.round(F.sum(F.col("cores") * hours), 4).alias("total_core_hours"),
    )


def by_month(df: DataFrame, ts: str, *aggs) -> DataFrame:
    return df.groupBy(F.date_format(ts, "yyyy-MM").alias("month")).agg(*aggs)


def previous_month(day):
    """``yyyy-MM`` of the calendar month before a date."""
    return F.date_format(F.add_months(F.trunc(day, "month"), -1), "yyyy-MM")


def duration_seconds(start, stop):
    return F.timestamp_diff("SECOND", start, stop)


def running_now(runs: DataFrame, start: str = "started_at", stop: str = "stopped_at", weight: str = "cores") -> DataFrame:
    """One row ``cores``: weight of the runs that have not ended."""
    return runs.where(F.col(start).isNotNull() & F.col(stop).isNull()).agg(F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias("cores"))
