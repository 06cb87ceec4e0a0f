"""Queries over execution lists and their event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgate.functions.expressions import EXTRACTED, INGESTED, counters, log_counter
from loomgate.runtime import TASK_ROWS, carried, in_ranges, with_carried


def status_pivot(runs: DataFrame, kind: str, status: str, statuses: list[str]) -> DataFrame:
    """Counts per kind and status, with a total per kind; statuses are given, so one pass does."""
    wide = runs.groupBy(F.col(kind).alias("kind")).agg(*[F.count_if(F.col(status) == s).alias(s.lower()) for s in statuses], F.count(F.lit(1)).alias("total"))
    return wide


def top_recent(runs: list[DataFrame], start: str, n: int, *ties: str, where: Column | None = None) -> DataFrame:
    """The n latest of several lists, filtered before the cut."""
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return (out if where is None else out.where(where)).orderBy(F.desc(start), *ties).limit(n)


def last_state_before(events: DataFrame, group: str, event_id: str, is_failure: Column, is_state: Column, state: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """For each failure event the last state entered before it in its group: a backward as-of.

    A running maximum inside ranges of (group, id) with the last state carried
    over from the ranges before, so a group of any size is spread; null groups
    do not match anything. Ids are whole numbers; of events with one id none is
    before the other.
    """
    entered = F.when(is_state, F.struct(F.col(event_id).alias("id"), F.col(state).alias("s")))
    marked = events.where(F.col(group).isNotNull()).select(F.col(group).alias("__g"), F.col(event_id).alias("__id"), entered.alias("__entered"), is_failure.alias("__failed"))
    rows, n = in_ranges(marked, ["__g"], ["__id"], task_rows)
    inside = rows.withColumn("__e", F.max("__entered").over(W.partitionBy("__g", "__range").orderBy("__id").rangeBetween(W.unboundedPreceding, -1)))
    found = inside.where("__failed")
    last = F.col("__e")
    if n > 1:
        before = carried(rows.groupBy("__g", "__range").agg(F.max("__entered").alias("__last")), ["__g"], F.max("__last"), "__before")
        found, last = with_carried(found, before, ["__g"], "__before"), F.coalesce("__e", "__before")
    return found.select(F.col("__g").alias(group), F.col("__id").alias(event_id), last["id"].alias("state_event_id"), last["s"].alias("state"))


def enriched_counts(runs: DataFrame, progress: str, output: str, log: str) -> DataFrame:
    """``ingested`` and ``extracted`` from progress, else output, else log lines; each text is parsed once at most."""
    counts = counters({"ingested": INGESTED, "extracted": EXTRACTED}, F.col(progress), F.col(output), F.col(log))
    found = runs.withColumn("__counts", counts)
    return found.withColumns({name: F.coalesce(F.col("__counts")[name], log_counter(F.col(log), name)) for name in ("ingested", "extracted")}).drop("__counts")


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct without case; the smallest spelling stands for the rest."""
    return df.where(F.col(column).isNotNull()).groupBy(F.lower(column).alias("__k")).agg(F.min(column).alias(column)).drop("__k")


def same_tenant(a: Column, b: Column) -> Column:
    return F.lower(F.trim(a)) == F.lower(F.trim(b))
