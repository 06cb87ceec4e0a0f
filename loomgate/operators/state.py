"""Run state: cursors, resumable re-key checkpoints, audit of id pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate import store
from loomgate.operators.rekey import Rekeyer


class Cursors:
    """Last version read per table, saved after each."""

    def __init__(self, path: str):
        self.path = path

    def get(self, table: str) -> int | None:
        return self._all().get(table, {}).get("last_version")

    def set(self, table: str, version: int | None) -> None:
        store.put_json(self.path, self._all() | {table: {"last_version": version}})

    def _all(self) -> dict:
        return store.get_json(self.path, {})


class Checkpoint:
    """Mappings and finished tables of a job, in a folder all executors see.

    A resumed run takes stored mappings as they are, so children of finished
    tables follow the same ids.
    """

    def __init__(self, spark: SparkSession, root: str, job_id: str):
        self.spark, self.base = spark, f"{root.rstrip('/')}/{job_id}"

    def save(self, rekeyer: Rekeyer, table: str) -> None:
        m = rekeyer.mappings.get(table)
        if m is not None and not store.exists(self.spark, f"{self.base}/{table}/_SUCCESS"):
            m.write.mode("overwrite").parquet(f"{self.base}/{table}")
        store.put_json(f"{self.base}/_done.json", sorted({*self.completed(), table}))

    def completed(self) -> list[str]:
        return store.get_json(f"{self.base}/_done.json", [])

    def restore(self, rekeyer: Rekeyer) -> list[str]:
        """Load stored mappings into a new rekeyer; return finished tables."""
        for name in store.names(self.spark, self.base):
            if store.exists(self.spark, f"{self.base}/{name}/_SUCCESS"):
                rekeyer.mappings[name] = self.spark.read.parquet(f"{self.base}/{name}")
        return self.completed()

    def delete(self) -> None:
        store.delete(self.spark, self.base)


def audit_records(mapping: DataFrame, table: str, column: str, job_id: str, tenant_id: str, at: str) -> DataFrame:
    return mapping.select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.col("old_sid").alias("original_id"), F.col("new_sid"),
        F.lit(job_id).alias("job_id"), F.lit(tenant_id).alias("tenant_id"), F.lit(at).cast("timestamp_ntz").alias("recorded_at"),
    )


def write_audit(records: DataFrame, path: str) -> None:
    records.withColumn("date", F.to_date("recorded_at")).write.mode("append").partitionBy("tenant_id", "date", "job_id").parquet(path)


def audit_lookup(audit: DataFrame, table: str, job_id: str | None = None, original_id: int | None = None, new_sid: int | None = None) -> DataFrame:
    """Records of a table (equal without case) by job, original id or new id."""
    keep = F.lower("table_name") == table.lower()
    for column, value in (("job_id", job_id), ("original_id", original_id), ("new_sid", new_sid)):
        if value is not None:
            keep = keep & (F.col(column) == value)
    return audit.where(keep)


def id_range(mapping: DataFrame) -> DataFrame:
    return mapping.agg(F.min("new_sid").alias("first_sid"), F.max("new_sid").alias("last_sid"), F.count(F.lit(1)).alias("ids"))


def level_metrics(results: DataFrame) -> DataFrame:
    """Rows, tables and time per level from (level, table_name, rows, seconds)."""
    return results.groupBy("level").agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"), F.round(F.sum("seconds"), 3).alias("seconds"))


def write_progress(path: str, done: int, total: int, **more) -> dict:
    """Progress from 20 to 70 per cent by tables done; the last write holds."""
    doc = {"percent": 20 + 50 * done // max(1, total), "tables_done": done, "tables_total": total, **more}
    store.put_json(path, doc)
    return doc
