"""Both directions end to end: extraction from the lake and ingestion into it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate import store
from loomgate.operators.filters import entity_filter, reachable_filter, select_names
from loomgate.operators.rekey import RangeAllocator, Rekeyer
from loomgate.operators.state import Checkpoint
from loomgate.operators.validate import Report, checksum_mismatches, file_checksums, validate
from loomgate.plans.hierarchy import Hierarchy
from loomgate.plans.mapping import project
from loomgate.plans.matching import rename
from loomgate.sources.lake import Lake


@dataclass
class TablePlan:
    source_table: str
    target_table: str
    row_filter: str | None = None


def build_plan(tables: list[str], overrides: dict[str, dict] | None = None) -> list[TablePlan]:
    """One plan per ``ns.table``; overrides are keyed ``ns_table``."""
    out = []
    for t in tables:
        o = (overrides or {}).get(t.replace(".", "_"), {})
        out.append(TablePlan(t, o.get("target_table", t.split(".")[-1]), o.get("row_filter")))
    return out


@dataclass
class Outcome:
    rows: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    report: Report | None = None

    @property
    def status(self) -> str:
        return "FAILED" if self.failed else "SUCCEEDED"

    def summary(self) -> dict:
        return {"status": self.status, "total_rows": sum(self.rows.values()), "success": len(self.rows), "failed": len(self.failed), "skipped": len(self.skipped), "tables": self.rows, "errors": self.failed}


def extract(lake: Lake, namespace: str, out: str, ids: list[int], wanted: str | list[str] | None = None, hierarchy: Hierarchy | None = None, roots: dict[str, str] | None = None, mappings: dict[str, dict] | None = None, overrides: dict[str, dict] | None = None) -> Outcome:
    """Filter, map and write each table as parquet below ``out`` with a SHA-256 manifest.

    With a hierarchy, tables without the entity column are restricted along
    their references; without one they are exported whole.
    """
    spark, result = lake.spark, Outcome()
    names = select_names(lake.list_tables(namespace), wanted)
    frames = {t.split(".")[-1]: lake.scan(t) for t in lake.list_tables(namespace)}
    written: dict[str, DataFrame] = {}
    for p in build_plan(names, overrides):
        short = p.source_table.split(".")[-1]
        try:
            df = reachable_filter(hierarchy, frames, short, roots or {}, ids) if hierarchy and short in hierarchy else entity_filter(frames[short], ids)
            df = df.where(p.row_filter) if p.row_filter else df
            entry = (mappings or {}).get(p.source_table.replace(".", "_"))
            df = project(df, entry) if entry else df
            df.write.mode("overwrite").parquet(f"{out}/{p.target_table}")
            written[p.target_table] = spark.read.schema(df.schema).parquet(f"{out}/{p.target_table}")
            result.rows[p.target_table] = written[p.target_table].count()
        except Exception as e:
            result.failed[p.target_table] = str(e)[:500]
    result.report = validate(written, result.rows | dict.fromkeys(result.failed, 0))
    if written:
        manifest = file_checksums(spark, out).where("path like '%.parquet'")
        manifest.coalesce(1).write.mode("overwrite").json(f"{out}/_manifest")
    return result


class DamagedBackup(RuntimeError):
    """Files of a backup are missing, or not what its manifest says."""


def verify_backup(spark: SparkSession, folder: str) -> None:
    """Check the files against the manifest, where the folder has one; extra files are not its business."""
    if not store.exists(spark, f"{folder}/_manifest"):
        return
    name = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)
    listed = spark.read.schema("path string, length bigint, sha256 string").json(f"{folder}/_manifest").withColumn("path", name)
    wrong = checksum_mismatches(file_checksums(spark, folder).withColumn("path", name), listed)
    bad = [r["path"] for r in wrong.select("path").limit(5).collect()]  # a few for the message
    if bad:
        raise DamagedBackup(f"{folder}: {', '.join(bad)}")


def ingest(spark: SparkSession, folder: str, lake: Lake, namespace: str, hierarchy: Hierarchy, allocator: RangeAllocator, overrides: dict[str, int] | None = None, mode: str = "append", convention: str = "as_is", checkpoint: Checkpoint | None = None, create_missing: bool = False) -> Outcome:
    """Re-key a folder of tables and write them to the lake, parents first.

    A missing destination is skipped before any id is taken for it, or created.
    """
    result = Outcome()
    verify_backup(spark, folder)
    frames = {n: spark.read.parquet(f"{folder}/{n}") for n in store.names(spark, folder) if not n.startswith((".", "_")) and store.is_folder(spark, f"{folder}/{n}")}
    for name in list(frames):
        if not lake.exists(f"{namespace}.{name}"):
            if create_missing:
                lake.create(f"{namespace}.{name}", frames[name].schema)
            else:
                result.skipped.append(name)
                del frames[name]
    rekeyer = Rekeyer(hierarchy, allocator, overrides)
    done = checkpoint.restore(rekeyer) if checkpoint else []
    rekeyer.build(frames)
    for name in hierarchy.order(list(frames)):
        if name in done:
            result.skipped.append(name)
            continue
        try:
            if name in hierarchy and rekeyer.results[hierarchy[name].name].error:
                raise ValueError(rekeyer.results[hierarchy[name].name].error)
            df = rekeyer.apply(name, frames[name])
            df = df.toDF(*rename(df.columns, convention))
            write = lake.overwrite if mode == "overwrite" else lake.append
            result.rows[name] = write(f"{namespace}.{name}", df)
            if checkpoint:
                checkpoint.save(rekeyer, name)
        except Exception as e:
            result.failed[name] = str(e)[:500]
    if checkpoint and not result.failed:
        checkpoint.delete()
    return result


def write_summary(path: str, outcome: Outcome) -> None:
    store.put_json(path, outcome.summary())
