"""Checks on what was written: counts, checksums, references, files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate.operators.filters import count_all
from loomgate.plans.hierarchy import Edge


def row_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(table_name, expected, actual, status) from (table_name, cnt) on both sides."""
    e, a = expected.select("table_name", F.col("cnt").alias("expected")), actual.select("table_name", F.col("cnt").alias("actual"))
    status = F.when(F.col("actual").isNull(), "ERROR").when(F.col("expected").isNull(), "EXTRA").when(F.col("expected") == F.col("actual"), "OK").otherwise("WARNING")
    return e.join(a, "table_name", "full").withColumn("status", status)


def checksum(df: DataFrame) -> DataFrame:
    """One row ``checksum``: independent of order, counts repeated rows, EMPTY for no rows."""
    cols = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t else F.col(f"`{c}`") for c, t in df.dtypes]
    h = F.xxhash64(*cols)
    # The sum over the low and the high half keeps repeated rows, which xor loses.
    parts = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"), F.sum(F.shiftrightunsigned(h, 32)).alias("hi"))
    return parts.select(F.when(F.col("n") == 0, "EMPTY").otherwise(F.lower(F.hex(F.xxhash64("n", "lo", "hi")))).alias("checksum"))


def orphan_counts(tables: dict[str, DataFrame], edges: list[Edge]) -> DataFrame:
    """(edge, orphans): references without a parent, per foreign key."""
    out = None
    for e in edges:
        parents = tables[e.parent].select(F.col(e.parent_key).alias("__p"))
        lost = tables[e.table].where(F.col(e.column).isNotNull()).select(F.col(e.column).alias("__c")).join(parents, F.col("__c") == F.col("__p"), "left_anti")
        one = lost.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(f"{e.table}.{e.column}").alias("edge"), "orphans")
        out = one if out is None else out.unionAll(one)
    return out


def unreadable_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, error): parquet files whose footer or data pages do not read."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 200)))

    def run(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        for pdf in batches:
            bad = []
            for p in pdf["path"]:
                try:
                    with pq.ParquetFile(p) as f:
                        for g in range(f.num_row_groups):
                            f.read_row_group(g)
                except Exception as e:  # the reason is the result
                    bad.append((p, str(e)[:200]))
            yield pd.DataFrame(bad, columns=["path", "error"])

    return listed.mapInPandas(run, "path string, error string")


def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, sha256) of every file below a folder, read as a stream: files of any size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import quote

        from pyarrow import fs

        for batch in batches:
            out = []
            for path, length in zip(batch["path"], batch["length"]):
                store, at = fs.FileSystem.from_uri(quote(path, safe="/:"))
                digest = hashlib.sha256()
                with store.open_input_stream(at) as f:
                    while chunk := f.read(8 << 20):
                        digest.update(chunk)
                out.append((path, length, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["path", "length", "sha256"])

    return files.mapInPandas(run, "path string, length bigint, sha256 string")


def checksum_mismatches(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Files missing or with another SHA-256 (hex compared without case)."""
    e = expected.select("path", F.lower("sha256").alias("want"))
    return e.join(actual.select("path", F.lower("sha256").alias("have")), "path", "left").where("have is null or have <> want")


def set_reconciliation(source: DataFrame, lake: DataFrame, key: str, low: int, high: int, entity: str | None = None, entity_id: int | None = None) -> DataFrame:
    """(source_rows, lake_rows, note): by entity where the lake has it, else by the key range."""
    s = source.agg(F.count(F.lit(1)).alias("source_rows"))
    by_range = F.count_if(F.col(key).between(low, high))
    by_entity = F.count_if(F.col(entity) == entity_id) if entity else F.lit(0)
    found = lake.agg(by_entity.alias("e"), by_range.alias("r")).select(F.when(F.col("e") > 0, F.col("e")).otherwise(F.col("r")).alias("lake_rows"))
    note = F.when(F.col("source_rows") == F.col("lake_rows"), "OK").when(F.col("lake_rows") > F.col("source_rows"), "EXTRA ROWS").otherwise("DIFF")
    return s.crossJoin(F.broadcast(found)).withColumn("note", note)  # one row each


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return not self.errors


def validate(tables: dict[str, DataFrame], expected: dict[str, int], edges: list[Edge] = ()) -> Report:
    """Counts (a mismatch warns, a missing table is an error) and references (orphans warn)."""
    report, spark = Report(), next(iter(tables.values())).sparkSession if tables else None
    if spark is None:
        report.errors = [f"{t}: missing" for t in expected]
        return report
    wanted = spark.createDataFrame(list(expected.items()), "table_name string, cnt bigint")
    for r in row_counts(wanted, count_all(tables)).collect():  # one row per table
        if r["status"] == "ERROR":
            report.errors.append(f"{r['table_name']}: missing")
        elif r["status"] == "WARNING":
            report.warnings.append(f"{r['table_name']}: {r['actual']} rows, {r['expected']} expected")
    if edges:
        report.warnings += [f"{r['edge']}: {r['orphans']} orphans" for r in orphan_counts(tables, list(edges)).where("orphans > 0").collect()]
    return report
