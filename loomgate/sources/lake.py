"""A file-backed lake with versions: scans, appends, overwrites, upserts.

Each table is a folder with ``v{n}`` data folders and a ``_versions`` log of
JSON lines, whose last line names the folders that make up the table. A write
adds a folder and then a log entry under a new name; the entry's rename is the
commit, so readers see whole versions only. All files are reached through the
cluster's Hadoop file systems.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgate import store
from loomgate.operators.coerce import align


class Lake:
    """Namespaces and tables below a root folder (a path all executors see)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- catalog

    def create_namespace(self, name: str) -> None:
        store.make_folder(self.spark, f"{self.root}/{name}")

    def list_tables(self, namespace: str) -> list[str]:
        base = f"{self.root}/{namespace}"
        return [f"{namespace}.{n}" for n in store.names(self.spark, base) if store.exists(self.spark, f"{base}/{n}/_versions")]

    def exists(self, table: str) -> bool:
        return store.exists(self.spark, f"{self._dir(table)}/_versions")

    def create(self, table: str, schema: T.StructType, partition_by: list[str] = ()) -> None:
        """Create if missing."""
        if not self.exists(table):
            store.make_folder(self.spark, f"{self._dir(table)}/_versions")
            self._commit(table, 0, {"schema": schema.json(), "partition_by": list(partition_by), "folders": []})

    def drop(self, table: str) -> None:
        store.delete(self.spark, self._dir(table))

    def schema(self, table: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._state(table)["schema"]))

    def version(self, table: str) -> int | None:
        """Current version; None for a table without data."""
        n = self._last(table)
        return n if self._state(table)["folders"] else None

    # ---- scans

    def scan(self, table: str, columns: list[str] | None = None, where: str | Column | None = None, limit: int | None = None, version: int | None = None) -> DataFrame:
        """Projected, filtered, limited rows of a version; an empty table keeps its schema."""
        df = self._read(table, self._state(table, version)["folders"])
        df = df if where is None else df.where(where)
        df = df.select(*columns) if columns else df
        return df.limit(limit) if limit else df

    def incremental(self, table: str, since: int | None) -> DataFrame:
        """Rows appended after version ``since``; everything when it is None or was replaced since."""
        now = self._state(table)["folders"]
        if since is None:
            return self._read(table, now)
        old = self._state(table, since)["folders"]
        return self._read(table, [f for f in now if f not in old] if set(old) <= set(now) else now)

    def read(self, table: str, mode: str = "full", since: int | None = None, limit: int | None = None) -> DataFrame:
        df = self.incremental(table, since) if mode == "incremental" else self.scan(table)
        return df.limit(limit) if limit else df

    def has_rows(self, table: str, where: str | Column | None = None) -> tuple[bool, int]:
        """(has rows, 1 or 0); a missing table has none; an error counts as (True, -1)."""
        if not self.exists(table):
            return False, 0
        try:
            empty = self.scan(table, where=where).limit(1).isEmpty()
        except Exception:
            return True, -1
        return not empty, int(not empty)

    def first_with_rows(self, tables: list[str], where: str | Column | None = None) -> str | None:
        return next((t for t in tables if self.has_rows(t, where)[0]), None)

    def scan_with_fallback(self, table: str, where: str | Column, columns: list[str] | None = None, most_bytes: int = 10 << 30) -> DataFrame:
        """A filtered scan; where folders do not have the table's types, one that casts them first.

        The second way reads all rows before it filters, so it is refused beyond ``most_bytes``.
        """
        want = {f.name: f.dataType for f in self.schema(table).fields}
        written = [self.spark.read.parquet(f"{self._dir(table)}/{f}").schema.fields for f in self._state(table)["folders"]]  # one footer a folder
        if all(f.dataType == want.get(f.name, f.dataType) for fields in written for f in fields):
            return self.scan(table, columns, where)
        if store.size(self.spark, self._dir(table)) > most_bytes:
            raise ValueError(f"{table} is too large to be read without its filter")
        df = None
        for f in self._state(table)["folders"]:
            part = align(self.spark.read.parquet(f"{self._dir(table)}/{f}"), self.schema(table))
            df = part if df is None else df.unionByName(part)
        df = df.where(where)
        return df.select(*columns) if columns else df

    def file_stats(self, table: str) -> DataFrame:
        """(files, bytes, rows) of the current version, from the files' footers."""
        return footer_stats(self.scan(table)).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))

    # ---- sinks

    def append(self, table: str, df: DataFrame) -> int:
        return self._write(table, df, keep=True)

    def overwrite(self, table: str, df: DataFrame, even_if_empty: bool = False) -> int:
        """Replace all rows; an empty input leaves the old data unless told otherwise."""
        return self._write(table, df, keep=False, even_if_empty=even_if_empty)

    def upsert(self, table: str, df: DataFrame, keys: list[str], legacy: bool = False) -> int:
        """Rows with a known key replace the old ones, others are added; ``legacy`` overwrites."""
        if legacy:
            return self.overwrite(table, df)
        new = align(df, self.schema(table))
        return self._write(table, upserted(self.scan(table), new, keys), keep=False)

    def add_columns(self, table: str, fields: list[T.StructField]) -> None:
        state, schema = self._state(table), self.schema(table)
        self._commit(table, self._last(table) + 1, state | {"schema": T.StructType([*schema.fields, *fields]).json()})

    # ---- internals

    def _dir(self, table: str) -> str:
        ns, _, name = table.rpartition(".")
        return f"{self.root}/{ns}/{name}" if ns else f"{self.root}/{name}"

    def _last(self, table: str) -> int:
        found = [int(n.removesuffix(".json")) for n in store.names(self.spark, f"{self._dir(table)}/_versions") if n.endswith(".json")]
        if not found:
            raise FileNotFoundError(table)
        return max(found)

    def _state(self, table: str, version: int | None = None) -> dict:
        n = self._last(table) if version is None else version
        return json.loads(store.read_text(self.spark, f"{self._dir(table)}/_versions/{n}.json"))

    def _commit(self, table: str, n: int, state: dict) -> None:
        if not store.create_text(self.spark, f"{self._dir(table)}/_versions/{n}.json", json.dumps(state)):
            raise FileExistsError(f"another writer made version {n} of {table}")

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        schema = self.schema(table)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(*[f"{self._dir(table)}/{f}" for f in folders])

    def _write(self, table: str, df: DataFrame, keep: bool, even_if_empty: bool = False) -> int:
        state, n = self._state(table), self._last(table)
        folder = f"v{n + 1}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        out = align(df, self.schema(table)).observe(seen, F.count(F.lit(1)).alias("n")).write
        if state["partition_by"]:
            out = out.partitionBy(*state["partition_by"])
        out.parquet(f"{self._dir(table)}/{folder}")
        written = seen.get["n"]
        if not written and not even_if_empty:
            store.delete(self.spark, f"{self._dir(table)}/{folder}")
            return 0
        self._commit(table, n + 1, state | {"folders": [*(state["folders"] if keep else []), folder]})
        return written


def footer_stats(df: DataFrame) -> DataFrame:
    """(path, bytes, rows) per parquet file of a scan, from its footer; no row is read."""
    spark, paths = df.sparkSession, df.inputFiles()
    if not paths:
        return spark.createDataFrame([], "path string, bytes bigint, rows bigint")
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 1_000))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path in batch["path"]:
                files, at = fs.FileSystem.from_uri(path)  # as Spark lists them: encoded
                with files.open_input_file(at) as f:
                    out.append((path, f.size(), pq.ParquetFile(f).metadata.num_rows))
            yield pd.DataFrame(out, columns=["path", "bytes", "rows"])

    return listed.mapInPandas(run, "path string, bytes bigint, rows bigint")


def catalog_statistics(spark: SparkSession, table: str) -> dict[str, int]:
    """``bytes``, ``rows`` (-1 where never counted) and ``columns`` the session's catalog holds for a table."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    numbers = re.findall(r"(\d+) (bytes|rows)", described.get("Statistics", ""))
    found = {kind: int(n) for n, kind in numbers}
    return {"bytes": found.get("bytes", -1), "rows": found.get("rows", -1), "columns": len(spark.table(table).columns)}


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the keys of ``new``, plus ``new``; null keys equal each other."""
    fresh = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return old.join(fresh, same, "left_anti").unionByName(new)


def prefix_bytes(spark: SparkSession, path: str, least: int = 1 << 20) -> int:
    """Bytes of all files below a path, at least ``least``, which is also the answer where it cannot be read."""
    try:
        return max(least, store.size(spark, path))
    except Exception:  # no such store or no right to it
        return least


# ---- relational and text connectors


def jdbc_read(spark: SparkSession, url: str, table: str, columns: list[str] | None = None, where: str | None = None, fetch: int = 10_000, split: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A relational table; ``split`` = (column, low, high, parts) reads it in parallel ranges."""
    r = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch), **options)
    if split:
        c, low, high, parts = split
        r = r.options(partitionColumn=c, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    df = r.load()
    df = df if where is None else df.where(where)  # pushed down
    return df.select(*columns) if columns else df


def jdbc_write(df: DataFrame, url: str, table: str, batch: int, truncate: bool = False, **options: str) -> None:
    w = df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options)
    (w.option("truncate", "true").mode("overwrite") if truncate else w.mode("append")).save()


def relational_catalog(query: Callable[[str], DataFrame], schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Tables (schema_name, table_name) and columns (…, column_name, data_type, nullable, at) of a relational source.

    ``query`` runs a statement there: ``lambda q: jdbc_read(spark, url, f"({q}) x")``.
    """
    only = f" AND TABLE_SCHEMA = '{schema.replace(chr(39), chr(39) * 2)}'" if schema else ""
    tables = query(f"SELECT TABLE_SCHEMA AS schema_name, TABLE_NAME AS table_name FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_TYPE = 'BASE TABLE'{only}")
    columns = query(
        "SELECT TABLE_SCHEMA AS schema_name, TABLE_NAME AS table_name, COLUMN_NAME AS column_name, DATA_TYPE AS data_type, IS_NULLABLE AS nullable, ORDINAL_POSITION AS at "
        f"FROM INFORMATION_SCHEMA.COLUMNS WHERE 1 = 1{only}")
    return tables, columns.withColumn("nullable", F.upper("nullable") == "YES")


def relational_counts(query: Callable[[str], DataFrame], names: list[str]) -> DataFrame:
    """(table_name, cnt) of the given tables as one statement."""
    return query(" UNION ALL ".join(f"SELECT '{n.replace(chr(39), chr(39) * 2)}' AS table_name, COUNT(*) AS cnt FROM {n}" for n in names))


def delimited_rows(df: DataFrame, separator: str = "\t", line_end: str = "\n") -> DataFrame:
    """(value, collides): rows as delimited text, nulls empty; binary and nested columns are refused."""
    bad = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    if bad:
        raise ValueError(f"columns cannot be written as text: {', '.join(bad)}")
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    collides = F.lit(False)
    for c in cells:
        collides = collides | c.contains(separator) | c.contains(line_end)
    return df.select(F.concat_ws(separator, *cells).alias("value"), collides.alias("collides"))


def csv_write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
