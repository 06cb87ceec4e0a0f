"""Surrogate-key remap: new dense ids for keys, carried into every reference.

All mappings are made first and every reference is rewritten in a second
pass, so references forward or within a level follow too. A key column that is
itself a reference gets no ids of its own. ``legacy`` gives the literal
one-pass behaviour instead.

Ids are dense in key order. The index is a sum of per-key row counts: keys are
range-partitioned, summed within each range, and ranges are offset by the
totals before them, so no task sees more than its range. Mappings are staged:
a re-run stage reads the same ids.

Edge cases: null keys use an index (they sort last) but stay null; of rows
with one key the last index holds; unmapped references and nulls stay; an
empty table gives no ids; a missing key column is an error in the result and
the table passes through; columns are found without case.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgate import store
from loomgate.plans.hierarchy import Hierarchy, Table
from loomgate.runtime import TASK_ROWS, bounded_broadcast, running_sum, salted_join, stage


class RangeAllocator:
    """Consecutive id ranges per table; the cursor may be kept in a JSON control file."""

    def __init__(self, first: int | Callable[[str], int] = 1_000_000, control: str | None = None):
        self.first = first if callable(first) else (lambda _: first)
        self.control = control
        self.next: dict[str, int] = store.get_json(control, {}) if control else {}

    def allocate(self, table: str, count: int) -> tuple[int, int]:
        """First id and count of a new range."""
        if count <= 0:
            raise ValueError("count must be positive")
        start = self.next.get(table, self.first(table))
        self.next[table] = start + count
        if self.control:
            store.put_json(self.control, self.next)
        return start, count


@dataclass
class TableResult:
    table: str
    rows: int = 0
    key: str = ""
    first: int | None = None
    last: int | None = None
    references: list[str] = field(default_factory=list)
    self_reference: bool = False
    error: str | None = None


def find_column(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def mapping(df: DataFrame, key: str, start: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """(old_sid, new_sid): ``start`` plus the last row index of each key, in key order."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("old_sid")).agg(F.count(F.lit(1)).alias("n"))
    # The range of a key is written down with it: later reads cannot disagree.
    return running_sum(counts, [], ["old_sid"], "n", "upto", task_rows).select("old_sid", (F.lit(start) + F.col("upto") - 1).cast("bigint").alias("new_sid"))


def rewrite(df: DataFrame, columns: dict[str, DataFrame], task_rows: int = TASK_ROWS) -> DataFrame:
    """Each column replaced through its mapping; misses and nulls stay.

    A mapping of bounded size is broadcast and moves no row. Beyond that rows
    are joined by shuffle, those of a null reference set apart and those of a
    hot parent salted.
    """
    out = df
    for i, (column, m) in enumerate(columns.items()):
        old, new, kind = f"__old{i}", f"__new{i}", df.schema[column].dataType
        ids, small = bounded_broadcast(m.select(F.col("old_sid").alias(old), F.col("new_sid").alias(new)))
        keyed = out.withColumn(old, F.col(f"`{column}`").cast("bigint"))
        out = keyed.join(ids, old, "left") if small else salted_join(keyed, ids, old, task_rows=task_rows)
        out = out.withColumn(column, F.coalesce(F.col(new), F.col(old)).cast(kind if kind.typeName() != "void" else "bigint")).drop(old, new)
    return out.select(*[F.col(f"`{n}`") for n in df.columns])


class Rekeyer:
    def __init__(self, hierarchy: Hierarchy, allocator: RangeAllocator, overrides: dict[str, int] | None = None, legacy: bool = False):
        self.hierarchy, self.allocator, self.overrides, self.legacy = hierarchy, allocator, overrides or {}, legacy
        self.mappings: dict[str, DataFrame] = {}
        self.results: dict[str, TableResult] = {}

    def build(self, tables: dict[str, DataFrame], workers: int = 8) -> None:
        """First pass: a mapping for every table that owns its key.

        Ranges are allocated in parents-first order; counting and mapping are
        independent per table and run side by side on driver threads.
        """
        names = self.hierarchy.order(list(tables))
        for name in names:
            if name not in self.hierarchy:
                self.results[name] = TableResult(name, error="unknown table")
        known = [n for n in names if n in self.hierarchy]
        with ThreadPoolExecutor(workers) as pool:
            counts = dict(zip(known, pool.map(lambda n: self._rows(self.hierarchy[n], tables[n]), known)))
            todo = [(n, self._allocate(self.hierarchy[n], counts[n])) for n in known]
            todo = [(n, start) for n, start in todo if start is not None]
            made = pool.map(lambda x: stage(self._mapping(self.hierarchy[x[0]], tables[x[0]], x[1]), "rekey-map"), todo)
            self.mappings |= {self.hierarchy[n].name: m for (n, _), m in zip(todo, made)}

    def _rows(self, t: Table, df: DataFrame) -> int | None:
        return None if find_column(df, t.key) is None else df.count()

    def _allocate(self, t: Table, rows: int | None) -> int | None:
        """First id for the table's mapping; None where it gets none."""
        r = self.results[t.name] = TableResult(t.name, rows or 0, t.key)
        if rows is None:
            r.error = f"key column {t.key} is missing"
        if not rows or t.name in self.mappings or (t.key_is_reference and not self.legacy):  # empty, resumed, follows its parent
            return None
        if t.name in self.overrides:
            r.first = r.last = self.overrides[t.name]
        else:
            r.first, n = self.allocator.allocate(t.name, rows)
            r.last = r.first + n - 1
        return r.first

    def _mapping(self, t: Table, df: DataFrame, start: int) -> DataFrame:
        key = find_column(df, t.key)
        if t.name in self.overrides:
            return df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("old_sid")).distinct().withColumn("new_sid", F.lit(start).cast("bigint"))
        return mapping(df, key, start)

    def apply(self, name: str, df: DataFrame) -> DataFrame:
        """Second pass for one table."""
        if name not in self.hierarchy or self.results.get(name, TableResult(name)).error:
            return df
        t = self.hierarchy[name]
        r = self.results[t.name]
        columns: dict[str, DataFrame] = {}
        key = find_column(df, t.key)
        if t.name in self.mappings:
            columns[key] = self.mappings[t.name]
        if self.legacy and columns:
            df = rewrite(df, columns)  # references then look up the new ids
            columns = {}
        for column, parent in t.parents.items():
            have = find_column(df, column)
            if have is None or parent not in self.mappings:
                continue
            if self.legacy and parent != t.name and self.hierarchy.order().index(parent) > self.hierarchy.order().index(t.name):
                continue
            columns[have] = self.mappings[parent]
            if parent == t.name:
                r.self_reference = True
            else:
                r.references.append(have)
        return rewrite(df, columns)

    def run(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """All tables re-keyed, parents first; errors are in ``results`` and do not stop the rest."""
        self.build(tables)
        return {n: self.apply(n, tables[n]) for n in self.hierarchy.order(list(tables))}


def speedup(hierarchy: Hierarchy, workers: int) -> float:
    """Tables over the sum of each level's rounds on ``workers``."""
    levels = hierarchy.levels().values()
    return sum(map(len, levels)) / sum(max(1, len(x) / workers) for x in levels)


def entity_metadata(df: DataFrame | None, id_column: str, name_column: str) -> DataFrame | None:
    """Non-null names with their old ids, and the count of all rows; None for no table."""
    if df is None:
        return None
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.where(F.col(name_column).isNotNull()).select(F.col(id_column).alias("old_sid"), F.col(name_column).alias("name")).crossJoin(F.broadcast(total))  # one row


def created_mapping(entities: DataFrame, create: Callable[[list[str]], dict[str, int]], single: bool = False, batch: int = 10_000) -> DataFrame | int:
    """Map each old entity, by name, to what ``create`` made of it; ``single`` gives the first id for all.

    Names are handed to ``create`` in order, so many at a time, as the driver
    reads them partition by partition; what it made is joined back.
    """
    names = (r["name"] for r in entities.select("name").distinct().orderBy("name").toLocalIterator())
    spark, made = entities.sparkSession, None
    schema = "name string, new_sid bigint"
    while group := list(islice(names, batch)):
        ids = create(group)
        if single:
            return next(iter(ids.values()))
        part = spark.createDataFrame(list(ids.items()), schema)
        made = part if made is None else made.unionByName(part)
    ids, _ = bounded_broadcast(stage(spark.createDataFrame([], schema) if made is None else made, "created"))
    return entities.join(ids, "name").select("name", F.col("old_sid").cast("bigint").alias("old_sid"), "new_sid")
