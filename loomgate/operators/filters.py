"""Filtering along foreign-key paths, and counts under it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgate.operators.rekey import find_column
from loomgate.plans.hierarchy import Edge, Hierarchy

# Columns an entity filter may use, in order of preference.
ENTITY_COLUMNS = ("exposuresetsid", "exposuresetid", "exposure_id", "exposureid")


def entity_filter(df: DataFrame, ids: list[int], candidates: tuple[str, ...] = ENTITY_COLUMNS) -> DataFrame:
    """Rows of the given entities by the first candidate column present; unfiltered without ids or column."""
    column = next((c for name in candidates if (c := find_column(df, name))), None)
    return df if not ids or column is None else df.where(F.col(f"`{column}`").isin(ids))


def path_filter(tables: dict[str, DataFrame], path: list[Edge], column: str, ids: list[int]) -> DataFrame:
    """Rows of the path's first table whose last parent has ``column`` in ``ids``.

    Semi-joins from the far end: each hop carries keys only, and a parent key
    that repeats does not multiply rows.
    """
    keys = tables[path[-1].parent].where(F.col(column).isin(ids)).select(F.col(path[-1].parent_key).alias("__k"))
    for edge, down in zip(reversed(path), [*reversed(path[:-1]), None]):
        child = tables[edge.table]
        rows = child.join(keys, F.col(f"`{edge.column}`") == F.col("__k"), "left_semi")
        if down is None:
            return rows
        keys = rows.select(F.col(down.parent_key).alias("__k"))
    raise ValueError("empty path")


def path_count(tables: dict[str, DataFrame], path: list[Edge], column: str, ids: list[int]) -> DataFrame:
    """``cnt`` of inner-joined rows along the path (a parent key that repeats multiplies)."""
    rows = tables[path[0].table].select(F.col(path[0].column).alias("__k"))
    for i, e in enumerate(path):
        parent = tables[e.parent]
        parent = parent.where(F.col(column).isin(ids)) if i == len(path) - 1 else parent
        carry = F.col(path[i + 1].column).alias("__n") if i + 1 < len(path) else F.lit(1).alias("__n")
        rows = rows.join(parent.select(F.col(e.parent_key).alias("__p"), carry), F.col("__k") == F.col("__p")).select(F.col("__n").alias("__k"))
    return rows.agg(F.count(F.lit(1)).alias("cnt"))


def reachable_filter(hierarchy: Hierarchy, tables: dict[str, DataFrame], name: str, roots: dict[str, str], ids: list[int]) -> DataFrame:
    """Filter a table by the entity: directly, over the shortest path to a filterable table, or not at all."""
    direct = roots.get(name)
    if direct:
        return tables[name].where(F.col(direct).isin(ids)) if ids else tables[name]
    path = hierarchy.path(name, set(roots)) if ids else None
    return path_filter(tables, path, roots[path[-1].parent], ids) if path else tables[name]


def join_sql(path: list[Edge], column: str, ids: list[int]) -> str:
    """The same restriction as a SQL fragment for a relational source."""
    joins = [f"JOIN {e.parent} j{i} ON {'t' if i == 0 else f'j{i - 1}'}.{e.column} = j{i}.{e.parent_key}" for i, e in enumerate(path)]
    last = f"j{len(path) - 1}.{column}" if path else column
    return " ".join([*joins, f"WHERE {last} IN ({', '.join(map(str, ids))})"])


def select_names(available: list[str], wanted: str | list[str] | None) -> list[str]:
    """Tables by exact or qualified name; ``all``, empty, a JSON list or comma text."""
    import json

    if isinstance(wanted, str):
        text = wanted.strip()
        wanted = [] if text.lower() in ("", "all") else [str(x) for x in json.loads(text)] if text.startswith("[") else [x.strip() for x in text.split(",") if x.strip()]
    if not wanted or any(w.lower() == "all" for w in wanted):
        return list(available)
    return [t for t in available if t in wanted or t.split(".")[-1] in wanted]


def count_all(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, cnt) of every table as one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        out = one if out is None else out.unionAll(one)
    return out


def picked_counts(hierarchy: Hierarchy, tables: dict[str, DataFrame], roots: dict[str, str], ids: list[int], references: tuple[str, ...] = ()) -> DataFrame:
    """(table_name, strategy, cnt): rows to move per table, counted as its place in the graph allows.

    ``direct`` by its own entity column, ``path`` over references to a table
    that has one, ``reference`` whole for the named tables, else ``skip`` with 0.
    """
    out = None
    for name, df in tables.items():
        path = hierarchy.path(name, set(roots)) if name in hierarchy and name not in roots else None
        if name in roots:
            how, one = "direct", df.where(F.col(roots[name]).isin(ids)).agg(F.count(F.lit(1)).alias("cnt"))
        elif path:
            how, one = "path", path_count(tables, path, roots[path[-1].parent], ids)
        elif name in references:
            how, one = "reference", df.agg(F.count(F.lit(1)).alias("cnt"))
        else:
            how, one = "skip", df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("cnt"))
        one = one.select(F.lit(name).alias("table_name"), F.lit(how).alias("strategy"), "cnt")
        out = one if out is None else out.unionAll(one)
    return out


def key_count(df: DataFrame, column: str, value: int | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """``cnt`` of rows null-safely equal to a value, or in an inclusive range."""
    keep = F.col(column).eqNullSafe(F.lit(value)) if low is None else F.col(column).between(low, high)
    return df.where(keep).agg(F.count(F.lit(1)).alias("cnt"))
