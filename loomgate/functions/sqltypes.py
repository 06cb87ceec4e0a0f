"""Spark types to SQL Server types, and batch sizes from schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# SQL Server type per Spark type name.
SQL_TYPES = {
    "boolean": "BIT", "byte": "TINYINT", "short": "SMALLINT", "integer": "INT", "long": "BIGINT", "float": "REAL", "double": "FLOAT",
    "date": "DATE", "timestamp_ntz": "DATETIME2", "timestamp": "DATETIMEOFFSET", "string": "NVARCHAR(MAX)", "binary": "VARBINARY(MAX)", "time": "TIME",
}
# Estimated bytes per Spark type name; others 50.
BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "long": 8, "double": 8, "decimal": 16, "date": 4, "timestamp": 8, "timestamp_ntz": 8, "time": 8, "string": 100, "binary": 200}


def sql_server_type(t: T.DataType) -> str:
    """Nested and unknown types become text (JSON)."""
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return SQL_TYPES.get(t.typeName(), "NVARCHAR(MAX)")


def read_batch_rows(schema: T.StructType, target_mb: int = 50, least: int = 1_000, most: int = 100_000) -> int:
    """Rows per Arrow batch for a memory target; no columns gives the most."""
    if not schema.fields:
        return most
    row = sum(BYTES.get(f.dataType.typeName().split("(")[0], 50) + 2 for f in schema.fields)
    return max(least, min(target_mb * 1024 * 1024 // row, most))


def insert_batch_rows(columns: int, target_mb: int = 10, least: int = 500, most: int = 50_000) -> int:
    """Rows per INSERT batch."""
    return most if columns <= 0 else max(least, min(target_mb * 1024 * 1024 // (columns * 100), most))
