"""Type names of either side mapped to one Spark type name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings per Spark type (SQL Server and Arrow names).
SPELLINGS = {
    "boolean": ["bit", "bool", "boolean"],
    "smallint": ["tinyint", "smallint", "int8", "uint8", "int16", "short"],
    "int": ["int", "integer", "int32", "uint16"],
    "bigint": ["bigint", "int64", "long", "uint32"],
    "decimal(20,0)": ["uint64"],
    "float": ["real", "float16", "halffloat", "float32"],
    "double": ["float", "float64", "double"],
    "date": ["date", "date32", "date64"],
    "timestamp_ntz": ["datetime", "datetime2", "smalldatetime", "timestamp", "ts"],
    "timestamp": ["datetimeoffset", "timestamptz"],
    "time": ["time", "time32", "time64"],
    "string": ["char", "varchar", "nchar", "nvarchar", "text", "ntext", "xml", "uniqueidentifier", "string", "large_string", "utf8", "str"],
    "binary": ["binary", "varbinary", "image", "large_binary", "fixed_size_binary"],
    "skipped": ["geography", "geometry", "hierarchyid", "sql_variant"],
}
# Decimal names whose precision and scale may be left out.
DECIMAL_DEFAULTS = {"decimal": (38, 0), "numeric": (38, 0), "dec": (38, 0), "decimal128": (38, 18), "decimal256": (38, 18), "money": (19, 4), "smallmoney": (10, 4)}


def spark_type(declared: Column) -> Column:
    """Spark type name of a declared type; null stays null, unknown names are strings.

    Case, blanks and text lengths do not matter; decimals keep precision and
    scale; a timestamp with a zone (``timestamp[us, tz=UTC]``) is ``timestamp``.
    """
    text = F.lower(F.regexp_replace(declared, r"\s+", ""))
    base = F.regexp_extract(text, r"^([a-z_0-9]+)", 1)
    size = F.regexp_extract_all(F.regexp_extract(text, r"[\(\[](.*)[\)\]]", 1), F.lit(r"(\d+)"), 1)
    out = F.lit("string")
    for kind, names in SPELLINGS.items():
        out = F.when(base.isin(names), kind).otherwise(out)
    out = F.when(base.isin("timestamp", "ts") & text.contains("tz="), "timestamp").otherwise(out)
    for name, (p, s) in DECIMAL_DEFAULTS.items():
        given = F.concat(F.lit("decimal("), F.element_at(size, 1), F.lit(","), F.coalesce(F.try_element_at(size, F.lit(2)), F.lit("0")), F.lit(")"))
        out = F.when(base == name, F.when(F.size(size) > 0, given).otherwise(f"decimal({p},{s})")).otherwise(out)
    return F.when(declared.isNotNull(), out)
