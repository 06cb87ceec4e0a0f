"""Alignment of a source to the destination's schema, which decides.

Order and names are the destination's (matched without case); source-only
columns drop out; absent and all-null columns become typed nulls. Casts that
fail give null and are counted by ``nulled``; ``wrap`` reproduces the wrapping
casts of two's-complement integers. Casts that Spark does not have raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgate.functions.expressions import hex_text, iso_timestamp, nested_as_json

_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _cast(c: Column, source: T.DataType, target: T.DataType, wrap: bool) -> Column:
    if source == target:
        return c
    if isinstance(target, T.StringType):
        if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            return iso_timestamp(c)
        if isinstance(source, T.BinaryType):
            return hex_text(c)
        return nested_as_json(c, source).cast(target)
    kind = target.simpleString()
    if wrap and kind in _BITS and isinstance(source, T.IntegralType):
        bits = _BITS[kind]
        if bits == 64:
            return c.cast(target)
        half, whole = 1 << (bits - 1), 1 << bits
        return (F.pmod(c.cast("bigint") + half, F.lit(whole)) - half).cast(target)
    if wrap and kind in _BITS and isinstance(source, (T.DoubleType, T.FloatType)):
        return _cast(c.try_cast("bigint"), T.LongType(), target, True)
    return c.try_cast(target)


def align(df: DataFrame, schema: T.StructType, wrap: bool = False) -> DataFrame:
    have = {c.lower(): c for c in reversed(df.columns)}
    out = []
    for f in schema.fields:
        s = have.get(f.name.lower())
        out.append((F.lit(None).cast(f.dataType) if s is None else _cast(F.col(f"`{s}`"), df.schema[s].dataType, f.dataType, wrap)).alias(f.name))
    return df.select(*out)


def nulled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, nulled): values that were there and did not cast."""
    have = {c.lower(): c for c in reversed(df.columns)}
    pairs = [(f, have[f.name.lower()]) for f in schema.fields if f.name.lower() in have]
    sums = [F.count_if(F.col(f"`{s}`").isNotNull() & _cast(F.col(f"`{s}`"), df.schema[s].dataType, f.dataType, False).isNull()).alias(f"c{i}") for i, (f, s) in enumerate(pairs)]
    if not sums:
        return df.sparkSession.createDataFrame([], "column_name string, nulled bigint")
    stacked = F.inline(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"c{i}").alias("nulled")) for i, (f, _) in enumerate(pairs)]))
    return df.agg(*sums).select(stacked)


def new_columns(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """Source columns the destination lacks: what an evolving destination would add."""
    known = {f.name.lower() for f in schema.fields}
    return [f for f in df.schema.fields if f.name.lower() not in known]


def evolved(schema: T.StructType, df: DataFrame) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType, True) for f in new_columns(df, schema)]])
