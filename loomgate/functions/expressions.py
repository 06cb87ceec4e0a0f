"""Column expressions for text, times and semi-structured values."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys (letters and digits, lower case) of the two counters and the total.
INGESTED = ("recordsingested", "ingestedrecords", "ingestedcount", "rowsingested", "totalingested", "ingestioncount", "ingested", "recordsprocessed")
EXTRACTED = ("recordsextracted", "extractedrecords", "extractedcount", "rowsextracted", "totalextracted", "extractioncount", "extracted", "outputrecordcount")
TOTAL = ("totalrecordcount", "recordcount", "totalrecords")
# How the counters are spelled in plain log lines.
LOG_KEYS = {
    "ingested": r"records?[_\s-]*ingested|ingested[_\s-]*records?",
    "extracted": r"records?[_\s-]*extracted|extracted[_\s-]*records?",
    "total": r"total[_\s-]*record[_\s-]*count|record[_\s-]*count|total[_\s-]*records",
}


def iso_timestamp(ts: Column) -> Column:
    """``T`` between date and time; six digits of fraction only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def squeezed(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"[_\-\s]+", ""))


def safe_name(name: Column, most: int = 128) -> Column:
    """Letters, digits and underscores; no leading digit; bounded length."""
    plain = F.regexp_replace(name, "[^a-zA-Z0-9_]", "_")
    return F.substring(F.when(plain.rlike("^[0-9]"), F.concat(F.lit("_"), plain)).otherwise(plain), 1, most)


def table_key_name(table: Column) -> Column:
    """``tLocation`` → ``locationsid``."""
    return F.concat(F.lower(F.regexp_replace(table, "^[tT]", "")), F.lit("sid"))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def nested_as_json(value: Column, kind: T.DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else value


def log_counter(message: Column, key: str) -> Column:
    """Number after a counter's name in a log line."""
    return F.regexp_extract(message, rf"(?i)(?:{LOG_KEYS[key]})\s*[:=]\s*(\d+)", 1).try_cast("int")


def json_counter(value: Column, path: str) -> Column:
    """Counter at a known path: the fast form of ``deep_counter``."""
    return F.get_json_object(value, path).try_cast("bigint")


def first_key(value: Column, paths: list[str]) -> Column:
    return F.coalesce(*[F.get_json_object(value, p) for p in paths])


def _counts(text: str | None, families: dict[str, frozenset]) -> dict[str, int]:
    """First counter of each key family in nested JSON, in document order, also in JSON held as text inside it.

    A key that names a counter but holds none is searched like any other.
    """
    found: dict[str, int] = {}
    todo: list = [text]
    while todo and len(found) < len(families):
        value = todo.pop()
        if isinstance(value, str):
            if value.lstrip()[:1] in ("{", "["):
                try:
                    todo.append(json.loads(value))
                except (ValueError, RecursionError):
                    pass
        elif isinstance(value, list):
            todo += reversed(value)
        elif isinstance(value, dict):
            todo += [x for kv in reversed(value.items()) for x in (kv[1], kv)]
        elif isinstance(value, tuple):  # a field, met before its value is searched
            key = re.sub(r"[\W_]+", "", value[0]).lower()
            for name, keys in families.items():
                if name not in found and key in keys and (n := _as_int(value[1])) is not None:
                    found[name] = n
    return found


def _as_int(v: object) -> int | None:
    if isinstance(v, bool):
        return None
    if isinstance(v, int):
        return v if -(2**31) <= v < 2**31 else None
    if isinstance(v, str) and re.fullmatch(r"\s*[+-]?\d{1,18}\s*", v):
        return _as_int(int(v))
    return None


def counters(families: dict[str, Iterable[str]], *texts: Column) -> Column:
    """Struct of the first counter of each key family in the texts, an earlier text before a later one.

    One Arrow pass: a text is parsed once for all families, and not at all when
    the texts before it had them.
    """
    wanted = {name: frozenset(keys) for name, keys in families.items()}

    @F.arrow_udf(T.StructType([T.StructField(name, T.IntegerType()) for name in wanted]))
    def search(*columns: pa.Array) -> pa.Array:
        out = []
        for row in zip(*[c.to_pylist() for c in columns]):
            found: dict[str, int] = {}
            for text in row:
                open_ = {n: k for n, k in wanted.items() if n not in found}
                if not open_:
                    break
                if text is not None:
                    found |= _counts(text, open_)
            out.append({n: found.get(n) for n in wanted})
        return pa.array(out, pa.struct([(n, pa.int32()) for n in wanted]))

    return search(*texts)


def deep_counter(value: Column, keys: Iterable[str]) -> Column:
    """First counter of a key family anywhere in nested JSON, or in JSON held as text inside it."""
    return counters({"n": keys}, value)["n"]


def parse_flag(value: Column) -> Column:
    """Whether a text says yes (``true``, ``1``, ``yes``, ``on``, in any case); null and all else say no."""
    return F.coalesce(F.lower(F.trim(value)).isin("true", "1", "yes", "on"), F.lit(False))


def parse_ids(value: Column) -> Column:
    """Array of ids from a JSON list or comma-separated text; entries that are no whole number drop out, null gives none."""
    inside = F.regexp_replace(value, r"[\[\]\"'\s]", "")
    parts = F.transform(F.split(inside, ","), lambda x: x.try_cast("bigint"))
    return F.coalesce(F.filter(parts, lambda x: x.isNotNull()), F.expr("cast(array() as array<bigint>)"))
