"""Consolidation of many tiny files into few well-sized ones.

1. *Select*: of rows that hold the same record (target table, key, fields and
   values, however the JSON is written) the first by file and row is kept.
   Only positions, digests and sizes are shuffled for it, no payload.
2. *Plan*: what is kept is cut into pieces of bounded size per file, and the
   pieces are assigned, longest first, to the least loaded of a fixed number
   of output groups (a heap). Very many files are first spread over shards by
   hash, each with its own heap, so no task and not the driver holds the list.
3. *Write*: each group is one file, streamed through pyarrow under a
   temporary name and renamed; a group's content is fixed by the plan, so a
   repeated task writes the same file.
4. *Publish*: the manifest (rows and content sum per group) is verified
   against the plan and against the files read back, then a pointer to it is
   renamed into place. Readers see the old state or the new one.

Two payloads are equal if their JSON is: numbers by exact value (of any length
and exponent), strings after escapes, objects whatever the order of their
fields; a field written twice counts twice, in order.

Edge cases: a file that is not listed, or listed with any state other than
``committed``, is not committed; listings may repeat; stated counts and sizes
are not trusted (real ones are taken from the rows); null payloads equal each
other; text that is not JSON, or nested too deeply to be read, is compared as
it stands; a null row key equals a null row key; rows without a number come
after the others of their file; different records at one position are all kept;
an empty input publishes an empty manifest.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgate.runtime import bounded_broadcast, prefer, salted_join, shared_path, stage, unstage
from loomgate.store import replace_text

#: Bytes of payload per output file, rows per piece of a file, files per heap, output files per task.
TARGET_BYTES, PIECE_ROWS, SHARD_FILES, TASK_GROUPS = 128 << 20, 1_000_000, 50_000, 4
OUT_SCHEMA = pa.schema([("target", pa.string()), ("file_id", pa.int64()), ("row_no", pa.int64()), ("row_key", pa.int64()), ("payload", pa.string())])
ROWS_PER_ROW_GROUP = 100_000


class _Number(str):
    """A JSON number as written."""


class _Object(list):
    """The fields of a JSON object as (name, value), sorted by name."""


def exact(number: str) -> str:
    """One spelling per value of a JSON number: sign, digits without outer zeros, power of ten."""
    mantissa, _, power = number.lower().partition("e")
    whole, _, part = mantissa.lstrip("-").partition(".")
    digits = (whole + part).lstrip("0")
    if not digits:
        return "0"
    short = digits.rstrip("0")
    return f"{'-' * (number[0] == '-')}{short}e{int(power or 0) - len(part) + len(digits) - len(short)}"


def _spelled(value: object) -> str:
    if isinstance(value, _Number):
        return f"#{exact(value)}"  # no string starts so: those are in quotes
    if isinstance(value, _Object):
        return "{" + ",".join(f"{json.dumps(k)}:{_spelled(v)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_spelled, value)) + "]"
    return json.dumps(value)


def _no_json(name: str) -> None:
    raise ValueError(name)  # NaN and Infinity are not JSON


def canonical(text: str | None) -> str | None:
    """One spelling per JSON value; text that is none keeps its own behind a zero byte."""
    if text is None:
        return None
    try:
        return _spelled(json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=_no_json, object_pairs_hook=lambda x: _Object(sorted(x, key=lambda f: f[0]))))
    except (ValueError, ArithmeticError, RecursionError):
        return "\x00" + text


@F.arrow_udf(T.BinaryType())
def record_digest(payload: pa.Array) -> pa.Array:
    one = lambda t: None if t is None else hashlib.blake2b(canonical(t).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return pa.array([one(t) for t in payload.to_pylist()], pa.binary())


def assign_groups(pieces: DataFrame, target_bytes: int) -> DataFrame:
    """(target, file_id, piece, bytes) → the same with ``group``, balanced per target table."""
    totals = pieces.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("all_bytes"))
    # Shards per table follow its number of pieces, so each heap is bounded.
    sharded = pieces.join(totals, "target").withColumn(
        "shard", F.pmod(F.xxhash64("file_id", "piece"), F.ceil(F.col("n") / SHARD_FILES)).cast("int")
    )

    def balance(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "file_id", "piece"], ascending=[False, True, True])
        n = max(1, -(-int(pdf["bytes"].sum()) // target_bytes))
        heap = [(0, g) for g in range(n)]
        where = []
        for size in pdf["bytes"]:
            load, g = heap[0]
            heapq.heapreplace(heap, (load + int(size), g))
            where.append(g)
        names = [f"g-{re.sub('[^a-z0-9_]', '_', t)}-{zlib.crc32(t.encode()):08x}-{s:04d}-{g:05d}" for t, s, g in zip(pdf["target"], pdf["shard"], where)]
        return pdf.assign(group=names)[["target", "file_id", "piece", "bytes", "group"]]

    return sharded.select("target", "shard", "file_id", "piece", "bytes").groupBy("target", "shard").applyInPandas(
        balance, "target string, file_id bigint, piece bigint, bytes bigint, group string"
    )


def committed_files(files: DataFrame) -> DataFrame:
    """file_id → target table, for files that every listing calls committed."""
    return (
        files.where("file_id is not null").groupBy("file_id")
        .agg(F.min(F.coalesce(F.col("commit_state") == "committed", F.lit(False))).alias("ok"), F.min(F.lower(F.trim("target_table"))).alias("target"))
        .where("ok").select("file_id", F.coalesce("target", F.lit("")).alias("target"))
    )


def _row_mark() -> Column:
    """Tells apart rows that share a position; equal only for full copies of a row."""
    return F.xxhash64(F.col("row_no").isNull(), "row_no", F.col("row_key").isNull(), "row_key", F.col("payload").isNull(), "payload")


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select("file_id", F.col("row_no").cast("bigint").alias("row_no"), F.col("row_key").cast("bigint").alias("row_key"), F.col("payload").cast("string").alias("payload"))


def plan_and_select(files: DataFrame, rows: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(group, target, file_id, no, mark, chars) of the rows to carry over; ``no`` is the row number, -1 for none."""
    committed, small = bounded_broadcast(stage(committed_files(files), "compact-committed"))
    narrow = _typed(rows).where("file_id is not null").select(
        "file_id", F.col("row_no"), "row_key", record_digest("payload").alias("record"), _row_mark().alias("mark"), F.coalesce(F.octet_length("payload"), F.lit(0)).alias("chars"))
    live = stage(narrow.join(committed, "file_id") if small else salted_join(narrow, committed, "file_id", "inner"), "compact-live")
    # The smallest position per record is combined map-side, so a record held
    # millions of times still moves one row per task.
    at = F.struct("file_id", F.col("row_no").isNull().alias("unnumbered"), "row_no", "mark", "chars")
    first = live.groupBy("target", "row_key", "record").agg(F.min(at).alias("at"))
    kept = first.select("target", "at.file_id", F.coalesce("at.row_no", F.lit(-1)).alias("no"), "at.mark", "at.chars").withColumn("piece", F.floor(F.col("no") / PIECE_ROWS))
    kept = stage(kept, "compact-kept")
    pieces = kept.groupBy("target", "file_id", "piece").agg(F.sum(F.col("chars") + 24).alias("bytes"))
    groups = stage(assign_groups(pieces, target_bytes), "compact-groups")
    chosen = stage(kept.join(groups.select("target", "file_id", "piece", "group"), ["target", "file_id", "piece"]).drop("piece"), "compact-chosen")
    unstage(live, kept, groups)
    return chosen


def with_payload(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen rows whole, each once; many files' rows spread by position, so no file is one task."""
    every = _typed(rows).where("file_id is not null").withColumn("no", F.coalesce("row_no", F.lit(-1))).withColumn("mark", _row_mark())
    return every.join(chosen.drop("chars"), ["file_id", "no", "mark"]).dropDuplicates(["file_id", "no", "mark"])


def write_groups(selected: DataFrame, folder: str, groups: int | None = None) -> DataFrame:
    """Write one parquet file per group below ``folder``; return the manifest."""
    base = folder
    n_groups = selected.sparkSession.sparkContext.defaultParallelism if groups is None else groups
    columns = [f.name for f in OUT_SCHEMA]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), base)
        store.create_dir(root, recursive=True)
        writer = group = tmp = None
        rows = check = 0

        def close():
            writer.close()
            final = f"{root}/{group}.parquet"
            if store.get_file_info(final).type != fs.FileType.NotFound and store.type_name != "local":
                store.delete_file(final)  # same content, written by a task that ran again
            store.move(tmp, final)
            return pa.RecordBatch.from_pydict({"group": [group], "rows": [rows], "content": pa.array([Decimal(check)], pa.decimal128(38, 0)), "bytes": [store.get_file_info(final).size]})

        for batch in batches:
            names = batch.column("group").to_pylist()
            start = 0
            while start < len(names):
                end = start
                while end < len(names) and names[end] == names[start]:
                    end += 1
                if names[start] != group:
                    if writer is not None:
                        yield close()
                    group, rows, check = names[start], 0, 0
                    tmp = f"{root}/.{group}.{uuid.uuid4().hex}.tmp"
                    writer = pq.ParquetWriter(store.open_output_stream(tmp), OUT_SCHEMA, compression="zstd")
                part = batch.slice(start, end - start)
                writer.write_batch(pa.RecordBatch.from_arrays([part.column(c).cast(OUT_SCHEMA.field(c).type) for c in columns], schema=OUT_SCHEMA), row_group_size=ROWS_PER_ROW_GROUP)
                rows += part.num_rows
                check += sum(part.column("content").to_pylist())
                start = end
        if writer is not None:
            yield close()

    # One shuffle by group, into as many partitions as there are groups to write.
    spread = selected.withColumnRenamed("mark", "content").repartition(prefer(n_groups, TASK_GROUPS), "group").sortWithinPartitions("group", "file_id", "no", "content")
    return spread.select("group", *columns, "content").mapInArrow(run, "group string, rows bigint, content decimal(38,0), bytes bigint")


class CompactionError(RuntimeError):
    """What was written is not what was selected."""


def consolidate(files: DataFrame, rows: DataFrame, folder: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Write, verify and publish; return the published manifest."""
    spark = files.sparkSession
    chosen = plan_and_select(files, rows, target_bytes)
    data = f"{folder}/data"
    mark = F.sum(F.col("mark").cast("decimal(38,0)"))
    expected = stage(chosen.groupBy("group").agg(F.count(F.lit(1)).alias("n"), mark.alias("c")), "compact-expected")
    manifest = stage(write_groups(with_payload(rows, chosen), data, expected.count()), "compact-manifest")
    if manifest.isEmpty():
        wrong = expected.count()
    else:
        back = spark.read.parquet(data).withColumn("mark", _row_mark()).withColumn("group", F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.parquet$", ""))
        held = back.groupBy("group").agg(F.count(F.lit(1)).alias("n2"), mark.alias("c2"))
        wrong = (
            manifest.join(expected, "group", "full").join(held, "group", "full")
            .where("not (rows <=> n and content <=> c and n2 <=> n and c2 <=> c)").count()
        )
    unstage(chosen)
    if wrong:
        raise CompactionError(f"{wrong} output groups differ from what was selected")
    publish(spark, folder, manifest)
    return manifest


def publish(spark: SparkSession, folder: str, manifest: DataFrame) -> None:
    """Write the manifest beside the data, then rename a pointer to it into place."""
    name = f"manifest-{uuid.uuid4().hex}"
    manifest.write.parquet(f"{folder}/{name}")
    replace_text(spark, f"{folder}/CURRENT", name)


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The consolidated rows."""
    return spark.read.parquet(f"{folder}/data")


# ---------------------------------------------------------------- this project's tables


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{d}/lake_files.parquet"), spark.read.parquet(f"{d}/lake_rows.parquet")


def found(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the published files do not carry."""
    files, rows = _inputs(spark, d)
    folder = shared_path(spark, "compact")
    manifest = consolidate(files, rows, folder)
    asked = rows.select("file_id", "row_no").distinct()
    if manifest.isEmpty():
        return asked
    held = published(spark, folder).select(F.col("file_id").alias("f"), F.col("row_no").alias("r")).distinct()
    return asked.join(held, F.col("file_id").eqNullSafe(F.col("f")) & F.col("row_no").eqNullSafe(F.col("r")), "left_anti")


def manifest(spark: SparkSession, d: str) -> DataFrame:
    """Files published per target table, with the rows and payload characters they hold."""
    files, rows = _inputs(spark, d)
    folder = shared_path(spark, "compact")
    groups = consolidate(files, rows, folder, 1 << 20)
    if groups.isEmpty():
        return spark.createDataFrame([], "target string, files bigint, rows bigint, payload_bytes bigint")
    held = published(spark, folder).select("target", F.col("_metadata.file_path").alias("file"), F.coalesce(F.octet_length("payload"), F.lit(0)).alias("b"))
    per_file = held.groupBy("target", "file").agg(F.count(F.lit(1)).alias("rows"), F.sum("b").alias("b"))
    return per_file.groupBy("target").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("b").alias("payload_bytes"))
