"""Shared-folder staging and skew handling used by several operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one key that one task of a join takes; a key with more is spread.
TASK_ROWS = 250_000
#: Largest side that is broadcast, in bytes of its values.
BROADCAST_BYTES = 16 << 20

_staged: dict[str, SparkSession] = {}


class NoSharedFolder(RuntimeError):
    """The session names no folder that all executors can reach."""


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``.

    Only a driver that is its own executor (``local[...]``: tests, a laptop) may
    do without; a temporary folder is then made and set for the context.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors can reach")
    own = tempfile.mkdtemp(prefix="loomgate-")
    spark.sparkContext.setCheckpointDir(own)
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed when the driver ends."""
    path = f"{shared_root(spark)}/loomgate/{label}-{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(sweep)
    _staged[path] = spark
    return path


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def sweep() -> None:
    """Delete every staged folder of this driver; results read from them end here."""
    while _staged:
        path, spark = _staged.popitem()
        try:
            delete(spark, path)
        except Exception:  # the session is gone; the folder is the cluster's to clean
            pass


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of any executor, and gives
    the next plan exact sizes to choose its joins from.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Free staged frames whose dependents have all been staged or written."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path in _staged:
            delete(_staged.pop(path), path)


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` marked for broadcast if its measured values come to at most ``limit`` bytes; and whether it was."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType)) else F.lit(8)
                 for f in df.schema.fields), F.lit(16))
    size = df.agg(F.sum(width)).first()[0] or 0
    return (F.broadcast(df), True) if size <= limit else (df, False)


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """(key, salts) of keys with more rows than one task should take.

    The count is combined map-side, so it moves one row per key and partition.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > task_rows).select(key, F.ceil(F.col("__n") / task_rows).cast("long").alias("__salts"))


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", task_rows: int = TASK_ROWS) -> DataFrame:
    """Equi-join on ``key`` in which the hot keys of ``left`` are spread.

    ``left`` is read twice: stage it if it is costly. Rows of a hot key get a
    random salt (a hash of the whole row, so a retried task repeats it) below
    the number of tasks its rows fill, and the right rows of hot keys are copied
    once per salt; all other rows keep salt 0. In a left join, rows of a null
    key are set apart and never shuffled.
    """
    spread = stage(hot_keys(left, key, task_rows), "hot-keys")
    if spread.isEmpty():
        joined = None
    else:
        hot, _ = bounded_broadcast(spread)
        zero = F.lit(0).cast("long")
        mix = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if _hashable(left, c)])
        rows = left.where(F.col(key).isNotNull()).join(hot, key, "left").withColumn("__salt", F.when(F.col("__salts").isNotNull(), F.pmod(mix, F.col("__salts"))).otherwise(zero)).drop("__salts")
        salts = F.when(F.col("__salts").isNotNull(), F.sequence(zero, F.col("__salts") - 1)).otherwise(F.array(zero))
        index = right.join(hot, key, "left").withColumn("__salt", F.explode(salts)).drop("__salts")
        joined = rows.join(index, [key, "__salt"], how).drop("__salt")
    if joined is None:
        joined = left.where(F.col(key).isNotNull()).join(right, key, how)
    if how != "left":
        return joined
    return joined.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def _hashable(df: DataFrame, name: str) -> bool:
    return "map<" not in df.schema[name].dataType.simpleString()


def prefer(n_rows: int, per_task: int, least: int = 1) -> int:
    """Number of groups so that each holds about ``per_task`` rows."""
    return max(least, -(-n_rows // per_task))


def in_ranges(df: DataFrame, by: list[str], order: list[str], task_rows: int = TASK_ROWS) -> tuple[DataFrame, int]:
    """Rows spread by ranges of (by, order), staged with the number ``__range`` of theirs; and how many ranges.

    Equal (by, order) share a range. A group with a third of all rows lies in
    many ranges, so work on ``(__range, by)`` has no hot group.
    """
    rows = stage(df, "unordered")
    n = prefer(rows.count(), task_rows)
    if n == 1:
        return rows.withColumn("__range", F.lit(0)), 1
    return stage(rows.repartitionByRange(n, *by, *order).withColumn("__range", F.spark_partition_id()), "ranges"), n


def carried(totals: DataFrame, by: list[str], aggregate, out: str) -> DataFrame:
    """Per group and range, ``aggregate`` over the ranges before; none for the first.

    ``totals`` has one row per group and range. Only groups that reach over a
    range's end come out: fewer than there are ranges.
    """
    order = W.partitionBy(*by).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    return totals.withColumn(out, aggregate.over(order)).where(F.col(out).isNotNull()).select(*by, "__range", out)


def with_carried(rows: DataFrame, before: DataFrame, by: list[str], out: str) -> DataFrame:
    """``rows`` with what their group and range carries over, null for nothing."""
    named = before.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__range").alias("__r"), out)
    offsets, _ = bounded_broadcast(stage(named, "range-offsets"))
    same = F.col("__range") == F.col("__r")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    return rows.join(offsets, same, "left").drop("__r", *[f"__by_{c}" for c in by])


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, out: str, task_rows: int = TASK_ROWS, row_by_row: bool = False) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of its group up to its own in ``order``.

    Rows equal in ``order`` have one sum, or, ``row_by_row``, one each. Sums are
    made inside ranges and offset by the totals of the ranges before.
    """
    rows, n = in_ranges(df, by, order, task_rows)
    inside = W.partitionBy(*by, "__range").orderBy(*order)
    summed = rows.withColumn(out, F.sum(value).over(inside.rowsBetween(W.unboundedPreceding, 0) if row_by_row else inside))
    if n == 1:
        return summed.drop("__range")
    before = carried(rows.groupBy(*by, "__range").agg(F.sum(value).alias("__sum")), by, F.sum("__sum"), "__before")
    return with_carried(summed, before, by, "__before").withColumn(out, F.col(out) + F.coalesce("__before", F.lit(0))).drop("__range", "__before")
