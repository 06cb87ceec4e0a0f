"""Orphan references, kept as keyed pending state.

A *reference* names a parent key at a point in time; a *parent fact* says when
a row of that key arrived and when it was deleted. The ledger is a folder:

* ``events``: arrivals and deletions, one segment per batch, only ever added to;
* ``refs``: every reference seen, likewise;
* ``pending``: the references that do not resolve, with the reason, one
  generation per batch (all other references are settled);
* ``snapshots``: open orphans per table and month after each batch;
* ``STATE``: the last whole batch, renamed into place, so that a batch which
  was cut off is as if it had not begun, and another session can ``load`` it.

``apply`` takes one batch of both and looks at touched keys only: new
references probe the index, arriving parents re-examine waiting orphans of their
keys, and deletions re-examine the settled references of their keys that lie
at or after them. The state after any sequence of batches equals that of one
batch with everything.

Edge cases: null keys refer to nothing and are ignored; a null reference time
means "now" (after every event); a parent without an arrival time counts as
not yet arrived; a parent deleted before it arrived is never live; repeated
references and, within a batch, repeated facts count once; empty inputs leave
the orphans as they were.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate.runtime import TASK_ROWS, bounded_broadcast, salted_join, shared_path, stage, unstage
from loomgate.store import read_text, replace_text

REFS = ["ref_field", "record_id", "ref_key", "parent_key", "at", "table_key"]
_REF_SCHEMA = "ref_field string, record_id bigint, ref_key string, parent_key string, at timestamp_ntz, table_key string"
_PENDING_SCHEMA = _REF_SCHEMA + ", orphan_kind string"
_EVENT_SCHEMA = "parent_key string, t timestamp_ntz, d bigint"
_COUNT_SCHEMA = "table_key string, period string, ref_field string, orphan_kind string, orphans bigint"
FAR = "9999-12-31 00:00:00"


def _far() -> Column:
    return F.lit(FAR).cast("timestamp_ntz")


def parent_events(parents: DataFrame) -> DataFrame:
    """(parent_key, live_from, live_to) facts → one +1 and at most one −1 event each."""
    facts = parents.select("parent_key", "live_from", "live_to").where("parent_key is not null").dropDuplicates()
    born = F.coalesce("live_from", _far())
    event = lambda t, d: F.struct(t.alias("t"), F.lit(d).cast("long").alias("d"))
    return facts.select(
        "parent_key",
        F.inline(
            F.when(F.col("live_to").isNull(), F.array(event(born, 1))).otherwise(
                F.array(event(born, 1), event(F.greatest(born, "live_to"), -1))
            )
        ),
    )


class OrphanLedger:
    """Incremental state of one family of references, in a folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.batch = spark, 0
        self.path = shared_path(spark, "orphan-ledger") if path is None else path.rstrip("/")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OrphanLedger:
        """The ledger as its last whole batch left it; a new one where there is none."""
        ledger = cls(spark, path)
        state = read_text(spark, f"{ledger.path}/STATE")
        ledger.batch = json.loads(state)["batch"] if state else 0
        return ledger

    def _segments(self, name: str, schema: str, upto: int) -> DataFrame:
        paths = [f"{self.path}/{name}/{n:06d}" for n in range(1, upto + 1)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, name: str, n: int, schema: str) -> DataFrame:
        where = f"{self.path}/{name}/{n:06d}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(schema).parquet(where)

    @property
    def pending(self) -> DataFrame:
        if not self.batch:
            return self.spark.createDataFrame([], _PENDING_SCHEMA)
        return self.spark.read.schema(_PENDING_SCHEMA).parquet(f"{self.path}/pending/{self.batch:06d}")

    def apply(self, refs: DataFrame | None, events: DataFrame | None) -> None:
        """Fold one batch of references and of ``parent_events`` into the state."""
        n, before = self.batch + 1, self.pending
        refs = self.spark.createDataFrame([], _REF_SCHEMA) if refs is None else refs
        new = self._write(refs.select(*REFS).where("ref_key is not null and parent_key is not null").dropDuplicates(), "refs", n, _REF_SCHEMA)
        candidates, kept = new, before
        if events is None:
            self._write(self.spark.createDataFrame([], _EVENT_SCHEMA), "events", n, _EVENT_SCHEMA)
        else:
            # Equal events are summed: the index holds the distinct event times of a key, not its rows.
            summed = events.groupBy("parent_key", "t", F.signum("d").alias("s")).agg(F.sum("d").alias("d")).select("parent_key", "t", "d")
            fresh = self._write(summed, "events", n, _EVENT_SCHEMA)
            if self.batch:
                touched = stage(fresh.groupBy("parent_key").agg(F.min(F.when(F.col("d") < 0, F.col("t"))).alias("first_deletion")), "orphan-touched")
                keys, small = bounded_broadcast(touched)
                ended = touched.where("first_deletion is not null")
                waiting = before.join(keys, "parent_key", "left_semi").select(*REFS)
                settled = self._segments("refs", _REF_SCHEMA, self.batch).join(F.broadcast(ended) if small else ended, "parent_key")
                settled = settled.where(F.coalesce("at", _far()) >= F.col("first_deletion")).select(*REFS)
                candidates = stage(new.unionByName(waiting).unionByName(settled), "orphan-candidates")
                # Those of reopened keys are among the touched, so none is kept and examined.
                kept = before.join(keys, "parent_key", "left_anti")
        probed = classify(candidates, self.index(candidates, n)).where("orphan_kind is not null").dropDuplicates()
        now = self._write(kept.select(*REFS, "orphan_kind").unionByName(probed), "pending", n, _PENDING_SCHEMA)
        self._write(open_orphans(now), "snapshots", n, _COUNT_SCHEMA)
        unstage(candidates)
        replace_text(self.spark, f"{self.path}/STATE", json.dumps({"batch": n}))
        self.batch = n

    def index(self, candidates: DataFrame, upto: int) -> DataFrame:
        """Per parent key its events in one row; for few candidates only their keys are gathered."""
        log = self._segments("events", _EVENT_SCHEMA, upto)
        if candidates.count() <= TASK_ROWS:
            log = log.join(F.broadcast(candidates.select("parent_key").distinct()), "parent_key", "left_semi")  # at most TASK_ROWS keys
        arrived = F.min(F.when((F.col("d") > 0) & (F.col("t") < _far()), F.col("t")))
        return log.groupBy("parent_key").agg(F.collect_list(F.struct("t", "d")).alias("events"), arrived.alias("first_arrival"))

    def snapshot(self) -> DataFrame:
        """Open orphans per table, month of the reference, field and kind."""
        return self.spark.read.schema(_COUNT_SCHEMA).parquet(f"{self.path}/snapshots/{self.batch:06d}") if self.batch else self.spark.createDataFrame([], _COUNT_SCHEMA)

    def history(self) -> DataFrame:
        """The snapshots of all batches, with their ``batch``."""
        if not self.batch:
            return self.spark.createDataFrame([], "batch int, " + _COUNT_SCHEMA)
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/snapshots/(\d+)/", 1).cast("int")
        return self._segments("snapshots", _COUNT_SCHEMA, self.batch).select(number.alias("batch"), "*")


def open_orphans(pending: DataFrame) -> DataFrame:
    return pending.groupBy("table_key", F.date_format("at", "yyyy-MM").alias("period"), "ref_field", "orphan_kind").agg(F.count(F.lit(1)).alias("orphans"))


def classify(refs: DataFrame, index: DataFrame) -> DataFrame:
    """Probe each reference against the parent index at its own time."""
    at = F.coalesce("at", _far())
    joined = salted_join(refs, index, "parent_key").withColumn("__at", at)
    live = F.aggregate(F.col("events"), F.lit(0).cast("long"), lambda n, e: n + F.when(e["t"] <= F.col("__at"), e["d"]).otherwise(F.lit(0).cast("long")))
    kind = (
        F.when(F.col("events").isNull(), "missing")
        .when(live > 0, None)
        .when(F.col("first_arrival").isNull() | (F.col("first_arrival") > F.col("__at")), "late")
        .otherwise("deleted")
    )
    return joined.select(*REFS, kind.alias("orphan_kind"))


def replay(spark: SparkSession, refs: DataFrame, parents: DataFrame, slices: int = 3, path: str | None = None) -> OrphanLedger:
    """Build the ledger from history, batch by batch, as it would have arrived.

    Time from the first to the last reference is cut into equal slices. A batch
    brings the references of its slice and the parent events of the slice
    before: parent tables are synchronised one batch after the records that
    refer to them. So references wait for their parents and deletions become
    known after references were settled.
    """
    micros = lambda t: F.unix_micros(F.coalesce(F.col(t), _far()).cast("timestamp"))
    refs, events = stage(refs, "orphan-refs"), parent_events(parents)
    low, high = refs.agg(F.min(F.unix_micros(F.col("at").cast("timestamp"))), F.max(F.unix_micros(F.col("at").cast("timestamp")))).first()
    low, high = (0, 0) if low is None else (low, high)
    number = lambda t: F.least(F.greatest(F.floor((micros(t) - low) * slices / F.lit(high - low + 1)), F.lit(0)), F.lit(slices - 1)).cast("int")
    events = stage(events.withColumn("slice", number("t")), "orphan-events")
    refs_of = refs.withColumn("slice", number("at"))
    ledger = OrphanLedger(spark, path)
    for b in range(slices + 1):
        ledger.apply(refs_of.where(F.col("slice") == b).drop("slice") if b < slices else None, events.where(F.col("slice") == b - 1).drop("slice") if b else None)
        if b == slices - 1:
            unstage(refs)
    unstage(events)
    return ledger


# ---------------------------------------------------------------- this project's tables

#: Allocation columns and the table whose rows their original id names.
ID_COLUMNS = {"contractsid": "tcontract", "locationsid": "tlocation", "parentlocationsid": "tlocation"}


def allocation_references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """References and parent facts of the allocation and transform tables."""
    alloc = spark.read.parquet(f"{d}/allocation_records.parquet").select(
        "allocation_id", F.lower(F.trim("table_name")).alias("t"), F.lower(F.trim("column_name")).alias("c"), "original_id", "new_sid", "job_id", "recorded_at"
    )
    results = spark.read.parquet(f"{d}/transform_results.parquet").select(
        "result_id", "job_id", F.lower(F.trim("table_name")).alias("t"), "fk_columns_updated", "finished_at"
    )
    target = F.create_map(*[F.lit(x) for kv in ID_COLUMNS.items() for x in kv])
    own_key = F.concat(F.lit("t"), F.regexp_replace("c", "sid$", "")) == F.col("t")
    key = lambda *parts: F.concat_ws("\x1f", *parts)

    ids = alloc.where(F.col("original_id").isNotNull() & F.col("c").isin(*ID_COLUMNS)).select(
        F.lit("original_id").alias("ref_field"), F.col("allocation_id").alias("record_id"), F.col("original_id").cast("string").alias("ref_key"),
        key(F.lit("row"), target[F.col("c")], F.col("original_id").cast("string")).alias("parent_key"), F.col("recorded_at").alias("at"), F.col("t").alias("table_key"),
    )
    sids = alloc.where(F.col("new_sid").isNotNull() & F.col("job_id").isNotNull() & (F.col("t") == "tlocation") & F.col("c").isin("contractsid", "parentlocationsid")).select(
        F.lit("new_sid").alias("ref_field"), F.col("allocation_id").alias("record_id"), F.col("new_sid").cast("string").alias("ref_key"),
        key(F.lit("sid"), target[F.col("c")], "job_id", F.col("new_sid").cast("string")).alias("parent_key"), F.col("recorded_at").alias("at"), F.col("t").alias("table_key"),
    )
    fks = results.where("job_id is not null").select("result_id", "job_id", "t", "finished_at", F.explode("fk_columns_updated").alias("fk")).where("fk is not null")
    fks = fks.select(
        F.lit("fk_columns_updated").alias("ref_field"), F.col("result_id").alias("record_id"), F.col("fk").alias("ref_key"),
        key(F.lit("job"), F.concat(F.lit("t"), F.regexp_replace(F.lower(F.trim("fk")), "sid$", "")), "job_id").alias("parent_key"), F.col("finished_at").alias("at"), F.col("t").alias("table_key"),
    )
    rows = lambda name, column: spark.read.parquet(f"{d}/{name}.parquet").where(F.col(column).isNotNull()).select(
        key(F.lit("row"), F.lit(name), F.col(column).cast("string")).alias("parent_key"), F.col("loaded_at").alias("live_from"), F.col("deleted_at").alias("live_to")
    )
    open_end = F.lit(None).cast("timestamp_ntz").alias("live_to")
    key_records = alloc.where(own_key & F.col("new_sid").isNotNull() & F.col("job_id").isNotNull()).select(
        key(F.lit("sid"), "t", "job_id", F.col("new_sid").cast("string")).alias("parent_key"), F.col("recorded_at").alias("live_from"), open_end
    )
    done = results.where("job_id is not null and t is not null").select(key(F.lit("job"), "t", "job_id").alias("parent_key"), F.col("finished_at").alias("live_from"), open_end)
    refs = ids.unionByName(sids).unionByName(fks)
    parents = rows("tcontract", "contractsid").unionByName(rows("tlocation", "locationsid")).unionByName(key_records).unionByName(done)
    return refs, parents


def found(spark: SparkSession, d: str) -> DataFrame:
    """Every open orphan of the project's tables."""
    ledger = replay(spark, *allocation_references(spark, d))
    return ledger.pending.select("ref_field", "record_id", "ref_key", "orphan_kind").distinct()


def counts(spark: SparkSession, d: str) -> DataFrame:
    """Open orphans per table and month after each batch; the last batch is the state now."""
    return replay(spark, *allocation_references(spark, d)).history()
