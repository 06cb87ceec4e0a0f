"""Rescue-column ingestion of files whose schema drifts.

1. *Ingest*: each row of a file is read against the schema of the file before it
   in its feed. Fields that schema knows and whose values cast to its types are
   kept; unknown and uncastable fields are preserved as JSON in ``_rescued``.
2. *Promote*: a rescued field that carries, for the same record keys, the values
   of a field that went missing is that field renamed; the other fields of the
   file's header are additions. Both are approved; what no header names is not.
3. *Replay*: approved fields are taken out of the rescue column and cast into
   the typed columns of one consistent table; what still has no column or will
   not cast stays in ``_rescued``.

The list of changes comes from the headers and the promotions.

Edge cases: names are compared without case; columns without a name are
ignored; of two columns of one file that differ in case only the first
(by ordinal) holds; an unknown (null) type is no evidence of a change; rows
without a key give no evidence of a rename; of a field written twice in one
object the first is the field, the others stay in the rescue column; rows that
are not JSON objects are rescued whole; rows of a file without a header are
rescued; the first file of a feed is read against its own header and has no
changes; empty inputs give empty outputs. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgate.functions.types import spark_type
from loomgate.runtime import bounded_broadcast, salted_join, stage

#: Share of a rescued field's comparable values that must equal the missing
#: field's; the lower bound where both also go to the same target.
SAME_FIELD, SAME_FIELD_AND_TARGET = 0.6, 0.3
_TEXTS = "cast(array() as array<string>)"


def headers(plans: DataFrame) -> DataFrame:
    """One row per file: its columns, and the columns of the file before it in the feed."""
    declared = plans.select(F.explode(F.array("source_type", "target_type")).alias("declared")).where("declared is not null").distinct()
    kinds, _ = bounded_broadcast(stage(declared.select("declared", spark_type(F.col("declared")).alias("kind")), "drift-types"))
    named = plans.where("plan_id is not null and source_name is not null and trim(source_name) <> ''").select(
        "feed_key", "file_seq", "plan_id", F.lower(F.trim("source_name")).alias("field"), F.coalesce("ordinal", F.lit(2147483647)).alias("ordinal"),
        F.col("source_name").alias("name"), F.col("target_name").alias("target"), "source_type", "target_type")
    for side in ("source_type", "target_type"):
        named = named.join(kinds.select(F.col("declared").alias(side), F.col("kind").alias(f"{side}_kind")), side, "left")
    cols = named.groupBy("feed_key", "file_seq", "plan_id", "field").agg(
        F.min(F.struct("ordinal", "name", "target", F.col("source_type_kind").alias("source_type"), F.col("target_type_kind").alias("target_type"))).alias("c"))
    files = stage(cols.groupBy("feed_key", "file_seq", "plan_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "c"))).alias("now")), "drift-headers")
    # Only keys go through the window over a feed; the columns are joined to them.
    order = W.partitionBy("feed_key").orderBy("file_seq", "plan_id")
    at = F.struct("file_seq", "plan_id")
    chain = files.select("feed_key", "file_seq", "plan_id").withColumn("before_at", F.lag(at).over(order)).withColumn("next_plan", F.lead("plan_id").over(order))
    before = files.select(F.col("feed_key").alias("f"), at.alias("b"), F.col("now").alias("before"))
    same = F.col("feed_key").eqNullSafe(F.col("f")) & (F.col("before_at") == F.col("b"))
    linked = chain.join(before, same, "left").drop("f", "b").withColumn("before_plan", F.col("before_at.plan_id")).drop("before_at")
    mine = files.select(F.col("feed_key").alias("f"), at.alias("b"), "now")
    return linked.join(mine, F.col("feed_key").eqNullSafe(F.col("f")) & (F.struct("file_seq", "plan_id") == F.col("b"))).drop("f", "b")


def usual_targets(plans: DataFrame) -> DataFrame:
    """The target name most often given to a field within its feed."""
    n = plans.where("source_name is not null and target_name is not null").groupBy("feed_key", F.lower(F.trim("source_name")).alias("field"), "target_name").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("feed_key", "field").agg(F.max_by("target_name", F.struct("n", "target_name")).alias("usual"))


def as_fields(payload: Column) -> Column:
    """JSON object text → (k, key, value) per field as written, ``k`` without case; null for anything else."""
    return F.transform(F.map_entries(F.from_json(payload, "map<string,string>")), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("k"), e["key"].alias("key"), e["value"].alias("value")))


def as_json(fields: Column) -> Column:
    """(k, key, value) fields → JSON object text; null for none. Repeated fields stay repeated."""
    pair = lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    one = F.transform(fields, lambda e: F.regexp_replace(F.to_json(F.create_map(e["key"], e["value"])), r"^\{|\}$", ""))
    names = F.transform(fields, lambda e: e["key"])
    text = F.when(F.size(F.array_distinct(names)) == F.size(names), F.to_json(F.map_from_entries(F.transform(fields, pair)))).otherwise(F.concat(F.lit("{"), F.array_join(one, ","), F.lit("}")))
    return F.when(F.size(fields) > 0, text)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def as_evidence(value: Column) -> tuple[Column, Column]:
    """(``v``, ``at``) of a value text, in a form that survives a change of type.

    ``v`` is the number, the day (UTC) of a date or time stamp, or the text;
    ``at`` the microseconds of a time stamp, null for all else. Two values are
    equal if ``v`` is and ``at`` is, or either has no time of day. A time
    stamp without zone is taken as UTC whatever the session's zone.
    """
    number = value.try_cast("double").cast("string")
    truth = F.when(F.lower(value) == "true", "1.0").when(F.lower(value) == "false", "0.0")
    day, moment = r"^\s*\d{4}-\d{1,2}-\d{1,2}", r"[T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?"
    zone = r"\s*([zZ]|UTC|[+-]\d{1,2}(:?\d{2})?)"
    stamp = F.trim(F.regexp_replace(value, r"\s+(?=[zZU+-])", ""))
    micros = F.unix_micros(
        F.when(value.rlike(day + r"\s*$"), F.concat(stamp, F.lit("T00:00:00Z")))
        .when(value.rlike(day + moment + r"\s*$"), F.concat(stamp, F.lit("Z")))
        .when(value.rlike(day + moment + zone + r"\s*$"), stamp).try_cast("timestamp")
    )
    on = F.concat(F.lit("day "), F.floor(micros / F.lit(86_400_000_000)).cast("string"))
    return F.coalesce(truth, number, on, value).alias("v"), F.when(value.rlike(day + "[T ]"), micros).alias("at")


def family(kind: Column) -> Column:
    """What the values of a type must look like: a number, a truth value, a time or any text."""
    return F.when(kind.rlike("^(smallint|int|bigint|float|double|decimal.*)$"), "number").when(kind == "boolean", "truth").when(kind.isin("date", "timestamp", "timestamp_ntz"), "time").otherwise("text")


def casts(value: Column, of: Column) -> Column:
    """Whether a value text fits the family of an enforced type; null fits all."""
    fits = F.when(of == "number", value.try_cast("double").isNotNull()).when(of == "truth", value.try_cast("boolean").isNotNull()).when(of == "time", value.try_cast("timestamp").isNotNull())
    return value.isNull() | fits.otherwise(True)


def schemas(files: DataFrame) -> DataFrame:
    """Per file: the enforced schema, the fields it lacks, and those that go missing in the next file."""
    key = lambda m: F.map_keys(m)
    own = files.select(
        "plan_id", "next_plan",
        F.transform_values(F.coalesce("before", "now"), lambda k, v: family(v["target_type"])).alias("enforced"),
        F.when(F.col("before").isNotNull(), F.array_except(key("now"), key("before"))).alias("fresh"),
        F.when(F.col("before").isNotNull(), F.array_except(key("before"), key("now"))).alias("gone"))
    later = own.where("size(gone) > 0 and size(fresh) > 0").select(F.col("plan_id").alias("next_plan"), F.col("gone").alias("gone_next"))
    # A plan listed in several feeds or places keeps one schema: a row is ingested once.
    return own.join(later, "next_plan", "left").groupBy("plan_id").agg(
        F.max_by(F.struct("enforced", F.when((F.size("gone") > 0), F.col("fresh")).alias("fresh"), "next_plan", "gone_next"), F.coalesce("next_plan", F.lit(-1))).alias("s")).select("plan_id", "s.*")


def rescue(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows read against their enforced schema: ``kept`` fields, and ``_rescued`` JSON of all others.

    A row is its plan, number, key and payload; repeated rows count once. The
    schemas are broadcast while small; beyond that a huge file's rows are salted.
    """
    distinct = rows.select("plan_id", "row_no", "row_key", "payload").dropDuplicates()
    known, small = bounded_broadcast(stage(schemas(files), "drift-schemas"))
    read = distinct.join(known, "plan_id", "left") if small else salted_join(stage(distinct, "drift-rows"), known, "plan_id")
    own_key = lambda e: (e["k"] == "row_key") & e["value"].eqNullSafe(F.col("row_key"))
    marked = lambda f, at: F.transform(f, lambda e, i: let(F.col("enforced")[e["k"]], lambda of: F.struct(
        e["k"].alias("k"), e["key"].alias("key"), e["value"].alias("value"), (of.isNotNull() & (F.array_position(at, e["k"]) == i + 1) & casts(e["value"], of)).alias("good"))))
    fields = let(F.filter(as_fields(F.col("payload")), lambda e: ~own_key(e)), lambda f: let(F.transform(f, lambda e: e["k"]), lambda at: marked(f, at)))
    read = read.withColumn("f", fields)
    bare = lambda e: F.struct(e["k"].alias("k"), e["key"].alias("key"), e["value"].alias("value"))
    good = lambda e: F.coalesce(e["good"], F.lit(False))
    return read.select(
        "plan_id", "row_no", "row_key", "next_plan", "fresh", "gone_next", F.col("f").isNull().alias("broken"),
        F.transform(F.filter("f", good), bare).alias("kept"),
        F.when(F.col("f").isNull(), F.col("payload")).otherwise(as_json(F.filter("f", lambda e: ~good(e)))).alias("_rescued"),
    )


def all_fields() -> Column:
    """Kept fields and those in the rescue column, of an ingested row."""
    return F.when(~F.col("broken"), F.concat("kept", F.coalesce(as_fields(F.col("_rescued")), F.filter("kept", lambda e: F.lit(False)))))


def promotions(files: DataFrame, plans: DataFrame, ingested: DataFrame) -> DataFrame:
    """(plan_id, old_field, new_field): rescued fields that are a missing field renamed.

    Evidence is equality of values for the same record key in the two files;
    only where no record can be compared does the usual target name decide.
    """
    shifts = files.where("before is not null").select(
        "feed_key", "plan_id",
        F.array_except(F.map_keys("before"), F.map_keys("now")).alias("gone"),
        F.array_except(F.map_keys("now"), F.map_keys("before")).alias("fresh"),
    ).where("size(gone) > 0 and size(fresh) > 0")
    shifts = stage(shifts, "drift-shifts")

    def values(fields: Column, wanted: str, shift: str, name: str) -> DataFrame:
        """Values of the wanted fields, one row per record key and field."""
        of = F.filter(fields, lambda e: e["value"].isNotNull() & F.array_contains(F.col(wanted), e["k"]))
        out = ingested.where(F.col("row_key").isNotNull() & (F.size(wanted) > 0)).select(F.col(shift).alias("shift"), "row_key", F.inline(of))
        return stage(out.select("shift", "row_key", F.col("k").alias(name), *as_evidence(F.col("value"))).dropDuplicates(), f"drift-{name}")

    # What the enforced schema rescued from the later file, and what it misses.
    rescued = values(as_fields(F.col("_rescued")), "fresh", "plan_id", "new_field")
    missed = values(all_fields(), "gone_next", "next_plan", "old_field")
    shared = missed.select("shift", "row_key").distinct()
    comparable = rescued.join(shared, ["shift", "row_key"], "left_semi").groupBy("shift", "new_field").agg(F.countDistinct("row_key").alias("compared"))
    equal = rescued.join(missed.withColumnRenamed("at", "old_at"), ["shift", "row_key", "v"]).where("at is null or old_at is null or at = old_at").groupBy("shift", "old_field", "new_field").agg(F.countDistinct("row_key").alias("equal"))
    by_value = equal.join(comparable, ["shift", "new_field"]).select("shift", "old_field", "new_field", (F.col("equal") / F.col("compared")).alias("ratio")).where(F.col("ratio") >= SAME_FIELD_AND_TARGET)
    comparable_old = missed.join(rescued.select("shift", "row_key").distinct(), ["shift", "row_key"], "left_semi").select("shift", "old_field").distinct().withColumn("old_compared", F.lit(True))

    usual = usual_targets(plans)
    side = lambda array, name: shifts.select("feed_key", F.col("plan_id").alias("shift"), F.explode(array).alias("field")).join(usual, ["feed_key", "field"]).select("shift", F.col("field").alias(name), F.lower(F.trim("usual")).alias("usual"))
    by_target = side("gone", "old_field").join(side("fresh", "new_field"), ["shift", "usual"]).select("shift", "old_field", "new_field", F.lit(True).alias("same_target"))
    pairs = by_value.join(by_target, ["shift", "old_field", "new_field"], "full").join(comparable, ["shift", "new_field"], "left").join(comparable_old, ["shift", "old_field"], "left")
    # By values; by some values and the target; by the target alone only where no values meet.
    pairs = pairs.where(f"ratio >= {SAME_FIELD} or (ratio is not null and same_target) or (ratio is null and (compared is null or old_compared is null))").withColumn(
        "score", F.coalesce("ratio", F.lit(0.0)) + F.when(F.col("same_target"), 0.5).otherwise(0.0)
    )
    # Best pair first, then the best of those whose fields are both still free;
    # a shift has at most as many pairs as two files have pairs of columns.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("cost"), "old_field", "new_field")))
    free = lambda taken, p: ~F.exists(taken, lambda t: (t["old_field"] == p["old_field"]) | (t["new_field"] == p["new_field"]))
    none = F.expr("cast(array() as array<struct<old_field:string,new_field:string>>)")
    step = lambda taken, p: F.when(free(taken, p), F.concat(taken, F.array(F.struct(p["old_field"].alias("old_field"), p["new_field"].alias("new_field"))))).otherwise(taken)
    matched = pairs.groupBy(F.col("shift").alias("plan_id")).agg(ranked.alias("ranked")).select("plan_id", F.aggregate("ranked", none, step).alias("matched"))
    return matched.select("plan_id", F.inline("matched"))


def ingest(plans: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, ingested rows, promotions), each written to the shared folder."""
    files = stage(headers(plans), "drift-files")
    ingested = stage(rescue(rows, files), "drift-ingested")
    return files, ingested, stage(promotions(files, plans, ingested), "drift-renamed")


def changes(plans: DataFrame, rows: DataFrame) -> DataFrame:
    """Each change with the file in which it first shows."""
    files, _, renamed = ingest(plans, rows)
    pairs = renamed.groupBy("plan_id").agg(F.map_from_entries(F.collect_list(F.struct("old_field", "new_field"))).alias("moved"))
    both = files.where("before is not null").join(pairs, "plan_id", "left").withColumn("moved", F.coalesce("moved", F.expr("cast(map() as map<string,string>)")))
    change = lambda kind, old, new, keep: F.struct(F.lit(kind).alias("change_kind"), old.alias("old_name"), new.alias("new_name"), keep.alias("keep"))
    empty, yes = F.lit(""), F.lit(True)
    old = F.transform(F.map_entries("before"), lambda e: F.struct(
        e["key"].alias("key"), e["value"].alias("was"), F.coalesce(F.col("now")[e["key"]], F.col("now")[F.col("moved")[e["key"]]]).alias("is"), F.col("moved")[e["key"]].isNotNull().alias("renamed")))
    of_old = F.flatten(F.transform(old, lambda x: F.array(
        change("removed", x["was"]["name"], empty, x["is"].isNull()),
        change("renamed", x["was"]["name"], x["is"]["name"], x["renamed"]),
        change("source_type", x["was"]["name"], x["is"]["name"], F.coalesce(x["was"]["source_type"] != x["is"]["source_type"], F.lit(False))),
        change("target_type", x["was"]["name"], x["is"]["name"], F.coalesce(x["was"]["target_type"] != x["is"]["target_type"], F.lit(False))),
    )))
    taken = F.map_values("moved")
    of_new = F.transform(
        F.filter(F.map_entries("now"), lambda e: F.col("before")[e["key"]].isNull() & ~F.array_contains(taken, e["key"])),
        lambda e: change("added", empty, e["value"]["name"], yes),
    )
    return both.select("plan_id", F.inline(F.concat(of_old, of_new))).where("keep").drop("keep").distinct()


def routes(plans: DataFrame, files: DataFrame, renamed: DataFrame, kinds: DataFrame) -> DataFrame:
    """Per file, the approved fields: ``route`` (field → column and its type).

    A field's column is the catalog name most often given to it, over its
    renames, within its feed.
    """
    listed, _ = bounded_broadcast(kinds)
    votes = plans.join(listed, "target_name", "left_semi").groupBy("feed_key", F.lower(F.trim("source_name")).alias("field"), "target_name").agg(F.count(F.lit(1)).alias("n"))
    # A rename carries the votes of either name over to the other.
    links = files.select("feed_key", "plan_id").join(renamed, "plan_id").select("feed_key", "old_field", "new_field").distinct()
    over = lambda a, b: votes.join(links.withColumnRenamed(a, "field"), ["feed_key", "field"]).select("feed_key", F.col(b).alias("field"), "target_name", "n")
    carried = votes.unionByName(over("old_field", "new_field")).unionByName(over("new_field", "old_field"))
    target = carried.groupBy("feed_key", "field", "target_name").agg(F.sum("n").alias("n")).groupBy("feed_key", "field").agg(F.max_by("target_name", F.struct("n", "target_name")).alias("target_name"))
    # One field per file and column; a second one stays in the rescue column.
    chosen = files.select("plan_id", "feed_key", F.explode(F.map_keys("now")).alias("field")).join(target, ["feed_key", "field"]).groupBy("plan_id", "target_name").agg(F.min("field").alias("field"))
    one = chosen.join(listed, "target_name").groupBy("plan_id", "field").agg(F.min(F.struct("target_name", "kind")).alias("x"))  # a plan in two feeds
    return one.groupBy("plan_id").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("x.target_name", F.coalesce("x.kind", F.lit("string")).alias("kind"))))).alias("route"))


def replay(ingested: DataFrame, routed: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Approved fields, kept or rescued, in typed columns; the rest in ``_rescued``."""
    where, small = bounded_broadcast(routed)
    rows = ingested.select("plan_id", "row_no", "row_key", "broken", "_rescued", all_fields().alias("f"))
    read = rows.join(where, "plan_id", "left") if small else salted_join(stage(rows, "drift-all"), where, "plan_id")
    as_text = ("string", "skipped", "time", "binary")

    def fails(kind: Column, v: Column) -> Column:
        out = F.when(kind.isin(*as_text), False)
        for t in sorted({t for _, t in names if t not in as_text}):
            out = out.when(kind == t, v.isNotNull() & v.try_cast(t).isNull())
        return out.otherwise(False)

    def routed(f: Column, at: Column) -> Column:
        """Fields with the column they go to, null where they stay; the first of keys that differ in case goes."""
        return F.transform(f, lambda e, i: let(F.col("route")[e["k"]], lambda r: F.struct(
            e["k"].alias("k"), e["key"].alias("key"), e["value"].alias("value"), F.when((F.array_position(at, e["k"]) == i + 1) & ~fails(r["kind"], e["value"]), r["target_name"]).alias("to"))))

    read = read.withColumn("f", let(F.col("f"), lambda f: let(F.transform(f, lambda e: e["k"]), lambda at: routed(f, at))))
    typed = F.map_from_entries(F.transform(F.filter("f", lambda e: e["to"].isNotNull()), lambda e: F.struct(e["to"], e["value"])))
    left = F.when(F.col("broken"), F.col("_rescued")).otherwise(as_json(F.filter("f", lambda e: e["to"].isNull())))
    read = read.select("plan_id", "row_no", "row_key", typed.alias("typed"), left.alias("_rescued"))
    value_of = lambda name, kind: (F.col("typed")[name] if kind in as_text else F.col("typed")[name].try_cast(kind)).alias(name)
    return read.select("plan_id", "row_no", "row_key", *[value_of(n, t) for n, t in names], "_rescued")


def consistent_table(plans: DataFrame, rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """All file rows in the catalog's typed columns, with a rescue column.

    The catalog's names become the columns, so it is read on the driver: a
    table of so many columns is bounded by what a plan can hold.
    """
    files, ingested, renamed = ingest(plans, rows)
    kinds = stage(catalog.where("column_name is not null").groupBy(F.col("column_name").alias("target_name")).agg(F.min(spark_type(F.col("sql_type"))).alias("kind")), "drift-kinds")
    names = [(r["target_name"], r["kind"] or "string") for r in kinds.orderBy("target_name").collect()]
    return replay(ingested, stage(routes(plans, files, renamed, kinds), "drift-routes"), names)


def found(spark: SparkSession, d: str) -> DataFrame:
    return changes(spark.read.parquet(f"{d}/column_plans.parquet"), spark.read.parquet(f"{d}/file_rows.parquet"))


def table(spark: SparkSession, d: str) -> DataFrame:
    return consistent_table(*[spark.read.parquet(f"{d}/{t}.parquet") for t in ("column_plans", "file_rows", "column_catalog")])
