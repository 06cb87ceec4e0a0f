"""Free-typed values mapped to the entry of a canonical list they mean.

SQL only, on distinct values, by a partition-based pigeonhole join: a reference
string is cut into k+1 segments; a value within k edits must contain one of
them unchanged, near its place. Positional substrings of the values are
equality-joined to segments and candidates verified with ``levenshtein``.

No list of synonyms is given. Reference strings are, in this order,

1. the names of the list, with their words in rotated order or without inner
   vowels (both rules, no word list), and
2. *aliases* learned from ``evidence``: where people typed two names of the same
   thing side by side, a value without any likeness to the list takes the
   entry its counterparts were joined to, if at least ``LEAST_SUPPORT`` distinct
   places say so and ``LEAST_SHARE`` of all that say anything. Aliases are
   reference strings like any other, so their typing errors are found too.

Words set before or after names of many entries (``src_``, ``_new``) are learned as
affixes: a value is also probed without them. The closest entry wins; values
without one come out of an anti-join as -1.

Edge cases: null and blank values are no cases; values of separators only
mean nothing (-1); values longer than any reference string by more than k
match nothing; equally close entries are decided by the likelier kind of edit,
then the lower id; repeated values are matched once; an empty list gives -1
for everything; without evidence only likeness counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate.runtime import bounded_broadcast, prefer, salted_join, stage

#: Edits the join looks for; a swap of neighbours is two of them and costs one.
K = 2
#: Cost allowed from this many letters on; shorter strings must be equal.
ONE_EDIT_FROM, TWO_EDITS_FROM = 5, 12
#: Distinct places that must support an alias, their share of all, rounds of learning.
LEAST_SUPPORT, LEAST_SHARE, ROUNDS = 2, 0.6, 2
#: Entries before or after whose names a word must stand to be an affix.
AFFIX_ENTRIES = 10
#: Distinct values probed per task.
PROBE_VALUES = 20_000

_MARKS = r"[\s\x{00A0}\[\]\"'`]+"


def words_of(name: Column) -> Column:
    """Words of a camel-case or separated name, in lower case."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"([A-Z]+(?![a-z])|[A-Z][a-z]+|[a-z]+|[0-9]+)"), 1), F.lower)


def plain(text: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def bare(value: Column) -> Column:
    """A typed name without the marks around it and remarks in brackets behind it."""
    return F.regexp_replace(F.regexp_replace(value, rf"^{_MARKS}|{_MARKS}$", ""), r"\s*\([^()]*\)\s*$", "")


def reference_strings(catalog: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(s, id): the names of the list, rotated and without inner vowels; linear in the words of a name."""
    entries = catalog.where(F.col(name_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(name_col).alias("name"), words_of(F.col(name_col)).alias("w"))
    n = F.size("w")
    joined = lambda w: F.array_join(w, "")
    thin = F.transform("w", lambda w: F.concat(F.substring(w, 1, 1), F.regexp_replace(F.substring(w, F.lit(2), F.length(w)), "[aeiou]", "")))
    cut_to = lambda least: F.zip_with("w", thin, lambda w, t: F.when(F.length(t) >= least, t).otherwise(w))
    thinned = [cut_to(3), cut_to(2)]
    turned = lambda w: F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(joined(F.slice(w, i + 1, n - i)), joined(F.slice(w, F.lit(1), i))))).otherwise(F.expr("cast(array() as array<string>)"))
    of = F.when(n > 1, F.array(F.concat(F.element_at("w", -1), F.lit("of"), joined(F.slice("w", F.lit(1), n - 1))))).otherwise(F.expr("cast(array() as array<string>)"))
    every = F.array_distinct(F.concat(F.array(plain(F.col("name"))), turned(F.col("w")), of, *[x for t in thinned for x in (F.array(joined(t)), turned(t))]))
    rows = entries.select("id", F.posexplode(every).alias("rank", "s")).where("s <> ''")
    # A spelling shared by two entries belongs to the one in which it ranks first.
    return rows.groupBy("s").agg(F.min(F.struct("rank", "id")).alias("x")).select("s", "x.id")


def _cut(i: Column, n: Column) -> Column:
    return F.floor(n * i / (K + 1)).cast("int")


def segments(refs: DataFrame) -> DataFrame:
    """(len, no, seg, s, id): k+1 segments of each reference string; short ones are one segment."""
    n = F.length("s")
    piece = F.transform(F.sequence(F.lit(0), F.lit(K)), lambda i: F.struct(i.alias("no"), F.substring(F.col("s"), _cut(i, n) + 1, _cut(i + 1, n) - _cut(i, n)).alias("seg")))
    whole = F.array(F.struct(F.lit(-1).alias("no"), F.col("s").alias("seg")))
    return refs.select("s", "id", n.alias("len"), F.inline(F.when(n < ONE_EDIT_FROM, whole).otherwise(piece)))


def probes(values: DataFrame) -> DataFrame:
    """(v, len, no, seg): substrings of each value that may equal a segment.

    Segment i (from 0) of a string that long can have moved by i places at
    most, counted from the left, and by k-i counted from the right.
    """
    v, n = F.col("v"), F.length("v")

    def of_length(size: Column) -> Column:
        def of_segment(i: Column) -> Column:
            low, high = F.greatest(-i, n - size - (K - i)), F.least(i, n - size + (K - i))
            shifts = F.when(low <= high, F.sequence(low, high))
            return F.transform(shifts, lambda s: F.struct(
                size.alias("len"), i.alias("no"), F.substring(v, _cut(i, size) + s + 1, _cut(i + 1, size) - _cut(i, size)).alias("seg"), (_cut(i, size) + s).alias("at")))

        return F.flatten(F.filter(F.transform(F.sequence(F.lit(0), F.lit(K)), of_segment), lambda x: x.isNotNull()))

    sizes = F.sequence(F.greatest(n - K, F.lit(ONE_EDIT_FROM)), F.greatest(n + K, F.lit(ONE_EDIT_FROM)))
    near = F.filter(F.flatten(F.transform(sizes, of_length)), lambda x: x["at"] >= 0)
    whole = F.array(F.struct(n.alias("len"), F.lit(-1).alias("no"), v.alias("seg"), F.lit(0).alias("at")))
    every = F.when(n < ONE_EDIT_FROM - K, whole).when(n < ONE_EDIT_FROM, F.concat(whole, near)).otherwise(near)
    return values.select("v", F.inline(every)).where("seg <> ''").select("v", "len", "no", "seg").distinct()


def swapped(a: Column, b: Column) -> Column:
    """Whether one swap of neighbours turns ``a`` into ``b``."""
    return (F.length(a) == F.length(b)) & F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))) == b,
    )


def nearest(values: DataFrame, refs: DataFrame) -> DataFrame:
    """Distinct plain values ``v`` → ``best`` (cost, kind, id) of the closest entry, for those that have one."""
    spark = values.sparkSession
    # Few bytes but much work per value: spread by number of values, not by size.
    probed = probes(values.repartition(prefer(values.count(), PROBE_VALUES, spark.sparkContext.defaultParallelism), "v"))
    parts, small = bounded_broadcast(stage(segments(refs), "canonical-segments"))
    if small:
        met = probed.join(parts, ["len", "no", "seg"])
    else:  # many values hold the same piece of text
        one = F.struct("len", "no", "seg")
        met = salted_join(probed.select("v", one.alias("piece")), parts.select(one.alias("piece"), "s", "id"), "piece", "inner")
    scored = met.select("v", "s", "id").distinct().withColumn("d", F.levenshtein("v", "s", K)).where("d >= 0")
    scored = scored.withColumn("cost", F.when((F.col("d") == 2) & swapped(F.col("v"), F.col("s")), 1).otherwise(F.col("d")))
    # At equal cost a lost, doubled or swapped letter is likelier than a wrong one.
    scored = scored.withColumn("kind", ((F.length("v") == F.length("s")) & (F.col("cost") == F.col("d")) & (F.col("d") > 0)).cast("int"))
    letters = F.least(F.length("s"), F.length("v") + 1)
    allowed = F.when(letters >= TWO_EDITS_FROM, 2).when(letters >= ONE_EDIT_FROM, 1).otherwise(0)
    return scored.where(F.col("cost") <= allowed).groupBy("v").agg(F.min(F.struct("cost", "kind", "id")).alias("best"))


def without_affixes(spelled: DataFrame, refs: DataFrame) -> DataFrame:
    """(value, v) of values less a word that stands before or after names of many entries."""
    parts = F.split("name", r"[\s_.\-]+")
    ends = spelled.where(F.size(parts) > 1).select("value", F.inline(F.array(
        F.struct(F.concat(F.lit("^"), F.lower(F.element_at(parts, 1))).alias("affix"), plain(F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 1), "")).alias("v")),
        F.struct(F.concat(F.lit("$"), F.lower(F.element_at(parts, -1))).alias("affix"), plain(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "")).alias("v")),
    ))).where("affix not in ('^', '$') and v <> ''")
    known, _ = bounded_broadcast(refs.withColumnRenamed("s", "v"))
    affixes = ends.join(known, "v").groupBy("affix").agg(F.count_distinct("id").alias("n")).where(F.col("n") >= AFFIX_ENTRIES).select("affix")
    listed, _ = bounded_broadcast(stage(affixes, "canonical-affixes"))
    return ends.join(listed, "affix").select("value", "v")


def aliases(said: DataFrame, known: DataFrame) -> DataFrame:
    """(s, id): values without an entry, each with that of its counterparts.

    ``said`` is (v, w, places): how many distinct places set w beside v.
    """
    open_ = said.join(known.select("v"), "v", "left_anti")
    votes = salted_join(open_, known.select(F.col("v").alias("w"), "best.id"), "w", "inner").groupBy("v", "id").agg(F.sum("places").alias("n"))
    won = votes.groupBy("v").agg(F.max(F.struct("n", (-F.col("id")).alias("id"))).alias("x"), F.sum("n").alias("all"))
    return won.where((F.col("x.n") >= LEAST_SUPPORT) & (F.col("x.n") >= F.col("all") * LEAST_SHARE)).select(F.col("v").alias("s"), (-F.col("x.id")).alias("id"))


def side_by_side(evidence: DataFrame) -> DataFrame:
    """(a, b, place) → (v, w, places), both ways round; rows count once per place."""
    v, w = plain(bare(F.col("a"))), plain(bare(F.col("b")))
    both = evidence.select("place", F.inline(F.array(F.struct(v.alias("v"), w.alias("w")), F.struct(w.alias("v"), v.alias("w"))))).where("v <> '' and w <> '' and v <> w")
    return both.distinct().groupBy("v", "w").agg(F.count(F.lit(1)).alias("places"))


def map_values(cases: DataFrame, catalog: DataFrame, id_col: str, name_col: str, evidence: DataFrame | None = None) -> DataFrame:
    """``cases`` (with column ``value``) plus ``id`` of the entry meant, -1 for none."""
    cases = stage(cases, "canonical-cases")
    name = bare(F.col("value"))
    spelled = stage(cases.select("value").distinct().select("value", name.alias("name"), plain(name).alias("v")), "canonical-values")
    refs = stage(reference_strings(catalog, id_col, name_col), "canonical-refs")
    forms = stage(spelled.select("value", "v").unionByName(without_affixes(spelled, refs)).distinct(), "canonical-forms")
    todo = forms.select("v")
    said = None
    if evidence is not None:
        said = stage(side_by_side(evidence), "canonical-said")
        todo = todo.unionByName(said.select("v"))
    todo = stage(todo.where("v <> ''").distinct(), "canonical-plain")
    known = stage(nearest(todo, refs), "canonical-known")
    for _ in range(ROUNDS if said is not None else 0):
        learned = stage(aliases(said, known), "canonical-aliases")
        if learned.isEmpty():
            break
        rest = todo.join(known.select("v"), "v", "left_anti")
        # Open values are near no earlier reference string, so only new ones are probed.
        known = stage(known.unionByName(nearest(rest, learned)), "canonical-known")
    matched = stage(forms.join(known, "v").groupBy("value").agg(F.min("best").alias("b")).select("value", "b.id"), "canonical-matched")
    unmatched = spelled.select("value").join(matched, "value", "left_anti").select("value", F.lit(-1).cast("bigint").alias("id"))
    return salted_join(cases, matched.unionByName(unmatched), "value", "inner")


# ---------------------------------------------------------------- this project's tables


def typed_cases(spark: SparkSession, d: str) -> DataFrame:
    """Values typed into the mapping and plan tables, not character for character an entry."""
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    part = lambda t, key, column, label: read(t).select(F.lit(label).alias("entry_field"), F.col(key).alias("record_id"), F.col(column).alias("value"))
    every = part("column_mappings", "mapping_id", "source", "source").unionByName(part("column_mappings", "mapping_id", "destination", "destination")).unionByName(
        part("column_plans", "column_plan_id", "target_name", "target_name"))
    names, _ = bounded_broadcast(read("column_catalog").select(F.col("column_name").alias("value")))
    every = every.where(F.col("value").isNotNull() & ~F.col("value").rlike(r"^[\s\x{00A0}]*$")).dropDuplicates()
    return every.join(names, "value", "left_anti")


def typed_together(spark: SparkSession, d: str) -> DataFrame:
    """(a, b, place): the two names of a mapping, and a feed's field with its target."""
    mapped = spark.read.parquet(f"{d}/column_mappings.parquet").select(F.col("source").alias("a"), F.col("destination").alias("b"), F.concat(F.lit("m"), "mapping_id").alias("place"))
    planned = spark.read.parquet(f"{d}/column_plans.parquet").select(
        F.col("target_name").alias("a"), F.col("source_name").alias("b"), F.concat_ws("\x1f", F.lit("p"), "feed_key", F.lower("source_name")).alias("place"))
    return mapped.unionByName(planned).where("a is not null and b is not null and place is not null")


def mapped_cases(spark: SparkSession, d: str) -> DataFrame:
    catalog = spark.read.parquet(f"{d}/column_catalog.parquet")
    return map_values(typed_cases(spark, d), catalog, "catalog_id", "column_name", typed_together(spark, d))


def found(spark: SparkSession, d: str) -> DataFrame:
    return mapped_cases(spark, d).select("entry_field", "record_id", F.col("id").alias("catalog_id"))


def unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, with how often they were typed."""
    return mapped_cases(spark, d).where("id = -1").groupBy("entry_field", "value").agg(F.count(F.lit(1)).alias("times"))
