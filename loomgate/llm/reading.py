"""Reading grade of what each message's author wrote.

Wording: the smallest frequency-ranked vocabularies that cover fixed shares
(``SHARES``) of a document's words - the ranks, in the corpus's own word list, of
its words at those quantiles; one quantile alone does not tell a text of rare
words throughout from one with a few. Sentences: letters per sentence. All are
calibrated on rated documents by a quadratic ridge fit, whose sums are made in
SQL. Words are counted and ranked per
language: that of the document's tag (``EN`` and ``en-XX`` are ``en``), or, where the
tag is null, ``und`` or no language, the tagged language whose word frequencies fit
the document's words best.

Scale: word counts are combined map-side. Ranks come from the distribution of
counts (words of equal count share a rank) by a running sum over ranges, so no
task sees the whole vocabulary. The ``HEAD`` most frequent words are broadcast;
rarer ones, which by definition are not hot, are joined by shuffle, so every word
counts.

Edge cases: untagged documents that share no word with a tagged one form a
language of their own; null or empty texts and texts without own words have a null
grade; a document given more than once counts once, and an id has one row; repeated
ratings count once, null grades not at all, several raters'
median holds; words are runs of letters; a text without a sentence end is one
sentence; the fewer ratings there are the nearer grades come to their mean, and
without any every grade is null.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate.llm import mail
from loomgate.runtime import bounded_broadcast, running_sum, stage

SHARES, HEAD = (0.3, 0.65, 0.9), 50_000
#: Weight of the ridge, in ratings: it holds a fit on few of them near their mean.
RIDGE = 0.1
#: Tags that name no language; a word tells its language if it is at least one in so many.
NO_LANGUAGE, TELLING = ("und", "mul", "mis", "zxx"), 10_000
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_STOP = re.compile(r"[.!?]+(?=\s|\Z)")


def own_words(documents: DataFrame, doc_id: str, text: str, lang: str | None = None) -> DataFrame:
    """(doc_id, lang, words, times, n_words, n_letters, n_sentences) of the authors' own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, times, n, letters, s = [], [], [], [], []
            for raw in batch.column(2).to_pylist():
                own = mail.own_text(raw) if raw else ""
                c = Counter(_WORD.findall(own.lower()))
                words.append(list(c)), times.append(list(c.values()))
                n.append(c.total()), letters.append(sum(len(w) * k for w, k in c.items())), s.append(max(1, len(_STOP.findall(own))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32())), pa.array(n, pa.int32()), pa.array(letters, pa.int64()), pa.array(s, pa.int32())],
                names=["doc_id", "lang", "words", "times", "n_words", "n_letters", "n_sentences"],
            )

    tag = F.col(lang) if lang else F.lit(None)
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), tag.cast("string").alias("lang"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, lang string, words array<string>, times array<int>, n_words int, n_letters bigint, n_sentences int"
    )


def with_language(own: DataFrame) -> DataFrame:
    """``own`` with the language in whose vocabulary a document is ranked."""
    tag = F.lower(F.regexp_extract("lang", r"^\s*([A-Za-z]{2,3})\s*(?:[-_]|$)", 1))
    tagged = own.withColumn("language", F.when(~tag.isin("", *NO_LANGUAGE), tag))
    words = tagged.where("n_words > 0").select("doc_id", "language", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("n"))))
    usual = words.where("language is not null").groupBy("language", "word").agg(F.sum("n").alias("n"))
    total = usual.groupBy("language").agg(F.sum("n").alias("total"))
    # The words that make up a language's running text; rarer ones weigh next to nothing.
    usual = usual.join(F.broadcast(total), "language").where(F.col("n") >= F.col("total") / TELLING).select("language", "word", (F.col("n") / F.col("total")).alias("share"))  # one row per language
    fits = words.where("language is null").select("doc_id", "word", "n").join(usual, "word").groupBy("doc_id", "language").agg(F.sum(F.col("n") * F.col("share")).alias("fit"))
    likely = fits.groupBy("doc_id").agg(F.max_by("language", F.struct("fit", "language")).alias("likely"))
    return tagged.join(likely, "doc_id", "left").withColumn("language", F.coalesce("language", "likely", F.lit("und"))).drop("likely")


def ranked_words(pairs: DataFrame) -> DataFrame:
    """(language, word, count, rank): how many words of the language are at least so frequent."""
    counts = stage(pairs.groupBy("language", "word").agg(F.sum("n").alias("count")), "reading-counts")
    # One row per language and distinct count, of which there are at most the root of twice the tokens.
    steps = counts.groupBy("language", "count").agg(F.count(F.lit(1)).alias("words"), (-F.col("count")).alias("down"))
    ranks = stage(running_sum(steps, ["language"], ["down"], "words", "rank").select("language", "count", "rank"), "reading-ranks")
    return stage(counts.join(ranks, ["language", "count"]), "reading-ranked")


def with_rank(pairs: DataFrame) -> DataFrame:
    """(doc_id, tag, language, rank, n) for every distinct word of every document."""
    ranked = ranked_words(pairs)
    key = ["doc_id", "tag", "language"]
    above = ranked.orderBy(F.desc("count")).limit(HEAD + 1).agg(F.count(F.lit(1)), F.min("count")).first()
    if above[0] <= HEAD:
        return pairs.join(F.broadcast(ranked.select("language", "word", "rank")), ["language", "word"]).select(*key, "rank", "n")  # at most HEAD rows
    head, tail = ranked.where(F.col("count") > above[1]), ranked.where(F.col("count") <= above[1])
    met = stage(pairs.join(F.broadcast(head.select("language", "word", "rank")), ["language", "word"], "left"), "reading-met")  # at most HEAD rows
    rare = met.where("rank is null").drop("rank").join(tail.select("language", "word", "rank"), ["language", "word"])
    return met.where("rank is not null").select(*key, "rank", "n").unionByName(rare.select(*key, "rank", "n"))


def features(own: DataFrame) -> DataFrame:
    """(doc_id, lang, ranks, sentence_words, sentence_letters) per document with words; ranks are per ``language`` if given."""
    own = own if "language" in own.columns else own.withColumn("language", F.lit("und"))
    pairs = own.where("n_words > 0").select("doc_id", F.coalesce("lang", F.lit("")).alias("tag"), "language", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("n"))))
    key = ["doc_id", "tag", "language"]
    # All of a document's words leave one task already combined; one row per document and distinct rank.
    per_doc = with_rank(pairs).groupBy(*key, "rank").agg(F.sum("n").cast("bigint").alias("n")).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("x"))
    per_doc = per_doc.withColumn("total", F.aggregate("x", F.lit(0).cast("bigint"), lambda a, e: a + e["n"]))

    def at(share: float):
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at"))
        step = lambda a, e: F.struct(
            (a["seen"] + e["n"]).alias("seen"), F.when(a["at"].isNotNull(), a["at"]).when(a["seen"] + e["n"] >= F.col("total") * share, e["rank"]).alias("at"))
        return F.aggregate("x", start, step)["at"]

    ranks = per_doc.select("doc_id", "tag", F.array(*[at(x) for x in SHARES]).alias("ranks"))
    sentences = own.select("doc_id", "lang", F.coalesce("lang", F.lit("")).alias("tag"), (F.col("n_words") / F.col("n_sentences")).alias("sentence_words"), (F.col("n_letters") / F.col("n_sentences")).alias("sentence_letters"))
    return ranks.join(sentences.dropDuplicates(["doc_id", "tag"]), ["doc_id", "tag"]).select("doc_id", "lang", "ranks", "sentence_words", "sentence_letters")


def terms() -> list:
    one = [F.log1p(F.col("ranks")[i]) for i in range(len(SHARES))] + [F.log1p("sentence_letters")]
    return [*one, *[one[i] * one[j] for i in range(len(one)) for j in range(i, len(one))]]


def calibrate(feats: DataFrame, ratings: DataFrame) -> list[float]:
    """Constant and weights of ``terms`` for the grade, from documents rated by ``(doc_id, rater, grade)``; none without ratings."""
    rated = ratings.select("doc_id", "rater", "grade").where("grade is not null").dropDuplicates().groupBy("doc_id").agg(F.percentile("grade", 0.5).alias("y"))
    x = [*terms(), F.col("y")]
    n = len(x)
    sums = [F.avg(a) for a in x] + [F.covar_pop(x[i], x[j]) for i in range(n) for j in range(i, n)]
    row = feats.join(rated, "doc_id").agg(F.count(F.lit(1)), *sums).first()
    if not row[0]:
        return []
    mean, m, k = np.array(row[1 : n + 1], dtype=float), np.zeros((n, n)), n + 1
    for i in range(n):
        for j in range(i, n):
            m[i, j] = m[j, i] = row[k]
            k += 1
    spread = np.sqrt(np.maximum(np.diag(m)[:-1], 0)) + 1e-9
    scaled = m[:-1, :-1] / np.outer(spread, spread) + RIDGE / row[0] * np.eye(n - 1)
    w = np.linalg.solve(scaled, m[:-1, -1] / spread) / spread
    return [float(mean[-1] - w @ mean[:-1]), *map(float, w)]


def once_each(own: DataFrame) -> DataFrame:
    """Without repeated rows: only marks are shuffled, and the rows that share one."""
    marked = own.withColumn("mark", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("lang").isNull(), "lang", "words", "times", "n_sentences"))
    shared, _ = bounded_broadcast(stage(marked.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark"), "reading-shared"))
    repeated = marked.join(shared, "mark", "left_semi").dropDuplicates(["doc_id", "lang", "mark"])
    return marked.join(shared, "mark", "left_anti").unionByName(repeated).drop("mark")


def grades(documents: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str | None = None) -> DataFrame:
    """(doc_id, lang, grade 1…5, ranks, sentence_words) per document; null grade without own words.

    Without ``lang`` all documents are ranked in one vocabulary.
    """
    own = once_each(stage(own_words(documents, doc_id, text, lang), "reading-own"))
    own = stage(with_language(own), "reading-language") if lang else own
    feats = stage(features(own), "reading-features")
    weights = calibrate(feats, ratings)
    score = sum((F.lit(w) * t for w, t in zip(weights[1:], terms())), F.lit(weights[0])) if weights else F.lit(None).cast("double")
    graded = feats.withColumn("grade", F.when(score.isNotNull() & ~F.isnan(score), F.greatest(F.lit(1.0), F.least(F.lit(5.0), score))))
    every = own.select("doc_id", "lang").distinct().alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & F.col("d.lang").eqNullSafe(F.col("g.lang"))
    return every.join(graded.alias("g"), same, "left").select("d.doc_id", "d.lang", "grade", "ranks", "sentence_words")


# ---------------------------------------------------------------- this project's tables


def graded(spark: SparkSession, d: str) -> DataFrame:
    """Every document, of whatever language."""
    return grades(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/reading_labels.parquet"), lang="lang")


def found(spark: SparkSession, d: str) -> DataFrame:
    return graded(spark, d).where("lang = 'en' and grade >= 3.5").select("doc_id")


def profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents and mean sentence length per language tag and whole grade; those without a grade are a row of grade null."""
    return graded(spark, d).groupBy("lang", F.round("grade").cast("int").alias("grade")).agg(F.count(F.lit(1)).alias("documents"), F.avg("sentence_words").alias("mean_sentence_words"))
