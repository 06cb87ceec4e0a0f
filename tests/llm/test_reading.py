import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loomgate.llm import mail
from loomgate.llm import reading as R


def test_rank_equals_brute_force(spark, monkeypatch):
    docs = [(i, "From: a\n\n" + " ".join(f"w{'abcdefghij'[(i * k) % 10]}{'xyz'[k % 3] * ((i + k) % 5)}" for k in range(1, 30 + i)) + ". End here now.") for i in range(25)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    own = R.own_words(frame, "doc_id", "text").cache()
    words = {r.doc_id: [w for w, n in zip(r.words, r.times) for _ in range(n)] for r in own.collect()}
    count = {}
    for ws in words.values():
        for w in ws:
            count[w] = count.get(w, 0) + 1
    rank = {w: sum(1 for x in count.values() if x >= n) for w, n in count.items()}

    def want(ws, share):
        ranks = sorted(rank[w] for w in ws)
        return next(r for r in ranks if sum(x <= r for x in ranks) >= share * len(ranks))

    expect = {d: [want(ws, x) for x in R.SHARES] for d, ws in words.items()}
    for head in (50_000, 3, 0):  # all words broadcast, few, none: the same ranks
        monkeypatch.setattr(R, "HEAD", head)
        assert {r.doc_id: r["ranks"] for r in R.features(own).collect()} == expect


def test_held_out_accuracy(spark):
    """Fit on two thirds of the rated documents, judge on the rest: within rater noise."""
    d = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{d}/documents.parquet").where("lang = 'en'")
    labels = spark.read.parquet(f"{d}/reading_labels.parquet")
    fit, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0 and grade is not null").groupBy("doc_id").agg(F.percentile("grade", 0.5).alias("y"))
    got = R.grades(documents, fit).join(held, "doc_id").where("grade is not null").select("grade", "y").toPandas()
    assert len(got) > 200
    assert ((got.grade >= 3.5) == (got.y >= 3.5)).mean() > 0.95
    assert (got.grade - got.y).abs().mean() < 0.4


def test_few_or_no_ratings_and_no_words(spark):
    docs = spark.createDataFrame([(1, "From: a\n\nSome plain words here."), (2, None), (3, ""), (4, "x" * 300_000 + ". " + "word " * 50_000)], "doc_id bigint, text string")
    rating = "doc_id bigint, rater string, grade int"
    some = {r.doc_id: r.grade for r in R.grades(docs, spark.createDataFrame([(1, "a", 4), (1, "a", 4), (1, "b", None)], rating)).collect()}
    assert {k: v and round(v, 6) for k, v in some.items()} == {1: 4.0, 2: None, 3: None, 4: 4.0}
    few = [(i, f"From: a\n\n{'Plain words here. ' * 3 if i % 2 else 'Incommensurable ratification notwithstanding circumspection ' * 9}.") for i in range(10, 30)]
    rated = R.grades(spark.createDataFrame(few, "doc_id bigint, text string"), spark.createDataFrame([(i, "a", 1 if i % 2 else 5) for i in range(10, 22)], rating))
    assert {r.doc_id % 2: round(r.grade) for r in rated.collect()} == {0: 5, 1: 1}
    none = {r.doc_id: r.grade for r in R.grades(docs, spark.createDataFrame([], rating)).collect()}
    assert set(none.values()) == {None}


def test_changed_tables(spark, tables, small, rows):
    names = ["documents", "reading_labels"]
    want = rows(R.found(spark, small))
    assert rows(R.found(spark, tables.clashing(names))) == want
    got = rows(R.found(spark, tables.repeated(["documents", "reading_labels"])))
    assert len(got) == len(set(got)) and len(set(got) ^ set(want)) <= 0.02 * len(want)
    assert R.found(spark, tables.empty(names)).count() == 0
    R.found(spark, tables.one_null_each(names)).count()


def test_every_document_is_graded_and_profiled(spark, tables, small):
    """Documents of all languages have a grade; the profile leaves none out."""
    names = ["documents", "reading_labels"]
    d = tables.changed(names, lambda df: df.unionByName(df.limit(1).select("*").withColumns({"doc_id": F.lit(-1).cast("bigint"), "text": F.lit(""), "lang": F.lit("fr")})) if "text" in df.columns else df)
    documents = spark.read.parquet(f"{d}/documents.parquet")
    got = R.graded(spark, d).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    assert {r.lang for r in got if r.grade is not None} == {r.lang for r in documents.select("lang").distinct().collect()}
    profile = R.profile(spark, d).collect()
    per_lang = {r.lang: r["count"] for r in documents.groupBy("lang").count().collect()}
    assert {k: sum(r.documents for r in profile if r.lang == k) for k in per_lang} == per_lang
    assert any(r.lang == "fr" and r.grade is None for r in profile)


def test_language_of_untagged_documents(spark):
    docs = [(1, "en", "The man saw the dog."), (2, "EN", "The dog and the man ran."), (3, "de-XX", "Der Mann sah der Hund."), (4, None, "The broker saw the plan."), (5, "und", "Der Plan und der Makler."), (6, None, "Zzz qqq.")]
    frame = spark.createDataFrame([(i, t, "From: a\n\n" + x) for i, t, x in docs], "doc_id bigint, lang string, text string")
    assert {r.doc_id: r.language for r in R.with_language(R.own_words(frame, "doc_id", "text", "lang")).collect()} == {1: "en", 2: "en", 3: "de", 4: "en", 5: "de", 6: "und"}


def test_own_text_is_not_quoted_text():
    for text in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).to_pylist():
        own = mail.own_text(text or "")
        assert "wrote:" not in own and "Original Message" not in own and "\n>" not in own
