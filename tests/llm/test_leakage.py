import random

from pyspark.sql import functions as F

from loomgate.llm import leakage as L

ITEMS = "item_id bigint, item_text string, extra string"
DOCS = "doc_id bigint, text string, item_id string"


def world(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(r.randrange(3, 8)))
    opening = "Read the passage below and choose the best answer."
    items = {i: f"{opening} " + " ".join(word() for _ in range(r.randrange(40, 80))) + "." for i in range(1, 13)}
    items[13] = "short item of nine words only and no more"
    return r, word, items


def passage(r, word, item, n, change):
    w = item.split()[10:]
    a = r.randrange(len(w) - n)
    w = w[a : a + n]
    if change:
        for k in range(4, n - 4, 9):
            w[k] = word() if r.random() < 0.5 else w[k] + " " + word()
    return " ".join(w)


def test_found_and_not_found(spark):
    r, word, items = world(1)
    docs, want = [], set()
    for d in range(1, 80):
        text = " ".join(word() for _ in range(60))
        i = r.randrange(1, 13)
        kind = d % 5
        if kind == 0:
            text += " " + passage(r, word, items[i], 24, False).upper().replace(" ", ",\n> ") + " " + word()
            want.add((d, i))
        elif kind == 1:
            text += " " + passage(r, word, items[i], 26, True) + " " + word()
            want.add((d, i))
        elif kind == 2:
            text += " " + passage(r, word, items[i], 12, False) + " " + word()
        elif kind == 3:
            text += " Read the passage below and choose the best answer. " + word()
        else:
            text = f"<p>{text} <i>" + items[13].replace(" ", "</i>&nbsp;<b>") + "</b></p>"
            text = "Content-Type: text/html\n\n" + text
            want.add((d, 13))
        docs.append((d, text, "clash"))
    docs += [(500, None, None), (501, "", None), (None, "x", None), (502, "y " * 500_000, None)]
    frame = spark.createDataFrame(docs, DOCS)
    listed = spark.createDataFrame([(i, t, None) for i, t in items.items()] + [(77, None, None), (78, "", None)], ITEMS)
    got = L.matches(frame, listed, "doc_id", "text", "item_id", "item_text")
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want
    # Items in several blocks give the same.
    L.BLOCK_CHARS, kept = 900, L.BLOCK_CHARS
    try:
        again = L.matches(frame, listed, "doc_id", "text", "item_id", "item_text")
        assert {(x.doc_id, x.item_id) for x in again.collect()} == want
    finally:
        L.BLOCK_CHARS = kept


def test_offsets_in_plain_text(spark):
    _, _, items = world(2)
    inner = " ".join(items[3].split()[12:40])
    docs = spark.createDataFrame([(1, f"From: a\n\nSome words. {inner} and more", None)], DOCS)
    got = L.matches(docs, spark.createDataFrame([(3, items[3], None)], ITEMS), "doc_id", "text", "item_id", "item_text").first()
    text = docs.first().text
    assert text[got.start : got.end].rstrip(".") == inner.rstrip(".")


def test_offsets_in_html_and_after_letters_that_grow(spark):
    _, _, items = world(2)
    inner = items[3].split()[12:40]
    html = "From: a\nContent-Type: text/html\n\n<p>İİİİİ some <b>words</b></p><p>" + " <i>x</i> ".join([" ".join(inner[:14]), " ".join(inner[14:])]) + "</p>"
    plain = "From: a\n\nİİİİİ it’s here: " + " ".join(inner) + " and more"
    docs = spark.createDataFrame([(1, html, None), (2, plain, None)], DOCS)
    got = {r.doc_id: (r.start, r.end) for r in L.matches(docs, spark.createDataFrame([(3, items[3], None)], ITEMS), "doc_id", "text", "item_id", "item_text").collect()}
    for i, raw in ((1, html), (2, plain)):
        cut = raw[got[i][0] : got[i][1]]
        assert cut.startswith(inner[0]) and cut.rstrip(".").endswith(inner[-1].rstrip("."))


def test_many_shared_openings_and_a_repeated_passage(spark):
    """Instructions of more than forty words are skipped whole; a text that repeats a passage stays linear."""
    opening = " ".join(f"w{i}x" for i in range(60))
    items = [(i, f"{opening} " + " ".join(f"i{i}n{k}" for k in range(30)), None) for i in range(5)]
    docs = [(1, opening, None), (2, " ".join(items[2][1].split()[60:]) + " end", None), (3, " ".join(items[1][1].split()[60:] * 400), None)]
    got = L.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), "doc_id", "text", "item_id", "item_text").select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in got} == {(2, 2), (3, 1)}


def test_empty_tables_and_changed_tables(spark, tables, small, rows):
    names = ["documents", "eval_items"]
    want = rows(L.found(spark, small))
    assert rows(L.found(spark, tables.clashing(names))) == want and rows(L.found(spark, tables.repeated(names))) == want
    assert L.found(spark, tables.empty(names)).count() == 0
    assert set(want) <= set(rows(L.found(spark, tables.all_null(names)).where(F.col("doc_id").isNotNull())))
