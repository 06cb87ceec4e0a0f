"""Evaluation passages that stand in corpus documents.

Items and documents are reduced to words (case, punctuation, markup, line
breaks, quote marks and transfer encoding drop out). One Aho-Corasick
automaton over the items' five-word runs scans each document's word text
once; hits are chained along the item (a word may be altered, put in or left
out between them), the ends are extended word by word, and the chain counts
when it covers ``MIN_WORDS`` words of the item running, or all of it. Matches
carry offsets into the original message, in HTML and attached messages too.

Standing instructions - openings shared by many items - give no seeds and do
not count. Items are a stated query set: their words lie in the shared folder,
from which each executor process builds the automaton once. Should they exceed
one automaton's memory they are kept as several, and every text, read once from
its message, is scanned by each in turn; there is one pass over the documents
however many items there are.

Edge cases: null or empty documents and items match nothing; an item shorter
than a seed is matched whole as one pattern; repeated documents each count,
repeated items once; very long texts are scanned whole, part by part.
"""

from __future__ import annotations

import re
from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate.llm import mail
from loomgate.runtime import bounded_broadcast, shared_path

SEED, MIN_WORDS = 5, 20
#: Longest stretch without a seed inside a chain, and shift of words it may hold.
GAP, SHIFT = 12, 4
#: An opening run shared by this share of the items (and at least 3) is an instruction.
SHARED = 0.02
#: Characters of items per automaton (about 150 MB in an executor's Python), automata kept built, characters of messages read at once.
BLOCK_CHARS, KEPT_BLOCKS, READ_CHARS = 1_000_000, 2, 16_000_000

_QUOTES = {ord(c): None for c in "'’‘ʼ`´′"}
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Words in lower case; a dot that lower-casing sets beside a letter is dropped."""
    return [w.lower().replace("\u0307", "") for w in _WORD.findall(text.translate(_QUOTES))]


class Matcher:
    """Automaton over one block of items."""

    def __init__(self, items: list[tuple[int, list[str], int]]):
        """Items are (id, words, number of opening words that are an instruction)."""
        import ahocorasick

        self.items = [(i, w, skip) for i, w, skip in items if w]
        seeds = defaultdict(list)
        for at, (_, w, skip) in enumerate(self.items):
            n = min(SEED, len(w))
            for p in range(skip, len(w) - n + 1):
                seeds[" ".join(w[p : p + n])].append((at, p))
        self.automaton = ahocorasick.Automaton()
        for s, where in seeds.items():
            self.automaton.add_word(f" {s} ", (len(s), where))
        if seeds:
            self.automaton.make_automaton()
        self.empty = not seeds

    def scan(self, doc: list[str]) -> list[tuple[int, int, int]]:
        """(item, first word, end word) in ``doc`` of every passage that counts."""
        if self.empty or not doc:
            return []
        line = f" {' '.join(doc)} "
        hits = defaultdict(list)
        index = None
        for end, (size, where) in self.automaton.iter(line):
            if index is None:
                index, at = {}, 0
                for k, w in enumerate(doc):
                    index[at] = k
                    at += len(w) + 1
            k = index[end - size - 1]
            for at, p in where:
                hits[at].append((k, p))
        out = []
        for at, found in hits.items():
            out += self.chains(at, doc, found)
        return out

    def chains(self, at: int, doc: list[str], found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Chain hits that follow one another; one open chain per diagonal, so the work is linear in the hits."""
        item, w, skip = self.items[at]
        done, open_ = [], {}
        for k, p in sorted(found):
            best = None
            for diagonal in range(k - p - SHIFT, k - p + SHIFT + 1):
                c = open_.get(diagonal)
                if c and 0 < k - c[2] <= GAP + SEED and 0 < p - c[3] <= GAP + SEED and (best is None or c[3] - c[1] > best[3] - best[1]):
                    best = c
            if best is None:
                best = [k, p, k, p]
            else:
                del open_[best[2] - best[3]]
                best[2], best[3] = k, p
            if k - p in open_:
                done.append(open_[k - p])
            open_[k - p] = best
        need, out, n = min(MIN_WORDS, len(w) - skip), [], min(SEED, len(w))
        for k0, p0, k1, p1 in [*done, *open_.values()]:
            k0, p0 = extend(doc, w, k0 - 1, p0 - 1, -1, skip)
            k1, p1 = extend(doc, w, k1 + n, p1 + n, 1, 0)
            if p1 - (p0 + 1) >= need:
                out.append((item, k0 + 1, k1))
        return out


def extend(doc: list[str], w: list[str], k: int, p: int, step: int, low: int) -> tuple[int, int]:
    """Go on from (k, p) while words agree; past one changed word if two agree behind it."""
    def same(a: int, b: int) -> bool:
        return 0 <= a < len(doc) and low <= b < len(w) and doc[a] == w[b]

    while True:
        if same(k, p):
            k, p = k + step, p + step
            continue
        for dk, dp in ((1, 1), (1, 0), (0, 1)):
            if same(k + dk * step, p + dp * step) and same(k + (dk + 1) * step, p + (dp + 1) * step):
                k, p = k + dk * step, p + dp * step
                break
        else:
            return k, p


def prepared(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(item, words, skip): the items' words, and how many opening words lie in runs shared by many items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([words(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))], names=["item", "words"])

    given = items.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).cast("string").alias("t")).where("item is not null and t is not null").dropDuplicates()
    spelled = given.mapInArrow(run, "item bigint, words array<string>").where("size(words) > 0").withColumn("no", F.xxhash64("item", "words"))
    starts = F.when(F.size("words") >= SEED, F.sequence(F.lit(1), F.size("words") - SEED + 1))
    runs = spelled.select("item", "no", F.posexplode(F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, SEED)))).alias("at", "run"))
    least = max(3.0, spelled.count() * SHARED)
    shared, _ = bounded_broadcast(runs.groupBy("run").agg(F.count_distinct("no").alias("n")).where(F.col("n") >= least).select("run", F.lit(True).alias("shared")))
    # An instruction is an opening: its shared runs start at 0, 1, 2 … without a gap.
    first_own = runs.join(shared, "run", "left").groupBy("item", "no").agg(F.min(F.when(F.col("shared").isNull(), F.col("at"))).alias("own"), F.count(F.lit(1)).alias("all"))
    n = F.coalesce("own", "all", F.lit(0))
    return spelled.join(first_own, ["item", "no"], "left").select("item", "words", F.when(n > 0, n + SEED - 1).otherwise(0).cast("int").alias("skip"))


_built: OrderedDict[tuple[str, int], Matcher] = OrderedDict()


def _matcher(folder: str, block: int) -> Matcher:
    """The automaton of a block, built from the shared folder unless this process still has it."""
    from pyarrow import fs

    if (folder, block) in _built:
        _built.move_to_end((folder, block))
        return _built[folder, block]
    while len(_built) >= KEPT_BLOCKS:
        _built.popitem(last=False)
    store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    listed = [f.path for f in store.get_file_info(fs.FileSelector(f"{root}/block={block}", allow_not_found=True)) if f.path.endswith(".parquet")]
    rows = [r for path in sorted(listed) for r in pq.read_table(store.open_input_file(path), partitioning=None).to_pylist()]
    _built[folder, block] = Matcher([(r["item"], r["words"], r["skip"]) for r in rows])
    return _built[folder, block]


def matches(documents: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, start, end): passages with offsets in the original text."""
    spark = documents.sparkSession
    folder = shared_path(spark, "leakage-items")
    ready = prepared(items, item_id, item_text)
    total = items.agg(F.sum(F.length(item_text))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    ready.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")).repartition("block").write.partitionBy("block").parquet(folder)
    read = READ_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                readings, size = [], 0
                while at < len(ids) and size < read:  # each message is parsed once
                    if raws[at]:
                        readings += [(ids[at], t, words(t.text)) for t in mail.texts(raws[at])]
                        size += len(raws[at])
                    at += 1
                rows = []
                for block in range(blocks):
                    m = _matcher(folder, block)
                    for i, t, doc in readings:
                        rows += [(i, item, *original_span(t, a, b)) for item, a, b in m.scan(doc)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "item_id", "start", "end"])

    found = documents.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(run, "doc_id bigint, item_id bigint, start bigint, end bigint")
    return found.withColumnsRenamed({"doc_id": doc_id, "item_id": item_id})


def original_span(read: mail.Text, a: int, b: int) -> tuple[int, int]:
    """Offsets in the raw message of words ``a`` to ``b`` of a part's text."""
    kept = [i for i, c in enumerate(read.text) if ord(c) not in _QUOTES]
    spans = [m.span() for m in _WORD.finditer(read.text.translate(_QUOTES))]
    return read.origin(kept[spans[a][0]], kept[spans[b - 1][1] - 1])


# ---------------------------------------------------------------- this project's tables


def spans(spark: SparkSession, d: str) -> DataFrame:
    return matches(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/eval_items.parquet"), "doc_id", "text", "item_id", "item_text")


def found(spark: SparkSession, d: str) -> DataFrame:
    return spans(spark, d).select("doc_id", "item_id").distinct()


def items_leaked(spark: SparkSession, d: str) -> DataFrame:
    """Per test: items with a leak and documents that hold one."""
    items = spark.read.parquet(f"{d}/eval_items.parquet").select("item_id", "test_name")
    return found(spark, d).join(items, "item_id").groupBy("test_name", "item_id").agg(F.count(F.lit(1)).alias("documents"))
