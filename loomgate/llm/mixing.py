"""A mix of sources at target shares of size, by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, so that
the source's expected size is its share of the total. The whole part is given
to all; the fractional parts are rounded by pairing: mass (tokens) moves at
random between two documents, without bias and keeping their summed size,
until one of them is whole. Buckets of a source are rounded independently and
leave one fractional document each; those are combined level by level in a
reduction tree until one per source is left. A source's size is thus met to
within one document.

The randomness of a bucket is seeded by its name, so repeated tasks repeat it.

Edge cases: null texts and texts of no tokens have size 0 and are never
taken; sources are compared without case, with blanks and hyphens as
underscores; null or unlisted sources are not part of the mix; a listed
source without documents gets nothing and the others share its part; a source
too small for its share even at ``max_repeats`` is repeated so often and no
more, where a total is given; repeated rows of one id count once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgate.runtime import bounded_broadcast, stage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Documents per bucket, and residuals per node of the reduction tree.
BUCKET_DOCS, FAN_IN = 4_000, 1_000
#: Longer texts are handed to the tokenizer in pieces of about this many characters.
PIECE_CHARS = 200_000
# Fixed value: the split pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(vocabulary: str):
    """Text → token ids, by a vocabulary file of lines "base64 rank"."""
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(vocabulary).read_bytes().splitlines() if line)}
    return tiktoken.Encoding("loomgate", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def token_counts(documents: DataFrame, doc_id: str, text: str, source: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens) of every document. The vocabulary file is sent to the executors."""
    context = documents.sparkSession.sparkContext
    context.addFile(tokenizer)
    name = Path(tokenizer).name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        encode = encoder(SparkFiles.get(name))
        for batch in batches:
            sizes = [sum(len(encode(p)) for p in pieces(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["doc_id", "source", "tokens"])

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), source_key(F.col(source)).alias("source"), F.col(text)).mapInArrow(
        run, "doc_id bigint, source string, tokens bigint"
    )


# A blank between two other characters begins a word of the split pattern, so the
# words on either side are the same whether the text is cut before it or not.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> Iterator[str]:
    """The text in pieces cut on boundaries of the split pattern; without one the piece goes on."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        m = _CUT.search(text, at + PIECE_CHARS)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def source_key(source: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-]+", "_")


def plan(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Copies expected per document of each source: (source, target_share, available, rate).

    Without a ``total`` the largest is taken at which every source that has
    documents meets its share within its repeats.
    """
    have = sizes.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("available"), F.count(F.lit(1)).alias("documents"))
    wanted = targets.where("source is not null").select(source_key(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats")).dropDuplicates(["source"])
    both = wanted.join(have, "source", "left").fillna(0, ["available", "documents"])
    live = both.where("available > 0 and target_share > 0")
    s = live.agg(F.sum("target_share"), F.min(F.col("max_repeats") * F.col("available") / F.col("target_share"))).first()
    reachable = (s[1] * s[0]) if s[0] else 0.0
    goal = float(reachable if total is None else total)
    rate = F.when((F.col("available") > 0) & (F.col("target_share") > 0), F.least(F.col("max_repeats").cast("double"), F.lit(goal) * F.col("target_share") / F.lit(s[0] or 1.0) / F.col("available"))).otherwise(0.0)
    return both.withColumn("rate", rate)


def round_pairs(p: list[float], w: list[int], seed: int) -> list[float]:
    """Pivotal rounding of one bucket: all but at most one value become 0 or 1, Σ p·w stays."""
    import random

    draw = random.Random(seed).random
    p, i = list(p), -1
    for j in range(len(p)):
        if not 1e-9 < p[j] < 1 - 1e-9:
            p[j] = float(round(p[j]))
            continue
        if i < 0:
            i = j
            continue
        up = min((1 - p[i]) * w[i], p[j] * w[j])  # mass that may move from j to i
        down = min(p[i] * w[i], (1 - p[j]) * w[j])
        move = up if draw() * (up + down) < down else -down
        p[i], p[j] = p[i] + move / w[i], p[j] - move / w[j]
        whole_i, whole_j = not 1e-9 < p[i] < 1 - 1e-9, not 1e-9 < p[j] < 1 - 1e-9
        if whole_i:
            p[i] = float(round(p[i]))
        if whole_j:
            p[j] = float(round(p[j]))
        i = -1 if whole_i and whole_j else j if whole_i else i
    return p


def copies(sizes: DataFrame, planned: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, tokens, copies) of every document taken at least once."""
    rates, _ = bounded_broadcast(planned.where("rate > 0").select("source", "rate"))
    docs = sizes.where("tokens > 0").join(rates, "source").select("doc_id", "source", "tokens", F.floor("rate").cast("bigint").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"))
    n = sizes.count()
    width = max(1, -(-n // BUCKET_DOCS))
    schema = "doc_id bigint, source string, tokens bigint, whole bigint, p double"

    def rounding(level: int):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("doc_id")
            name = f"{seed}/{level}/{key[0]}/{key[1]}"
            return pdf.assign(p=round_pairs(pdf["p"].tolist(), pdf["tokens"].tolist(), zlib.crc32(name.encode())))[["doc_id", "source", "tokens", "whole", "p"]]

        return run

    # Level 0: buckets of bounded size by hash of the id, so no source is one task.
    level, done = 0, None
    todo = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(width)))
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    while True:
        part = stage(todo.groupBy("source", "bucket").applyInPandas(rounding(level), schema), f"mixing-level{level}")
        settled = part.where(~fractional)
        done = settled if done is None else done.unionByName(settled)
        if width == 1:
            break
        width = -(-width // FAN_IN)  # residuals: one per bucket at most
        level += 1
        todo = part.where(fractional).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(width)))
    # The last document of each source is rounded by its own draw.
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    last = part.where(fractional).withColumn("p", F.when(draw < F.col("p"), 1.0).otherwise(0.0))
    return done.unionByName(last).select("doc_id", "source", "tokens", (F.col("whole") + F.col("p").cast("bigint")).alias("copies")).where("copies > 0")


# ---------------------------------------------------------------- this project's tables


def _sized(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    documents = spark.read.parquet(f"{d}/documents.parquet")
    sizes = stage(token_counts(documents, "doc_id", "text", "source").dropDuplicates(["doc_id"]), "mixing-sizes")
    return sizes, stage(plan(sizes, spark.read.parquet(f"{d}/mix_targets.parquet")), "mixing-plan")


def mix(spark: SparkSession, d: str) -> DataFrame:
    sizes, planned = _sized(spark, d)
    return copies(sizes, planned)


def shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share per listed source."""
    sizes, planned = _sized(spark, d)
    got = copies(sizes, planned).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    all_tokens = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    report = planned.join(got, "source", "left").crossJoin(F.broadcast(all_tokens))  # one row
    return report.select("source", "target_share", "max_repeats", "documents", "available", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("reached_share"))
