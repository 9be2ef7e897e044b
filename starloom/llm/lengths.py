"""Exact length histogram of a corpus in tokens.

Documents are aggregated by their encoded length; every later question is
answered from the histogram alone.  With ``docs(l)`` documents of length l,
prefix and suffix sums give, for each context limit L:

    truncated(L) = sum of l * docs(l) over l < L  +  L * (documents of length >= L),

the totals kept and lost at that limit, and exact quantiles.

The query gives every occurring length and the usual limits, each with the
share of documents up to it (``quantile``): a quantile is the least length whose
share reaches it.

The histogram has at most one row per distinct length.  Its sums run in two
levels (within blocks of ``BLOCK`` lengths, then over the blocks), so no task
holds more than a block, or one row per block.

Defined results: null and empty texts have length 0; repeated rows count each;
an empty table gives no rows; ``doc_id`` and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import documents, whole_text
from starloom.llm.tokens import Cache, Encoder
from starloom.session import reliable_checkpoint

BLOCK = 1024
#: Context limits that the query answers whether or not a document has that length.
LIMITS = (512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072)


@lru_cache(maxsize=2)
def _counts(path: str) -> Cache:
    encode = Encoder(path)
    return Cache(lambda chunks: [len(ids) // 4 for ids in encode(chunks)], 300_000)


def encoded_lengths(docs: DataFrame, path: str) -> DataFrame:
    """(length) of every row's text under the tokenizer file ``path``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _counts(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(sum, cache.of_texts(map(str, b.column(0)))), pa.int64())], ["length"])
    return docs.select(whole_text().alias("text")).mapInArrow(count, "length long")


def histogram(lengths: DataFrame, limits: tuple[int, ...] = ()) -> DataFrame:
    """(length, docs, docs_upto, docs_from, tokens_upto, truncated), one row per length.

    ``docs_upto`` counts documents of at most that length, ``docs_from`` of at
    least it; ``truncated`` is the corpus' total cut to that context limit.
    ``limits`` have a row each, also where no document has that length.  The
    grouped lengths are written once, so the two levels of sums read those
    and the texts are encoded once.
    """
    h = reliable_checkpoint(lengths.groupBy("length").agg(F.count(F.lit(1)).alias("docs")), "lengths")
    if limits and not h.isEmpty():
        more = h.sparkSession.createDataFrame([(n, 0) for n in limits], "length long, docs long")
        h = h.unionByName(more).groupBy("length").agg(F.sum("docs").alias("docs"))
    h = h.withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = (F.col("length") * F.col("docs")).alias("tokens")
    blocks = h.groupBy("block").agg(F.sum("docs").alias("b_docs"), F.sum(tokens).alias("b_tokens"))
    upto = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block", F.coalesce(F.sum("b_docs").over(upto), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("b_tokens").over(upto), F.lit(0)).alias("tokens_before"),
        F.sum("b_docs").over(everything).alias("all_docs"))
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    h = (h.withColumn("docs_in", F.sum("docs").over(inside))
         .withColumn("tokens_in", F.sum(tokens).over(inside)).join(blocks, "block"))
    docs_upto = F.col("docs_before") + F.col("docs_in")
    tokens_upto = F.col("tokens_before") + F.col("tokens_in")
    return h.select("length", "docs", docs_upto.alias("docs_upto"),
                    (F.col("all_docs") - docs_upto + F.col("docs")).alias("docs_from"),
                    tokens_upto.alias("tokens_upto"),
                    (tokens_upto + F.col("length") * (F.col("all_docs") - docs_upto)).alias("truncated"))


def totals_at(h: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_cut, kept_tokens): truncated totals at any limits, from the histogram."""
    each = h.select("length", "docs", F.explode(F.array(*[F.lit(n) for n in limits])).alias("context_limit"))
    kept = F.least("length", "context_limit") * F.col("docs")
    return each.groupBy("context_limit").agg(
        F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_cut"),
        F.sum(kept).alias("kept_tokens"))


def quantile(h: DataFrame, share: float) -> Column:
    """The least length that ``share`` of the documents do not exceed (an aggregate over ``h``)."""
    return F.min(F.when(F.col("docs_upto") >= F.ceil(F.lit(share) * (F.col("docs_upto") + F.col("docs_from") - F.col("docs"))),
                        F.col("length")))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    h = histogram(encoded_lengths(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")), LIMITS)
    return h.withColumn("quantile", F.col("docs_upto") / (F.col("docs_upto") + F.col("docs_from") - F.col("docs")))
