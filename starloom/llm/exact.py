"""Exact duplicates with a heavy-hitter split.

Texts are equal when their SHA-256 is.  A Misra-Gries summary of ``HEAVY``
counters per task, merged in a tree, names every digest that can hold more
than ``1 / (HEAVY + 1)`` of all rows.  The named digests (at most ``HEAVY``,
whatever the input's size) are counted exactly; their verified winners are
broadcast, so the largest groups of copies are settled map-side and never
meet in one task.  The other digests take an ordinary shuffle, where no group
can hold more than that fraction of the rows.

The digests are written to the checkpoint folder once, so the passes over
them read 40 bytes a row and not the texts.

Defined results: a null text counts as empty; of rows that tie on the largest
``doc_id`` one stays in ``drop_copies`` while ``groups`` marks each of them
kept; a null ``doc_id`` is smaller than any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import documents, fresh, whole_text
from starloom.session import reliable_checkpoint

HEAVY = 1024
FAN_IN = 64


def digests(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.sha2(whole_text(), 256).alias("digest"))


def _reduce(count: dict[str, int], most: int) -> dict[str, int]:
    """Misra-Gries step: lower all counters by the first that has no place."""
    if len(count) <= most:
        return count
    cut = sorted(count.values(), reverse=True)[most]
    return {k: n - cut for k, n in count.items() if n > cut}


def heavy_candidates(rows: DataFrame, most: int = HEAVY) -> DataFrame:
    """(digest): every digest with more than 1 / (most + 1) of the rows, among at most ``most``."""
    schema = "digest string, n long"

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts().to_pylist():
                count[pair["values"]] = count.get(pair["values"], 0) + pair["counts"]
            count = _reduce(count, most)
        yield pa.RecordBatch.from_pydict({"digest": pa.array(list(count), pa.string()),
                                          "n": pa.array(list(count.values()), pa.int64())})

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        count: dict[str, int] = {}
        for k, n in zip(table.column("digest").to_pylist(), table.column("n").to_pylist()):
            count[k] = count.get(k, 0) + n
        count = _reduce(count, most)
        return pa.table({"digest": pa.array(list(count), pa.string()),
                         "n": pa.array(list(count.values()), pa.int64()),
                         "part": pa.array([key[0].as_py()] * len(count), pa.int32())})

    level = reliable_checkpoint(rows.select("digest").mapInArrow(summarise, schema)
                                .withColumn("part", F.spark_partition_id()), "summaries")
    n = (level.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        n = -(-n // FAN_IN)
        level = (level.groupBy(F.floor(F.col("part") / FAN_IN).cast("int").alias("node"))
                 .applyInArrow(merge, schema + ", part int"))
        if n == 1:
            break
    return level.select("digest")


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact winners of the heavy digests, and the heavy digests alone."""
    names = heavy_candidates(rows).distinct()
    counted = (rows.join(F.broadcast(names), "digest").groupBy("digest")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # a digest seen once is no heavy hitter, however few rows there are
    winners = reliable_checkpoint(counted.where("group_size > 1"), "winners")
    return winners, winners.select("digest")


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = reliable_checkpoint(digests(docs), "digests")
    winners, names = _split(rows)
    hot = rows.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    cold = (rows.join(F.broadcast(names), "digest", "left_anti")
            .withColumn("keep_id", F.max("doc_id").over(same))
            .withColumn("group_size", F.count(F.lit(1)).over(same)))
    return hot.unionByName(cold).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their own columns; one of equal texts.

    Copies of a heavy digest are dropped map-side but for the winner's own
    rows, which one more, small window reduces to one.  The window's limit of
    one row is applied before its shuffle as well, so where many copies tie on
    the winner's doc_id (all null, say) one row per digest leaves each task.
    """
    rows = reliable_checkpoint(digests(docs), "digests")
    winners, names = _split(rows)
    d, keep, rn = (fresh(docs, n) for n in ("_digest", "_keep_id", "_rn"))
    tagged = docs.withColumn(d, F.sha2(whole_text(), 256))
    hot = tagged.join(F.broadcast(winners.select(F.col("digest").alias(d), F.col("keep_id").alias(keep))), d) \
        .where(F.col("doc_id").eqNullSafe(F.col(keep))).drop(keep)
    cold = tagged.join(F.broadcast(names.select(F.col("digest").alias(d))), d, "left_anti")
    first = Window.partitionBy(d).orderBy(F.col("doc_id").desc_nulls_last())
    return (cold.unionByName(hot).withColumn(rn, F.row_number().over(first))
            .where(F.col(rn) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY sha256(coalesce(text, '')))
"""


def query(spark, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir))
