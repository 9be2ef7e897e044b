"""Small helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def whole_text() -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame) -> DataFrame:
    """(dk, th, doc_id, text): documents under a join key that is never null.

    ``dk`` is the document id (-1 for a null one) and ``th`` a hash of the
    text, so rows that share an id but not a text stay apart, and repeated
    rows share their (equal) result.
    """
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("dk"),
        F.xxhash64(whole_text()).alias("th"),
        F.col("doc_id"), whole_text().alias("text"))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (dk, th) is in ``kept``; of repeated rows one stays.

    The window has the partitioning and order of the join before it, so it
    adds no shuffle.
    """
    dk, th, rn = fresh(docs, "_dk"), fresh(docs, "_th"), fresh(docs, "_rn")
    k = kept.select(F.col("dk").alias(dk), F.col("th").alias(th))
    rows = docs.withColumn(dk, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))) \
        .withColumn(th, F.xxhash64(whole_text()))
    one = Window.partitionBy(dk, th).orderBy(dk)
    return (rows.join(k, [dk, th], "left_semi")
            .withColumn(rn, F.row_number().over(one)).where(F.col(rn) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def text_batches(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``most`` bytes of text each (one row at least)."""
    at = text_offsets(batch.column(column))[1]
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def text_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the column's buffer, offsets of its rows); the column has no nulls."""
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at.astype(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                 most: int = 1 << 26) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from batches sorted by ``keys``.

    The last group of what has been read waits for the next batch, so a group
    is never cut; callers bound a group's size beforehand.  A table is handed
    out once it has some ``most`` bytes.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = int(group_starts(table, keys)[-1])
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size = sum(b.nbytes for b in held)
        most = max(most, 2 * size)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group begins (sorted table)."""
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
