"""Dense row numbering in a total order (W1 surrogate keys, W2 record ids).

``row_number().over(Window.orderBy(...))`` without a partition moves every row
into one task; at scale that is the bottleneck (and an OOM).  Two ways avoid it:

* **File order** (``file_tag``): rows read from files are numbered in the order
  of file name and position, without a shuffle.  Each row is written once with
  its partition, its file and file block, and its position in the partition;
  a block is read by one task, so counting rows per block and cumulating the
  counts in (file, block) order gives each block's first number.
* **A key column** (``range_tag``): the table is staged, range-partitioned on
  the key over the staged files (so sampling reads those and never runs the
  source plan twice), sorted, and written once with partition and position.

Either way the id is the partition's (or block's) offset plus the position,
and both are stored columns, so a lost executor changes no number.

``small_index`` is the single-partition window, only for inputs with a proven
small bound (dimension tuples over closed domains).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from starloom.session import reliable_checkpoint, scratch_path, table_bytes

PID, MID = "_pid", "_mid"
_TIE = "_tie"

#: Where a row comes from, for the file order; rows written on the way also keep their position.
FILE, BLOCK, POS = "_file", "_block", "_pos"

# Range partitions hold about this many bytes of the staged table each; never
# fewer than it takes to occupy every core.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def partition_count(df: DataFrame, explicit: int | None = None, staged_bytes: int = 0) -> int:
    """Partitions for a range shuffle of a staged table: explicit, else by its size on disk.

    Explicit in the plan (AQE cannot split a range partition, only merge), so
    a small table gets only as many partitions as there are cores.
    """
    if explicit:
        return max(1, explicit)
    spark = df.sparkSession
    base = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                      spark.sparkContext.defaultParallelism))
    return max(base, -(-staged_bytes // TARGET_PARTITION_BYTES))


def with_file_order(scan: DataFrame) -> DataFrame:
    """A file scan with the file and the file block of each row (``_file``, ``_block``)."""
    return scan.withColumns({FILE: F.col("_metadata.file_path"),
                             BLOCK: F.col("_metadata.file_block_start")})


def has_file_order(df: DataFrame) -> bool:
    return FILE in df.columns and BLOCK in df.columns


def file_tag(df: DataFrame) -> DataFrame:
    """Position-tagged and checkpointed copy of ``df`` in file order, without a shuffle.

    ``df`` is a scan ``with_file_order`` followed by narrow steps only
    (projections and filters), so a partition holds its blocks' rows in order.
    """
    if POS in df.columns:  # rows written on the way: a block may lie in several pieces
        df = df.sortWithinPartitions(FILE, BLOCK, POS)
    return reliable_checkpoint(df.withColumn(PID, F.spark_partition_id())
                               .withColumn(MID, F.monotonically_increasing_id()), "filed")


def block_sizes(tagged: DataFrame) -> DataFrame:
    """(_pid, _file, _block, _n, _base, _from, _to) per piece of a block; the positions only if rows keep them."""
    place = F.col(POS) if POS in tagged.columns else F.col(MID)
    return tagged.groupBy(PID, FILE, BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), F.min(MID).alias("_base"), F.min(place).alias("_from"), F.max(place).alias("_to"))


def block_offsets(sizes: DataFrame) -> DataFrame:
    """Sizes per piece of a block -> start offsets in (file, block, position) order.

    One row per piece of a file block; the windows run over that table.
    ``_mixed`` marks a piece that begins before the piece before it ends: then
    pieces alone do not give the order of the rows.
    """
    order = Window.orderBy(FILE, BLOCK, "_from")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(FILE, BLOCK).orderBy("_from")
    return sizes.select(PID, FILE, BLOCK, "_base", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                        F.coalesce(F.lag("_to").over(inside) >= F.col("_from"), F.lit(False)).alias("_mixed"))


def _order_cols(order_by: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def range_tag(df: DataFrame, order_by: list[str | Column],
              num_partitions: int | None = None, unique: bool = False) -> DataFrame:
    """Range-partitioned, sorted, position-tagged and checkpointed copy of ``df``.

    ``unique`` (column names only) raises if two rows share their key.  Equal
    keys meet in one range partition, next to each other in its sort order, so they
    are counted in the same write, without another shuffle or sort.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    n = partition_count(staged, num_partitions, table_bytes(spark, path))
    order = _order_cols(order_by)
    ranged = staged.repartitionByRange(n, *order).sortWithinPartitions(*order)
    if unique:
        same = Window.partitionBy(*order_by).orderBy(*order)
        ranged = ranged.withColumn(_TIE, F.row_number().over(same) > 1)
    ranged = ranged.withColumn(PID, F.spark_partition_id()).withColumn(MID, F.monotonically_increasing_id())
    if not unique:
        return reliable_checkpoint(ranged, "ranged")
    seen = Observation("ties")
    out = reliable_checkpoint(ranged.observe(seen, F.count_if(_TIE).alias("ties")).drop(_TIE), "ranged")
    if seen.get["ties"]:
        raise ValueError(f"{order_by} does not order the rows: {seen.get['ties']} rows repeat a key")
    return out


def partition_offsets(sizes: DataFrame) -> DataFrame:
    """(_pid, _n, _base) per partition -> (_pid, _base, _off) start offsets.

    The input has one row per partition, so the window runs over a tiny table.
    """
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(PID, "_base", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def apply_offsets(ranged: DataFrame, offsets: DataFrame, out_col: str, start: int = 1) -> DataFrame:
    """Dense index = partition offset + position inside the partition."""
    keys = [c for c in (PID, FILE, BLOCK) if c in offsets.columns]
    return (ranged.join(F.broadcast(offsets), keys)
                  .withColumn(out_col, (F.col("_off") + (F.col(MID) - F.col("_base"))
                                        + F.lit(start)).cast("long"))
                  .drop(PID, MID, POS, "_base", "_off", "_mixed", *keys))


def attach_index(ranged: DataFrame, out_col: str, start: int = 1) -> DataFrame:
    """Turn a ``range_tag`` frame's (partition, position) into a dense index."""
    sizes = ranged.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"), F.min(MID).alias("_base"))
    offsets = reliable_checkpoint(partition_offsets(sizes), "offsets")
    return apply_offsets(ranged, offsets, out_col, start)


def _file_order_rows(rows: DataFrame, out_col: str, start: int) -> DataFrame:
    """Dense index in file order: pieces of blocks where they suffice, else a range shuffle by position."""
    tagged = file_tag(rows)
    offsets = reliable_checkpoint(block_offsets(block_sizes(tagged)), "offsets")
    if POS in rows.columns and not offsets.where("_mixed").isEmpty():
        return attach_index(range_tag(rows, [FILE, BLOCK, POS]), out_col, start).drop(FILE, BLOCK)
    return apply_offsets(tagged, offsets, out_col, start)


def numbered_rows(rows: DataFrame, out_col: str, order_key: str | None,
                  num_partitions: int | None = None, start: int = 1) -> DataFrame:
    """The rows with dense ids, over a copy tagged with block and position.

    Counting rows per block reads the tags alone; the offsets table has one
    row per partition or (piece of a) file block.  A key that two rows share is
    an error: their ids would depend on the run.
    """
    if order_key is None:
        return _file_order_rows(rows, out_col, start)
    return attach_index(range_tag(rows, [order_key], num_partitions, unique=True), out_col, start)


def dense_index(df: DataFrame, order_by: list[str | Column], out_col: str,
                start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = start, start+1, ... in ``order_by`` order (must be unique)."""
    return attach_index(range_tag(df, order_by, num_partitions), out_col, start)


def small_index(df: DataFrame, order_by: list[str | Column], out_col: str,
                start: int = 1) -> DataFrame:
    """Single-partition ``row_number`` for inputs whose size is proven small."""
    w = Window.orderBy(*_order_cols(order_by))
    return df.withColumn(out_col, (F.row_number().over(w) + F.lit(start - 1)).cast("int"))
