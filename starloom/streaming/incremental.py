"""Incremental yearly loads (E6) with Structured Streaming.

Two sources.  ``start_year_stream`` follows a folder of real yearly CSV files:
the stream carries the files' names alone (their contents are not read by the source), and
every micro-batch takes its files in as a batch run does, each part file under
its own header, the year from its path, malformed years set aside.
``start_incremental`` follows files of one known schema.

Either way ``foreachBatch`` cleans the micro-batch with the DECLARED encodings
(no data-dependent inference, so a batch's result never depends on other
batches), then upserts the star with keys that are stable across batches:

* a dimension tuple seen before keeps its key; new tuples get
  ``max(previous key) + rank`` in first-seen order within the batch;
* record ids continue from the previous maximum, in the order of the files
  (no shuffle), or of a key column, within the batch.

The dimensions are small tables (bounded by their domains), kept as parquet,
not in the state store.  Every table is partitioned by ``batch_id`` and a batch
only overwrites its own partition, reading "previous" state as
``batch_id < current``.  A replayed batch (after a failure between the
write and the checkpoint commit) therefore rewrites exactly the same rows:
the load is idempotent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import spec as S
from starloom.operators.clean import clean_survey
from starloom.operators.numbering import dense_index, numbered_rows
from starloom.operators.star import FIRST, lookup_key, resolve_order, star_grouping
from starloom.session import local_table, reliable_checkpoint, scratch_path, scratch_scope
from starloom.sources import files
from starloom.sources.intake import take_in

BATCH = "batch_id"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A state table with its known schema: a folder without a data file is an empty table."""
    from pyspark.sql.types import LongType, StructField, StructType

    fields = [f for f in schema.fields if f.name != BATCH]
    return spark.read.schema(StructType(fields + [StructField(BATCH, LongType())])).parquet(path)


def _previous(spark: SparkSession, path: str, batch_id: int, schema) -> DataFrame | None:
    if not _exists(spark, path):
        return None
    return _read(spark, path, schema).filter(F.col(BATCH) < batch_id)


def star_schemas(layout: S.StarLayout, clean_schema) -> dict:
    """Schema of every stored table, from the clean table's."""
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    out = {d.table: StructType([StructField(d.key, IntegerType())] +
                               [StructField(o, clean_schema[s].dataType) for s, o in d.columns])
           for d in layout.dims}
    measures = [StructField(o, StructType.fromDDL(f"x {cast}")["x"].dataType if cast else clean_schema[s].dataType)
                for s, o, cast in layout.measures]
    out[layout.fact_table] = StructType([StructField(layout.record_key, LongType()), *measures] +
                                        [StructField(d.key, IntegerType()) for d in layout.dims])
    out[LEDGER] = StructType.fromDDL("last_record_id long, rows long")
    return out


def _max_key(df: DataFrame | None, key: str) -> int:
    if df is None:
        return 0
    v = df.agg(F.max(key)).first()[0]   # one scalar
    return int(v or 0)


def _write_partition(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn(BATCH, F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(BATCH).parquet(path))


LEDGER = "_ledger"


def _local_new_tuples(spark: SparkSession, prev: DataFrame | None, batch_rows, d: S.DimSpec,
                      schema) -> tuple[DataFrame, DataFrame]:
    """(new rows to append, full dimension for lookups) from bounded local rows."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    fields = StructType([StructField(d.key, IntegerType(), False)] +
                        [StructField(o, schema[s].dataType, True) for s, o in d.columns])
    old = [tuple(r) for r in prev.select(d.key, *d.outputs).collect()] if prev is not None else []
    known = {row[1:] for row in old}
    start = max((row[0] for row in old), default=0) + 1
    fresh = sorted((r for r in batch_rows if tuple(r[s] for s in d.sources) not in known),
                   key=lambda r: (r[FIRST] is not None, r[FIRST]))
    new = [tuple([start + i] + [r[s] for s in d.sources]) for i, r in enumerate(fresh)]
    return local_table(spark, new, fields), local_table(spark, old + new, fields)


def process_batch(batch: DataFrame, batch_id: int, out_root: str,
                  layout: S.StarLayout = S.MAIN_STAR, spec: S.SurveySpec = S.SURVEY,
                  order_key: str | None = None) -> None:
    """Clean one micro-batch and upsert it into the star under ``out_root``.

    Rows are numbered by ``order_key``, ``row_key`` or the order of their files
    (``resolve_order``), after the last id of the ledger (one row per batch),
    never from a scan of the growing fact.  One grouping-sets pass over the
    numbered copy finds every dimension's tuples in the batch.  Dimensions
    bounded by their closed domains (the batch is validated) are ranked locally
    against the previous rows; larger ones take the distributed path.
    """
    spark = batch.sparkSession
    root = out_root.rstrip("/")
    clean = clean_survey(batch, spec, "declared")
    schemas = star_schemas(layout, clean.schema)
    dims_spec = list(layout.dims)
    bounds = [S.dimension_bound(spec, d) for d in dims_spec]
    small = all(b is not None and b <= S.BROADCAST_ROW_BOUND for b in bounds)
    ledger = _previous(spark, f"{root}/{LEDGER}", batch_id, schemas[LEDGER])
    start = _max_key(ledger, "last_record_id") + 1
    # staged once, numbered: the tuples and the fact read files, not the source
    fact = numbered_rows(clean, layout.record_key, resolve_order(clean, order_key), start=start)
    grouped, cols = star_grouping(fact, layout)

    def gid(d: S.DimSpec) -> int:
        return sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in d.sources)

    dims: dict[str, DataFrame] = {}
    if small:
        rows = grouped.collect()                      # bounded: sum of dimension sizes
        for d in dims_spec:
            prev = _previous(spark, f"{root}/{d.table}", batch_id, schemas[d.table])
            new, full = _local_new_tuples(spark, prev, [r for r in rows if r["_gid"] == gid(d)],
                                          d, clean.schema)
            _write_partition(new, f"{root}/{d.table}", batch_id)
            dims[d.table] = full
    else:
        grouped = reliable_checkpoint(grouped, "batch-tuples")
        for d in dims_spec:
            path = f"{root}/{d.table}"
            prev = _previous(spark, path, batch_id, schemas[d.table])
            seen = grouped.where(F.col("_gid") == gid(d))
            renamed = seen.select(*[F.col(s).alias(o) for s, o in d.columns], FIRST)
            if prev is not None:
                cond = [renamed[o].eqNullSafe(prev[o]) for o in d.outputs]
                renamed = renamed.join(prev.select(*d.outputs),
                                       reduce(lambda a, b: a & b, cond), "left_anti")
            first = _max_key(prev, d.key) + 1
            new = dense_index(renamed, [FIRST], d.key, start=first).select(
                F.col(d.key).cast("int").alias(d.key), *d.outputs)
            _write_partition(new, path, batch_id)
            dims[d.table] = (_read(spark, path, schemas[d.table]).filter(F.col(BATCH) <= batch_id)
                             .drop(BATCH))
    for d, b in zip(dims_spec, bounds):
        fact = lookup_key(fact, dims[d.table], d, b if small else None,
                          layout.null_safe_lookup, layout.strict_lookup)
    measures = [(F.col(src).cast(cast) if cast else F.col(src)).alias(out)
                for src, out, cast in layout.measures]
    fact = fact.select(layout.record_key, *measures, *[d.key for d in layout.dims])
    _write_partition(fact, f"{root}/{layout.fact_table}", batch_id)
    written = _read(spark, f"{root}/{layout.fact_table}", schemas[layout.fact_table]) \
        .filter(F.col(BATCH) == batch_id)
    summary = written.agg(F.coalesce(F.max(layout.record_key), F.lit(start - 1))
                          .cast("long").alias("last_record_id"),
                          F.count(F.lit(1)).alias("rows"))
    _write_partition(summary, f"{root}/{LEDGER}", batch_id)


# --- yearly CSV files ----------------------------------------------------------------

REJECTED = "_rejected"
REJECT_SCHEMA = "file string, block long, DATA_YEAR int, line string"
#: What the stream reads of a file.  ``content`` is never selected, so it is never read.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def load_files(spark: SparkSession, paths: list[str], batch_id: int, out_root: str,
               layout: S.StarLayout = S.MAIN_STAR, spec: S.SurveySpec = S.SURVEY) -> None:
    """Take yearly CSV files in as batch ``batch_id`` of the star under ``out_root``.

    Files whose path names no year are ignored.  A file without the target column
    is an error: it is no file of this survey, and a stream that passed over it
    would lose it silently.  The files of a year with a malformed row are set
    aside, and its rejected lines are kept in ``_rejected`` (see ``read_rejected``).
    """
    years: dict[int, list[str]] = {}
    for path in sorted(paths):
        year = files.year_of_path(path)
        if year is not None:
            years.setdefault(year, []).append(path)
    if not years:
        return
    with scratch_scope(spark):
        taken = take_in(spark, years, spec, files.KEY_COLUMNS, files.year_from(F.col("_metadata.file_path")),
                        strict_header=True, allow_none=True)
        _write_partition(taken.rejected, f"{out_root.rstrip('/')}/{REJECTED}", batch_id)
        process_batch(taken.rows, batch_id, out_root, layout, spec)


def start_year_stream(spark: SparkSession, source_dir: str, out_root: str, checkpoint: str,
                      files_per_trigger: int | None = None, layout: S.StarLayout = S.MAIN_STAR,
                      spec: S.SurveySpec = S.SURVEY):
    """Follow a folder of yearly CSV files or folders (``<year>.csv``, ``DATA_YEAR=<year>``).

    The stream's rows are file names, so the driver sees one name per new file
    of a micro-batch; ``files_per_trigger`` bounds them.
    """
    reader = (spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.where("length > 0").select("path").collect()]
        load_files(spark, paths, batch_id, out_root, layout, spec)

    return (reader.load(source_dir).select("path", "length").writeStream
            .foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_rejected(spark: SparkSession, out_root: str) -> DataFrame:
    """(file, block, DATA_YEAR, line): the rows that set a year's files aside, of all batches."""
    from pyspark.sql.types import StructType

    path = f"{out_root.rstrip('/')}/{REJECTED}"
    if not _exists(spark, path):
        return spark.createDataFrame([], REJECT_SCHEMA)
    return _read(spark, path, StructType.fromDDL(REJECT_SCHEMA)).drop(BATCH)


def start_incremental(spark: SparkSession, source_dir: str, schema: str, out_root: str,
                      checkpoint: str, fmt: str = "parquet", files_per_trigger: int | None = None,
                      layout: S.StarLayout = S.MAIN_STAR, spec: S.SurveySpec = S.SURVEY):
    """Start the stream; ``trigger(availableNow)`` drains what is there, then stops.

    ``files_per_trigger`` bounds a micro-batch (None: all new files in one).
    """
    reader = spark.readStream.schema(schema).format(fmt).option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(source_dir)
    return (stream.writeStream
                  .foreachBatch(lambda df, bid: process_batch(df, bid, out_root, layout, spec))
                  .option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())


def read_star(spark: SparkSession, out_root: str, layout: S.StarLayout = S.MAIN_STAR,
              spec: S.SurveySpec = S.SURVEY, schema: str | None = None) -> dict[str, DataFrame]:
    """The stored star; tables to which no batch has brought a row are empty."""
    raw = spark.createDataFrame([], schema or SURVEY_STREAM_SCHEMA)
    schemas = star_schemas(layout, clean_survey(raw, spec, "declared").schema)
    return {t: _read(spark, f"{out_root.rstrip('/')}/{t}", schemas[t]).drop(BATCH) for t in layout.tables}


# --- demo over the given tables ----------------------------------------------

SURVEY_STREAM_SCHEMA = ("row_key bigint, " + ", ".join(f"{c} double" for c in S.SELECTED_COLUMNS)
                        + ", DATA_YEAR int")


def arrive_year(staged_by_year: DataFrame, source_dir: str, year: int) -> None:
    """One year's survey file(s) land in the source folder (normal parallel write).

    ``staged_by_year`` is partitioned by year on disk, so the filter prunes the
    scan to that year's files: all arrivals together read the data once.
    """
    (staged_by_year.filter(F.col(S.YEAR_COLUMN) == year)
        .write.mode("append").parquet(source_dir))


def incremental_demo(spark: SparkSession, sf_dir: str,
                     layout: S.StarLayout = S.MAIN_STAR) -> dict[str, DataFrame]:
    """Yearly files arrive one year at a time; each arrival is drained by a run
    of the stream (``availableNow``) on the same checkpoint, as a weekly job
    would do.  Each run is one micro-batch, however many files the year has.
    Returns the loaded star.
    """
    from starloom.sources.survey import derived_survey

    from starloom.sources.sinks import write_stage

    src = scratch_path(spark, "e6-source")
    out = scratch_path(spark, "e6-star")
    ckpt = scratch_path(spark, "e6-checkpoint")
    # one pass over the given tables: the survey, partitioned by year
    raw = write_stage(derived_survey(spark, sf_dir, with_year=True),
                      scratch_path(spark, "e6-years"), partition_by=[S.YEAR_COLUMN])
    years = sorted(r[0] for r in raw.select(S.YEAR_COLUMN).distinct().collect())  # calendar years
    for year in years:
        arrive_year(raw, src, year)
        q = start_incremental(spark, src, SURVEY_STREAM_SCHEMA, out, ckpt, files_per_trigger=None, layout=layout)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_star(spark, out, layout)


def year_stream_demo(spark: SparkSession, source_dir: str, years: list[int],
                     arrive) -> tuple[dict[str, DataFrame], DataFrame]:
    """``arrive(year)`` lays a year's file down; the stream drains it, one batch a year, on one checkpoint."""
    out, ckpt = scratch_path(spark, "e6-year-star"), scratch_path(spark, "e6-year-checkpoint")
    for year in years:
        arrive(year)
        q = start_year_stream(spark, source_dir, out, ckpt)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_star(spark, out), read_rejected(spark, out)
