"""Session construction and lineage cutting.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``,
which is read from the session.  Only a local session without that setting
(tests, scripts) gets a folder of its own; on a cluster the call fails, since
no other folder is known to be shared by the executors.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "starloom", cores: int | str = "*",
              shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests, bench and scripts (cluster jobs pass their own)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.constraintPropagation.enabled", "false")
         .config("spark.sql.codegen.hugeMethodLimit", "8000")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written stage tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Removes, at its end, every scratch table written inside it.

    For runs whose results are published elsewhere: nothing built inside may
    be read afterwards.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_table(spark, path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Deletes a written table; none there is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table_bytes(spark: SparkSession, path: str, suffix: str = "") -> int:
    """Bytes of the files directly or deeper under ``path``, from the file system (no Spark job)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    total = 0
    while files.hasNext():
        f = files.next()
        if f.getPath().getName().endswith(suffix):
            total += f.getLen()
    return total


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/starloom-{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def reliable_checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder.

    Cuts the lineage like ``checkpoint()`` and survives executor loss (a lost
    task re-reads the written files, never recomputes the source), but the
    table is columnar: later passes read only the columns they use.  Anything
    that must stay fixed between passes (e.g. partition id and position for
    numbering) is stored as a column, so it does not depend on how the files
    are split when read back.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer-reading inference job on the way back
    return spark.read.schema(df.schema).parquet(path)


# Above this many rows the SQL text of an inline table would cost more to parse
# than shipping the rows (e.g. one offset row per partition at 100 TB).
INLINE_MAX_ROWS = 5_000


def local_table(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A small driver-side table as an inline ``VALUES`` relation.

    Only for rows whose count is proven small (dimension tuples over closed
    domains, one row per partition).  ``createDataFrame`` on a list would ship
    pickled rows through Python workers; an inline table is a local relation
    that the JVM scans directly.  Types the SQL literal cannot express, and
    more than ``INLINE_MAX_ROWS`` rows, fall back to ``createDataFrame``.
    """
    from pyspark.sql.types import StructType

    from starloom.functions.recode import quote, sql_literal

    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)

    def lit(v) -> str:
        return "NULL" if v is None else sql_literal(v)
    try:
        body = "" if len(rows) > INLINE_MAX_ROWS else \
            ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    except TypeError:
        body = ""
    if not body:
        return spark.createDataFrame(rows, schema)
    names = [f"c{i}" for i in range(len(schema.fields))]
    # An inline column without a NULL is non-nullable; IF(FALSE, NULL, c) keeps
    # the declared nullability whatever the rows hold (the optimizer folds it).
    cols = ", ".join(
        f"CAST({f'IF(FALSE, NULL, {n})' if f.nullable else n} AS {f.dataType.simpleString()})"
        f" AS {quote(f.name)}" for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({', '.join(names)})")

