"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zlib

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import bound_batches, spread  # noqa: F401

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _LIBC = None

#: Largest table, in estimated bytes, that an operator broadcasts; beyond it the same join shuffles.
BROADCAST_BYTES = 16 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; where none is set a local session makes one for itself, and any other fails."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="factmill-checkpoint-"))


def shared_dir(spark: SparkSession) -> str:
    """The folder, seen by driver and executors, for tables that outlive one plan."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df as a Parquet table in the shared checkpoint folder and read it back, which cuts its lineage there.

    A written table is smaller than a checkpoint of rows, and the planner knows its size.
    """
    path = f"{shared_dir(df.sparkSession)}/cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete tables of cut() that no plan reads any more."""
    for df in tables:
        remove_folder(df.sparkSession, df._cut_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def broadcast_if_small(df: DataFrame, row_bytes: int, *arrays: str, item_bytes: int = 24, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df (already materialised) with a broadcast hint if its rows, and the items of its array columns, fit the limit; else df itself."""
    return F.broadcast(df) if real_bytes(df, *arrays, row_bytes=row_bytes, item_bytes=item_bytes) <= limit else df


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


def as_text(column: pa.Array) -> list[str]:
    """A string column; null counts as empty."""
    return ["" if v is None else v for v in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20):
    """Cut a batch into runs of rows that hold about max_bytes of text, so that very long texts don't pile up."""
    sizes = batch.column(column).cast(pa.binary()) if not pa.types.is_binary(batch.column(column).type) else batch.column(column)
    start = held = 0
    lengths = pa.compute.binary_length(sizes).to_pylist()
    for i, n in enumerate(lengths):
        held += n or 0
        if held >= max_bytes:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(lengths):
        yield batch.slice(start)


def row_key(*columns: Column) -> Column:
    """Names a row by a 128-bit digest: rows that agree in these columns, of any type, are one. Made without Python, so that no stage has two Python steps for it."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def by_place(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1 ...: no name of an operator's own can clash with them, nor two that differ in case only."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def keyed(placed: DataFrame, text_at: int, id_at: int) -> DataFrame:
    """by_place() rows with a last column key: rows that agree in id and text are one document (a null text counts as empty)."""
    return placed.withColumn("key", row_key(F.col(f"c{id_at}"), F.coalesce(F.col(f"c{text_at}"), F.lit(""))))


def real_bytes(df: DataFrame, *arrays: str, row_bytes: int = 60, item_bytes: int = 24) -> int:
    """Bytes that df (already materialised) takes when broadcast: so many a row and an item of its array columns."""
    items = sum((F.coalesce(F.size(a), F.lit(0)).cast("bigint") for a in arrays), F.lit(0).cast("bigint"))
    n, held = df.agg(F.count("*"), F.coalesce(F.sum(items), F.lit(0))).first()
    return n * row_bytes + held * item_bytes


def crc_of_id(doc_id) -> int:
    """CRC-32 of an id written as text (null: of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def give_back() -> None:
    """Return what this process doesn't use any more to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


_single = False


def single_thread() -> None:
    """NumPy's matrix products on one thread in this worker: the cores belong to Spark's tasks, and more threads only wait for each other on small products."""
    global _single
    if _single:
        return
    _single = True
    try:
        with open("/proc/self/maps") as f:
            libraries = {line.split(None, 5)[5].strip() for line in f if "openblas" in line}
    except OSError:  # another system: its threads stay as they are
        return
    for path in libraries:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def tidy(run, pause_gc: bool = False):
    """run, for mapInArrow, giving back the memory that it held once it ends: a worker lives on for other stages.

    With pause_gc the search for cycles rests meanwhile, for steps that make many objects and no cycles.
    """

    def whole(batches):
        single_thread()
        if pause_gc:
            gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
            give_back()

    return whole


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """df with place, its rows' numbers from 0 in that order; sorted range by range, so that no task sees all."""
    ranged = df.repartitionByRange(*order).withColumn("rid", F.spark_partition_id())
    placed = cut(ranged.withColumn("rn", F.row_number().over(Window.partitionBy("rid").orderBy(*order))))
    before, offsets = 0, []
    for r in sorted(placed.groupBy("rid").count().collect()):  # a row for each shuffle partition
        offsets.append((r[0], before))
        before += r[1]
    if not offsets:
        return placed.select(*df.columns, F.lit(None).cast("bigint").alias("place"))
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, "rid int, before bigint"))
    return placed.join(table, "rid").select(*df.columns, (F.col("before") + F.col("rn") - 1).cast("bigint").alias("place"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
