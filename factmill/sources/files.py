"""File inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = ("pdf", "docx", "doc")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^./\\]+)$", 1))


def relative_path(path: Column, root: str) -> Column:
    """The path without scheme and without the first occurrence of root."""
    plain = F.regexp_replace(path, r"^file:(//)?", "")
    at = F.instr(plain, root.rstrip("/"))
    cut = F.substr(plain, at + F.lit(len(root.rstrip("/"))))
    return F.regexp_replace(F.when(at > 0, cut).otherwise(plain), "^/+", "")


def listing(spark: SparkSession, root: str, extensions=EXTENSIONS) -> DataFrame:
    """(relative_path, file_name, size_bytes, content_hash) of the files under root; hashing runs where the bytes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(extension(name).isin(*extensions)).select(
        relative_path(F.col("path"), root).alias("relative_path"), name.alias("file_name"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("content_hash")
    )


def spread(df: DataFrame) -> DataFrame:
    """A table that is read in fewer parts than there are cores, dealt over them; larger ones as they are.

    Only tables of less than a part for each core are moved, so what is shuffled stays small whatever the data.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    part = int(str(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if size < part * cores and size > 1 << 20 and -(-size // part) < cores else df


def bound_batches(spark: SparkSession) -> None:
    """Hold the batches that go to Python to a few megabytes; by default Spark lets them grow to 64 MB.

    Set for the session, as plans run after the operator has returned. Settings that were changed
    from the default are kept.
    """
    for key, default, most in (("maxRecordsPerBatch", "10000", "1000"), ("maxBytesPerBatch", "67108864b", "4m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", default) == default:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", most)
