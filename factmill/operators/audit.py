"""The audit trail: steps of a field's making, which of them are kept, and the last one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chosen(steps: Column, interesting: Column, mode: str) -> Column:
    """All steps (full), none (off), or all of interesting rows and the last of others (gated)."""
    if mode == "off":
        return F.slice(steps, 1, 0)
    if mode == "full":
        return steps
    return F.when(interesting, steps).otherwise(F.slice(steps, -1, 1))


def interesting(touched: Column, verdict: Column, trust: Column) -> Column:
    return touched | ~F.coalesce(verdict == "correct", F.lit(False)) | (trust != "high")


def log(df: DataFrame, keys: list[str], mode: str = "gated") -> DataFrame:
    """(keys, step_seq from 1, fields of the step) from rows with steps (array of structs) and interesting."""
    kept = df.select(*keys, F.posexplode(chosen(F.col("steps"), F.col("interesting"), mode)).alias("_at", "_step"))
    return kept.select(*keys, (F.col("_at") + 1).alias("step_seq"), "_step.*")


def terminal(trail: DataFrame, keys: list[str], versions: DataFrame | None = None, version: str = "version_id") -> DataFrame:
    """The last step of each key, the later of two with the same number; of live versions only, if those are given."""
    order = Window.partitionBy(*keys).orderBy(F.desc("step_seq"), F.desc("created_at"))
    last = trail.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return last if versions is None else last.join(versions.select(version), version, "left_semi")
