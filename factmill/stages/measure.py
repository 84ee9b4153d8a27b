"""Measures of the fields against a truth set, appended run by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate, extract
from ..sources import providers
from ..sources.snapshots import Store
from .common import KEY, live

TABLE = "eval_results"


def scored(gold: DataFrame, truth: DataFrame, fields: list[dict], judge: providers.Provider = providers.rule_match) -> DataFrame:
    """(file_name, field_name, strategy, expected, actual, score, passed, rationale) from truth (file_name, field_name, expected, strategy).

    gold is the wide table; names meet in plain form, the last gold row of a name counts, and truth
    without gold is left out. A strategy in the truth goes before the kind's own.
    """
    names = list(extract.wide_schema(fields))
    kind = F.create_map(*[x for f in fields for x in (F.lit(f["field_name"]), F.lit((f.get("type") or "string").lower()))])
    values = F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"`{n}`").cast("string"))])
    rows = gold.select("file_name", KEY, values.alias("actuals"))
    found, _ = evaluate.join_truth(truth.withColumnRenamed("file_name", "name"), rows.withColumnRenamed("file_name", "name"), "name", KEY)
    asked = found.where(F.col("field_name").isin(names)).select(F.col("name").alias("file_name"), "field_name", evaluate.strategy(F.col("strategy"), F.lit(None).cast("string"), kind[F.col("field_name")]).alias("strategy"), "expected", F.try_element_at("actuals", F.col("field_name")).alias("actual"))
    return evaluate.score(asked, judge)


def run(store: Store, truth: DataFrame, fields: list[dict], run_id: str, now: Column, judge: providers.Provider = providers.rule_match) -> int:
    """Score the live fields and append the results under run_id; nothing to score is an error."""
    rows = store.staged(scored(live(store, "gold_fields"), truth, fields, judge).withColumns({"run_id": F.lit(run_id), "run_at": now}))
    if rows.isEmpty():
        raise ValueError("no document of the truth set has fields")
    done = store.commit(append={TABLE: rows})
    store.clear()
    return done
