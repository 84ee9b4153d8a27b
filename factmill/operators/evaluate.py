"""Quality against a truth set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import matchers as M
from ..sources.providers import Provider, call, rule_match


def strategy(override: Column, table: Column, kind: Column) -> Column:
    by_kind = F.when(kind == "boolean", "bool").when(kind.isin("integer", "number"), "numeric").when(kind == "list", "set_f1").when(kind == "struct_list", "judge").otherwise("string")
    return F.coalesce(override, table, by_kind)


def join_truth(truth: DataFrame, gold: DataFrame, name: str = "file_name", order: str = "ordinal") -> tuple[DataFrame, DataFrame]:
    """(truth rows with their gold row, truth rows without one); names meet in plain form, the last gold row of a name counts."""
    key = M.plain(F.col(name))
    last = Window.partitionBy("_k").orderBy(F.desc(order))
    g = gold.withColumn("_k", key).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", name)
    t = truth.withColumn("_k", key)
    return t.join(g, "_k").drop("_k"), t.join(g, "_k", "left_anti").drop("_k")


def score(df: DataFrame, judge: Provider = rule_match) -> DataFrame:
    """df (strategy, expected, actual) with score, passed and rationale.

    Fuzzy rows alone go through Python, and judge rows alone to the provider: its score is held to
    0 to 1, and a call that fails, or an answer without a score, counts 0 with the error as rationale.
    """
    e, a, s = F.col("expected"), F.col("actual"), F.col("strategy")
    plain = F.when(s == "bool", M.bool_score(e, a)).when(s == "numeric", M.number_score(e, a)).when(s == "date", M.date_score(e, a)).when(s == "set_f1", M.set_f1(e, a)).otherwise(M.string_score(e, a))
    none = F.lit(None).cast("string")
    by_column = df.where(~s.isin("fuzzy", "judge")).withColumns({"score": plain, "rationale": none})
    fuzzy = df.where(s == "fuzzy").withColumns({"score": M.fuzzy_score(e, a), "rationale": none})
    asked = call(df.where(s == "judge").withColumn("_request", F.to_json(F.struct("expected", "actual"), {"ignoreNullFields": "false"})), "_request", judge)
    answer = F.from_json("payload", "score double, verdict string, rationale string")
    told = F.concat(F.coalesce(answer["verdict"], F.lit("?")), F.lit(": "), F.coalesce(answer["rationale"], F.lit("")))
    judged = asked.withColumns({
        "score": F.when(F.col("ok"), F.coalesce(F.least(F.greatest(answer["score"], F.lit(0.0)), F.lit(1.0)), F.lit(0.0))).otherwise(0.0),
        "rationale": F.when(F.col("ok"), told).otherwise(F.concat(F.lit("judge_error: "), F.col("error"))),
    })
    scored = by_column.unionByName(fuzzy).unionByName(judged.select(by_column.columns))
    return scored.withColumn("passed", M.passed(s, F.col("score")))


def rollup(results: DataFrame, field: str = "field_name", doc: str = "file_name") -> DataFrame:
    """Accuracy overall, by field and by document in one pass."""
    sets = results.groupingSets([[], [field], [doc]], field, doc)
    return sets.agg(F.avg(F.col("passed").cast("int")).alias("accuracy"), F.count("*").alias("n"))
