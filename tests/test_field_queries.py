"""Queries over all documents that SQL doesn't express, against plain versions."""

from difflib import SequenceMatcher

from pyspark.sql import functions as F

from factmill.functions import text as T
from factmill.operators import extract
from factmill.plans import catalog, fields

SF = "/root/testdata/sf0.001"


def test_quote_queries_take_all_documents(spark):
    ids = sorted(r.doc_id for r in catalog.read(spark, SF, "documents").collect())
    assert sorted(r.doc_id for r in fields.locate_fuzzy(spark, SF).collect()) == ids
    got = {r.doc_id: r.ratio for r in fields.fuzzy_ratios(spark, SF).collect()}
    assert sorted(got) == ids
    quotes = fields._quotes(spark, SF)
    nq, nt = T.normalize(F.col("quote")), T.normalize(F.col("text"))
    for r in quotes.select("doc_id", nq.alias("q"), T.fuzzy_window(nq, nt).alias("w")).collect():
        wanted = None if r.q is None or r.w is None else SequenceMatcher(None, r.q, r.w).ratio()
        assert (got[r.doc_id] is None) == (wanted is None) and (wanted is None or abs(got[r.doc_id] - wanted) < 1e-8)


def test_prompts_are_cut_at_the_limit_only(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",), (None,)], "t string")
    q = F.array(F.struct(F.lit("f").alias("field_name"), F.lit("q?").alias("question")))
    got = [r.p for r in df.select(extract.prompt(q, F.col("t"), 3).alias("p")).collect()]
    assert got == ["Fields:\n- f: q?\n\nText:\n" + t for t in ("abc", "ab", "")]
