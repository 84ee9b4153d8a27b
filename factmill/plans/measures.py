"""Queries over measures of quality against a truth set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import matchers as M
from ..functions import values as V
from ..operators import evaluate as E
from .catalog import query, read

_PLAIN = "trim(regexp_replace(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}_ \\t\\n\\r\\f\\x0B]', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ')"


@query(f"SELECT doc_id, {_PLAIN.format('text')} AS plain FROM documents")
def plain_texts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", M.plain(F.col("text")).alias("plain"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN false END AS b, strftime(o_orderdate, '%Y-%m-%d') AS d, round(o_totalprice, 2) AS n FROM orders""")
def typed_readings(spark, sf_dir):
    k = F.col("o_orderkey")
    word = F.when(k % 3 == 0, " Yes").when(k % 3 == 1, "0").otherwise("maybe")
    pattern = F.when(k % 4 == 0, F.date_format("o_orderdate", "d MMMM yyyy")).when(k % 4 == 1, F.date_format("o_orderdate", "d/M/yyyy")).when(k % 4 == 2, F.concat(F.lit("on "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("."))).otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    price = F.concat(F.lit("USD "), F.format_number("o_totalprice", 2), F.lit(" net"))
    return read(spark, sf_dir, "orders").select("o_orderkey", V.to_bool(word).alias("b"), V.to_date(pattern).alias("d"), F.round(V.to_number(price), 2).alias("n"))


@query("""SELECT p_partkey, p_name || '|' || p_brand AS items FROM part""")
def list_readings(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_name"), F.lit(" ; \n"), F.col("p_brand"))).otherwise(F.to_json(F.array("p_name", F.lit(" "), "p_brand")))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(V.as_list(text), "|").alias("items"))


_PRED = "SELECT doc_id, quality, toxic, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS guess, lang, source FROM labels JOIN documents USING (doc_id)"


def _results(spark, sf_dir):
    d = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id")
    guess = (F.col("n_chars") > 1000).cast("int").cast("string")
    rows = d.select("doc_id", "lang", "source", F.lit("bool").alias("strategy"), F.col("quality").cast("string").alias("expected"), guess.alias("actual"))
    return E.score(rows)


@query(f"SELECT doc_id, (quality = guess)::INT::DOUBLE AS score, quality = guess AS passed FROM ({_PRED})")
def eval_bool(spark, sf_dir):
    return _results(spark, sf_dir).select("doc_id", "score", "passed")


@query("SELECT l_orderkey, l_linenumber, (l_quantity = l_linenumber * 5)::INT::DOUBLE AS score FROM lineitem")
def eval_numeric(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", M.number_score(F.concat(F.lit("about "), F.col("l_quantity").cast("string")), (F.col("l_linenumber") * 5).cast("string")).alias("score"))


@query("SELECT o_orderkey, (day(o_orderdate) <= 14)::INT::DOUBLE AS score FROM orders")
def eval_date(spark, sf_dir):
    expected = F.date_format("o_orderdate", "yyyy-MM-dd")
    moved = F.when(F.dayofmonth("o_orderdate") <= 14, F.col("o_orderdate")).otherwise(F.col("o_orderdate") - F.expr("interval 1 day"))
    return read(spark, sf_dir, "orders").select("o_orderkey", M.date_score(expected, F.date_format(moved, "d MMM yyyy")).alias("score"))


@query("SELECT c_custkey, (c_mktsegment = 'BUILDING')::INT::DOUBLE AS score FROM customer")
def eval_string(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", M.string_score(F.lit("Building!"), F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("score"))


@query("""WITH t AS (SELECT conv_id, list_distinct(list_filter(list_transform(regexp_split_to_array(string_agg(role || ',' || text, ',' ORDER BY turn), '[,;\\n]'), lambda x: """ + _PLAIN.format("x") + """), lambda x: length(x) > 0)) AS e FROM conversations GROUP BY 1),
a AS (SELECT conv_id, list_distinct(list_filter(list_transform(string_split(string_agg(substr(role, 1, 4) || ',' || lang, ','), ','), lambda x: """ + _PLAIN.format("x") + """), lambda x: length(x) > 0)) AS a FROM (SELECT *, 'system' AS lang FROM conversations WHERE turn < 2) GROUP BY 1),
s AS (SELECT conv_id, len(list_filter(e, lambda x: len(list_filter(a, lambda y: contains(x, y) OR contains(y, x))) > 0)) / len(e) AS r, len(list_filter(a, lambda x: len(list_filter(e, lambda y: contains(x, y) OR contains(y, x))) > 0)) / len(a) AS p FROM t JOIN a USING (conv_id))
SELECT conv_id, round(CASE WHEN r + p > 0 THEN 2 * r * p / (r + p) ELSE 0 END, 9)::DOUBLE AS f1 FROM s""")
def eval_set_f1(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    joined = lambda x, df: df.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", x.alias("x")))), lambda r: r["x"]), ",").alias("t"))
    e = joined(F.concat("role", F.lit(","), "text"), c)
    a = joined(F.concat(F.substring("role", 1, 4), F.lit(",system")), c.where("turn < 2")).withColumnRenamed("t", "u")
    return e.join(a, "conv_id").select("conv_id", F.round(M.set_f1(F.col("t"), F.col("u")), 9).alias("f1"))


@query()
def eval_fuzzy(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", F.round(M.fuzzy_score(F.col("p_name"), F.col("p_type")), 9).alias("score"))


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 7 = 0 THEN 'fuzzy' END, CASE WHEN lang = 'en' THEN 'date' END, CASE source WHEN 'src1' THEN 'bool' WHEN 'src2' THEN 'numeric' WHEN 'src3' THEN 'set_f1' WHEN 'src4' THEN 'judge' ELSE 'string' END) AS strategy FROM documents")
def eval_strategy(spark, sf_dir):
    kind = F.when(F.col("source") == "src1", "boolean").when(F.col("source") == "src2", "integer").when(F.col("source") == "src3", "list").when(F.col("source") == "src4", "struct_list").otherwise("string")
    return read(spark, sf_dir, "documents").select("doc_id", E.strategy(F.when(F.col("doc_id") % 7 == 0, "fuzzy"), F.when(F.col("lang") == "en", "date"), kind).alias("strategy"))


@query("""SELECT c_custkey, n_name AS gold FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey % 2 = 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_nationkey % 2 = 1""")
def truth_join(spark, sf_dir):
    """Names meet in plain form; of two gold rows with one name the later counts; truth without gold is listed too."""
    n = read(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("F-"), F.col("n_nationkey").cast("string"), F.lit(".PDF")).alias("file_name"), "n_name", F.lit(1).alias("ordinal"))
    old = n.withColumns({"n_name": F.lit("old"), "ordinal": F.lit(0)})
    t = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("f "), F.col("c_nationkey").cast("string"), F.lit(" pdf")).alias("file_name"))
    found, missing = E.join_truth(t, n.unionByName(old))
    return found.select("c_custkey", F.col("n_name").alias("gold")).unionByName(missing.select("c_custkey", F.lit(None).cast("string").alias("gold")))


@query(f"""SELECT lang, source, round(avg((quality = guess)::INT), 9) AS accuracy, count(*) AS n FROM ({_PRED}) GROUP BY GROUPING SETS ((), (lang), (source))""")
def eval_rollup(spark, sf_dir):
    return E.rollup(_results(spark, sf_dir), "lang", "source").withColumn("accuracy", F.round("accuracy", 9))
