"""Queries over versioned tables, on orders as if they were documents of two days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..operators import scd2
from .catalog import query, read

DAY2, NOW = "2024-02-01", "2024-03-01"

_T = """t AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, 'v1' AS version_id, '2024-01-01' AS valid_from, CASE WHEN o_orderkey % 17 = 0 THEN '2024-01-15' END AS valid_to, o_orderkey % 17 <> 0 AS is_current, o_orderkey % 17 = 0 AS doc_deleted FROM orders WHERE o_orderkey % 10 < 7
  UNION ALL SELECT o_orderkey, o_orderstatus, 'v0', '2023-01-01', '2024-01-01', false, false FROM orders WHERE o_orderkey % 13 = 0),
s AS (SELECT o_orderkey AS k, o_orderpriority AS status, CASE WHEN o_orderkey % 7 = 0 THEN 'v2' ELSE 'v1' END AS version_id, '2024-02-01' AS valid_from FROM orders WHERE o_orderkey % 10 >= 4 AND o_orderkey % 11 <> 0),
l AS (SELECT * FROM t WHERE is_current AND NOT doc_deleted)"""
_COLUMNS = "k, status, version_id, valid_from, valid_to, is_current, doc_deleted"


def target(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    at = lambda d: F.lit(d).cast("timestamp")
    day1 = o.where(k % 10 < 7).select(k.alias("k"), F.col("o_orderstatus").alias("status"), F.lit("v1").alias("version_id"), at("2024-01-01").alias("valid_from"), F.when(k % 17 == 0, at("2024-01-15")).alias("valid_to"), (k % 17 != 0).alias("is_current"), (k % 17 == 0).alias("doc_deleted"))
    past = o.where(k % 13 == 0).select(k.alias("k"), F.col("o_orderstatus").alias("status"), F.lit("v0").alias("version_id"), at("2023-01-01").alias("valid_from"), at("2024-01-01").alias("valid_to"), F.lit(False).alias("is_current"), F.lit(False).alias("doc_deleted"))
    return day1.unionByName(past)


def source(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.where((k % 10 >= 4) & (k % 11 != 0)).select(k.alias("k"), F.col("o_orderpriority").alias("status"), F.when(k % 7 == 0, "v2").otherwise("v1").alias("version_id"), F.lit(DAY2).cast("timestamp").alias("valid_from"))


def show(df):
    """Dates as text, for comparison."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return df.select("k", "status", "version_id", day("valid_from"), day("valid_to"), "is_current", "doc_deleted")


@query("SELECT doc_id, substr(sha256(source || '/' || doc_id || '|' || sha256(text) || '|code1'), 1, 16) AS version_id FROM documents")
def version_ids(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", ids.version_id(F.concat_ws("/", "source", "doc_id"), F.sha2("text", 256), F.lit("code1")).alias("version_id"))


@query("""SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_\\-=]', '_', 'g') || '_b1__v1' AS safe_key,
substr(sha256(page_id || '|title'), 1, 16) AS evidence_id, substr(sha256(page_id || '|title|judge|2'), 1, 16) AS audit_id FROM pages""")
def surrogate_keys(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", ids.safe_key(F.col("url"), F.lit("b1"), F.lit("v1")).alias("safe_key"), ids.evidence_id(F.col("page_id"), F.lit("title")).alias("evidence_id"), ids.audit_id(F.col("page_id"), F.lit("title"), F.lit("judge"), F.lit(2)).alias("audit_id"))


@query(f"WITH {_T} SELECT {_COLUMNS} FROM l")
def live_rows(spark, sf_dir):
    return show(scd2.live(target(spark, sf_dir)))


@query(f"WITH {_T} SELECT {_COLUMNS} FROM t WHERE is_current")
def current_rows(spark, sf_dir):
    return show(scd2.current(target(spark, sf_dir)))


@query(f"WITH {_T} SELECT {_COLUMNS} FROM t WHERE doc_deleted OR NOT is_current")
def not_live_rows(spark, sf_dir):
    return show(scd2.not_live(target(spark, sf_dir)))


@query(f"""WITH {_T}
SELECT s.k, s.status, s.version_id, s.valid_from, NULL::VARCHAR AS valid_to, true AS is_current, false AS doc_deleted FROM s
UNION ALL SELECT l.k, l.status, l.version_id, l.valid_from, CASE WHEN s.k IS NOT NULL THEN s.valid_from ELSE l.valid_to END, s.k IS NULL, l.doc_deleted FROM l LEFT JOIN s ON l.k = s.k WHERE s.k IS NULL OR s.version_id <> l.version_id
UNION ALL SELECT {_COLUMNS} FROM t WHERE NOT (is_current AND NOT doc_deleted)""")
def scd2_merge(spark, sf_dir):
    return show(scd2.merge(target(spark, sf_dir), source(spark, sf_dir), "k"))


@query(f"""WITH {_T}
SELECT s.k, s.status, s.version_id, s.valid_from, NULL::VARCHAR AS valid_to, true AS is_current, false AS doc_deleted FROM s LEFT JOIN l ON l.k = s.k WHERE l.k IS NULL OR l.version_id <> s.version_id
UNION ALL SELECT l.k, CASE WHEN s.version_id = l.version_id THEN s.status ELSE l.status END, l.version_id, l.valid_from, CASE WHEN s.version_id <> l.version_id THEN s.valid_from ELSE l.valid_to END, coalesce(s.version_id = l.version_id, true), l.doc_deleted FROM l LEFT JOIN s ON l.k = s.k
UNION ALL SELECT {_COLUMNS} FROM t WHERE NOT (is_current AND NOT doc_deleted)""")
def scd2_refresh_only(spark, sf_dir):
    """An unchanged version refreshes the named columns and keeps its own dates."""
    return show(scd2.merge(target(spark, sf_dir), source(spark, sf_dir), "k", refresh=["status"]))


@query(f"""WITH {_T}, n AS (SELECT DISTINCT version_id FROM s WHERE version_id = 'v2')
SELECT k, status, version_id, valid_from, CASE WHEN hit THEN '{NOW}' ELSE valid_to END AS valid_to, CASE WHEN hit THEN false ELSE is_current END AS is_current, doc_deleted
FROM (SELECT t.*, is_current AND NOT doc_deleted AND t.k IN (SELECT k FROM s WHERE version_id = 'v2') AS hit FROM t) WHERE NOT (hit AND version_id IN (SELECT version_id FROM n))
UNION ALL SELECT k, status, version_id, valid_from, NULL, true, false FROM s WHERE version_id = 'v2'""")
def expire_append(spark, sf_dir):
    new = scd2.fresh(source(spark, sf_dir).where("version_id = 'v2'"))
    return show(scd2.expire_and_append(target(spark, sf_dir), new, new, "k", F.lit(NOW).cast("timestamp")))


@query(f"""WITH {_T} SELECT k, status, version_id, valid_from, CASE WHEN gone THEN '{NOW}' ELSE valid_to END AS valid_to, is_current AND NOT gone AS is_current, doc_deleted OR gone AS doc_deleted
FROM (SELECT t.*, is_current AND NOT doc_deleted AND k NOT IN (SELECT k FROM s) AS gone FROM t)""")
def tombstone_absent(spark, sf_dir):
    return show(scd2.tombstone(target(spark, sf_dir), source(spark, sf_dir), "k", F.lit(NOW).cast("timestamp")))


@query(f"WITH {_T} SELECT {_COLUMNS} FROM t WHERE valid_from <= '2023-06-01' AND (valid_to IS NULL OR '2023-06-01' < valid_to)")
def as_of_date(spark, sf_dir):
    return show(scd2.as_of(target(spark, sf_dir), F.lit("2023-06-01").cast("timestamp")))


@query(f"WITH {_T} SELECT s.k, s.version_id FROM s LEFT JOIN (SELECT * FROM t WHERE is_current) c ON s.k = c.k WHERE c.k IS NULL OR c.version_id <> s.version_id")
def changed_detection(spark, sf_dir):
    return scd2.changed(source(spark, sf_dir), target(spark, sf_dir), "k", ["version_id"]).select("k", "version_id")


@query(f"""WITH {_T}, v AS (SELECT k, substr(sha256(k || '|' || version_id || '|c1'), 1, 16) AS version_id FROM s), d AS (SELECT substr(sha256(k || '|' || version_id || '|c1'), 1, 16) AS version_id FROM t WHERE is_current)
SELECT k, version_id FROM v WHERE version_id NOT IN (SELECT version_id FROM d)""")
def pending_versions(spark, sf_dir):
    stamp = ids.version_id(F.col("k"), F.col("version_id"), F.lit("c1"))
    return scd2.pending(source(spark, sf_dir).withColumn("version_id", stamp), target(spark, sf_dir).withColumn("version_id", stamp)).select("k", "version_id")


@query("""SELECT source || '/' || doc_id AS path, doc_id % 5 = 0 AS pending FROM documents WHERE doc_id % 5 = 0 OR source || '/' || doc_id IN ('src1/1', 'src2/2', 'src5/5')""")
def force_subset(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "doc_id").alias("path"), (F.col("doc_id") % 5 == 0).alias("pending"))
    return scd2.apply_force(d, d.where("pending"), scd2.force_selection("src1/1, src2/2\nsrc5/5", None), "path")


@query(f"""WITH {_T} SELECT DISTINCT k FROM t WHERE (doc_deleted OR NOT is_current) AND k NOT IN (SELECT k FROM l)""")
def stale_index_ids(spark, sf_dir):
    return scd2.stale_in_index(target(spark, sf_dir), "k")


@query(f"""WITH {_T} SELECT k, status, version_id, valid_from, CASE WHEN gone THEN '{NOW}' ELSE valid_to END AS valid_to, is_current AND NOT gone AS is_current, doc_deleted OR gone AS doc_deleted
FROM (SELECT t.*, is_current AND NOT doc_deleted AND version_id || k NOT IN (SELECT version_id || k FROM s) AS gone FROM t)""")
def self_heal(spark, sf_dir):
    """Live rows whose version isn't valid any more are closed."""
    pair = F.concat("version_id", "k")
    healed = scd2.tombstone(target(spark, sf_dir).withColumn("pair", pair), source(spark, sf_dir).withColumn("pair", pair), "pair", F.lit(NOW).cast("timestamp"))
    return show(healed)


@query(f"WITH {_T} SELECT count(*) AS n, count(*) FILTER (WHERE is_current AND NOT doc_deleted) AS n_live, max(valid_from) AS latest, count(DISTINCT version_id) AS versions FROM t")
def run_summary(spark, sf_dir):
    t = target(spark, sf_dir)
    return t.agg(F.count("*").alias("n"), F.count_if(scd2.is_live()).alias("n_live"), F.date_format(F.max("valid_from"), "yyyy-MM-dd").alias("latest"), F.countDistinct("version_id").alias("versions"))
