"""Queries that run whole stages over a store of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import scd2
from ..operators import search as S
from ..sources import providers
from ..sources.files import spread
from ..sources.snapshots import Store, scratch
from ..stages import bronze, chunk, gold, measure, silver
from .catalog import ORACLES, query, read
from .documents import _BM, _NORM, _WS
from .history import _T, source, target

_AT = lambda day: F.lit(day).cast("timestamp")
_DAY = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)


def _store(spark) -> Store:
    return Store(spark, scratch(spark))


@query("""WITH a AS (SELECT url AS relative_path, page_id, sha256(html) AS h FROM pages WHERE page_id % 10 < 8), b AS (SELECT url AS relative_path, page_id, sha256(html || CASE WHEN page_id % 7 = 0 THEN 'new' ELSE '' END) AS h FROM pages WHERE page_id % 10 >= 2),
v AS (SELECT coalesce(a.relative_path, b.relative_path) AS relative_path, coalesce(a.page_id, b.page_id) AS page_id, a.h AS ha, b.h AS hb FROM a FULL JOIN b ON a.relative_path = b.relative_path)
SELECT page_id, content_hash, substr(sha256(relative_path || '|' || content_hash || '|c1'), 1, 16) AS version_id, valid_from, valid_to, first_seen_at, last_seen_at, is_current, doc_deleted FROM (
SELECT relative_path, page_id, ha AS content_hash, '2024-01-01' AS valid_from, CASE WHEN hb IS NULL OR ha <> hb THEN '2024-01-02' END AS valid_to, '2024-01-01' AS first_seen_at, CASE WHEN ha = hb THEN '2024-01-02' ELSE '2024-01-01' END AS last_seen_at, coalesce(ha = hb, false) AS is_current, hb IS NULL AS doc_deleted FROM v WHERE ha IS NOT NULL
UNION ALL SELECT relative_path, page_id, hb, '2024-01-02', NULL, '2024-01-02', '2024-01-02', true, false FROM v WHERE hb IS NOT NULL AND (ha IS NULL OR ha <> hb))""")
def stage_bronze(spark, sf_dir):
    """Two days of an inventory: unchanged, changed, new and missing files; an empty listing in between changes nothing."""
    p = read(spark, sf_dir, "pages")
    i = F.col("page_id")
    files = lambda df, html: df.select(F.col("url").alias("relative_path"), i.cast("string").alias("file_name"), F.length("html").alias("size_bytes"), F.sha2(html, 256).alias("content_hash"))
    store = _store(spark)
    bronze.run(store, files(p.where(i % 10 < 8), F.col("html")), "c1", _AT("2024-01-01"))
    bronze.run(store, files(p.limit(0), F.col("html")), "c1", _AT("2024-01-01"))
    bronze.run(store, files(p.where(i % 10 >= 2), F.concat("html", F.when(i % 7 == 0, "new").otherwise(""))), "c1", _AT("2024-01-02"))
    return store.read(bronze.TABLE).select(F.col("file_name").cast("bigint").alias("page_id"), "content_hash", "version_id", *map(_DAY, ("valid_from", "valid_to", "first_seen_at", "last_seen_at")), "is_current", "doc_deleted")


_LINE = f"""e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT doc_id, i, line, contains(line, ' | ') AS bar, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos, CASE WHEN length(line) < 40 THEN 'sectionHeading' WHEN length(line) % 11 = 0 THEN 'pageFooter' END AS role, 1 + (i - 1) // 40 AS page, 1 - length(line) % 7 / 10.0 AS conf FROM e),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, bar ORDER BY i) AS run FROM p),
c AS (SELECT doc_id, run, i, unnest(string_split(line, ' | ')) AS cell, generate_subscripts(string_split(line, ' | '), 1) AS k FROM g WHERE bar),
n AS (SELECT doc_id, run, max(k) AS cols, min(i) AS first, max(i) AS last FROM c GROUP BY 1, 2),
r AS (SELECT n.doc_id, n.run, g.i, n.first, n.cols, '| ' || (SELECT string_agg(replace(trim(coalesce(list_extract(string_split(g.line, ' | '), z), ''), {_WS}), '|', chr(92) || '|'), ' | ' ORDER BY z) FROM (SELECT unnest(generate_series(1, n.cols)) AS z)) || ' |' AS row FROM n JOIN g ON g.doc_id = n.doc_id AND g.run = n.run AND g.bar),
t AS (SELECT r.doc_id, r.run, string_agg(row || CASE WHEN r.i = first THEN chr(10) || '| ' || repeat('--- | ', cols - 1) || '--- |' ELSE '' END, chr(10) ORDER BY r.i) AS text, min(g.pos) AS start, min(g.page) AS page, min(g.conf) AS conf_min, avg(g.conf) AS conf_mean FROM r JOIN g ON g.doc_id = r.doc_id AND g.i = r.i GROUP BY 1, 2),
u AS (SELECT doc_id, 'prose' AS type, role, trim(line, {_WS}) AS text, pos AS start, page, CASE WHEN length(line) > 0 THEN conf END AS conf_min, CASE WHEN length(line) > 0 THEN conf END AS conf_mean, 0 AS kind FROM p WHERE NOT bar AND coalesce(role, '') <> 'pageFooter'
UNION ALL SELECT doc_id, 'table', NULL, text, start, page, conf_min, conf_mean, 1 FROM t)"""


@query(f"""WITH {_LINE}, b AS (SELECT * FROM u WHERE trim(text, {_WS}) <> '')
SELECT doc_id, (row_number() OVER w - 1)::INT AS block_index, type, last_value(CASE WHEN role = 'sectionHeading' THEN text END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS section, page::INT AS page, text, length(text)::INT AS char_count, round(conf_min, 6)::DOUBLE AS conf_min, round(conf_mean, 6)::DOUBLE AS conf_mean FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY start, kind)""")
def stage_silver_blocks(spark, sf_dir):
    """Documents through the layout port to blocks: headings, furniture, tables of lines with bars, confidence of words."""
    d = read(spark, sf_dir, "documents")
    files = d.select(F.col("doc_id").cast("string").alias("relative_path"), F.col("text").alias("content"))
    _, blocks, _ = silver.extract(_store(spark).staged(silver.analysed(spread(files))))  # analysed once
    return blocks.select(F.col("relative_path").cast("bigint").alias("doc_id"), "block_index", "type", "section", "page", "text", "char_count", F.round("conf_min", 6).alias("conf_min"), F.round("conf_mean", 6).alias("conf_mean"))


@query(f"""WITH {_LINE}, q AS (SELECT doc_id, avg((conf >= 0.9)::INT) AS q FROM p GROUP BY 1), h AS (SELECT doc_id, count(*) AS n FROM n GROUP BY 1)
SELECT d.doc_id, length(trim(d.text, {_WS}))::INT AS n_chars, (1 + (length(d.text) - length(replace(d.text, chr(10), ''))) // 40)::INT AS page_count, coalesce(h.n, 0) > 0 AS has_tables, round(q.q, 6)::DOUBLE AS di_quality, CASE WHEN q.q < 0.6 THEN 'low' ELSE 'ok' END AS di_quality_flag, d.doc_id % 2 = 1 AS is_current, d.doc_id % 2 = 0 AS doc_deleted
FROM documents d JOIN q USING (doc_id) LEFT JOIN h USING (doc_id)""")
def stage_silver_text(spark, sf_dir):
    """Two runs of the stage over an inventory: files that are gone in the second are closed, the others keep their version."""
    d = read(spark, sf_dir, "documents")
    files = d.select(F.col("doc_id").cast("string").alias("relative_path"), F.col("doc_id").cast("string").alias("file_name"), F.sha2("text", 256).alias("content_hash"), F.col("text").alias("content"))
    store = _store(spark)
    silver.run(store, files, "c1", _AT("2024-01-01"))
    silver.run(store, files.where("cast(file_name AS bigint) % 2 = 1"), "c1", _AT("2024-01-02"))
    return store.read(silver.TEXT).select(F.col("relative_path").cast("bigint").alias("doc_id"), F.length("extracted_text").alias("n_chars"), "page_count", "has_tables", F.round("di_quality", 6).alias("di_quality"), "di_quality_flag", "is_current", "doc_deleted")


_PIECES = f"""x AS (SELECT doc_id, block_index, type, section, text FROM b0), o AS (SELECT *, length(text) >= 516 AND type = 'prose' AS long FROM x),
k AS (SELECT doc_id, block_index, type, section, 0 AS part, text FROM o WHERE NOT long
UNION ALL SELECT doc_id, block_index, type, section, part, trim(substr(t, part * 448 + 1, 512), ' ') FROM (SELECT *, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ') AS t, unnest(generate_series(0, CASE WHEN length(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ')) > 512 THEN ceil((length(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ')) - 512) / 448.0)::INT ELSE 0 END)) AS part FROM o WHERE long)),
v AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY block_index, part) AS i, greatest(1, length(text) // 4) AS tok, type = 'table' AS atomic FROM k),
w AS (SELECT doc_id, i, type, section, text, atomic, 0 AS pack, tok AS held FROM v WHERE i = 1
UNION ALL SELECT v.doc_id, v.i, v.type, v.section, v.text, v.atomic, CASE WHEN w.atomic OR v.atomic OR w.held + v.tok > 128 THEN w.pack + 1 ELSE w.pack END, CASE WHEN w.atomic OR v.atomic OR w.held + v.tok > 128 THEN v.tok ELSE w.held + v.tok END FROM w JOIN v ON v.doc_id = w.doc_id AND v.i = w.i + 1),
m AS (SELECT doc_id, pack AS chunk_index, first(section ORDER BY i) FILTER (WHERE coalesce(section, '') <> '') AS section, string_agg(text, chr(10) || chr(10) ORDER BY i) AS body, CASE WHEN count(DISTINCT type) = 1 THEN min(type) ELSE 'mixed' END AS block_type, count(*) AS n_units FROM w GROUP BY 1, 2)
SELECT doc_id, chunk_index::INT AS chunk_index, CASE WHEN section IS NOT NULL THEN '## ' || section || chr(10) || chr(10) || body ELSE body END AS text, block_type, section, n_units::INT AS n_units FROM m"""


ORACLES["chunk_documents"] = f"""WITH RECURSIVE e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
f AS (SELECT *, CASE WHEN length(line) < 40 THEN 'sectionHeading' WHEN length(line) % 11 = 0 THEN 'pageFooter' END AS role FROM e),
b0 AS (SELECT doc_id, row_number() OVER w - 1 AS block_index, CASE WHEN contains(line, ' | ') THEN 'table' ELSE 'prose' END AS type, last_value(CASE WHEN role = 'sectionHeading' THEN line END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS section, trim(line, {_WS}) AS text FROM f WHERE coalesce(role, '') <> 'pageFooter' AND trim(line, {_WS}) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
{_PIECES.replace("n_units::INT AS n_units FROM m", "1 AS page, NULL::VARCHAR AS table_id, NULL::VARCHAR AS figure_uri, n_units::INT AS n_units, length(CASE WHEN section IS NOT NULL THEN '## ' || section || chr(10) || chr(10) || body ELSE body END)::INT AS char_count FROM m")}"""


@query(f"""WITH RECURSIVE e AS (SELECT doc_id, unnest(string_split(replace(text, ' | ', ' / '), chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE doc_id % 3 <> 0),
f AS (SELECT *, CASE WHEN length(line) < 40 THEN 'sectionHeading' WHEN length(line) % 11 = 0 THEN 'pageFooter' END AS role FROM e),
b0 AS (SELECT doc_id, row_number() OVER w - 1 AS block_index, 'prose' AS type, last_value(CASE WHEN role = 'sectionHeading' THEN trim(line, {_WS}) END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS section, trim(line, {_WS}) AS text FROM f WHERE coalesce(role, '') <> 'pageFooter' AND trim(line, {_WS}) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
{_PIECES.replace("SELECT doc_id, chunk_index::INT", "SELECT doc_id, doc_id || '_' || chunk_index || '__' || substr(sha256(doc_id || '|' || substr(sha256(doc_id || '|' || h || '|s1'), 1, 16) || '|k1'), 1, 16) AS chunk_id, chunk_index::INT").replace("FROM m", "FROM m JOIN (SELECT doc_id, sha256(text) AS h FROM documents) USING (doc_id)")}""")
def stage_chunks(spark, sf_dir):
    """From texts over blocks to the live chunks, after documents have gone: their chunks are closed, the others keep their ids."""
    d = read(spark, sf_dir, "documents")
    files = d.select(F.col("doc_id").cast("string").alias("relative_path"), F.col("doc_id").cast("string").alias("file_name"), F.sha2("text", 256).alias("content_hash"), F.replace("text", F.lit(" | "), F.lit(" / ")).alias("content"))
    store = _store(spark)
    silver.run(store, files, "s1", _AT("2024-01-01"))
    chunk.run(store, "k1", _AT("2024-01-01"), 128, 16)
    silver.run(store, files.where("cast(file_name AS bigint) % 3 <> 0"), "s1", _AT("2024-01-02"))
    chunk.run(store, "k1", _AT("2024-01-02"), 128, 16)
    units = F.size(F.split("text", "\n\n")) - F.when(F.col("section").isNotNull(), 1).otherwise(0)
    return scd2.live(store.read(chunk.TABLE)).select(F.col("relative_path").cast("bigint").alias("doc_id"), "chunk_id", "chunk_index", "text", "block_type", "section", units.alias("n_units"))


_GOLD = [
    {"field_name": "opening", "type": "string", "question": r"([A-Za-z]+)", "extraction_strategy": "full_text", "validation_pattern": "^[A-Z]"},
    {"field_name": "number", "type": "integer", "question": r"(\d+)", "extraction_strategy": "full_text"},
]
_LINE_OF = "list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{}'))[1]"
_FIELD_ROWS = f"""d AS (SELECT doc_id, text, avg_conf, CASE WHEN avg_conf < 0.6 THEN 'low' ELSE 'ok' END AS flag FROM (SELECT doc_id, trim(text, {_WS}) AS text, (SELECT avg((1 - length(x) % 7 / 10.0 >= 0.9)::INT) FROM (SELECT unnest(string_split(text, chr(10))) AS x)) AS avg_conf FROM documents)),
a AS (SELECT doc_id, flag, 'opening' AS field_name, nullif(regexp_extract(text, '([A-Za-z]+)', 1), '') AS value, {_LINE_OF.format('[A-Za-z]+')} AS quote FROM d UNION ALL SELECT doc_id, flag, 'number', try_cast(nullif(regexp_extract(text, '([0-9]+)', 1), '') AS BIGINT)::VARCHAR, {_LINE_OF.format('[0-9]+')} FROM d),
r AS (SELECT *, CASE WHEN value IS NULL THEN 'na_null' WHEN trim(quote, {_WS}) = '' THEN 'not_found' ELSE 'exact' END AS match_type, CASE WHEN value IS NULL THEN 'not_applicable' WHEN field_name = 'number' OR regexp_matches(value, '^[A-Z]') THEN 'valid' ELSE 'invalid' END AS type_validation, CASE WHEN value IS NOT NULL THEN 'correct' END AS judge_verdict, CASE WHEN flag = 'low' THEN 'low' END AS source_verified FROM a),
z AS (SELECT *, CASE WHEN value IS NULL THEN 'unknown' WHEN type_validation = 'invalid' OR source_verified = 'low' THEN 'review' ELSE 'high' END AS trust FROM r)"""


def _gold(spark, sf_dir, mode: str = "off", entries=None) -> Store:
    """A store with fields of all documents, from their text alone (no blocks, so nothing is known of a quote's place)."""
    d = read(spark, sf_dir, "documents")
    files = d.select(F.col("doc_id").cast("string").alias("relative_path"), F.concat(F.lit("Doc-"), "doc_id").alias("file_name"), F.sha2("text", 256).alias("content_hash"), F.lit("s1").alias("code_hash"), F.lit("v1").alias("version_id"), F.col("text").alias("content"))
    store = _store(spark)
    text, _, _ = silver.extract(store.staged(silver.analysed(spread(files))))
    store.commit(**{silver.TEXT: scd2.fresh(text.withColumn("valid_from", _AT("2024-01-01")))})
    gold.run(store, entries or _GOLD, "g1", _AT("2024-01-02"), mode=mode)
    return store


@query(f"WITH {_FIELD_ROWS} SELECT doc_id, field_name, value, substr(quote, 1, 600) AS evidence_text, match_type, type_validation, judge_verdict, source_verified, trust FROM z")
def stage_gold(spark, sf_dir):
    """Fields asked for by the rule-based model, judged by rule, located, validated and rated."""
    e = _gold(spark, sf_dir).read(gold.TALL)
    return e.select(F.col("relative_path").cast("bigint").alias("doc_id"), "field_name", "value", "evidence_text", "match_type", "type_validation", "judge_verdict", "source_verified", "trust")


@query(f"""WITH {_FIELD_ROWS}, s AS (SELECT *, 'extract' AS stage, 1 AS step_seq, CASE WHEN value IS NULL OR match_type = 'not_found' THEN 'unknown' ELSE 'review' END AS trust_after FROM z WHERE trust <> 'high' OR judge_verdict IS NULL
UNION ALL SELECT *, 'judge', CASE WHEN trust = 'high' THEN 1 ELSE 2 END, trust FROM z)
SELECT doc_id, field_name, step_seq, stage, trust_after, substr(sha256(substr(sha256(doc_id || '|v1|g1'), 1, 16) || '|' || field_name || '|' || stage || '|' || step_seq), 1, 16) AS audit_id FROM s""")
def stage_gold_trail(spark, sf_dir):
    """The gated trail: both steps of fields that aren't high, the last of the others."""
    t = _gold(spark, sf_dir).read(gold.TRAIL)
    return t.select(F.col("relative_path").cast("bigint").alias("doc_id"), "field_name", "step_seq", "stage", "trust_after", "audit_id")


@query(f"WITH {_FIELD_ROWS} SELECT doc_id, max(value) FILTER (WHERE field_name = 'opening') AS opening, try_cast(max(value) FILTER (WHERE field_name = 'number') AS INT) AS number, NULL::VARCHAR AS extraction_error FROM z GROUP BY 1")
def stage_gold_wide(spark, sf_dir):
    return _gold(spark, sf_dir).read(gold.WIDE).select(F.col("relative_path").cast("bigint").alias("doc_id"), "opening", "number", "extraction_error")


@query(f"""WITH {_FIELD_ROWS} SELECT field_name, file_name, round(avg(passed::INT), 9) AS accuracy, count(*) AS n FROM (SELECT field_name, 'doc ' || doc_id AS file_name, CASE WHEN field_name = 'opening' THEN lower(coalesce(value, '')) = CASE WHEN doc_id % 4 = 0 THEN 'other' ELSE lower(coalesce(value, '')) END ELSE value IS NOT NULL AND try_cast(value AS INT) IS NOT NULL AND doc_id % 5 <> 0 END AS passed FROM z WHERE doc_id % 50 = 0) GROUP BY GROUPING SETS ((), (field_name), (file_name))""")
def stage_measures(spark, sf_dir):
    """Accuracy of the fields against a truth of the documents divisible by 50, appended to the results and rolled up."""
    store = _gold(spark, sf_dir)
    actual = store.read(gold.WIDE).select(F.col("relative_path").cast("bigint").alias("i"), "opening", "number").where("i % 50 = 0")
    i = F.col("i")
    name = F.concat(F.lit("doc "), i).alias("file_name")
    none = F.lit(None).cast("string").alias("strategy")
    truth = actual.select(name, F.lit("opening").alias("field_name"), F.when(i % 4 == 0, "other").otherwise(F.coalesce("opening", F.lit(""))).alias("expected"), none)
    truth = truth.unionByName(actual.select(name, F.lit("number").alias("field_name"), F.when(i % 5 == 0, "none").otherwise(F.coalesce("number", F.lit(0)).cast("string")).alias("expected"), none))
    from ..operators import evaluate

    measure.run(store, truth, _GOLD, "run1", _AT("2024-01-03"))
    return evaluate.rollup(store.read(measure.TABLE)).withColumn("accuracy", F.round("accuracy", 9))


_KNN = """x AS (SELECT c.conv_id, c.conv_id * 1000 + c.turn AS chunk, c.text, e.embedding::DOUBLE[] AS v FROM conversations c JOIN embeddings e ON e.vec_id = (c.conv_id * 7 + c.turn) % 500),
y AS (SELECT c.conv_id, c.text, e.embedding::DOUBLE[] AS v FROM conversations c JOIN embeddings e ON e.vec_id = c.conv_id % 500 WHERE c.turn = 0 AND c.conv_id % 50 = 0),
s AS (SELECT conv_id, chunk, row_number() OVER (PARTITION BY conv_id ORDER BY round(list_cosine_similarity(x.v, y.v), 6) DESC, chunk) AS r FROM x JOIN y USING (conv_id))"""


@query(f"""WITH {_BM.split("q AS (")[0].rstrip().rstrip(",")}, {_KNN}, q AS (SELECT DISTINCT conv_id, unnest(list_filter(regexp_split_to_array({_NORM.format("text")}, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) > 0)) AS term FROM y),
b AS (SELECT conv_id, p.chunk, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))) AS score FROM q JOIN p USING (term, conv_id) JOIN d USING (term) JOIN z USING (chunk), m GROUP BY 1, 2),
k AS (SELECT conv_id, chunk, row_number() OVER (PARTITION BY conv_id ORDER BY round(score, 6) DESC, chunk) AS r FROM b),
f AS (SELECT conv_id, chunk, round(sum(1.0 / (60 + r))::DOUBLE, 6) AS score FROM (SELECT * FROM s WHERE r <= 3 UNION ALL SELECT * FROM k WHERE r <= 3) GROUP BY 1, 2)
SELECT conv_id, chunk, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, chunk) AS rank FROM f) WHERE rank <= 3""")
def hybrid_in_document(spark, sf_dir):
    """Vectors and words fused, within one conversation for each question."""
    c, e = read(spark, sf_dir, "conversations"), read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    chunks = c.select("conv_id", (F.col("conv_id") * 1000 + F.col("turn")).alias("chunk"), "text", ((F.col("conv_id") * 7 + F.col("turn")) % 500).alias("vec_id")).join(e, "vec_id")
    asked = c.where("turn = 0 and conv_id % 50 = 0").select(F.col("conv_id").alias("q"), "conv_id", F.col("text").alias("question"), (F.col("conv_id") % 500).alias("vec_id")).join(e, "vec_id")
    inverted = S.postings(c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("chunk"), "conv_id", "text"), "chunk", keep=["conv_id"])
    return S.hybrid(chunks, inverted, asked, "q", "chunk", "conv_id", 3).select("conv_id", "chunk", "score", "rank")


@query("""SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN false ELSE true END AS ok, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE upper(lang) || doc_id % 4 END AS payload, CASE WHEN doc_id % 9 = 0 THEN 'ValueError: no ' || lang END AS error FROM documents""")
def provider_answers(spark, sf_dir):
    """What a port answers, row by row; requests that fail have their error and leave the others of their batch alone."""

    def provider(requests):
        if any(r.endswith("!") for r in requests):
            raise ValueError("no " + requests[0].split()[0])
        return ["".join(r.upper().split()) for r in requests]

    i = F.col("doc_id")
    request = F.concat(F.col("lang"), F.lit(" "), (i % 4).cast("string"), F.when(i % 9 == 0, "!").otherwise(""))
    return providers.call(read(spark, sf_dir, "documents").select("doc_id", request.alias("request")), "request", provider).select("doc_id", "ok", "payload", "error")


@query(f"""WITH {_T} SELECT k, status, version_id, valid_from, valid_to, is_current, note FROM (
SELECT s.k, s.status, s.version_id, s.valid_from, NULL::VARCHAR AS valid_to, true AS is_current, 'new' AS note FROM s
UNION ALL SELECT l.k, l.status, l.version_id, l.valid_from, CASE WHEN s.k IS NOT NULL THEN s.valid_from ELSE l.valid_to END, s.k IS NULL, NULL FROM l LEFT JOIN s ON l.k = s.k WHERE s.k IS NULL OR s.version_id <> l.version_id
UNION ALL SELECT k, status, version_id, valid_from, valid_to, is_current, NULL FROM t WHERE NOT (is_current AND NOT doc_deleted))""")
def merge_new_column(spark, sf_dir):
    """A column that only the new rows have joins the history."""
    merged = scd2.merge(target(spark, sf_dir), source(spark, sf_dir).withColumn("note", F.lit("new")), "k")
    return merged.select("k", "status", "version_id", _DAY("valid_from"), _DAY("valid_to"), "is_current", "note")


@query(f"""WITH {_T} SELECT k, CASE WHEN same THEN status END AS status, version_id, is_current FROM (
SELECT s.k, l.status, s.version_id, true AS is_current, coalesce(l.version_id = s.version_id, false) AS same FROM s LEFT JOIN l ON l.k = s.k
UNION ALL SELECT l.k, l.status, l.version_id, s.k IS NULL, true FROM l LEFT JOIN s ON l.k = s.k WHERE s.k IS NULL OR s.version_id <> l.version_id
UNION ALL SELECT k, status, version_id, is_current, true FROM t WHERE NOT (is_current AND NOT doc_deleted))""")
def merge_missing_column(spark, sf_dir):
    """A column that the new rows lack keeps its value in the same version and is null in a new one."""
    return scd2.merge(target(spark, sf_dir), source(spark, sf_dir).drop("status"), "k").select("k", "status", "version_id", "is_current")


@query(f"""WITH {_T}, n AS (SELECT k, version_id FROM s WHERE version_id = 'v2')
SELECT t.k, t.status, t.version_id, is_current AND NOT doc_deleted AND n.k IS NULL AS live, NULL AS note FROM t LEFT JOIN n ON n.k = t.k UNION ALL SELECT k, NULL, version_id, true, 'new' FROM n""")
def expire_append_columns(spark, sf_dir):
    """Columns on either side alone are null in the other's rows."""
    new = scd2.fresh(source(spark, sf_dir).where("version_id = 'v2'").drop("status").withColumn("note", F.lit("new")))
    out = scd2.expire_and_append(target(spark, sf_dir), new, new, "k", _AT("2024-03-01"))
    return out.select("k", "status", "version_id", scd2.is_live().alias("live"), "note")


@query(f"""WITH {_T}, c AS (SELECT *, k % 5 = 0 AS failed FROM t WHERE is_current)
SELECT s.k, s.version_id FROM s WHERE s.version_id || s.k NOT IN (SELECT version_id || k FROM c WHERE NOT failed)""")
def pending_after_errors(spark, sf_dir):
    """Versions that are current only with an error are pending again."""
    stamp = F.concat("version_id", "k")
    done = target(spark, sf_dir).withColumns({"version_id": stamp, "extraction_error": F.when(F.col("k") % 5 == 0, "failed")})
    found = scd2.pending(source(spark, sf_dir).withColumn("stamp", stamp), done.withColumnRenamed("version_id", "stamp"), "stamp", "extraction_error")
    return found.select("k", "version_id")


@query(f"""WITH {_T} SELECT s.k FROM s LEFT JOIN (SELECT * FROM t WHERE is_current) c ON s.k = c.k WHERE c.k IS NULL OR c.version_id <> s.version_id OR s.k % 4 = 0 OR s.k % 5 = 0""")
def changed_by_code_or_error(spark, sf_dir):
    """Other content, other code, or an error before."""
    now = source(spark, sf_dir).withColumn("code_hash", F.lit("c2"))
    k = F.col("k")
    before = target(spark, sf_dir).withColumns({"code_hash": F.when(k % 4 == 0, "c1").otherwise("c2"), "extraction_error": F.when(k % 5 == 0, "failed")})
    return scd2.changed(now, before, "k", ["version_id", "code_hash"], "extraction_error").select("k")


@query(f"WITH d AS (SELECT doc_id, text, {_NORM.format('text')} AS t FROM documents) SELECT doc_id, contains(t, {_NORM.format('substr(text, 31, 90)')}) AS found FROM d")
def quotes_contained(spark, sf_dir):
    """A stretch of each document looked for in it, in normal form."""
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.contains(T.normalize(F.col("text")), T.normalize(F.substring("text", 31, 90))).alias("found"))
