"""Queries over layout, chunks and retrieval."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks as C
from ..operators import layout as L
from ..operators import search as S
from ..sources import files
from .catalog import query, read

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NORM = "lower(trim(regexp_replace({}, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' '))"
_LINES = "e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM documents)"
_ROLE = "CASE WHEN length(text) < 40 THEN 'sectionHeading' WHEN length(text) % 11 = 0 THEN 'pageFooter' END"


def lines(spark, sf_dir):
    """Documents as layout: lines are paragraphs, short ones headings, some are page furniture."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    size = F.length("text")
    return d.select("doc_id", F.lit("prose").alias("kind"), F.when(size < 40, "sectionHeading").when(size % 11 == 0, "pageFooter").alias("role"), (F.col("i") + 1).alias("start"), (F.col("i") + 1).alias("idx"), F.lit(1).alias("page"), "text")


@query("SELECT page_id, lower(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '\\.([^./\\\\]+)$', 1)) AS ext, lower(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '\\.([^./\\\\]+)$', 1)) IN ('html', 'pdf') AS supported FROM pages")
def extension_predicate(spark, sf_dir):
    name = F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    return read(spark, sf_dir, "pages").select("page_id", files.extension(name).alias("ext"), files.extension(name).isin("html", "pdf").alias("supported"))


@query("SELECT page_id, sha256(html) AS content_hash, length(html) AS size_chars FROM pages")
def content_hashes(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("content_hash"), F.length("html").cast("bigint").alias("size_chars"))


@query("SELECT doc_id, 'in/' || source || '/' || doc_id || '.pdf' AS relative_path FROM documents")
def relative_paths(spark, sf_dir):
    full = F.concat(F.lit("file:///mnt/files/in/"), "source", F.lit("/"), "doc_id", F.lit(".pdf"))
    return read(spark, sf_dir, "documents").select("doc_id", files.relative_path(full, "/mnt/files/").alias("relative_path"))


@query(f"WITH {_LINES} SELECT doc_id, idx::INT AS idx, text FROM e WHERE coalesce({_ROLE}, '') <> 'pageFooter'")
def noise_filter(spark, sf_dir):
    return L.drop_noise(lines(spark, sf_dir)).select("doc_id", "idx", "text")


@query(f"""WITH {_LINES}, b AS (SELECT doc_id, text, idx, {_ROLE} AS role FROM e WHERE trim(text, {_WS}) <> ''),
n AS (SELECT * FROM b WHERE coalesce(role, '') <> 'pageFooter')
SELECT doc_id, text, (row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1)::INT AS block_index,
last_value(CASE WHEN role = 'sectionHeading' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS section, length(text)::INT AS char_count FROM n""")
def section_blocks(spark, sf_dir):
    return L.blocks(L.drop_noise(lines(spark, sf_dir)), "doc_id").select("doc_id", "text", "block_index", "section", "char_count")


@query(f"WITH {_LINES} SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY idx) AS text FROM e WHERE trim(text, {_WS}) <> '' GROUP BY doc_id")
def blocks_to_text(spark, sf_dir):
    return L.blocks_to_text(lines(spark, sf_dir).withColumn("block_index", F.col("idx")), "doc_id")


@query("""WITH p AS (SELECT l_orderkey AS doc, l_linenumber AS start, l_partkey AS part FROM lineitem), r AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS lo, l_linenumber + 2 AS hi FROM lineitem WHERE l_returnflag = 'R')
SELECT doc, start::INT AS start, part FROM p WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc = p.doc AND p.start >= r.lo AND p.start < r.hi)""")
def covered_ranges(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    p = li.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("start"), F.col("l_partkey").alias("part"))
    r = li.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("lo"), (F.col("l_linenumber") + 2).alias("hi")).distinct()
    return L.drop_covered(p, r, "doc").select("doc", "start", "part")


@query("""WITH b AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS start, l_linenumber + 2 AS "end" FROM lineitem WHERE l_linenumber % 2 = 1), w AS (SELECT l_orderkey AS doc, l_linenumber AS at, 1 - l_discount * 5 AS conf FROM lineitem WHERE l_tax > 0.01)
SELECT b.doc, b.start::INT AS start, round(min(conf), 6) AS conf_min, round(avg(conf), 6) AS conf_mean FROM b LEFT JOIN w ON b.doc = w.doc AND w.at >= b.start AND w.at < b."end" GROUP BY b.doc, b.start""")
def span_confidence(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    b = li.where("l_linenumber % 2 = 1").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("start"), (F.col("l_linenumber") + 2).alias("end")).distinct()
    w = li.where("l_tax > 0.01").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("at"), (1 - F.col("l_discount") * 5).alias("conf"))
    return L.span_confidence(b, w, "doc").select("doc", "start", F.round("conf_min", 6).alias("conf_min"), F.round("conf_mean", 6).alias("conf_mean"))


@query("""SELECT doc, round(q, 6) AS di_quality, CASE WHEN q < 0.6 THEN 'low' ELSE 'ok' END AS di_quality_flag FROM (SELECT l_orderkey AS doc, avg(CASE WHEN 1 - l_discount >= 0.95 THEN 1 ELSE 0 END) AS q FROM lineitem GROUP BY 1)""")
def document_quality(spark, sf_dir):
    w = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), (1 - F.col("l_discount")).alias("conf"))
    return L.document_quality(w, "doc", 0.95).select("doc", F.round("di_quality", 6).alias("di_quality"), "di_quality_flag")


_SPANS = "SELECT l_orderkey AS doc, min(l_linenumber * 10) AS lo, max(l_linenumber * 10 + l_quantity::INT) AS hi FROM lineitem GROUP BY 1"


@query(f"SELECT doc, lo::INT AS lo, hi::INT AS hi FROM ({_SPANS})")
def span_bounds(spark, sf_dir):
    spans = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(F.collect_list(F.struct((F.col("l_linenumber") * 10).alias("offset"), F.col("l_quantity").cast("int").alias("length"))).alias("spans"))
    return spans.select("doc", L.span_start(F.col("spans")).cast("int").alias("lo"), L.span_end(F.col("spans")).cast("int").alias("hi"))


@query("""SELECT p_partkey, CASE WHEN p_size > 1 AND p_retailprice > 0 THEN round((p_size - 1) * 10.0 / (p_retailprice * 2), 6) END AS fraction FROM part""")
def figure_fraction(spark, sf_dir):
    size = F.col("p_size").cast("double")
    polygon = F.array(F.lit(1.0), F.lit(2.0), size, F.lit(2.0), size, F.lit(12.0), F.lit(1.0), F.lit(12.0))
    return read(spark, sf_dir, "part").select("p_partkey", F.round(L.area_fraction(polygon, F.col("p_retailprice"), F.lit(2.0)), 6).alias("fraction"))


@query("""SELECT p_partkey, p_size / 50.0 AS fraction FROM part WHERE p_size % 7 = 0 OR p_size / 50.0 >= 0.5""")
def decorative_figures(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") / 50.0).alias("share"), "p_size")
    known = p.withColumn("fraction", F.when(F.col("p_size") % 7 != 0, F.col("share")))
    return L.drop_decorative(known, 0.5).select("p_partkey", F.col("share").alias("fraction"))


@query(f"""SELECT doc_id, substr(trim(a || ' ' || b, ' '), 1, 60) AS piece FROM (SELECT doc_id, {_NORM.format("substr(text, 1, 30)").replace("lower(", "(")} AS a, {_NORM.format("substr(text, 51, 40)").replace("lower(", "(")} AS b FROM documents)""")
def content_slices(spark, sf_dir):
    spans = F.array(F.struct(F.lit(0).alias("offset"), F.lit(30).alias("length")), F.struct(F.lit(50).alias("offset"), F.lit(40).alias("length")))
    return read(spark, sf_dir, "documents").select("doc_id", T.slice_spans(F.col("text"), spans, 60).alias("piece"))


@query("""WITH RECURSIVE l AS (SELECT n_regionkey AS region, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, '| ' || n_name || ' |' AS row FROM nation),
w AS (SELECT region, i, 0 AS piece, row AS body FROM l WHERE i = 1
UNION ALL SELECT l.region, l.i, CASE WHEN (24 + length(body) + length(l.row)) // 4 > 14 THEN piece + 1 ELSE piece END, CASE WHEN (24 + length(body) + length(l.row)) // 4 > 14 THEN l.row ELSE body || chr(10) || l.row END FROM w JOIN l ON l.region = w.region AND l.i = w.i + 1)
SELECT region, '| name |' || chr(10) || '| ---------- |' || chr(10) || arg_max(body, i) AS piece FROM w GROUP BY region, w.piece""")
def table_row_packs(spark, sf_dir):
    """Pieces of several rows, each under the header."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.concat(F.lit("| "), r["n_name"], F.lit(" |")))
    md = F.concat(F.lit("| name |\n| ---------- |\n"), F.array_join(rows, "\n"))
    return read(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(md.alias("md")).select("region", F.explode(C.split_table(F.col("md"), 14)).alias("piece"))


@query("""WITH c AS (SELECT n_regionkey AS region, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT AS i, n_name FROM nation),
g AS (SELECT region, r, string_agg(coalesce(n_name, ''), ' | ' ORDER BY col) AS line FROM (SELECT DISTINCT region FROM c), (SELECT unnest([0, 1, 2]) AS r), (SELECT unnest([0, 1]) AS col) LEFT JOIN (SELECT region AS region2, i // 2 AS r2, i % 2 AS col2, n_name FROM c) ON region2 = region AND r2 = r AND col2 = col GROUP BY region, r)
SELECT region, string_agg('| ' || line || ' |' || CASE WHEN r = 0 THEN chr(10) || '| --- | --- |' ELSE '' END, chr(10) ORDER BY r) AS markdown FROM g GROUP BY region""")
def table_markdown(spark, sf_dir):
    i = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    cells = read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), i.alias("i"), F.col("n_name").alias("text"))
    cells = cells.select("region", F.lit(3).alias("n_rows"), F.lit(2).alias("n_cols"), F.floor(F.col("i") / 2).cast("int").alias("row"), (F.col("i") % 2).alias("col"), F.col("i").alias("seq"), "text")
    return L.table_markdown(cells, ["region"])


@query("""SELECT n_regionkey AS region, '[' || string_agg('{"row":' || n_nationkey || ',"col":' || n_regionkey || ',"row_span":1,"col_span":2,"kind":"content","text":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS cells_json FROM nation GROUP BY 1""")
def table_cells(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("row"), F.col("n_regionkey").alias("col"), F.lit(0).alias("row_span"), F.lit(2).alias("col_span"), F.lit(None).cast("string").alias("kind"), F.col("n_name").alias("text"))
    return L.table_cells(n, ["region"])


@query("""SELECT p_partkey, replace(replace(p_name || ' | ' || p_type || chr(10) || p_brand, chr(10), ' '), '|', '\\|') AS cell FROM part""")
def cell_escape(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", L.cell_text(F.concat("p_name", F.lit(" | "), "p_type", F.lit("\n"), "p_brand")).alias("cell"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, p_type) OR contains(p_type, p_name) THEN p_name ELSE p_name || ' — ' || p_type END AS caption, 'figs/p' || p_size || '_f' || p_partkey || '.png' AS uri FROM part""")
def figure_captions(spark, sf_dir):
    pieces = F.array("p_name", "p_type", "p_name", F.lit(" "))
    return read(spark, sf_dir, "part").select("p_partkey", L.caption(pieces, F.lit("Figure"), 500).alias("caption"), L.figure_uri(F.lit("figs"), F.col("p_size"), F.col("p_partkey")).alias("uri"))


@query("SELECT doc_id, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END::BIGINT AS tokens, greatest(1, length(text) // 4 + 2000)::BIGINT AS call_tokens FROM documents")
def token_lengths(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.token_length(F.col("text")).cast("bigint").alias("tokens"), T.call_tokens(F.col("text")).cast("bigint").alias("call_tokens"))


_PLAIN = "trim(regexp_replace({}, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ')"


@query(f"""WITH p AS (SELECT doc_id, {_PLAIN.format('text')} AS t FROM documents), w AS (SELECT doc_id, t, unnest(generate_series(0, CASE WHEN length(t) > 400 THEN ceil((length(t) - 400) / 320.0)::INT ELSE 0 END)) AS i FROM p WHERE length(t) > 0)
SELECT doc_id, i::INT AS i, trim(substr(t, i * 320 + 1, 400), ' ') AS piece FROM w""")
def sliding_windows(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(C.char_windows(F.col("text"), 100, 20)).alias("i", "piece"))


@query("""WITH t AS (SELECT doc_id, string_split(text, ' ') AS ws FROM documents), w AS (SELECT doc_id, ws, unnest(generate_series(0, CASE WHEN len(ws) > 50 THEN ceil((len(ws) - 50) / 40.0)::INT ELSE 0 END)) AS i FROM t)
SELECT doc_id, i::INT AS i, array_to_string(ws[i * 40 + 1 : i * 40 + 50], ' ') AS piece FROM w""")
def token_windows(spark, sf_dir):
    """Windows of fifty tokens, ten of them shared, words being the tokens."""
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(C.token_windows(F.split("text", " "), 50, 10)).alias("i", "ids")).select("doc_id", "i", F.array_join("ids", " ").alias("piece"))


@query("""WITH RECURSIVE u AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, role = 'system' AS atomic, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS tok FROM conversations),
w AS (SELECT conv_id, i, atomic, tok, 0 AS pack, tok AS held FROM u WHERE i = 1
UNION ALL SELECT u.conv_id, u.i, u.atomic, u.tok, CASE WHEN w.atomic OR u.atomic OR w.held + u.tok > 100 THEN w.pack + 1 ELSE w.pack END, CASE WHEN w.atomic OR u.atomic OR w.held + u.tok > 100 THEN u.tok ELSE w.held + u.tok END FROM w JOIN u ON u.conv_id = w.conv_id AND u.i = w.i + 1)
SELECT conv_id, pack::INT AS pack, count(*) AS n_units, sum(tok)::BIGINT AS tokens FROM w GROUP BY conv_id, pack""")
def greedy_pack(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    unit = F.struct("turn", T.token_length(F.col("text")).alias("tokens"), (F.col("role") == "system").alias("atomic"))
    packed = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(unit)).alias("us")).select("conv_id", F.posexplode(C.pack(F.col("us"), 100)).alias("pack", "us"))
    return packed.select("conv_id", "pack", F.size("us").cast("bigint").alias("n_units"), F.aggregate(F.transform("us", lambda u: u["tokens"].cast("bigint")), F.lit(0).cast("bigint"), lambda s, t: s + t).alias("tokens"))


@query()
def chunk_documents(spark, sf_dir):
    """Blocks to units to chunks of a whole table; its oracle stands with those of the stages."""
    b = L.blocks(L.drop_noise(lines(spark, sf_dir)), "doc_id").select("doc_id", "block_index", F.when(F.contains("text", F.lit(" | ")), "table").otherwise("prose").alias("type"), "section", "page", F.lit(None).cast("string").alias("table_id"), F.lit(None).cast("string").alias("figure_uri"), "text")
    return C.chunks(C.units(b, 128, 16), "doc_id", 128)


@query("""SELECT region, unnest(CASE WHEN n < 3 THEN [md] ELSE list_transform(generate_series(1, n), lambda i: hd || chr(10) || ls[i]) END) AS piece FROM (SELECT n_regionkey AS region, '| name |' || chr(10) || '| --- |' AS hd, list('| ' || n_name || ' |' ORDER BY n_nationkey) AS ls, count(*) AS n, '' AS md FROM nation GROUP BY 1)""")
def table_row_split(spark, sf_dir):
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.concat(F.lit("| "), r["n_name"], F.lit(" |")))
    md = F.concat(F.lit("| name |\n| --- |\n"), F.array_join(rows, "\n"))
    return read(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(md.alias("md")).select("region", F.explode(C.split_table(F.col("md"), 6)).alias("piece"))


_COS = """c AS (SELECT q.vec_id AS q, e.vec_id, e.label, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings e ON q.label = e.label AND q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0)"""


def _cosines(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("qe"), "label")
    return S.nearest(q, e, "q", "vec_id", "label", 5)


@query(f"WITH {_COS} SELECT q, vec_id, round(score, 4) AS score, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 4) DESC, vec_id) AS r FROM c) WHERE r <= 5")
def cosine_topk(spark, sf_dir):
    """Exact nearest vectors with the same label (the document filter), for the stated query set."""
    scored = _cosines(spark, sf_dir).withColumn("score", F.round("score", 4))
    return S.top_k(scored, ["q"], 5, "vec_id").select("q", "vec_id", "score", "rank")


_BM = """t AS (SELECT conv_id * 1000 + turn AS chunk, conv_id, unnest(list_filter(regexp_split_to_array(""" + _NORM.format("text") + """, '[^\\p{L}\\p{N}_]+'), lambda x: length(x) > 0)) AS term FROM conversations),
p AS (SELECT chunk, conv_id, term, count(*) AS tf FROM t GROUP BY ALL), z AS (SELECT chunk, count(*) AS size FROM t GROUP BY 1), m AS (SELECT count(*) AS n, avg(size) AS mean FROM z), d AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
q AS (SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(""" + _NORM.format("text") + """, '[^\\p{L}\\p{N}_]+'), lambda x: length(x) > 0)) AS term FROM benchmark WHERE item_id % 50 = 0),
b AS (SELECT item_id, p.chunk, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))) AS score FROM q JOIN p USING (term) JOIN d USING (term) JOIN z USING (chunk), m GROUP BY 1, 2)"""


def _bm25(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("chunk"), "text")
    q = read(spark, sf_dir, "benchmark").where("item_id % 50 = 0").select("item_id", F.explode(S.terms(F.col("text"))).alias("term"))
    return S.bm25(S.postings(c, "chunk"), q, "chunk", "item_id")


@query(f"WITH {_BM} SELECT item_id, chunk, round(score, 4) AS score, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 4) DESC, chunk) AS r FROM b) WHERE r <= 10")
def bm25_topk(spark, sf_dir):
    scored = _bm25(spark, sf_dir).withColumn("score", F.round("score", 4))
    return S.top_k(scored, ["item_id"], 10, "chunk").select("item_id", "chunk", "score", "rank")


@query(f"""WITH {_BM}, k AS (SELECT item_id, chunk, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 4) DESC, chunk) AS r FROM b), l AS (SELECT item_id, chunk, row_number() OVER (PARTITION BY item_id ORDER BY chunk) AS r FROM b),
f AS (SELECT item_id, chunk, sum(1.0 / (60 + r))::DOUBLE AS score FROM (SELECT * FROM k WHERE r <= 10 UNION ALL SELECT * FROM l WHERE r <= 10) GROUP BY 1, 2)
SELECT item_id, chunk, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, chunk) AS rank FROM f) WHERE rank <= 5""")
def hybrid_rrf(spark, sf_dir):
    """Reciprocal-rank fusion of two rankings: by BM25 and by position."""
    b = _bm25(spark, sf_dir).withColumn("score", F.round("score", 4))
    by_score = S.top_k(b, ["item_id"], 10, "chunk")
    by_place = S.top_k(b.withColumn("score", -F.col("chunk")), ["item_id"], 10, "chunk")
    fused = S.fuse(by_score, by_place, ["item_id", "chunk"]).withColumn("score", F.round("score", 6))
    return S.top_k(fused, ["item_id"], 5, "chunk").select("item_id", "chunk", "score", "rank")


@query(f"WITH {_COS}, h AS (SELECT label, vec_id, round(max(score), 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 4) DESC, vec_id) AS r FROM c) WHERE r <= 5 GROUP BY 1, 2) SELECT label, vec_id, score, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS pos FROM h")
def group_union(spark, sf_dir):
    hits = S.top_k(_cosines(spark, sf_dir).withColumn("score", F.round("score", 4)), ["q"], 5, "vec_id").withColumn("chunk_index", F.col("vec_id"))
    return S.group_union(hits, ["label"], "vec_id").select("label", "vec_id", "score", "pos")


@query("SELECT conv_id, CASE WHEN count(*) >= 3 THEN string_agg(text, chr(10) ORDER BY turn) ELSE 'full' END AS context FROM conversations WHERE role = 'user' GROUP BY 1")
def min_hits_fallback(spark, sf_dir):
    u = read(spark, sf_dir, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda r: r["text"]), "\n").alias("found"), F.count("*").alias("n"))
    return u.select("conv_id", S.context(F.col("found"), F.col("n"), F.lit("full")).alias("context"))
