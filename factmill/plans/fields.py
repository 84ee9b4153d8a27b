"""Queries over extracted fields: strategies, values, evidence, trust, escalation and audit."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import trust as R
from ..functions import values as V
from ..functions.fuzzy import ratio
from ..operators import audit, evidence, extract
from ..sources import providers
from ..sources.files import spread
from .catalog import query, read

_WS = "[ \\t\\n\\r\\f\\x0B]+"
_NORM = "lower(trim(regexp_replace({}, '" + _WS + "', ' ', 'g'), ' '))"

#: (field, kind, source, override, position)
_FIELDS = [("parties", "list", None, None, 0), ("starts", "string", None, None, 1), ("renews", "boolean", None, None, 2), ("price", "string", "tables", None, 3), ("days", "integer", None, None, 4), ("levels", "struct_list", "tables", None, 5), ("clauses", "struct_list", None, None, 6), ("summary", "string", None, "full_text", 7)]


def _values(rows: list[tuple], names: str) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({names})"


_STRATEGY = "CASE WHEN override IS NOT NULL THEN override WHEN source = 'tables' THEN 'tables' WHEN kind = 'boolean' THEN 'retrieve_classify' WHEN kind = 'list' THEN 'map_reduce' WHEN kind = 'struct_list' THEN 'full_text' ELSE 'rag' END"


def _fields(spark):
    return spark.createDataFrame(_FIELDS, "field_name string, kind string, source string, override string, position int").withColumn("strategy", extract.strategy(F.col("kind"), F.col("source"), F.col("override")))


@query(f"SELECT field_name, {_STRATEGY} AS strategy FROM {_values(_FIELDS, 'field_name, kind, source, override, position')}")
def strategy_resolution(spark, sf_dir):
    return _fields(spark).select("field_name", "strategy")


@query(f"SELECT {_STRATEGY} AS strategy, string_agg(field_name, ',' ORDER BY position) AS fields FROM {_values(_FIELDS, 'field_name, kind, source, override, position')} GROUP BY 1")
def strategy_groups(spark, sf_dir):
    return extract.group_fields(_fields(spark)).withColumn("fields", F.array_join("fields", ","))


@query("""SELECT event_id, CASE WHEN b IN ('true', '1', 'yes') THEN 'true' ELSE 'false' END AS as_bool, TRY_CAST(i AS BIGINT)::VARCHAR AS as_int, list AS as_list FROM
(SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'yes' WHEN event_id % 4 = 1 THEN 'maybe' WHEN event_id % 4 = 2 THEN '1' ELSE 'false' END AS b, CASE WHEN event_id % 3 = 0 THEN '30 days' ELSE event_id::VARCHAR END AS i, '["' || event_type || '","' || user_id || '"]' AS list FROM events)""")
def coerce_values(spark, sf_dir):
    i = F.col("event_id")
    b = F.when(i % 4 == 0, "yes").when(i % 4 == 1, "maybe").when(i % 4 == 2, "1").otherwise("false")
    n = F.when(i % 3 == 0, "30 days").otherwise(i.cast("string"))
    items = F.concat(F.col("event_type"), F.lit(" , "), F.col("user_id").cast("string"), F.lit(","))
    return read(spark, sf_dir, "events").select("event_id", V.coerce(b, F.lit("boolean")).alias("as_bool"), V.coerce(n, F.lit("integer")).alias("as_int"), V.coerce(items, F.lit("list")).alias("as_list"))


@query("""SELECT event_id, '[{"k":"' || json_extract_string(props, '$.k') || '","z":null}]' AS coerced FROM events""")
def coerce_structs(spark, sf_dir):
    raw = F.concat(F.lit("["), F.col("props"), F.lit(",null]"))
    return read(spark, sf_dir, "events").select("event_id", V.coerce_structs(raw, ["k", "z"]).alias("coerced"))


#: (kind, value, whether it was a JSON string, what it is written as)
_COERCED = [
    ("boolean", "YES ", True, "true"), ("boolean", "maybe", True, "false"), ("boolean", "2", False, "true"), ("boolean", "0", False, "false"), ("boolean", None, True, None),
    ("integer", "30.7", False, "30"), ("integer", "30.7", True, None), ("integer", " 12 ", True, "12"), ("integer", "30 days", True, None), ("integer", "-4", False, "-4"),
    ("number", "1e3", True, "1000.0"), ("float", "abc", True, None), ("double", " 2.50", True, "2.5"), ("number", "1d", True, None),
    ("list", '["a",null,"b"]', False, '["a","b"]'), ("list", "a, ,b,", True, '["a","b"]'), ("list", "[not json", True, '["[not json"]'), ("list", "[]", False, "[]"),
    ("string", " kept ", True, " kept "), ("odd", "7", False, "7"),
]
_CHECKED = [
    ("string", " 12 ", r"^12$", "valid"), ("string", "x12", r"^12$", "invalid"), ("string", "x", "(", "valid"), ("string", " \n", None, "not_applicable"), ("string", None, None, "not_applicable"),
    ("list", '["a",null]', None, "valid"), ("list", '["[redacted]","{x"]', None, "valid"), ("list", '[["a"]]', None, "invalid"), ("list", '{"a":1}', None, "invalid"), ("list", "[1,true]", None, "valid"), ("list", "[]", None, "not_applicable"), ("list", "[", None, "invalid"),
    ("boolean", "true", None, "valid"), ("boolean", "1", None, "invalid"), ("integer", "5", None, "valid"), ("integer", "5.0", None, "invalid"), ("float", "5.5", None, "valid"), ("double", "five", None, "invalid"),
]
_STRUCTS = [
    ('[{"k":"1","n":"2.5","b":"yes","x":9},"loose",null,{"k":null}]', '[{"k":"1","n":2.5,"b":true},{"k":null,"n":null,"b":null}]', "invalid"), ('[{"k":""},{"n":3}]', '[{"k":"","n":null,"b":null},{"k":null,"n":3.0,"b":null}]', "invalid"),
    ('[{"k":" "},{"n":0,"b":false}]', '[{"k":" ","n":null,"b":null},{"k":null,"n":0.0,"b":false}]', "valid"), ("[]", "[]", "not_applicable"), ("no list", None, "invalid"), (None, None, "not_applicable"), ('[{"k":[]}]', '[{"k":"[]","n":null,"b":null}]', "valid"),
]


@query(f"SELECT id, written FROM {_values([(i, r[3]) for i, r in enumerate(_COERCED)], 'id, written')}")
def coerce_kinds(spark, sf_dir):
    """Every kind, from JSON strings and from bare values."""
    d = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(_COERCED)], "id int, kind string, value string, quoted boolean")
    return d.select("id", V.coerce(F.col("value"), F.col("kind"), F.col("quoted")).alias("written"))


@query(f"SELECT id, validation FROM {_values([(i, r[3]) for i, r in enumerate(_CHECKED)], 'id, validation')}")
def validate_kinds(spark, sf_dir):
    """Trimmed values, patterns that are none, nulls and brackets in lists."""
    d = spark.createDataFrame([(i, *r[:2], V.pattern_that_compiles(r[2])) for i, r in enumerate(_CHECKED)], "id int, kind string, value string, pattern string")
    return d.select("id", V.validate(F.col("value"), F.col("kind"), F.col("pattern")).alias("validation"))


@query(f"SELECT id, coerced, validation FROM {_values([(i, *r[1:]) for i, r in enumerate(_STRUCTS)], 'id, coerced, validation')}")
def struct_kinds(spark, sf_dir):
    """Struct lists by the kinds of their members, and their validation."""
    d = spark.createDataFrame([(i, r[0]) for i, r in enumerate(_STRUCTS)], "id int, value string")
    return d.select("id", V.coerce_structs(F.col("value"), [("k", "string"), ("n", "number"), ("b", "boolean")]).alias("coerced"), V.validate_structs(F.col("value"), ["k", "n", "b"]).alias("validation"))


_ANSWERS = [
    ('{"x":{"value":"a","evidence":"q"}}', "a", "q", True), ('{"x":{"value":5,"evidence":""}}', "5", None, False), ('{"x":{"a":"1"}}', '{"a":"1"}', None, False), ('{"x":"bare"}', "bare", None, True), ('{"x":[1,"b"]}', '[1,"b"]', None, False),
    ('{"x":null}', None, None, False), ('{"y":1}', None, None, False), ("no json", None, None, False), ('{"x":{"evidence":"only"}}', None, "only", False), ('{"x":{"value":true,"evidence":7}}', "true", None, False), ('{"x":{"value":null,"evidence":"q"}}', None, "q", False),
]


@query(f"SELECT id, value, quote, quoted FROM {_values([(i, *r[1:]) for i, r in enumerate(_ANSWERS)], 'id, value, quote, quoted')}")
def parse_kinds(spark, sf_dir):
    """Answers with and without evidence, bare values, objects that are values, and what isn't there."""
    d = spark.createDataFrame([(i, r[0]) for i, r in enumerate(_ANSWERS)], "id int, response string").select("id", extract.parse(F.col("response"), F.lit("x")).alias("p"))
    return d.select("id", "p.value", "p.quote", "p.quoted")


@query(f"SELECT conv_id, value FROM (SELECT conv_id, string_agg(chr(123) || '\"r\":\"' || role || '\"' || chr(125), ',' ORDER BY t) AS value FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1, 2) GROUP BY 1)")
def struct_union(spark, sf_dir):
    """Objects are the same whatever the order of their members and the case of what they hold."""
    c = read(spark, sf_dir, "conversations")
    odd = F.col("turn") % 2 == 1
    one = F.concat(F.lit('{"r":"'), F.when(odd, F.col("role")).otherwise(F.col("role")), F.lit('"}'))
    partials = c.select("conv_id", F.col("turn").alias("chunk_index"), F.array(one, F.replace(one, F.lit('":"'), F.lit('" : "'))).alias("items"), F.lit(None).cast("string").alias("quote"))
    return extract.union_partials(partials, ["conv_id"]).select("conv_id", F.array_join("value", ",").alias("value"))


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'not_applicable' WHEN p_size % 5 = 1 THEN 'valid' WHEN p_size % 5 = 2 THEN 'invalid' ELSE CASE WHEN regexp_matches(p_brand, '#1') THEN 'valid' ELSE 'invalid' END END AS validation FROM part""")
def validate_values(spark, sf_dir):
    m = F.col("p_size") % 5
    value = F.when(m == 0, F.lit("  ")).when(m == 1, F.col("p_size").cast("string")).when(m == 2, F.lit("30 days")).otherwise(F.col("p_brand"))
    kind = F.when(m.isin(1, 2), "integer").otherwise("string")
    return read(spark, sf_dir, "part").select("p_partkey", V.validate(value, kind, F.when(m > 2, "#1")).alias("validation"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'not_applicable' WHEN 2 THEN 'invalid' ELSE 'invalid' END AS lists, CASE event_id % 3 WHEN 0 THEN 'valid' WHEN 1 THEN 'invalid' ELSE 'not_applicable' END AS structs FROM events""")
def validate_collections(spark, sf_dir):
    i = F.col("event_id")
    lists = F.when(i % 4 == 0, '["a","b"]').when(i % 4 == 1, "[]").when(i % 4 == 2, '["a",{"b":1}]').otherwise("no list")
    structs = F.when(i % 3 == 0, F.concat(F.lit("["), F.col("props"), F.lit("]"))).when(i % 3 == 1, '[{"other":"x"}]').otherwise(F.lit(None))
    return read(spark, sf_dir, "events").select("event_id", V.validate(lists, F.lit("list")).alias("lists"), V.validate_structs(structs, ["k"]).alias("structs"))


@query("""SELECT doc_id, 'Fields:' || chr(10) || '- lang: Which language?' || chr(10) || '- source: From where?' || chr(10) || chr(10) || 'Text:' || chr(10) || substr(text, 1, 200) AS prompt FROM documents""")
def prompts(spark, sf_dir):
    q = lambda n, t: F.struct(F.lit(n).alias("field_name"), F.lit(t).alias("question"))
    return read(spark, sf_dir, "documents").select("doc_id", extract.prompt(F.array(q("lang", "Which language?"), q("source", "From where?")), F.col("text"), 200).alias("prompt"))


@query("""SELECT doc_id, 'Fields:' || chr(10) || '- lang: Which language?' || chr(10) || '- source: From where?' || chr(10) || chr(10) || 'Text:' || chr(10) || text AS prompt FROM documents""")
def prompts_whole(spark, sf_dir):
    """As prompts, with whole documents."""
    q = lambda n, t: F.struct(F.lit(n).alias("field_name"), F.lit(t).alias("question"))
    return read(spark, sf_dir, "documents").select("doc_id", extract.prompt(F.array(q("lang", "Which language?"), q("source", "From where?")), F.col("text"), 2**31 - 1).alias("prompt"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE user_id::VARCHAR END AS value, CASE WHEN event_id % 2 = 0 AND event_id % 4 <> 0 THEN event_type || '!' END AS quote FROM events""")
def parse_responses(spark, sf_dir):
    i = F.col("event_id")
    quote = F.when(i % 4 == 0, F.lit(" ")).otherwise(F.concat("event_type", F.lit("!")))
    full = F.to_json(F.struct(F.struct(F.col("event_type").alias("value"), quote.alias("evidence")).alias("x")))
    bare = F.concat(F.lit('{"x":'), F.col("user_id").cast("string"), F.lit("}"))
    parsed = extract.parse(F.when(i % 2 == 0, full).otherwise(bare), F.lit("x"))
    return read(spark, sf_dir, "events").select("event_id", parsed.alias("p")).select("event_id", "p.value", "p.quote")


@query("""WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS item, generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, lower(trim(item)) ORDER BY turn, pos) AS r FROM w WHERE trim(item) <> ''),
q AS (SELECT conv_id, arg_min(text, turn) AS quote FROM conversations WHERE role = 'user' AND trim(text) <> '' GROUP BY 1)
SELECT c.conv_id, u.value, q.quote FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN (SELECT conv_id, string_agg(item, ' ' ORDER BY turn, pos) AS value FROM f WHERE r = 1 GROUP BY 1) u USING (conv_id) LEFT JOIN q USING (conv_id)""")
def map_union_first_seen(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    partials = c.select("conv_id", F.col("turn").alias("chunk_index"), F.split("text", " ").alias("items"), F.when(F.col("role") == "user", F.col("text")).alias("quote"))
    return extract.union_partials(partials, ["conv_id"]).withColumn("value", F.array_join("value", " "))


@query("""SELECT source, string_agg('[Table ' || doc_id || ', page ' || coalesce((nullif(doc_id % 3, 0))::VARCHAR, '?') || ']' || chr(10) || lang, chr(10) || chr(10) ORDER BY doc_id) AS rendered FROM documents GROUP BY 1""")
def rendered_tables(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("table_index"), F.nullif(F.col("doc_id") % 3, F.lit(0)).alias("page"), F.col("lang").alias("markdown"))
    return extract.render_tables(d, "source")


@query("""SELECT user_id, max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'purchase') AS purchase, max(value) FILTER (WHERE event_type = 'view') AS view FROM (SELECT user_id, event_type, max(value) AS value FROM events GROUP BY 1, 2) GROUP BY 1""")
def wide_rows(spark, sf_dir):
    tall = read(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("field_name")).agg(F.max("value").alias("value"))
    return extract.wide(tall, ["user_id"], ["click", "purchase", "view"])


@query("""WITH RECURSIVE t AS (SELECT lang, doc_id, least(n_chars // 4 + 2000, 50000) AS c, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents),
w AS (SELECT lang, doc_id, i, 0 AS wave, c AS held FROM t WHERE i = 1
UNION ALL SELECT t.lang, t.doc_id, t.i, CASE WHEN held + c > 50000 THEN wave + 1 ELSE wave END, CASE WHEN held + c > 50000 THEN c ELSE held + c END FROM w JOIN t ON t.lang = w.lang AND t.i = w.i + 1)
SELECT lang, doc_id, wave::BIGINT AS wave FROM w""")
def token_budget_waves(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("lang", "doc_id", (F.floor(F.col("n_chars") / 4) + 2000).alias("cost"))
    return extract.admit(d, ["lang"], "doc_id", "cost", 50000).select("lang", "doc_id", "wave")


def _quotes(spark, sf_dir):
    """A quote of each document: exact, with other case and spaces, with edits after the anchor, foreign, or none."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    part = F.substr("text", F.lit(21), F.lit(120))
    kind = F.col("doc_id") % 6
    edited = F.concat(F.substr(part, F.lit(1), F.lit(60)), F.lit("XX"), F.substr(part, F.lit(63), F.lit(58)))
    quote = F.when(kind == 0, part).when(kind == 1, F.replace(F.replace(part, F.lit(" "), F.lit("  ")), F.lit("e"), F.lit("E"))).when(kind == 2, edited).when(kind == 3, F.lit("no such words are in here 0123456789 at all")).when(kind == 4, F.lit(" "))
    return d.select("doc_id", "text", "n_chars", F.when(kind < 5, F.lit("v")).alias("value"), quote.alias("quote"))


@query(f"""WITH q AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN substr(text, 21, 120) WHEN 1 THEN replace(replace(substr(text, 21, 120), ' ', '  '), 'e', 'E') ELSE 'no such words are in here 0123456789 at all' END AS quote FROM documents)
SELECT doc_id, CASE WHEN {_NORM.format('quote')} = '' THEN 'not_found' WHEN contains(text, quote) THEN 'exact' WHEN contains({_NORM.format('text')}, {_NORM.format('quote')}) THEN 'normalized' ELSE 'not_found' END AS match_type FROM q""")
def locate_quotes(spark, sf_dir):
    """A quote of every document: as it stands, with other case and spaces, or foreign."""
    part, kind = F.substr("text", F.lit(21), F.lit(120)), F.col("doc_id") % 3
    quote = F.when(kind == 0, part).when(kind == 1, F.replace(F.replace(part, F.lit(" "), F.lit("  ")), F.lit("e"), F.lit("E"))).otherwise("no such words are in here 0123456789 at all")
    return evidence.locate(read(spark, sf_dir, "documents").select("doc_id", "text", F.lit("v").alias("value"), quote.alias("quote"))).select("doc_id", "match_type")


@query()
def locate_fuzzy(spark, sf_dir):
    """All tiers, the fuzzy one included; tests hold it against a plain version."""
    return evidence.locate(_quotes(spark, sf_dir)).select("doc_id", "match_type")


@query()
def fuzzy_ratios(spark, sf_dir):
    q = _quotes(spark, sf_dir)
    nq, nt = T.normalize(F.col("quote")), T.normalize(F.col("text"))
    return q.select("doc_id", F.round(ratio(nq, T.fuzzy_window(nq, nt)), 9).alias("ratio"))


@query(f"""WITH d AS MATERIALIZED (SELECT doc_id, text, {_NORM.format('text')} AS t FROM documents), b AS MATERIALIZED (SELECT item_id, text, {_NORM.format('text')} AS q FROM benchmark)
SELECT doc_id, item_id, CASE WHEN contains(d.text, b.text) THEN 'exact' ELSE 'normalized' END AS match_type, 'review' AS trust FROM d JOIN b ON contains(t, q)""")
def quote_trust(spark, sf_dir):
    return flagship(spark, sf_dir)


def flagship(spark, sf_dir):
    """Which quotes are in which documents, and how far that can be trusted before anyone judged it.

    A quote and a document meet on one of the quote's words, the one that the fewest documents hold,
    so the join is keyed and grows with what that word finds.
    """
    d = spread(read(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("t", T.normalize(F.col("text")))
    b = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote"), T.normalize(F.col("text")).alias("q"))
    hits = evidence.containing(d, b, "doc_id", "item_id")
    match = T.locate(F.col("quote"), F.col("text"))
    none = F.lit(None).cast("string")
    return hits.select("doc_id", "item_id", match.alias("match_type"), R.trust(F.col("quote"), match, none, F.lit(False), F.lit(False), none, none).alias("trust"))


@query(f"""WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), q AS (SELECT doc_id, {_NORM.format("substr(text, 1, 12)")} AS q FROM documents),
h AS (SELECT b.doc_id, min(i) AS i FROM b JOIN q USING (doc_id) WHERE length(q) > 0 AND contains({_NORM.format('t')}, q) GROUP BY 1)
SELECT q.doc_id, round(1.0 / h.i, 6)::DOUBLE AS conf_min, (h.i % 4)::INT AS page FROM q LEFT JOIN h USING (doc_id)""")
def block_confidence(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    blocks = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text")).select("doc_id", (F.col("i") + 1).alias("block_index"), F.round(1.0 / (F.col("i") + 1), 6).alias("conf_min"), ((F.col("i") + 1) % 4).alias("page"), "text")
    quotes = d.select("doc_id", F.substr("text", F.lit(1), F.lit(12)).alias("quote"))
    return evidence.block_confidence(quotes, blocks, "doc_id", []).select("doc_id", "conf_min", "page")


_MATCH = ("exact", "normalized", "fuzzy", "vision_page", "not_found", "na_null")
_DOMAIN = [(i, *r) for i, r in enumerate(product(("v", None), _MATCH, ("correct", "partial", "incorrect", "unverifiable", "odd", None), (True, False), (True, False), ("valid", "invalid", "not_applicable", None), ("high", "low", "confirmed", None)))]
_COLS = "id, value, match, verdict, judge_error, judged, validation, source"
_BASE = """CASE WHEN judge_error THEN 'review' WHEN NOT judged OR verdict IS NULL THEN CASE WHEN located THEN 'review' ELSE 'unknown' END WHEN verdict = 'incorrect' THEN 'low' WHEN verdict = 'unverifiable' THEN 'unknown' WHEN verdict = 'correct' AND located THEN 'high' ELSE 'review' END"""
_LIST = lambda xs: ", ".join("NULL" if x is None else str(x).lower() if isinstance(x, bool) else f"'{x}'" for x in xs)


@query(f"""WITH d AS (SELECT * FROM (SELECT unnest(['v', NULL]) AS value), (SELECT unnest([{_LIST(_MATCH)}]) AS match), (SELECT unnest(['correct', 'partial', 'incorrect', 'unverifiable', 'odd', NULL]) AS verdict), (SELECT unnest([true, false]) AS judge_error), (SELECT unnest([true, false]) AS judged), (SELECT unnest(['valid', 'invalid', 'not_applicable', NULL]) AS validation), (SELECT unnest(['high', 'low', 'confirmed', NULL]) AS source)),
b AS (SELECT *, {_BASE} AS base FROM (SELECT *, match IN ('exact', 'normalized', 'fuzzy', 'vision_page') AS located FROM d)),
p AS (SELECT *, CASE WHEN base = 'review' AND verdict = 'correct' AND source = 'confirmed' THEN 'high' ELSE base END AS up FROM b)
SELECT value, match, verdict, judge_error, judged, validation, source, CASE WHEN value IS NULL THEN 'unknown' WHEN up = 'high' AND (coalesce(validation, '') = 'invalid' OR coalesce(source, '') = 'low') THEN 'review' ELSE up END AS trust FROM p""")
def trust_fusion(spark, sf_dir):
    """Every combination of the categories."""
    d = spark.createDataFrame(_DOMAIN, "id int, value string, match string, verdict string, judge_error boolean, judged boolean, validation string, source string")
    c = F.col
    return d.select("value", "match", "verdict", "judge_error", "judged", "validation", "source", R.trust(c("value"), c("match"), c("verdict"), c("judge_error"), c("judged"), c("validation"), c("source")).alias("trust"))


_ROWS = """r AS (SELECT doc_id, source, CASE WHEN quality = 1 AND toxic = 0 THEN 'high' WHEN toxic = 1 THEN 'low' ELSE 'review' END AS trust, CASE doc_id % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy' WHEN 2 THEN 'normalized' ELSE 'not_found' END AS match_type, CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 10) / 10.0 END AS conf_min, CASE WHEN n_chars < 600 THEN 'low' ELSE 'ok' END AS document_flag FROM documents JOIN labels USING (doc_id))"""


def _rated(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    i = F.col("doc_id")
    trust = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "high").when(F.col("toxic") == 1, "low").otherwise("review")
    match = F.when(i % 4 == 0, "exact").when(i % 4 == 1, "fuzzy").when(i % 4 == 2, "normalized").otherwise("not_found")
    return d.select("doc_id", "source", trust.alias("trust"), match.alias("match_type"), F.when(i % 5 != 0, (i % 10) / 10.0).alias("conf_min"), F.when(F.col("n_chars") < 600, "low").otherwise("ok").alias("document_flag"))


@query(f"""WITH {_ROWS}, g AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE trust WHEN 'low' THEN 0 WHEN 'review' THEN 1 ELSE 3 END, CASE match_type WHEN 'not_found' THEN 0 WHEN 'fuzzy' THEN 1 WHEN 'normalized' THEN 3 ELSE 4 END, coalesce(conf_min, 1.0), doc_id) AS rank FROM r WHERE match_type IN ('fuzzy', 'not_found') OR trust IN ('review', 'low') OR conf_min < 0.7 OR document_flag = 'low')
SELECT source, doc_id, rank::INT AS rank FROM g WHERE rank <= 5""")
def escalation_topk(spark, sf_dir):
    return evidence.to_escalate(_rated(spark, sf_dir), "source", "doc_id", 5).select("source", "doc_id", "rank")


@query(f"WITH {_ROWS} SELECT doc_id, CASE WHEN document_flag = 'low' OR conf_min < 0.7 THEN 'low' WHEN conf_min IS NOT NULL THEN 'high' END AS source_verified, CASE doc_id % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'low' ELSE trust END AS folded FROM r")
def source_gate(spark, sf_dir):
    i = F.col("doc_id")
    verdict = F.when(i % 3 == 0, "confirmed").when(i % 3 == 1, "contradicted").otherwise("unclear")
    return _rated(spark, sf_dir).select("doc_id", R.source_verified(F.col("document_flag"), F.col("conf_min")).alias("source_verified"), R.fold_verdict(verdict, F.col("trust")).alias("folded"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size::VARCHAR WHEN p_size % 3 = 1 THEN CASE WHEN p_size % 2 = 0 OR p_size = 7 THEN '7' ELSE '7,' || p_size END ELSE '1,2,3' END AS pages FROM part""")
def page_resolution(spark, sf_dir):
    s = F.col("p_size")
    found = F.when(s % 3 == 1, F.array(F.lit(7), F.when(s % 2 == 0, F.lit(7)).otherwise(s), F.lit(None).cast("int")))
    pages = R.pages_to_read(F.when(s % 3 == 0, s), found, F.lit(3))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(pages, ",").alias("pages"))


def _trails(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    step = F.struct("ts", "event_id", F.col("event_type").alias("stage"))
    return e.groupBy("user_id").agg(F.array_sort(F.collect_list(step)).alias("steps"), (F.max("value") > 60).alias("interesting"))


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n, max(value) OVER (PARTITION BY user_id) > 60 AS interesting FROM events)
SELECT user_id, CASE WHEN interesting THEN r ELSE 1 END::INT AS step_seq, event_id, event_type AS stage FROM e WHERE interesting OR r = n""")
def audit_gated(spark, sf_dir):
    return audit.log(_trails(spark, sf_dir), ["user_id"]).select("user_id", "step_seq", "event_id", "stage")


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) SELECT user_id, arg_max(event_id, r) AS event_id FROM e WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY 1""")
def audit_terminal(spark, sf_dir):
    trail = audit.log(_trails(spark, sf_dir), ["user_id"], "full").withColumn("created_at", F.col("ts"))
    some = read(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id").distinct()
    return audit.terminal(trail, ["user_id"], some, "user_id").select("user_id", "event_id")


@query("SELECT doc_id, true AS ok, NULL::VARCHAR AS error FROM documents")
def provider_calls(spark, sf_dir):
    """Requests through a provider port, by the rule-based extractor."""
    d = read(spark, sf_dir, "documents")
    request = F.to_json(F.struct("text", F.create_map(F.lit("number"), F.lit(r"\d{3,}")).alias("patterns")))
    return providers.call(d.select("doc_id", request.alias("request")), "request", providers.rule_extractor).select("doc_id", "ok", "error")
