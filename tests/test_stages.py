"""Stages on small inputs: what their queries' oracles don't reach."""

import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from factmill.functions import matchers, values
from factmill.operators import evaluate, extract, layout, scd2, search
from factmill.sources import providers
from factmill.sources.snapshots import Conflict, Store
from factmill.stages import bronze, chunk, gold, measure, silver

TEXT = "# Deal\nThe parties are Acme Ltd of Rome and Bolt Inc.\n\nkey | value\nterm | 30 days\nfee | 5\nBolt Inc. is paid by Acme Ltd within 30 days of the invoice, always.\nGoverned by the law of the land; signed on 2024-01-05 by all of them."


def now():
    return F.lit("2024-01-01").cast("timestamp")


def later():
    return F.lit("2024-01-02").cast("timestamp")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def files(spark, rows):
    return spark.createDataFrame([(p, p, t, t) for p, t in rows], "relative_path string, file_name string, content_hash string, content string").withColumn("content_hash", F.sha2("content_hash", 256))


def test_commits_that_overlap_conflict(spark, store):
    """The one that comes second fails and changes nothing, whatever it read."""
    store.commit(x=spark.range(1), y=spark.range(1))
    other = Store(spark, store.root)

    class Late:
        """A table that is written only after another commit."""

        @property
        def write(self):
            other.commit(z=other.spark.range(5))
            return spark.range(2).write

    with pytest.raises(Conflict):
        store.commit(y=Late())
    assert {t: store.read(t).count() for t in store.tables()} == {"x": 1, "y": 1, "z": 5}
    store.commit(y=spark.range(2), append={"z": spark.range(3)})
    assert store.read("y").count() == 2 and store.read("z").count() == 8 and store.read("z", 1).count() == 5


def test_views_show_live_rows(spark, store):
    rows = spark.createDataFrame([(1, True, False), (2, True, True), (3, False, False)], "k int, is_current boolean, doc_deleted boolean")
    store.commit(t=rows, log=spark.range(2))
    assert sorted(store.views()) == ["log", "t_active"]
    assert [r.k for r in spark.sql("SELECT k FROM t_active").collect()] == [1]


def test_layout_of_tables_figures_and_furniture(spark):
    region = lambda page, polygon=None: [{"page": page, "polygon": polygon}]
    result = {
        "content": "x" * 200,
        "paragraphs": [
            {"role": "title", "content": " Title ", "regions": region(1), "spans": [{"offset": 0, "length": 5}]},
            {"role": "pageHeader", "content": "page 1", "regions": region(1), "spans": [{"offset": 6, "length": 5}]},
            {"role": None, "content": "in the table", "regions": region(1), "spans": [{"offset": 25, "length": 5}]},
            {"role": None, "content": "last, without a place", "regions": None, "spans": []},
            {"role": None, "content": "after", "regions": region(2), "spans": [{"offset": 90, "length": 5}]},
        ],
        "tables": [
            {"row_count": 1, "column_count": 2, "regions": region(1), "spans": [{"offset": 20, "length": 20}], "cells": [{"row": 0, "col": 1, "row_span": 0, "col_span": 2, "kind": None, "text": "a|b"}]},
            {"row_count": 0, "column_count": 0, "regions": None, "spans": [{"offset": 50, "length": 1}], "cells": []},
        ],
        "figures": [
            {"id": "f0", "caption": "A map", "ocr": "map", "regions": region(1, [0.0, 0.0, 5.0, 0.0, 5.0, 5.0, 0.0, 5.0]), "spans": [{"offset": 60, "length": 5}]},
            {"id": None, "caption": "logo", "ocr": None, "regions": region(1, [0.0, 0.0, 0.1, 0.0, 0.1, 0.1]), "spans": [{"offset": 61, "length": 5}]},
            {"id": None, "caption": None, "ocr": None, "regions": None, "spans": []},
        ],
        "pages": [{"width": 10.0, "height": 10.0, "words": [{"offset": 0, "length": 5, "confidence": 0.5}, {"offset": 2, "length": 1, "confidence": 0.9}, {"offset": 3, "length": 1, "confidence": None}]}, {"width": 10.0, "height": 10.0, "words": None}],
    }
    df = spark.createDataFrame([("d", json.dumps(result))], "relative_path string, payload string").select("relative_path", F.from_json("payload", layout.RESULT).alias("result"))
    told = spark.createDataFrame([("d", "f0", "roads and rivers")], "relative_path string, figure_id string, words string")
    blocks, tables = layout.build(df, "relative_path", uri_prefix=F.lit("figs"), described=told)
    got = [(r.type, r.section, r.page, r.text, r.table_id, r.figure_uri, r.conf_min, r.conf_mean) for r in blocks.orderBy("block_index").collect()]
    assert got == [
        ("prose", "Title", 1, "Title", None, None, 0.5, 0.7),
        ("table", "Title", 1, "|  | a\\|b |\n| --- | --- |", "t0", None, None, None),
        ("figure", "Title", 1, "[FIGURE p.1 — A map — roads and rivers]", None, "figs/p1_f0.png", None, None),
        ("prose", "Title", 2, "after", None, None, None, None),
        ("prose", "Title", None, "last, without a place", None, None, None, None),
        ("figure", "Title", None, "[FIGURE p.None — no caption]", None, "page=null&figure=2", None, None),
    ]
    assert [(r.table_id, r.n_rows, r.n_cols, json.loads(r.cells_json)) for r in tables.orderBy("table_index").collect()] == [("t0", 1, 2, [{"row": 0, "col": 1, "row_span": 1, "col_span": 2, "kind": "content", "text": "a\\|b"}]), ("t1", 0, 0, [])]


def test_a_file_that_fails_is_tried_again(spark, store):
    def odd(requests):
        if any("bad" in r for r in requests):
            raise ValueError("no")
        return providers.layout_of_text(requests)

    given = files(spark, [("a", TEXT), ("b", "bad\ntext of some kind that is long enough to be no heading")])
    silver.run(store, given, "c1", now(), odd)
    rows = {r.relative_path: r for r in store.read(silver.TEXT).collect()}
    assert rows["a"].extraction_error is None and rows["a"].has_tables and "ValueError" in rows["b"].extraction_error and rows["b"].extracted_text is None
    assert {r.relative_path for r in store.read(silver.BLOCKS).collect()} == {"a"}
    assert [r.relative_path for r in silver.todo(store, given.withColumn("code_hash", F.lit("c1"))).collect()] == ["b"]
    silver.run(store, given, "c1", later())
    assert store.read(silver.TEXT).count() == 2 and {r.relative_path for r in scd2.live(store.read(silver.BLOCKS)).collect()} == {"a", "b"}


def test_figure_images_are_saved_where_they_can_be(spark, store, tmp_path):
    figures = spark.createDataFrame([("a", "f0", "figs/p1_f0.png"), ("a", "bad", "figs/p1_f1.png")], "relative_path string, figure_id string, figure_uri string")

    def images(requests):
        if "bad" in requests:
            raise ValueError("no")
        return [b"png".hex() for _ in requests]

    got = {r.figure_uri: r.written for r in silver.figure_images(store, figures, images, str(tmp_path)).collect()}
    assert got == {"figs/p1_f0.png": True, "figs/p1_f1.png": False} and (tmp_path / "figs" / "p1_f0.png").read_bytes() == b"png"


FIELDS = [
    {"field_name": "term", "type": "string", "question": r"(\d+ days)", "source": "tables"},
    {"field_name": "signed", "type": "string", "question": r"(\d{4}-\d{2}-\d{2})"},
    {"field_name": "governed", "type": "boolean", "question": r"(yes|no such)"},
    {"field_name": "names", "type": "list", "question": r"([A-Z]\w+ (?:Ltd|Inc))", "reduce": "llm"},
    {"field_name": "fee", "type": "number", "question": r"fee\D+(\d+)", "extraction_strategy": "full_text"},
]


def whole(store, spark, mode="off", **how):
    silver.run(store, files(spark, [("a", TEXT), ("b", TEXT.replace("Acme", "Core"))]), "c1", now())
    chunk.run(store, "k1", now(), 30, 4)
    chunk.index(store)
    gold.run(store, FIELDS, "g1", now(), "full", mode=mode, **how)
    return {(r.relative_path, r.field_name): r for r in store.read(gold.TALL).collect()}


def test_all_strategies_over_all_stages(spark, store):
    rows = whole(store, spark)
    a = {f: rows["a", f] for f in ("term", "signed", "governed", "names", "fee")}
    assert {f: r.extraction_strategy for f, r in a.items()} == {"term": "tables", "signed": "rag", "governed": "retrieve_classify", "names": "map_reduce", "fee": "full_text"}
    assert a["term"].value == "30 days" and a["signed"].value == "2024-01-05" and a["fee"].value == "5.0"
    assert json.loads(a["names"].value) == ["Acme Ltd", "Bolt Inc"] and json.loads(rows["b", "names"].value) == ["Core Ltd", "Bolt Inc"]
    assert a["governed"].value is None and a["governed"].match_type == "na_null" and a["governed"].trust == "unknown"
    assert a["signed"].match_type == "exact" and a["signed"].judge_verdict == "correct" and json.loads(a["names"].retrieved_chunk_ids)
    assert a["term"].match_type == "not_found" or a["term"].evidence_page == 1
    trail = store.read(gold.TRAIL)
    assert trail.count() == 2 * len(rows) and {r.stage for r in gold.current_trail(store).collect()} == {"judge"}
    assert gold.current_trail(store).count() == len(rows)
    wide = {r.relative_path: r for r in store.read(gold.WIDE).collect()}
    assert wide["a"].fee == 5.0 and wide["a"].governed is None and wide["a"].extraction_error is None
    assert gold.todo(store, "g1")[1].isEmpty() and gold.todo(store, "g2")[1].count() == 2
    ids = {r.chunk_id for r in store.read(chunk.INDEX).collect()}
    assert ids == {r.chunk_id for r in store.read(chunk.POSTINGS).collect()} == {r.chunk_id for r in scd2.live(store.read(chunk.TABLE)).collect()}
    silver.run(store, files(spark, [("b", TEXT.replace("Acme", "Core"))]), "c1", later())
    chunk.run(store, "k1", later(), 30, 4)
    chunk.index(store)
    gold.run(store, FIELDS, "g1", later())
    assert {r.relative_path for r in store.read(chunk.INDEX).collect()} == {"b"}
    assert {r.relative_path for r in scd2.live(store.read(gold.TALL)).collect()} == {"b"} == {r.relative_path for r in scd2.live(store.read(gold.WIDE)).collect()}


def test_a_call_that_fails_is_an_error_of_its_document(spark, store):
    def odd(requests, fmt):
        if fmt == "json_schema":
            raise ValueError("not in this format")
        if any("Core" in r and "fee" in r for r in requests):
            raise ValueError("no answer")
        return providers.rule_extractor(requests)

    rows = whole(store, spark, provider=odd)
    assert {p for p, _ in rows} == {"a"}
    wide = {r.relative_path: r for r in store.read(gold.WIDE).collect()}
    assert "no answer" in wide["b"].extraction_error and wide["b"].fee is None and wide["a"].fee == 5.0
    assert [r.relative_path for r in gold.todo(store, "g1")[1].collect()] == ["b"]


def test_pages_confirm_and_correct(spark, store):
    def misread(requests, _):
        answers = [json.loads(a) for a in providers.rule_extractor(requests)]
        for a in answers:
            if "signed" in a:
                a["signed"] = {"value": "2042-01-05", "evidence": "signed on 2042-01-05"}
        return [json.dumps(a) for a in answers]

    checked = whole(store, spark, "verify", provider=misread)
    assert checked["a", "signed"].vision_action == "verify" and checked["a", "signed"].vision_verdict in ("contradicted", "unclear") and checked["a", "signed"].value == "2042-01-05"
    assert checked["a", "governed"].vision_action == "none"


def test_a_corrected_value_is_judged_again(spark, tmp_path):
    store = Store(spark, str(tmp_path / "second"))

    def misread(requests, _):
        answers = [json.loads(a) for a in providers.rule_extractor(requests)]
        for a in answers:
            if "signed" in a:
                a["signed"] = {"value": "2042-01-05", "evidence": "signed on 2042-01-05"}
        return [json.dumps(a) for a in answers]

    rows = whole(store, spark, "correct", provider=misread, most_fields=-1)
    r = rows["a", "signed"]
    assert (r.value, r.original_value, r.value_source, r.source_verified, r.match_type, r.judge_verdict, r.trust) == ("2024-01-05", "2042-01-05", "vision", "confirmed", "exact", "correct", "high")
    stages = [x.stage for x in store.read(gold.TRAIL).where("relative_path = 'a' and field_name = 'signed'").orderBy("step_seq").collect()]
    assert stages == ["extract", "judge", "vision_verify", "vision_correct", "rejudge"]
    assert rows["a", "governed"].value is None and rows["a", "governed"].vision_action == "none"
    with pytest.raises(ValueError):
        gold.extracted(store, store.read(silver.TEXT), gold.Plan(spark, FIELDS), mode="guess")


def test_measures_use_the_judge_and_append(spark, store):
    whole(store, spark)
    truth = spark.createDataFrame([("A", "signed", "05 January 2024", "date"), ("a", "names", "Acme Ltd; Bolt Inc", None), ("a", "term", "thirty days", "judge"), ("none", "term", "x", None)], "file_name string, field_name string, expected string, strategy string")
    for run in ("r1", "r2"):
        measure.run(store, truth, FIELDS, run, now())
    rows = {r.field_name: r for r in store.read(measure.TABLE).where("run_id = 'r2'").collect()}
    assert store.read(measure.TABLE).count() == 6 and len(rows) == 3
    assert rows["signed"].passed and rows["names"].score == 1.0 and rows["names"].strategy == "set_f1"
    assert abs(rows["term"].score - 1 / 3) < 1e-9 and not rows["term"].passed and rows["term"].rationale.startswith("other: ")
    with pytest.raises(ValueError):
        measure.run(store, truth.where("file_name = 'none'"), FIELDS, "r3", now())


def test_a_judge_that_fails_scores_nothing(spark):
    def broken(requests):
        raise ValueError("no judge")

    df = spark.createDataFrame([("judge", "a", "a"), ("string", "a", "A!")], "strategy string, expected string, actual string")
    got = {r.strategy: (r.score, r.passed, r.rationale) for r in evaluate.score(df, broken).collect()}
    assert got == {"judge": (0.0, False, "judge_error: ValueError: no judge"), "string": (1.0, True, None)}
    beyond = evaluate.score(df, lambda rs: ['{"score": 7, "verdict": "same"}' for _ in rs]).where("strategy = 'judge'").first()
    assert (beyond.score, beyond.passed, beyond.rationale) == (1.0, True, "same: ")


def test_fuzzy_scores_are_difflibs(spark):
    rows = [("Acme Ltd", "acme limited"), ("", None), ("a", ""), ("the law of the land", "law of the land!"), ("x y", "z")]
    got = [r.s for r in spark.createDataFrame(rows, "e string, a string").select(matchers.fuzzy_score(F.col("e"), F.col("a")).alias("s")).collect()]
    norm = lambda t: " ".join("".join(c if c.isalnum() or c == "_" else " " for c in (t or "").lower()).split())
    wanted = []
    for e, a in ((norm(x), norm(y)) for x, y in rows):
        wanted.append(1.0 if not e and not a else 0.0 if not e or not a else max(SequenceMatcher(None, e, a).ratio(), 0.9 if e in a or a in e else 0))
    assert all(abs(g - w) < 1e-9 for g, w in zip(got, wanted))


def test_dates_in_all_formats(spark):
    rows = [("Jan 5, 2024", "2024-01-05"), ("12/25/2024", "2024-12-25"), ("5/1/2024", "2024-01-05"), ("on 2024/1/5.", "2024-01-05"), ("5 January 2024", "2024-01-05"), ("5 jan 2024", "2024-01-05"), ("January 5, 2024", "2024-01-05"), ("5.1.2024", "5.1.2024"), (" Perpetual. ", "Perpetual."), (None, None)]
    df = spark.createDataFrame(rows, "v string, w string")
    assert [r.d for r in df.select(values.to_date(F.col("v")).alias("d")).collect()] == [w for _, w in rows]
    assert df.select(matchers.date_score(F.lit("Perpetual."), F.lit("perpetual")).alias("s")).first().s == 1.0


def test_response_format_is_strict_all_the_way():
    fields = [{"field_name": "a", "type": "float"}, {"field_name": "b", "type": "struct_list", "item_fields": [{"name": "n", "type": "double"}, {"name": "s"}]}, {"field_name": "c"}, {"field_name": "d", "type": "list"}]
    made = extract.response_schema(fields)
    body = made["json_schema"]
    assert made["type"] == "json_schema" and body["strict"] and body["schema"]["required"] == ["a", "b", "c", "d"]
    value = lambda n: body["schema"]["properties"][n]["properties"]["value"]
    assert value("a") == {"type": ["number", "null"]} and value("c") == {"type": ["string", "null"]} and value("d")["items"] == {"type": "string"}
    assert value("b")["items"] == {"type": "object", "properties": {"n": {"type": ["number", "null"]}, "s": {"type": ["string", "null"]}}, "required": ["n", "s"], "additionalProperties": False}
    assert extract.wide_schema(fields) == {"a": "double", "b": "string", "c": "string", "d": "string"}


def test_union_keeps_first_spellings_and_objects(spark):
    rows = [("d", 1, [" Acme", '{"a":"1","b":"2"}'], None), ("d", 2, ["ACME ", '{"b":"2","a":"1"}', "Bolt", " "], " "), ("d", 3, None, "said"), ("e", 1, [], None)]
    got = {r.doc: (r.value, r.quote) for r in extract.union_partials(spark.createDataFrame(rows, "doc string, chunk_index int, items array<string>, quote string"), ["doc"]).collect()}
    assert got == {"d": ([" Acme", '{"a":"1","b":"2"}', "Bolt"], "said"), "e": (None, None)}
    made = spark.createDataFrame([(['x"y', '{"a":1}', "z]"],)], "v array<string>").select(extract.items_json(F.col("v")).alias("j")).first().j
    assert json.loads(made) == ['x"y', {"a": 1}, "z]"]


def test_quotes_meet_on_their_rarest_word(spark):
    from factmill.operators import evidence

    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["the quick brown fox", "a quick brown fox jumps", "brown", "", "the the the"])], "doc int, t string")
    quotes = spark.createDataFrame([(i, q) for i, q in enumerate(["k brown fo", "quick brown fox", "ow", "", "the the", "no such words here"])], "item int, q string")
    got = {(r.doc, r.item) for r in evidence.containing(texts, quotes, "doc", "item").collect()}
    assert got == {(d, i) for d, t in [(r.doc, r.t) for r in texts.collect()] for i, q in [(r.item, r.q) for r in quotes.collect()] if q and q in t}


def test_bm25_asks_no_job_while_it_is_planned(spark):
    index = search.postings(spark.createDataFrame([(1, "a b b"), (2, "a c")], "chunk int, text string"), "chunk")
    found = search.bm25(index, spark.createDataFrame([("q", "b"), ("q", "a")], "q string, term string"), "chunk", "q")
    assert {r.chunk for r in found.collect()} == {1, 2} and "BroadcastNestedLoop" not in found._jdf.queryExecution().toString()


def test_chunks_in_tokens_of_a_vocabulary(spark):
    import public_tokenizers

    from factmill.functions import tokens
    from factmill.operators import chunks

    text = " ".join(f"word{i} is here" for i in range(60))
    for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"):
        path = public_tokenizers.path(name)
        df = spark.createDataFrame([(1, "prose", text), (2, "prose", "short"), (3, "figure", text), (4, "prose", " ")], "block_index int, type string, text string")
        got = chunks.units(df, 40, 8, path).orderBy("block_index", "part").select("block_index", "part", "text", tokens.length(F.col("text"), path).alias("n")).collect()
        mine = [r for r in got if r.block_index == 1]
        assert len(mine) > 3 and all(r.n <= 41 for r in mine) and mine[0].text.startswith("word0 is") and mine[-1].text.endswith("word59 is here")
        assert [r.text for r in got if r.block_index > 1] == ["short", text]
    assert [r.n for r in spark.createDataFrame([(None,), ("",)], "t string").select(tokens.length(F.col("t"), path).alias("n")).collect()] == [0, 0]


def test_layers_are_mounted_once():
    from factmill.sources.config import Context

    c = Context({"gold": "/g"}, "gold")
    assert c.mount("silver", "/s") == c.mount("silver", "/s") == "/s" and c.expect("gold") == "/g"
    with pytest.raises(RuntimeError):
        c.mount("silver", "/other")


def test_figures_are_described_where_the_model_can(spark):
    def eyes(requests):
        if any("f1" in r for r in requests):
            raise ValueError("no")
        return ["roads" for _ in requests]

    page = {"content": "", "paragraphs": [], "tables": [], "figures": [{"id": i, "caption": None, "ocr": "map", "regions": [{"page": 1}], "spans": [{"offset": k, "length": 1}]} for k, i in enumerate(["f0", "f1", None])], "pages": [{"width": 1.0, "height": 1.0, "words": []}]}
    given = spark.createDataFrame([("d", "x")], "relative_path string, content string")
    text, blocks, _ = silver.extract(given, lambda rs: [json.dumps(page) for _ in rs], describe=eyes)
    assert [r.text for r in blocks.orderBy("block_index").collect()] == ["[FIGURE p.1 — roads — map]", "[FIGURE p.1 — map]", "[FIGURE p.1 — map]"]
    assert text.first().has_figures and text.first().extracted_text.startswith("[FIGURE")


def test_a_path_listed_twice_keeps_the_name_it_had(spark, store):
    """As stage_bronze's SQL has it: what follows a live row has that row's name, and every file of the path follows it."""
    listed = lambda *rows: spark.createDataFrame([("p", n, 1, h) for n, h in rows], "relative_path string, file_name string, size_bytes int, content_hash string")
    bronze.run(store, listed(("1", "a")), "c1", now())
    bronze.run(store, listed(("1", "a"), ("2", "b"), ("3", "c")), "c1", later())
    got = sorted((r.file_name, r.content_hash, r.is_current) for r in store.read(bronze.TABLE).collect())
    assert got == [("1", "a", False), ("1", "a", False), ("1", "a", True), ("1", "b", True), ("1", "c", True)]


def test_answers_leave_python_call_by_call(spark):
    """A worker holds the answers of one call, not those of a whole batch of rows."""
    import pyarrow as pa

    class Rows:
        """A table whose Python step is handed back, to be run here."""

        sparkSession, schema = spark, spark.createDataFrame([], "i int, r string").schema

        def mapInArrow(self, run, _):
            return run

    asked = []

    def provider(requests):
        asked.append(len(requests))
        return [r.upper() for r in requests]

    batch = pa.RecordBatch.from_pydict({"i": [1, 2, 3, None, 5], "r": ["a" * 40, None, "b" * 40, "c", "d" * 400]})
    out = providers.call(Rows(), "r", provider, budget=12, reserve=1)([batch])
    first = next(out)
    assert asked == [2] and first.num_rows == 2 and first.column("payload").to_pylist() == ["A" * 40, ""]
    rest = [r for b in out for r in b.to_pylist()]
    assert asked == [2, 2, 1]
    assert [(r["i"], r["ok"], r["payload"], r["error"]) for r in rest] == [(3, True, "B" * 40, None), (None, True, "C", None), (5, True, "D" * 400, None)]
    vectors = providers.embed(Rows(), "r", lambda ts: asked.append(-len(ts)) or [[0.0]] * len(ts), 2)([batch])
    assert next(vectors).num_rows == 2 and asked[-1] == -2


def test_text_needs_blocks_of_few_documents_only(spark):
    """Quality comes from a document's own row; white space goes at the very ends alone; blank content and figures still ask the blocks."""
    from factmill.functions import text as T

    word = lambda at, conf: {"offset": at, "length": 1, "confidence": conf}
    page = lambda words: {"width": 1.0, "height": 1.0, "words": words}
    made = {
        "a": {"content": " whole \u2028", "pages": [page([word(0, 0.95), word(None, 0.1), word(2, None)]), page(None), page([word(4, 0.2), word(5, 0.9)])], "figures": []},
        "b": {"content": " \n", "pages": None, "figures": None},
        "c": {"content": "text", "pages": [page([word(0, 0.1)])], "figures": [{"id": None, "caption": "map", "ocr": None, "regions": [{"page": 1}], "spans": [{"offset": 0, "length": 1}]}]},
    }
    prose = [{"role": None, "content": "said", "regions": [{"page": 1}], "spans": [{"offset": 0, "length": 4}]}]
    given = spark.createDataFrame([(k, json.dumps(v | {"paragraphs": prose, "tables": []})) for k, v in made.items()], "relative_path string, content string")
    text, _, _ = silver.extract(given, lambda rs: rs)
    got = {r.relative_path: (r.extracted_text, r.page_count, r.has_figures, r.di_quality, r.di_quality_flag) for r in text.collect()}
    assert got == {"a": ("whole \u2028", 3, False, 2 / 3, "ok"), "b": ("said", 0, False, None, None), "c": ("text", 1, True, 0.0, "low")}
    share, flag = layout.pages_quality(F.col("result.pages"))
    results = given.select("relative_path", F.from_json("content", layout.RESULT).alias("result"))
    old = layout.document_quality(layout.word_confidences(results, "relative_path"), "relative_path")
    assert sorted(results.select("relative_path", share.alias("q"), flag.alias("f")).where("q is not null").collect()) == sorted(old.collect())
    assert spark.range(1).select(T.strip(F.lit("\t x \u2028"))).first()[0] == "x \u2028"


def test_nearest_holds_the_best_of_all_pairs(spark):
    """Against cosine() over every pair: copies and ties, no vector, nulls in it, zero and NaN, other lengths, many deals and blocks."""
    import random

    draw = random.Random(7)
    rows = [(i, i % 3, [float(draw.randint(-2, 2)) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, 0, [1.0, 2.0, 0.0, 1.0]) for i in range(30)]
    rows += [(300, 1, None), (301, 1, [1.0, None, 0.0, 1.0]), (302, 1, [0.0] * 4), (303, 1, [1.0, 2.0]), (304, 1, [float("nan"), 1.0, 0.0, 0.0]), (305, None, [1.0] * 4), (306, 9, [1.0] * 4), (307, 9, [])]
    e = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    q = e.where("vec_id % 10 = 0 or vec_id >= 300").select(F.col("vec_id").alias("q"), F.col("embedding").alias("qe"), "label")
    every = q.join(e, "label").where("q <> vec_id").select("q", "vec_id", "label", search.cosine(F.col("qe"), F.col("embedding")).alias("score"))
    best = lambda df: sorted((r.q, r.rank, r.vec_id, r.label, str(r.score)) for r in search.top_k(df.withColumn("score", F.round("score", 4)), ["q"], 5, "vec_id").collect())
    wanted = best(every)
    assert best(search.nearest(q, e, "q", "vec_id", "label", 5)) == wanted
    few = search.nearest(q, e, "q", "vec_id", "label", 5, per_deal=20, block=30)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that groups lie apart
    try:
        assert best(few) == wanted and few.count() < every.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
