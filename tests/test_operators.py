"""What the catalogue's oracles don't reach: sequential versions, invariants, sources and ports."""

import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from factmill.functions import ids
from factmill.functions import text as T
from factmill.operators import audit, chunks, evidence, layout, scd2
from factmill.plans import fields
from factmill.sources import config, files, providers
from factmill.sources.snapshots import Store
from factmill.streaming import bronze

SF = "/root/testdata/sf0.001"
HISTORY = "k int, status string, version_id string, valid_from timestamp, valid_to timestamp, is_current boolean, doc_deleted boolean"


def history(spark, seed):
    rng = random.Random(seed)
    t = spark.createDataFrame([(k, "a", f"v{rng.randint(1, 2)}", None, None, rng.random() < 0.8, rng.random() < 0.1) for k in range(60)], HISTORY).withColumn("valid_from", F.lit("2024-01-01").cast("timestamp"))
    s = spark.createDataFrame([(k, "b", f"v{rng.randint(1, 3)}") for k in range(30, 90)], "k int, status string, version_id string").withColumn("valid_from", F.lit("2024-02-01").cast("timestamp"))
    return t, s


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_invariants(spark, seed):
    t, s = history(spark, seed)
    once = spark.createDataFrame(scd2.merge(t, s, "k").collect(), HISTORY)
    assert scd2.live(once).groupBy("k").count().where("count > 1").isEmpty()
    assert once.count() >= t.count()
    past = lambda df: sorted(map(str, scd2.not_live(df).collect()))
    assert set(past(t)) <= set(past(once))
    assert scd2.merge(once, s, "k").count() == once.count()
    assert scd2.merge(t.limit(0), s, "k").count() == s.count()


def test_force_selection():
    assert scd2.force_selection(None, None) is None and scd2.force_selection("none", None) is None
    assert scd2.force_selection("a, all", ["x"]) == "ALL" and scd2.force_selection(None, "x\ny") == ["x", "y"]


def test_code_fingerprint(tmp_path):
    f = tmp_path / "a.py"
    f.write_text("x = 1")
    one = ids.code_fingerprint([str(f)], {"size": 1})
    assert one == ids.code_fingerprint([str(f)], {"size": 1}) != ids.code_fingerprint([str(f)], {"size": 2})
    assert ids.file_fingerprint(str(tmp_path / "no.py")) == "missing:no.py" and len(one) == 16


def test_snapshots_change_together(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.tables() == {} and not store.exists("a")
    store.commit(a=spark.range(3), b=spark.range(1))
    store.commit(a=store.read("a").unionByName(spark.range(2)))
    assert store.read("a").count() == 5 and store.read("a", 0).count() == 3 and store.read("b").count() == 1


def pack(units, size):
    out, cur, held = [], [], 0
    for tokens, atomic in units:
        if cur and (held + tokens > size or atomic):
            out.append(cur)
            cur, held = [], 0
        cur.append(tokens)
        held += tokens
        if atomic:
            out.append(cur)
            cur, held = [], 0
    return out + ([cur] if cur else [])


def test_pack_against_a_loop(spark):
    rng = random.Random(3)
    cases = [[(rng.randint(0, 60), rng.random() < 0.2) for _ in range(rng.randint(0, 30))] for _ in range(80)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, us array<struct<tokens:int,atomic:boolean>>")
    for r in df.select("i", chunks.pack(F.col("us"), 100).alias("p")).collect():
        assert [[u.tokens for u in p] for p in r.p] == pack(cases[r.i], 100)


def test_table_split_repeats_the_header(spark):
    md = "|a|\n|---|\n" + "\n".join(f"|row {i}|" for i in range(9)) + "\n|" + "x" * 90 + "|"
    pieces = spark.createDataFrame([(md,), ("|a|\n|b|",)], "m string").select(chunks.split_table(F.col("m"), 12).alias("p")).collect()
    assert all(p.startswith("|a|\n|---|\n") for p in pieces[0].p) and pieces[1].p == ["|a|\n|b|"]
    assert [line for p in pieces[0].p for line in p.split("\n")[2:]] == md.split("\n")[2:]


def test_fuzzy_tier_against_difflib(spark):
    norm = lambda s: " ".join(s.split()).lower()
    for r in fields._quotes(spark, SF).where("doc_id % 6 = 2").withColumn("w", T.fuzzy_window(T.normalize(F.col("quote")), T.normalize(F.col("text")))).collect():
        q, t = norm(r.quote), norm(r.text)
        at = t.find(q[:40])
        if at < 0 and len(q) > 80:
            mid = t.find(q[len(q) // 2 :][:40])
            at = max(0, mid - len(q) // 2) if mid >= 0 else -1
        assert r.w == (t[at : at + len(q) + 20] if at >= 0 else None)
    got = {r.doc_id: r.match_type for r in evidence.locate(fields._quotes(spark, SF)).collect()}
    assert {got[i] for i in got if i % 6 == 5} <= {"na_null"} and {got[i] for i in got if i % 6 == 4} == {"not_found"}
    assert sum(got[i] == "fuzzy" for i in got if i % 6 == 2) > 0


def test_ratio_is_difflibs(spark):
    from factmill.functions.fuzzy import ratio

    rows = [("abcd", "bcde"), ("", "x"), (None, "x"), ("a" * 300 + "b", "a" * 299)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None if a is None else difflib.SequenceMatcher(None, a, b).ratio() for a, b in rows]


def test_captions_and_tables(spark):
    df = spark.createDataFrame([(["Map", "A Map of it", " Map  of ", "ocr text"],), ([],)], "p array<string>")
    assert [r[0] for r in df.select(layout.caption(F.col("p"), F.lit("Figure 1"), 30)).collect()] == ["Map — ocr text", "Figure 1"]
    cells = spark.createDataFrame([(1, 2, 2, 0, 0, 0, "a|b"), (1, 2, 2, 0, 0, 1, "c\nd"), (1, 2, 2, 5, 0, 2, "out"), (2, 0, 0, 0, 0, 0, "z")], "t int, n_rows int, n_cols int, row int, col int, seq int, text string")
    assert {r.t: r.markdown for r in layout.table_markdown(cells, ["t"]).collect()} == {1: "| c d |  |\n| --- | --- |\n|  |  |", 2: ""}


def test_audit_modes(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], False), (2, ["a", "b"], True)], "id int, s array<string>, interesting boolean").withColumn("steps", F.transform("s", lambda x: F.struct(x.alias("stage"))))
    log = lambda mode: sorted((r.id, r.step_seq, r.stage) for r in audit.log(df, ["id"], mode).collect())
    assert log("gated") == [(1, 1, "c"), (2, 1, "a"), (2, 2, "b")] and log("off") == [] and len(log("full")) == 5


def test_admission_keeps_the_budget():
    rng = random.Random(4)
    costs = [rng.randint(1, 900) for _ in range(200)]
    runs = list(providers.admitted(costs, 500))
    assert [i for r in runs for i in r] == list(range(200)) and all(sum(min(costs[i], 500) for i in r) <= 500 for r in runs)


def test_a_failing_request_is_a_row(spark):
    def odd(requests):
        if "bad" in requests:
            raise ValueError("no")
        return [r.upper() for r in requests]

    got = {r.q: (r.ok, r.payload) for r in providers.call(spark.createDataFrame([("a",), ("bad",), ("c",)], "q string").coalesce(1), "q", odd).collect()}
    assert got == {"a": (True, "A"), "bad": (False, None), "c": (True, "C")}
    assert providers.rule_judge([json.dumps({"value": "30 days", "quote": "in 30 days", "located": True}), json.dumps({"value": "x", "quote": "y", "located": False})]) == ["correct", "unverifiable"]


def test_inventory_stream_and_secrets(spark, tmp_path):
    folder = tmp_path / "in" / "sub"
    folder.mkdir(parents=True)
    (folder / "a.PDF").write_bytes(b"one")
    (folder / "b.txt").write_bytes(b"two")
    rows = files.listing(spark, str(tmp_path / "in")).collect()
    assert [(r.relative_path, r.size_bytes) for r in rows] == [("sub/a.PDF", 3)]
    store = Store(spark, str(tmp_path / "store"))
    build = lambda f: f.select(F.element_at(F.split("path", "/"), -1).alias("k"), F.sha2("content", 256).alias("version_id"), F.lit("2024-01-01").cast("timestamp").alias("valid_from"))
    for n in range(2):
        (folder / f"c{n}.pdf").write_bytes(b"three")
        bronze.start(spark, str(tmp_path / "in"), store, "inventory", build, "k", str(tmp_path / "cp")).awaitTermination(60)
    assert scd2.live(store.read("inventory")).count() == 4
    env = {}
    (tmp_path / "env").write_text("# c\nA=1\nB='x y'\nbad line\n")
    assert config.load_secrets([str(tmp_path / "no"), str(tmp_path / "env")], environ=env) and env == {"A": "1", "B": "x y"}
    with pytest.raises(RuntimeError):
        config.Context({"bronze": "/b", "gold": "/g"}, "bronze").expect("gold")
    with pytest.raises(ValueError):
        config.fields(spark, [])
    assert config.fields(spark, [{"field_name": "a", "question": "?", "type": "struct_list", "item_fields": [{"name": "x", "type": "string"}]}]).count() == 1
