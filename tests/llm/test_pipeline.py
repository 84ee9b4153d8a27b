"""The pipeline end to end, and its stages on odd rows."""

import hashlib
import random

import corpus_pipeline
import public_tokenizers
from test_corpus_operators import distance_in, near_brute_force
from tokenizers import Tokenizer

from factmill.llm import decontam, queries
from factmill.llm.common import read

SF = "/root/testdata/sf0.001"


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert 0 < len(rows) <= read(spark, SF, "documents").count()
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages_take_odd_rows_and_none(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0), (2, "one two three", "en", "s", 13), (2, "one two three", "en", "s", 13)], schema)
    for docs in (odd, odd.limit(0)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, SF)
            assert got.count() <= docs.count()
            if i < len(corpus_pipeline.STAGES) - 1:
                assert got.columns == docs.columns


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))


def test_passages_on_one_line_are_cut(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage, "en", "s", 0), (2, "before " + passage + " after", "en", "s", 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_deduplication(spark, docs, SF).collect()} == {1: (passage, len(passage)), 2: ("before after", 12)}


def cut_lines(rows):
    """Rows (id, text) less three-line windows that occurred before, then less runs of fifty words that did, by id and place."""
    def without(parts, size, seen):
        gone = set()
        for k in range(len(parts) - size + 1):
            run = tuple(parts[k : k + size])
            if any(p.strip() for p in run):
                gone |= set(range(k, k + size)) if run in seen else set()
                seen.add(run)
        return gone

    seen, out = set(), []
    for i, t in sorted(rows):
        lines = t.split("\n")
        gone = without(lines, 3, seen)
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    seen = set()
    for n, (i, t) in enumerate(out):
        words = t.split()
        gone = without(words, 50, seen)
        out[n] = (i, t if not gone else " ".join(w for k, w in enumerate(words) if k not in gone))
    return out


def test_run_against_brute_force(spark, tmp_path):
    """Clean prose, junk, abuse, repeated lines and passages, near copies and leaks, through all stages."""
    rng = random.Random(31)
    vocabulary = [a + b + c for a in ("ba", "de", "fi", "go", "ku", "la", "me", "ni") for b in ("n", "r", "st", "l", "m") for c in ("a", "ing", "er", "o")]
    prose = lambda n: [rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(n)]
    lines = lambda ws, n=9: "\n".join(" ".join(ws[k : k + n]) for k in range(0, len(ws), n))
    items = [" ".join(prose(16)) for _ in range(3)]
    shared, passage = [" ".join(prose(8)) for _ in range(4)], prose(60)
    rows, bad = [], set()
    for i in range(240):
        w = prose(rng.randint(40, 110) if i % 12 else 90)
        t = lines(w)
        if i % 12 == 1:
            t, _ = " ".join(x + "%%$" for x in w), bad.add(i)
        elif i % 12 == 2:
            t, _ = t + " you idiot and scum of a moron", bad.add(i)
        elif i % 12 == 3:
            t = t + "\n" + "\n".join(shared) + "\nend " + str(i)
        elif i % 12 == 4:
            t = t + " " + " ".join(passage) + " " + " ".join(prose(5))
        elif i % 12 == 5 and i > 12:
            w = rows[i - 5][1].split()
            w[45] = "other"  # no run of fifty words is left, and lines end elsewhere
            t = lines(w, 7)
        elif i % 12 == 6:
            leak = list(rng.choice(items))
            leak[rng.randrange(len(leak))] = "q"
            t = t + "\n" + "".join(leak)
        rows.append((i, t))
    sf = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 0 if i in bad and i % 12 == 1 else 1, int(i % 12 == 2)) for i in range(0, 240)], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")

    left = cut_lines([r for r in rows if r[0] not in bad])
    stay, links = near_brute_force(left)
    left = [r for r in left if r[0] in stay]
    found = lambda t: any(distance_in(decontam.normalise(q), decontam.normalise(t)) <= decontam.budget(decontam.normalise(q), decontam.ERROR_RATE) for q in items)
    kept = {i: t for i, t in left if not found(t)}
    assert links >= 10 and len(kept) < len(left) < 220
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = {i: hashlib.sha256(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for i, t in kept.items()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf).collect()} == wanted
