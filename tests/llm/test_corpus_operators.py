"""Each operator against a brute-force version, on rows with nulls, empties, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factmill.llm import bpe, components, decontam, exact_dedup, html_extract, line_dedup, lm_score, myers, quality, sharding, simhash, token_counts

SCHEMA = "doc_id bigint, text string, size string, kept string, h int"
WORDS = "alpha beta gamma delta épsilon Zeta eta theta iota kappa".split()


def some_texts(seed=3, n=60):
    rng = random.Random(seed)
    rows = [(i, "\n".join(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 6)))) for i in range(n)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, rows[0][1]), (104, rows[0][1].upper()), (105, rows[1][1] + " eta"), (None, "no id"), (106, "ß Σίσυφος 's don't 12,5 <|endoftext|> x y"), (107, "word " * 9000), (7, rows[7][1])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in some_texts()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return (t or "").encode().lower()


def test_exact_dedup(docs, empty):
    got = exact_dedup.exact_groups(docs, block_bytes=8).collect()
    groups = collections.defaultdict(list)
    for i, t in some_texts():
        groups[lower(t)].append(i)
    by_sha = {hashlib.sha256(k).hexdigest(): v for k, v in groups.items()}
    assert len(got) == len(some_texts())
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    for sha in by_sha:
        assert sum(r.kept for r in got if r.text_sha256 == sha) == 1
    assert len({(r.level, r.name) for r in got}) == len(by_sha)
    assert exact_dedup.exact_groups(empty).collect() == []


def test_exact_dedup_survives_equal_digests(docs):
    """Blocks that share a digest are told apart by content."""
    rows = docs.where("doc_id < 12 or doc_id > 100")
    results = lambda **more: {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_groups(rows, block_bytes=16, **more).collect()}
    assert results(digest=lambda b: len(b) % 3 + sum(b[:1]) % 2) == results()


def test_sharding(docs, empty):
    got = sharding.shard(docs, shards=5).collect()
    texts = collections.defaultdict(list)
    for i, t in some_texts():
        texts[i].append(t)
    for r in got:
        assert any(r.size == len((t or "").encode()) + 8 and r.text_crc32 == zlib.crc32((t or "").encode()) for t in texts[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 5
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len(got) == len(some_texts())
    assert sharding.shard(empty).collect() == []


def check_shards(rows, got, shards, share=0.01):
    """The law, by hand: records in key order, cut near the even places, small groups of equal texts whole, slots in that order."""
    sizes = [len((t or "").encode()) + 8 for _, t in rows]
    total, largest = sum(sizes), max(sizes)
    assert collections.Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows) == collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    groups = collections.defaultdict(list)
    for r in got:
        groups[r.text_crc32, r.size].append(r)
    whole = max((sum(r.size for r in g) for g in groups.values() if sum(r.size for r in g) <= share * total / shards), default=0)
    for s in range(shards):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / shards) <= 2 * (0.001 * total / shards + max(largest, whole))
    for g in groups.values():
        if sum(r.size for r in g) <= share * total / shards:
            assert len({r.shard for r in g}) == 1
        order = sorted(g, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        places = [(r.shard, r.slot) for r in order]
        ids = [r.doc_id for r in order]
        assert len(set(ids)) < len(ids) or places == sorted(places)
        by_shard = collections.defaultdict(list)
        for r in g:
            by_shard[r.shard].append(r.slot)
        assert all(max(v) - min(v) + 1 == len(v) for v in by_shard.values())  # equal texts lie together


@pytest.mark.parametrize("hot", [0, 3])
def test_sharding_by_its_law(spark, hot):
    rng = random.Random(21)
    rows = [(i, "the same text " * 20 if hot and i % hot == 0 else f"text {i // 2 if i % 5 else i} " * rng.randint(0, 40)) for i in range(6000)]
    rows += [(None, "no id"), (None, "no id"), (5, rows[5][1]), (5, rows[5][1]), (7000, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, size int, rid string").repartition(7)
    got = sharding.shard(docs, rows_per_range=100).collect()
    check_shards(rows, got, 24)


def test_sharding_of_rows_that_repeat_whole_and_of_long_texts(spark):
    rows = [(1, "one row many times") for _ in range(3000)]
    check_shards(rows, sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), 24)
    rows = [(1, "x" * 2_000_000), (2, "y" * 10)] + [(i, "z" * 1000 + str(i)) for i in range(3, 60)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=3).collect()
    assert len(got) == len(rows) and {r.shard for r in got} <= {0, 1, 2}


def test_sharding_runs_without_python(spark):
    plan = sharding.shard(spark.createDataFrame([(i, str(i)) for i in range(50)], "doc_id bigint, text string"), shards=2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_line_dedup(docs, empty):
    rows = [(1, "a\nb\nc\nd", 0), (2, "x\na\nb\nc\ny", 0), (3, "b\nc\nd\nb\nc\nd", 0), (4, "a\nb", 0), (5, None, 0), (6, "", 0), (7, "\n\n\n\n", 0), (8, "a\nb\nc", 0), (None, "p\nq\nr", 0), (9, "p\nq\nr", 0), (4, "a\nb", 0)]
    df = docs.sparkSession.createDataFrame(rows, "doc_id bigint, text string, lines_in int")
    got = {r.doc_id: (r.text, r.lines_in, r.lines_removed) for r in line_dedup.drop_repeated_lines(df).collect()}
    assert got == {1: ("a\nb\nc\nd", 4, 0), 2: ("x\ny", 5, 3), 3: ("", 6, 6), 4: ("a\nb", 2, 0), 5: (None, 0, 0), 6: ("", 1, 0), 7: ("\n\n\n\n", 5, 0), 8: ("", 3, 3), None: ("p\nq\nr", 3, 0), 9: ("", 3, 3)}
    assert line_dedup.drop_repeated_lines(empty).collect() == []
    assert line_dedup.drop_repeated_lines(docs).count() == len(some_texts())


def test_repeated_passages_go_whole_however_they_lie_on_lines(spark):
    rng = random.Random(12)
    prose = lambda n: [f"w{rng.randrange(10**6)}é" for _ in range(n)]
    passages = [prose(n) for n in (50, 51, 60, 75, 120, 49)]
    rows = [(i, " ".join(p), 1) for i, p in enumerate(passages)]
    for i in range(10, 40):
        p = rng.choice(passages)
        rows.append((i, " ".join([*prose(rng.randint(0, 80)), ""]) + "".join(w + rng.choice(["  ", " ", "\n"] if i % 2 else [" "]) for w in p) + " ".join(prose(rng.randint(0, 80))), 1))
    rows += [(50, "same " * 300, 1), (51, None, 1), (52, "", 1), (None, " ".join(passages[4][10:80]), 1), (3, rows[3][1], 1), (53, "x\n" + " ".join(passages[2]) + "\ny z", 1)]
    seen, wanted = set(), collections.Counter()
    for i, t in sorted({r[:2] for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        ws = (t or "").split()
        gone = set()
        for k in range(len(ws) - 49):
            run = tuple(ws[k : k + 50])
            gone |= set(range(k, k + 50)) if run in seen else set()
            seen.add(run)
        wanted[i, None if t is None else tuple(w for k, w in enumerate(ws) if k not in gone)] += sum(r[:2] == (i, t) for r in rows)
    left = line_dedup.drop_repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string, size int").repartition(3)).collect()
    assert collections.Counter((r.doc_id, None if r.text is None else tuple(r.text.split())) for r in left) == wanted
    assert {r.text for r in left if r.doc_id == 53} == {"x\ny z"}
    assert line_dedup.drop_repeated_passages(spark.createDataFrame(rows[:0], "doc_id bigint, text string, size int")).collect() == []


def brute_fingerprint(t, width):
    ws = lower(t).split()
    sh = [b" ".join(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))] if ws else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_groups(docs, empty):
    rows = some_texts()
    fps = [brute_fingerprint(t, 3) for _, t in rows]
    got = collections.Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_groups(docs).collect())
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    wanted = collections.Counter((d, fps[i], min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))
    assert got == wanted
    assert simhash.near_groups(empty).collect() == []


@pytest.mark.parametrize("grid", [(1, 8), (1, 4), (2, 2), (2, 4), (3, 2), (4, 8)])
def test_simhash_links_are_complete(spark, grid):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for f in list(fps):
        for _ in range(3):
            g = f
            for _ in range(rng.randint(1, 5)):
                g ^= 1 << rng.randrange(64)
            fps.add(g)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    radius = 2 if grid[0] == 1 else 3
    got = {(r.u, r.v) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), radius, *grid).collect()}
    wanted = {(min(a, b), max(a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    assert got == wanted


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(30)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}


def near_brute_force(rows, width=5, similarity=0.8):
    """Rows (id, text) that stay, by comparing all pairs."""
    def shingles(t):
        ws = lower(t).split()
        return {tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))}

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = 0
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= similarity * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
                links += sets[i] != sets[j]
    least = {}
    for i, (d, t) in enumerate(rows):
        k = (d is None, d or 0)
        least[find(i)] = min(least.get(find(i), (k, i)), (k, i))
    return {rows[i][0] for _, i in least.values()}, links


def near_rows(seed, bases, copies, words):
    """Texts and copies of them with scattered words changed, or with a block added or cut, most about a similarity of 0.8."""
    rng = random.Random(seed)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for _ in range(bases):
        base = prose(rng.randint(*words))
        rows.append(base)
        for _ in range(copies):
            w = list(base)
            if rng.random() < 0.5:
                for k in rng.sample(range(len(w)), rng.randint(1, max(1, len(w) // 35))):
                    w[k] = "x"
            elif rng.random() < 0.5:
                w[rng.randrange(len(w)) : 0] = prose(rng.randint(1, len(w) // 4))
            else:
                k = rng.randrange(len(w))
                del w[k : k + rng.randint(1, len(w) // 5)]
            rows.append(w)
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def test_near_copies_leave_one_of_each_group(spark):
    """Against exact similarities of all pairs: whatever the edits, every group that links connect leaves its smallest id."""
    rows = near_rows(2, 25, 8, (40, 300)) + near_rows(3, 1, 120, (120, 150))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    wanted, links = near_brute_force(rows)
    left = simhash.drop_near_copies(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, fp int").repartition(5))
    assert left.columns == ["doc_id", "text", "fp"]
    assert sorted(r.doc_id for r in left.collect()) == sorted(wanted) and links > 300 and len(wanted) < len(rows) / 2


def test_near_copies_on_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [("1", "a b c d e f g", 1), ("2", "A b  c d e f\ng", 2), (None, "a b c d e f g", 3), ("x", "other words than all these", 4), ("3", None, 5), ("4", "", 6), ("7", long, 7), ("8", long + " end", 8), ("1", "a b c d e f g", 1), ("9", "one", 9), ("10", "ONE", 10)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, key int").selectExpr("doc_id", "text", "key", "key AS c0", "1 AS node", "2 AS Text2")
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.key for r in left.collect()) == [1, 4, 5, 7, 9]
    assert simhash.drop_near_copies(docs.limit(0)).collect() == []


def distance_in(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        row, last = [i] + [0] * len(t), row
        for j, d in enumerate(t, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d))
    return min(row)


def test_myers():
    rng = random.Random(4)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert myers.best_end(myers.masks(p), len(p), t)[0] == distance_in(p, t)


def test_decontamination(spark, docs):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("red blue green stone river cloud seven walking quickly house".split()) for _ in range(25))) for i in range(8)] + [(20, None), (21, ""), (22, "abc")]
    rows = []
    for i in range(200):
        t = " ".join(rng.choice("red blue green stone tree lake".split()) for _ in range(60))
        if i % 3 == 0:
            t = list(rng.choice(items[:8])[1].upper().replace(" ", ",\n"))
            for _ in range(rng.randint(0, 16)):
                t[rng.randrange(len(t))] = rng.choice("abcd ")
            t = "so it begins " + "".join(t) + " and goes on"
        rows.append((i, t))
    rows += [(300, None), (301, ""), (302, "x abc y"), (303, "xabcy"), (0, rows[0][1]), (None, rows[0][1])]
    found = decontam.matches(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), block_chars=300)
    got = collections.Counter((r.doc_id, r.item_id) for r in found.collect())
    wanted = collections.Counter()
    for i, t in rows:
        n = decontam.normalise(t)
        for j, q in items:
            q = decontam.normalise(q)
            k = decontam.budget(q, decontam.ERROR_RATE)
            if q and (distance_in(q, n) <= k if k else f" {q} " in f" {n} "):
                wanted[(i, j)] += 1
    assert got == wanted and len(wanted) > 20
    kept = decontam.clean(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), block_chars=300)
    assert kept.count() == sum(1 for i, t in rows if not any((i, j) in wanted for j, _ in items))
    assert decontam.matches(docs, spark.createDataFrame([], "item_id bigint, text string")).collect() == []


def reference_tokens():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return t, [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in some_texts()]


def test_bpe(docs, empty):
    t, wanted = reference_tokens()
    rows = bpe.encode(docs, keep_decoded=True).collect()
    got = collections.Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded, r.ids_sha256, r.decoded_sha256) for r in rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = lambda ids: t.decode(ids, skip_special_tokens=False)
    assert got == collections.Counter((i, len(ids), tuple(ids), text(ids), sha(" ".join(map(str, ids))), sha(text(ids))) for i, ids in wanted)
    assert bpe.encode(empty).collect() == []


def test_bpe_on_odd_words():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    c = bpe.Codec(bpe.word_vocabulary())
    rng = random.Random(8)
    odd = "aeiou'stdrvml.,-_<|>#09éßñÅ中文日😀́‍ \n\t ẞİΣ٣"
    for n in range(600):
        s = "".join(rng.choice(odd) for _ in range(rng.randint(0, 60))) + rng.choice(["", "<|startoftext|>", "<|endoftext|>x", " <|ENDOFTEXT|>"])
        ids = t.encode(s, add_special_tokens=False).ids
        got, form = c.encode(s)
        assert got == " ".join(map(str, ids)), repr(s)
        assert form == t.decode(ids, skip_special_tokens=False) == c.decode(got)
        assert c.count(s) == len(ids)
    assert any(len(c.cut("".join(map(c.letters.__getitem__, w.encode())))) > 1 for w in ("中文日本語", "😀😀"))


def test_token_counts_and_cache(spark, docs, empty, tmp_path):
    _, wanted = reference_tokens()
    cache, path = str(tmp_path / "cache"), public_tokenizers.path("word_bpe_49k.json")
    texts = collections.defaultdict(list)
    for (i, t), (_, ids) in zip(some_texts(), wanted):
        texts[i].append((len((t or "").encode()), len(ids), len(ids) > 100))
    got = collections.defaultdict(list)
    for r in token_counts.count_tokens(docs.where("doc_id < 30"), path, cache, limit=100).collect():
        got[r.doc_id].append((r.n_bytes, r.n_tokens, r.over_limit))
    stored = spark.read.parquet(cache).count()
    for r in token_counts.count_tokens(docs, path, cache, limit=100).where("doc_id >= 30 or doc_id is null").collect():
        got[r.doc_id].append((r.n_bytes, r.n_tokens, r.over_limit))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    distinct = len({(t or "").encode().strip() for _, t in some_texts()})
    assert stored < spark.read.parquet(cache).count() == distinct  # only what was missing is added
    assert token_counts.count_tokens(empty, path, cache).collect() == []


def test_token_counts_of_other_tokenizers_in_one_cache(spark, tmp_path):
    """White space outside counts where the tokenizer has tokens for it; each version has its own counts."""
    import sentencepiece

    texts = ["\n\nhello world \n", "hello world", " x", "", "  ", "a\u00a0b", "Hello  WORLD"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    cache = str(tmp_path / "cache")
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        if name.endswith(".json"):
            t = Tokenizer.from_file(path)
            wanted = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
        else:
            p = sentencepiece.SentencePieceProcessor(model_file=path)
            wanted = [len(p.encode(x)) for x in texts]
        got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, cache).collect()}
        assert [got[i] for i in range(len(texts))] == wanted, name
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 3


def softmax_score(model, counts, ws):
    """log10 of a text's probability, word by word: a softmax over all classes, and the word's share of its class."""
    v = model.vocabulary
    m = lm_score.LogBilinear(v.size, v.unigram).load(model.params)
    own = {w: i for i, w in enumerate(v.words[: v.n_own])}
    kind = lambda w: own.get(w, v.n_own + lm_score.shape(w) if w not in own else None)
    mass = collections.Counter()
    for w, n in counts.items():
        if w not in own:
            mass[kind(w)] += n + 0.5
    one = two = v.size
    total = 0.0
    for w in ws:
        x = (m.r[one] * m.c[0] + m.r[two] * m.c[1]).astype(float) @ m.q.T + m.b
        k = kind(w)
        total += (x[k] - np.log(np.exp(x).sum())) / math.log(10)
        if w not in own:
            total += math.log10((counts[w] + 0.5) / (mass[k] + 0.5))
        one, two = k, one
    return total


def test_lm_scores(docs, empty):
    rows = some_texts()
    tokens = [(i, lower(t).split() + [lm_score.END]) for i, t in rows]
    train = [ws for i, ws in tokens if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1]
    c = collections.Counter(w for ws in train for w in ws)
    n, v = sum(c.values()), len(c)
    model = lm_score.fit(docs, own_classes=5, frequent=8)
    assert model.vocabulary.n_own == 6 and len(model.vocabulary.words) < v
    wanted = collections.defaultdict(list)
    for i, ws in tokens:
        wanted[i].append((len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6), softmax_score(model, c, ws)))
    got = collections.defaultdict(list)
    for r in lm_score.score_with(docs, model).collect():
        got[r.doc_id].append((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.score))
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 1)
    assert got.keys() == wanted.keys()
    for k in wanted:
        for x, y in zip(sorted(got[k]), sorted(wanted[k]), strict=True):
            assert x[:4] == y[:4] and abs(x[4] - y[4]) < 1e-3 * (1 + abs(y[4]))
    assert lm_score.score(empty).collect() == []
    assert lm_score.score(docs.where("doc_id = 106")).count() == 1


def test_lm_bounds_what_it_gathers(spark):
    """Many words with the same count, or all beyond a bin: never more than asked for."""
    rows = [(i, " ".join(f"w{k}" for k in range(200))) for i in range(40)]
    _, v = lm_score.learn(spark.createDataFrame(rows, "doc_id bigint, text string"), 10, 50)
    assert v.words == [lm_score.END] and v.n_own == 1
    assert lm_score.class_count(10**5) == lm_score.LEAST_CLASSES < lm_score.class_count(10**8) < lm_score.class_count(10**10) == lm_score.MOST_CLASSES


def test_lm_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    unigram = np.full(6, 1 / 6)
    m = lm_score.LogBilinear(6, unigram, dim=4)
    seq = np.tile([0, 1, 2, 3, 4, 5], 800)
    contexts = lm_score._contexts(seq, np.arange(0, len(seq), 240), 6)
    before = m.log_probabilities(*contexts, m.norms()).mean()
    t = lm_score.Trainer(m, unigram, 0.2, 1)
    for _ in range(30):
        lm_score._steps(t, *contexts)
    assert m.log_probabilities(*contexts, m.norms()).mean() > before + 0.3
    ctx = rng.integers(0, 7, (5, 2))
    total = sum(np.exp(m.log_probabilities(ctx[:, 0], ctx[:, 1], np.full(5, k), m.norms())) for k in range(6))
    assert np.allclose(total, 1, atol=1e-4)


@pytest.mark.parametrize("chances", [((0.003, 0.8), (0.004, 0.7), (0.005, 0.6), (0.001, 0.95)), ((0.03, 0.8), (0.04, 0.7), (0.05, 0.6), (0.01, 0.95)), ((0.05, 0.7), (0.05, 0.7), (0.05, 0.7), (0.02, 0.8))])
def test_label_model_finds_the_good_labellers(chances):
    """Close to what could be decided with the truth of each pattern in hand."""
    rng = random.Random(9)
    patterns = collections.Counter()
    truth = collections.defaultdict(list)
    for _ in range(4000):
        bad = rng.random() < 0.2
        v = tuple((quality.BAD if rng.random() < p[bad] else quality.GOOD) if rng.random() < 0.9 else quality.ABSTAIN for p in chances)
        patterns[v] += 1
        truth[v].append(bad)
    post = quality.label_model(dict(patterns))
    right = sum(sum(b == (post[v] > 0.5) for b in bs) for v, bs in truth.items())
    best = sum(max(sum(bs), len(bs) - sum(bs)) for bs in truth.values())
    assert right >= best - 0.01 * 4000
    assert quality.label_model({}) == {}


def test_label_model_climbs_the_likelihood():
    """Two rounds of EM by hand, document by document."""
    rng = random.Random(3)
    docs = [tuple(rng.choice([0, 1, 1, 1, 2]) for _ in range(3)) for _ in range(60)]
    kinds = []
    for v in docs:
        alarms = [x == 2 for x in v[:-1]]
        k = [(0.1 if any(alarms) else 0.98) + 1e-3] + [0.9 * a / max(1, sum(alarms)) + 1e-3 for a in alarms]
        kinds.append([x / sum(k) for x in k])
    for _ in range(2):
        share = [sum(k[i] for k in kinds) + 1e-3 for i in range(3)]
        rate = [[(sum(k[i] for k, v in zip(kinds, docs) if v[j] == 2) + 0.025) / (sum(k[i] for k, v in zip(kinds, docs) if v[j]) + 0.5) for i in range(3)] for j in range(3)]
        kinds = [[share[i] / sum(share) * math.prod(rate[j][i] if v[j] == 2 else 1 - rate[j][i] if v[j] else 1 for j in range(3)) for i in range(3)] for v in docs]
        kinds = [[x / sum(k) for x in k] for k in kinds]
    heard = [sum(k[i] for k, v in zip(kinds, docs) if v[-1]) for i in range(3)]
    bad = [i > 0 and (heard[i] < quality.HEARD or rate[-1][i] > 0.5) for i in range(3)]
    post = quality.label_model(dict(collections.Counter(docs)), rounds=2)
    assert all(abs(post[v] - sum(x for x, b in zip(k, bad) if b)) < 1e-9 for v, k in zip(docs, kinds))


def test_quality_on_documents_whose_labels_it_never_saw(spark):
    """Held-out accuracy: labels of odd ids are kept from the model."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    found = quality.classify(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r.kept for r in found if r.quality and not r.toxic]
    junk = [r.kept for r in found if not r.quality and not r.toxic]
    assert sum(clean) >= 0.98 * len(clean) and sum(junk) <= 0.05 * len(junk) and len(junk) > 15


def test_quality_takes_long_texts_and_repeats(spark):
    rows = [(1, "fine words of several kinds " * 3), (1, "fine words of several kinds " * 3), (2, " ".join(f"word{i % 4000}" for i in range(200_000))), (3, "#$% " * 100_000), (3, "#$% " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "doc_id AS junk", "text AS word", "1 AS q")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, None)], "doc_id bigint, quality int, toxic int")
    got = quality.classify(docs, quality.fit(docs, labels)).collect()
    assert len(got) == len(rows) and len({(r.doc_id, r.junk_score, r.toxic_score) for r in got}) == 3


def test_quality_keeps_clean_and_rejects_junk(spark, empty):
    rng = random.Random(10)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "ling", "ter")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, bad = [], set()
    for i in range(600):
        t = prose(rng.randint(20, 120))
        if i % 10 == 0:
            t, _ = " ".join(w + "%%%" for w in t.split()), bad.add(i)
        elif i % 10 == 1:
            t, _ = "same " * 60 + t[:20], bad.add(i)
        elif i % 10 == 2:
            t, _ = t + " you idiot and scum", bad.add(i)
        rows.append((i, t, 1))
    rows += [(700, None, 1), (701, "", 1), (None, prose(30), 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept int")
    labels = spark.createDataFrame([(i, 0 if i in bad and i % 10 < 2 else 1, 1 if i % 10 == 2 else 0) for i in range(0, 600, 3)] + [(None, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int")
    for given in (labels, labels.limit(0), None):
        got = {r.doc_id: r.kept for r in quality.classify(docs, quality.fit(docs, given)).collect()}
        assert sum(not got[i] for i in bad) >= 0.97 * len(bad)
        assert sum(got[i] for i in range(600) if i not in bad) >= 0.99 * (600 - len(bad))
        assert got[700] and got[701]
    assert quality.classify(empty, quality.fit(empty, None)).collect() == []


PAGE = "<html><head><title>T</title><style>p{{}}</style><script>x='<p>no</p>'</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>{}<footer>&copy; us</footer></body></html>"


def test_html_lines():
    html = "<article><h1>A &amp; B</h1><p><b>one\n two<br><p>three<aside>side</aside><div class='comments'><p>nice</p></div><form>f</form></article>"
    kept = [t for t, article, furniture in html_extract.text_lines(PAGE.format(html)) if article and not furniture]
    assert kept == ["A & B", "one two", "three"]
    assert html_extract.text_lines("") == [] and html_extract.text_lines("<p") == []


def article_text(html):
    return " ".join(t for t, _, furniture in html_extract.text_lines(html) if not furniture)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("""<script>for(i=0;i<n;i++){f("it's")}</script><article><p>Body</p></article>""", "Body"),
        ("<script>if(a<b){c()}</script><style>a<b{}</style><article>Body</article>", "Body"),
        ("<div class='content has-sidebar'><article>Body</article></div>", "Body"),
        ("<section class='post no-comments'><article>Body</article></section>", "Body"),
        ("<div class='sidebar-right'><main>Body</main></div><div class='sidebar'>Side</div>", "Body"),
        ("<article><div class='entry-header'><h1>Head</h1></div><header><h2>Sub</h2></header>Body</article>", "Head Sub Body"),
        ("<article><p class='search-results'>Found</p></article>", "Found"),
        ("<p title=don't>Body one</p><p>it's</p>", "Body one it's"),
        ("<p title=don't>Body one", "Body one"),
        ("<p title='a > b' data-x=\"<i>\">Body</p>", "Body"),
        ("a < b <!-- <p>no</p> --><!doctype html><?x y?>c<![CDATA[ <p>no</p> ]]>", "a < b c"),
        ("<!--> one <!---> two <!-- never <p>three", "one two"),
        ("<title>no</title><textarea><p>no</textarea><svg><text>no</text></svg>yes<noscript>no</noscript>", "yes"),
        ("<article>Body<section id='comments'><article class='comment'>Hi</article></section></article><div class='related-posts'><article>Card</article></div>", "Body"),
        ("<div class='post-comments'>Hi</div><div class='ad-slot'>Buy</div><div hidden>h</div><div style='display : none'>h</div><div aria-hidden=true>h</div><p>Body", "Body"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one two a b c"),
        ("<nav>Menu<div>Body</nav></div>after</b></i>!", "after!"),
        ("<div>&lt;p&gt; &amp;amp; &#233;&eacute;</div>", "<p> &amp; éé"),
    ],
)
def test_html_of_the_wild(html, text):
    assert article_text(html) == text


def test_html_scanner_is_linear():
    for piece in ("<a ", "<a b='", '<p x="', "<!--", "</", "<div>", "<p>", "<script>", "<i>", "</b>", "<b x=y ", "&", "<![CDATA[", "<li><i>"):
        began = time.process_time()
        html_extract.text_lines(piece * 60_000)
        assert time.process_time() - began < 4, piece


def test_shared_lines_is_a_longest_common_subsequence():
    rng = random.Random(11)
    for _ in range(200):
        a, b = ([bytes([rng.choice(b"abcd")]) for _ in range(rng.randint(0, 12))] for _ in range(2))
        at = html_extract.shared_lines(a, b)
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert len(at) == table[-1][-1] and at == sorted(set(at))
        rest = iter(b)
        assert all(a[i] in rest for i in at)


@pytest.mark.parametrize("run_pages", [2, 3, 256])
def test_html_extraction(spark, run_pages):
    plain = "<html><body><div>Welcome to us</div><p>{}</p><div>Call now</div></body></html>"
    rows = [(i, f"http://h{i % 2}.org/a/{i:02d}?q=1", plain.format(f"story {i}"), "x") for i in range(14)]
    rows += [(50, "http://alone.org/x", plain.format("alone"), "x"), (51, "http://z.org/1", PAGE.format("<article><p>art</p></article>"), "x"), (52, None, None, "x"), (53, "http://z.org/2", "", "x"), (51, "http://z.org/1", PAGE.format("<article><p>art</p></article>"), "x")]
    got = collections.defaultdict(list)
    for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"), run_pages).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert all(got[i] == [f"story {i}"] for i in range(14))
    assert got[50] == ["Welcome to us alone Call now"] and got[51] == ["art", "art"] and got[52] == [""] and got[53] == [""]
    assert html_extract.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_differencing_decides_open_lines_of_pages_with_articles(spark):
    site = "<html><body><div>Welcome to us</div>{}<div>Call now</div></body></html>"
    teaser = "<article><h3>More</h3></article>"
    rows = [(i, f"http://h.org/{i}", site.format(f"<p>lead {i}</p><article><p>story {i}</p></article>")) for i in range(4)]
    rows += [(10 + i, f"http://side.org/{i}", site.format(f"<p>story {i}</p><aside>{teaser}</aside>")) for i in range(4)]
    rows += [(20 + i, f"http://card.org/{i}", site.format(f"<p>story {i}</p><div>{teaser}</div>")) for i in range(4)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[i] == f"lead {i} story {i}" and got[10 + i] == f"story {i}" and got[20 + i] == f"story {i} More" for i in range(4))


class Reader(HTMLParser):
    """Text of pages of well-formed blocks, by the standard library's parser: what is in the article, and the lines outside it."""

    BLOCKS = set("html head body nav ul li div article h1 p footer br title style script".split())

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.lines, self.held, self.stack = [], [], []
        self.feed(html)
        self.close()
        self.end()

    def end(self):
        text = " ".join("".join(self.held).split())
        if text and not set(self.stack) & {"script", "style", "title"}:
            self.lines.append((text, "article" in self.stack, bool({"nav", "ad", "footer"} & set(self.stack))))
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.end()
        if tag not in ("br", "meta", "b", "p"):
            self.stack.append("ad" if ("class", "ad") in attrs else tag)

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.end()
        if tag not in ("br", "meta", "b", "p"):
            self.stack.pop()

    def handle_data(self, data):
        self.held.append(data)


def test_html_extraction_against_another_parser_and_all_alignments(spark):
    """The whole query by brute force: another parser, pages sorted by host and path, and a full table for each alignment."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in pages.collect()}
    read = {i: Reader(r.html).lines for i, r in rows.items()}
    key = lambda r: hashlib.md5(f"{len(r.url)}:{r.url}{len(r.html)}:{r.html}".encode()).digest()
    order = sorted(rows, key=lambda i: (*html_extract.host_path(rows[i].url), key(rows[i])))
    host = lambda i: html_extract.host_path(rows[i].url)[0]
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    shared = 0
    for n, i in enumerate(order):
        pair = next((k for k in (order[n - 1 : n] + order[n + 1 : n + 2]) if host(k) == host(i)), None)
        a, b = ([t for t, article, _ in read.get(k, ()) if not article] for k in (i, pair))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                table[x + 1][y + 1] = table[x][y] + 1 if a[x] == b[y] else max(table[x][y + 1], table[x + 1][y])
        assert got[i].text == " ".join(t for t, _, furniture in read[i] if not furniture)
        assert got[i].lines_shared == table[-1][-1] and got[i].lines_shared + got[i].lines_furniture == len(a)
        shared += table[-1][-1]
    assert shared > 0


def test_html_extraction_of_very_long_pages(spark):
    page = "<div>{}</div>" + "".join(f"<div>line {i % 700}</div>" for i in range(20_000)) + "<article>" + "word " * 200_000 + "</article>"
    rows = [(i, f"http://long.org/{i}", page.format(f"own {i}")) for i in range(2)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r.text == f"own {r.page_id} " + ("word " * 200_000).strip() and r.lines_shared == 20_000 for r in got)


def test_word_pattern_is_ascii_space():
    assert re.findall(r"[^\x20\x09-\x0D]+", "a\x0bb\x1cc d e") == [w.decode() for w in simhash.words("a\x0bb\x1cc d e".encode())]


def test_parities_never_exceed_the_difference_of_sets():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 400):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for extra in (0, 1, 20, 300):
            other = np.unique(np.concatenate([base[extra // 2 :], rng.integers(0, 2**64, extra, dtype=np.uint64)]))
            bits = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(simhash.parities(base), simhash.parities(other)))
            assert bits <= len(np.setxor1d(base, other))


def edited(rng, ws, kind, share):
    """A copy of ws with edits that leave about 0.8 to 0.9 of its five-word shingles."""
    out = list(ws)
    if kind == "block":
        at = rng.randrange(len(out))
        out[at:at] = [f"n{rng.randrange(10**6)}" for _ in range(int(share * len(ws)))]
    else:
        for at in range(3, len(out), int(10 / share)):
            out[at] = f"n{rng.randrange(10**6)}"
    return out


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_by_blocks_and_by_scattered_edits_are_found(spark):
    rng = random.Random(13)
    rows, wanted = [], set()
    for i in range(0, 400, 2):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        copy = edited(rng, base, "block" if i % 4 else "scattered", rng.choice([0.12, 0.18, 0.22, 0.3]))
        rows += [(i, " ".join(base)), (i + 1, " ".join(copy))]
        wanted |= {i} | ({i + 1} if jaccard(base, copy) < 0.8 else set())
    assert 20 < len(wanted) - 200 < 180
    assert {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == wanted


def test_bands_meet_as_their_law_says():
    rng = np.random.default_rng(14)
    for common, least in ((0.8, 0.999), (0.9, 1)):
        met = 0
        for _ in range(400):
            x = rng.integers(0, 2**64, 200, dtype=np.uint64)
            n = round(200 * common)
            met += bool(set(simhash.bands(x)) & set(simhash.bands(x[:n])))
        assert met >= 400 * least
    assert simhash.bands(x[:0]) == []
