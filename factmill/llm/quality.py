"""Quality classifier from weak labels.

Overlapping heuristic labellers vote bad, good or nothing on every document, once for junk and once
for abuse; people's labels, where there are any, are one more labeller. Expectation-maximisation
over the counts of vote patterns estimates each labeller's accuracy on good documents and on each
kind of bad ones, and the posterior labels of a bounded sample train a linear scorer on hashed
features, which decides on every row.
"""

from __future__ import annotations

import math
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bound_batches, broadcast_if_small, cut, slices, tidy

#: Documents that the scorer learns from, and labelled documents that the lexicon is taken from (expected numbers).
TRAIN_ROWS, LEXICON_ROWS = 6000, 20000
BUCKETS = 1 << 16
#: Common English words of abuse.
ABUSE = "idiot moron stupid scum loser trash worthless pathetic disgusting clown"
_MARKS = b"#%&*$|!~^=<>@+_\\{}[]"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_EDGE = b".,;:!?\"'()[]{}<>#%&*$|~^=@+_-\\/"
_LISTED = frozenset(ABUSE.encode().split())
_HALVES = [frozenset(ABUSE.encode().split()[i::2]) for i in range(2)]
ABSTAIN, GOOD, BAD = 0, 1, 2
#: Bytes that the learned lexicon's beginnings of words have (a shorter word is its own).
STEMS = range(4, 9)
#: Votes of people that a kind of documents needs before they say whether it is bad; with fewer, the labeller that it is named by does.
HEARD = 20


class Lexicon:
    """Beginnings of words; knows(word) tells the shortest one that a word has, or nothing."""

    def __init__(self, stems):
        self.stems = frozenset(stems)
        self.heads = frozenset(s[: STEMS[0]] for s in self.stems)

    def knows(self, word: bytes) -> bytes | None:
        if word[: STEMS[0]] in self.heads:
            for k in STEMS:
                if word[:k] in self.stems:
                    return word[:k]
        return None


def _vote(x: float, good: float, bad: float) -> int:
    """Bad beyond bad, good short of good; which way is up follows from their order."""
    if good < bad:
        return GOOD if x < good else BAD if x > bad else ABSTAIN
    return GOOD if x > good else BAD if x < bad else ABSTAIN


class Reading:
    """What labellers and features look at in one text."""

    def __init__(self, text: bytes, learned: Lexicon):
        self.words = text.split()
        n, size = len(self.words), max(1, len(text))
        self.n = n
        self.vocabulary = set(text.lower().split())
        self.marks = 1 - len(text.translate(None, _MARKS)) / size
        self.upper = 1 - len(text.translate(None, _UPPER)) / size
        self.repeats = sum(map(eq, self.words, self.words[1:])) / max(1, n - 1)
        self.unique = len(self.vocabulary) / max(1, n)
        trios = n - 2
        self.trios = len(set(zip(self.words, self.words[1:], self.words[2:]))) / trios if trios > 20 else 1.0
        bare = {v.strip(_EDGE) for v in self.vocabulary}
        self.listed = sorted(_LISTED & bare)
        self.learned = sorted(s for s in map(learned.knows, bare) if s) if learned.stems else []  # one for each word

    def junk_votes(self) -> list[int]:
        if not self.n:
            return [ABSTAIN] * 5
        many = self.n >= 20
        return [
            _vote(self.marks, 0.005, 0.02),
            _vote(self.repeats, 0.03, 0.15) if self.n >= 5 else ABSTAIN,
            _vote(self.unique, 0.45, 0.35) if many else ABSTAIN,
            _vote(self.upper, 0.15, 0.4) if many else ABSTAIN,
            _vote(self.trios, 0.9, 0.6) if many else ABSTAIN,
        ]

    def abuse_votes(self) -> list[int]:
        """Two halves of the list, which different words bear witness to, and the words that were learned from people's labels."""
        if not self.n:
            return [ABSTAIN] * 3
        learned = len(self.learned)
        return [BAD if any(w in half for w in self.listed) else GOOD for half in _HALVES] + [BAD if learned > 1 else ABSTAIN if learned else GOOD]

    def features(self, bucket) -> tuple[list[int], list[float]]:
        own = [
            b"\0marks%d" % min(20, int(self.marks * 100)), b"\0repeats%d" % int(self.repeats * 10), b"\0unique%d" % (int(self.unique * 20) if self.n >= 20 else 99),
            b"\0upper%d" % (int(self.upper * 10) if self.n >= 20 else 99), b"\0trios%d" % int(self.trios * 10), b"\0listed%d" % min(3, len(self.listed)), b"\0learned%d" % min(3, len(self.learned)),
            *(b"\0word " + w for w in self.listed), *(b"\0stem " + s for s in set(self.learned)), *(b"\0vote%d %d" % (j, v) for j, v in enumerate(self.junk_votes())), b"\0bias",
        ]
        each = 0.3 / math.sqrt(max(1, len(self.vocabulary)))
        return [bucket(w) for w in own] + [bucket(w) for w in self.vocabulary], [1.0] * len(own) + [each] * len(self.vocabulary)


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = b = zlib.crc32(word) % BUCKETS
        return b


def _code(votes: list[int]) -> int:
    return sum(v * 3**i for i, v in enumerate(votes))


def _decode(code: int, n: int) -> list[int]:
    return [code // 3**i % 3 for i in range(n)]


def label_model(patterns: dict[tuple[int, ...], float], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """P(bad) for each vote pattern, given how often each occurs; people are the last labeller, all others are heuristics.

    A document is good or of one of as many kinds as there are heuristics, for each knows a fault of
    its own, and several may know the same one. Given what a document is, votes are independent, and
    each labeller has its own chance of calling it bad; an abstention says nothing. It starts with a
    document being of the kinds that the heuristics call it, and all chances and shares are then
    estimated freely. A kind whose documents people mostly call good is good: its heuristic has
    false alarms. Patterns with no votes have the share of bad documents; no patterns give nothing.
    """
    if not patterns:
        return {}
    votes = np.array(list(patterns))
    weight = np.array(list(patterns.values()), float)
    alarms = votes[:, :-1] == BAD
    kinds = np.hstack([np.where(alarms.any(1), 0.1, 0.98)[:, None], 0.9 * alarms / np.maximum(alarms.sum(1, keepdims=True), 1)]) + 1e-3
    kinds /= kinds.sum(1, keepdims=True)
    for _ in range(rounds):
        held = kinds * weight[:, None]
        share = held.sum(0) + 1e-3
        logs = np.tile(np.log(share / share.sum()), (len(votes), 1))
        for column in votes.T:
            bad, good = (((column == v)[:, None] * held).sum(0) for v in (BAD, GOOD))
            rate = (bad + 0.025) / (bad + good + 0.5)  # half a vote, one in twenty of it bad, before any
            logs += np.where((column == BAD)[:, None], np.log(rate), 0) + np.where((column == GOOD)[:, None], np.log(1 - rate), 0)
        kinds = np.exp(logs - logs.max(1, keepdims=True))
        kinds /= kinds.sum(1, keepdims=True)
    heard = ((votes[:, -1] != ABSTAIN)[:, None] * kinds * weight[:, None]).sum(0)
    is_bad = np.where(heard >= HEARD, rate > 0.5, True)
    is_bad[0] = False
    return {tuple(v): float(b) for v, b in zip(votes.tolist(), kinds @ is_bad)}


def _fit(rows: list[tuple[list[int], list[float]]], target: np.ndarray, rounds: int = 150, l2: float = 1e-6) -> np.ndarray:
    """Logistic regression by full gradients with AdaGrad steps."""
    w = np.zeros(BUCKETS)
    if not len(rows):
        return w
    idx = np.concatenate([np.array(i, np.int64) for i, _ in rows])
    val = np.concatenate([np.array(v) for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    seen = np.full(BUCKETS, 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=val * w[idx], minlength=len(rows)), -30, 30)))
        g = np.bincount(idx, weights=val * (p - target)[row], minlength=BUCKETS) / len(rows) + l2 * w
        seen += g * g
        w -= 1.0 * g / np.sqrt(seen)
    return w


def _draw(df: DataFrame, rows: int, id_col: str, n: int, seed: int) -> DataFrame:
    """About so many of df's n rows, by a hash of the id."""
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 40)) < int((1 << 40) * rows / n))


def _learned_lexicon(docs: DataFrame, labels: DataFrame, rows: int) -> list[bytes]:
    """Beginnings of words (STEMS) in labelled toxic documents that hardly any labelled clean document has.

    One counts by the different words before it, so that copies of one document count once. There
    are no more than the labelled sample holds.
    """

    def run(batches):
        clean: dict[bytes, int] = {}
        pairs: set[tuple[bytes, int]] = set()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for b, t in zip(as_bytes(part.column("text")), part.column("toxic").to_pylist()):
                    words = [v.strip(_EDGE) for v in b.lower().split()]
                    if t:
                        pairs.update((w[:k], zlib.crc32(v)) for v, w in zip([b"", *words], words) if len(w) > 2 for k in STEMS if k <= max(len(w), STEMS[0]))
                    else:
                        for w in {v[:k] for v in words if len(v) > 2 for k in STEMS if k <= max(len(v), STEMS[0])}:
                            clean[w] = clean.get(w, 0) + 1
            if len(clean) + len(pairs) > 120_000:
                yield _counts(clean, pairs)
                clean, pairs = {}, set()
        yield _counts(clean, pairs)

    some = cut(_draw(labels, rows, "doc_id", labels.count(), 7).where("toxic is not null").select("doc_id", "toxic"))
    counts = docs.join(broadcast_if_small(some, 24), "doc_id").select("text", "toxic").mapInArrow(tidy(run), "word binary, clean bigint, before bigint")
    found = counts.groupBy("word", "before").agg(F.sum("clean").alias("clean")).groupBy("word").agg(F.sum("clean").alias("clean"), F.count("before").alias("toxic"))
    return [bytes(r.word) for r in found.where("toxic >= 6 and toxic >= 20 * clean").collect()]


def _counts(clean: dict[bytes, int], pairs: set[tuple[bytes, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([*clean, *(w for w, _ in pairs)], pa.binary()), pa.array([*clean.values(), *[0] * len(pairs)], pa.int64()), pa.array([*[None] * len(clean), *(v for _, v in pairs)], pa.int64())],
        ["word", "clean", "before"],
    )


class Model:
    """The learned lexicon and the two scorers; small, so it travels with each task."""

    def __init__(self, learned: Lexicon, junk: np.ndarray, toxic: np.ndarray):
        self.learned, self.junk, self.toxic = learned, junk.astype(np.float32), toxic.astype(np.float32)

    def score(self, text: bytes, bucket) -> tuple[float, float]:
        idx, val = Reading(text, self.learned).features(bucket)
        v = np.array(val, np.float32)
        return tuple(float(1 / (1 + np.exp(-np.clip(w[idx] @ v, -30, 30)))) for w in (self.junk, self.toxic))


def fit(docs: DataFrame, labels: DataFrame | None, train_rows: int = TRAIN_ROWS, lexicon_rows: int = LEXICON_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from docs (all rows vote) and labels (doc_id, quality, toxic), which may be empty or None.

    Null texts count as empty, which no heuristic votes on; repeated rows vote as often as they
    occur; a document that is labelled several times counts as bad if any label says so; rows
    without an id have no label; an empty table gives a model that rejects nothing. The lexicon comes
    from lexicon_rows labelled documents and the scorer from train_rows documents (expected numbers,
    drawn by a hash of the id), whatever the size of the corpus; all rows vote and are classified.
    """
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if labels is None:
        labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    labels = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    lexicon = Lexicon(_learned_lexicon(docs, labels, lexicon_rows))

    def votes(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                read = [Reading(b, lexicon) for b in as_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([_code(r.junk_votes()) for r in read], pa.int32()), pa.array([_code(r.abuse_votes()) for r in read], pa.int32())], ["doc_id", "junk", "abuse"])

    human = lambda c, bad: F.when(F.col(c).isNull(), ABSTAIN).when(F.col(c) == bad, BAD).otherwise(GOOD)
    voted = docs.mapInArrow(tidy(votes), "doc_id bigint, junk int, abuse int").join(labels, "doc_id", "left").select("junk", "abuse", human("quality", 0).alias("q"), human("toxic", 1).alias("t"))
    counted = voted.groupBy("junk", "abuse", "q", "t").count().collect()  # at most 3**10 patterns, whatever the corpus
    junk: dict = {}
    abuse: dict = {}
    for r in counted:
        a, b = (*_decode(r.junk, 5), r.q), (*_decode(r.abuse, 3), r.t)
        junk[a] = junk.get(a, 0) + r["count"]
        abuse[b] = abuse.get(b, 0) + r["count"]
    junk_posterior, abuse_posterior = label_model(junk), label_model(abuse)
    n = sum(r["count"] for r in counted)

    def sample(batches):
        bucket = _Buckets()
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for d, b in zip(part.column("doc_id").to_pylist(), as_bytes(part.column("text"))):
                    r = Reading(b, lexicon)
                    idx, val = r.features(bucket.__getitem__)
                    out.append((d, _code(r.junk_votes()), _code(r.abuse_votes()), idx, val))
                cols = list(zip(*out)) or [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "junk", "abuse", "idx", "val"])

    drawn = _draw(docs, train_rows, "doc_id", n, 11).mapInArrow(tidy(sample), "doc_id bigint, junk int, abuse int, idx array<int>, val array<float>")
    rows = drawn.join(labels, "doc_id", "left").withColumns({"q": human("quality", 0), "t": human("toxic", 1)}).toArrow()
    features = [(i, v) for i, v in zip(rows["idx"].to_pylist(), rows["val"].to_pylist())]
    y_junk = np.array([junk_posterior.get((*_decode(a, 5), q), 0.0) for a, q in zip(rows["junk"].to_pylist(), rows["q"].to_pylist())])
    y_abuse = np.array([abuse_posterior.get((*_decode(a, 3), t), 0.0) for a, t in zip(rows["abuse"].to_pylist(), rows["t"].to_pylist())])
    return Model(lexicon, _fit(features, y_junk), _fit(features, y_abuse))


def classify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with junk_score, toxic_score (chances of being so) and kept (both below 0.5).

    Null and empty texts give no evidence beyond the prior and are scored like any other. Each row is
    decided by its text alone, so repeated rows are decided alike; an empty table gives an empty
    result; very long texts are read whole. Other columns pass through, whatever their names (the added ones replace columns of the same name).
    """
    bound_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("junk_score", "toxic_score", "kept")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        bucket, m = _Buckets(), shared.value
        for batch in batches:
            scores = [m.score(b, bucket.__getitem__) for part in slices(batch, batch.schema.names[at], 1 << 20) for b in as_bytes(part.column(at))]
            junk, toxic = [s[0] for s in scores], [s[1] for s in scores]
            kept = [a < 0.5 and b < 0.5 for a, b in scores]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(junk, pa.float64()), pa.array(toxic, pa.float64()), pa.array(kept, pa.bool_())], [*names, "junk_score", "toxic_score", "kept"])

    schema = docs.withColumns({"junk_score": F.lit(0.0), "toxic_score": F.lit(0.0), "kept": F.lit(True)}).schema
    return docs.mapInArrow(tidy(run), schema)
