"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words fall into classes: each of the most frequent training words is one (the more words were read,
the more classes), all others share classes by their shape (length, last character, kind of
letters). The model gives the next class from the two before it: their vectors, each scaled by the
weights of its place, are added, and the scores are products with the classes' own vectors,
normalised over all classes. Within a shared class a word has its share of the class's training
count, so that probabilities over all words, and one unseen word for each class, add up to one.

The score of a class is a sum of one term for each place, so the sum over all classes that
normalises a context is a product of two vectors that depend on one word each: one matrix product
gives the norms of all contexts there are.

Training goes over all training texts: every task takes noise-contrastive steps over its own rows
from a common start, and the results are averaged by the number of tokens, once for each round.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bound_batches, crc_of_id, cut, slices, tidy

#: Words whose counts travel with the tasks; all others are looked up by a join, with the same result.
FREQUENT = 200_000
#: Words with a class of their own: at least, at most (the table of norms is the square of it), and the power of the training tokens between.
LEAST_CLASSES, MOST_CLASSES, CLASS_POWER = 2000, 4096, 0.42
DIM, NOISE, BATCH = 16, 64, 1024
END = b"\n"  # no word holds white space
LETTERS, ENDINGS, LENGTHS = 4, 4, 3
SHAPES = LETTERS * ENDINGS * LENGTHS + 1

#: By the second byte of a word's first accented Latin letter; everything else that isn't ASCII is of kind 1.
_KIND = {c.encode()[1]: kind for kind, letters in ((1, "àâçèéêëîïôù"), (2, "áíñóú"), (3, "äöüß")) for c in letters}
_ENDING = {ord("."): 1, ord(","): 2}


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def name(word: bytes) -> bytes:
    """What a word goes by in counts: itself, or a 128-bit digest behind a mark that no word has."""
    return word if len(word) <= 16 else b" " + xxhash.xxh3_128_digest(word)


def shape(word: bytes) -> int:
    """The shared class of a word, from 0 to SHAPES - 1."""
    n = len(word)
    if n > 16:
        return SHAPES - 1
    accent = word.find(b"\xc3") + 1
    kind = 0 if word.isascii() else _KIND.get(word[accent], 1) if accent and accent < n else 1
    last = word[-1]
    ending = _ENDING.get(last, 3 if last < 128 and not word[-1:].isalpha() else 0)
    return (kind * ENDINGS + ending) * LENGTHS + (0 if n <= 4 else 1 if n <= 8 else 2)


def held_out(doc_id) -> bool:
    return crc_of_id(doc_id) % 5 == 1


def _count(batches):
    held: Counter[bytes] = Counter()
    texts = 0
    for batch in batches:
        for part in slices(batch, "text"):
            for d, b in zip(part.column("doc_id").to_pylist(), as_bytes(part.column("text"))):
                if not held_out(d):
                    texts += 1
                    held.update(words(b))
            if len(held) > 400_000:
                yield _counted(held, 0)
                held = Counter()
    yield _counted(held, texts)


def _counted(held: dict[bytes, int], texts: int) -> pa.RecordBatch:
    keys = [name(w) for w in held]
    kinds = [shape(w) for w in held]
    counts = list(held.values())
    if texts:
        keys, kinds, counts = [*keys, END], [*kinds, 0], [*counts, texts]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(kinds, pa.int32()), pa.array(counts, pa.int64())], ["w", "shape", "c"])


def class_count(tokens: int) -> int:
    """How many words have classes of their own after so many training tokens."""
    return min(MOST_CLASSES, max(LEAST_CLASSES, int(tokens**CLASS_POWER)))


class Vocabulary:
    """Numbers for words: the frequent ones in order of their counts (the first n_own have classes of their own), then one for each shape of the rare ones."""

    def __init__(self, frequent: list[tuple[bytes, int, int]], n_own: int, mass: dict[int, float], total: int, distinct: int):
        """frequent: (word, shape, count); mass: of all training words by shape, with a half for each."""
        self.words = [w for w, _, _ in frequent]
        self.end = self.words.index(END)
        self.total, self.distinct, self.n_own = total, distinct, n_own
        self.base = total + 0.5 * (distinct + 1)
        self.size = n_own + SHAPES
        counts = np.array([c for _, _, c in frequent], np.float64)
        shapes = np.array([k for _, k, _ in frequent], np.int64)
        left = np.array([mass.get(k, 0.0) for k in range(SHAPES)]) - np.bincount(shapes[:n_own], weights=np.where(counts[:n_own] > 0, counts[:n_own] + 0.5, 0), minlength=SHAPES)
        self.mass = np.maximum(left, 0) + 0.5  # with an unseen word each
        weights = np.concatenate([counts[:n_own] + 0.5, self.mass])
        self.unigram = weights / weights.sum()
        own = np.arange(len(frequent)) < n_own
        rare = np.arange(SHAPES)
        #: By number: class, whether it was seen in training, log10 of the base probability and of the share of the class; rare words have zeros.
        self.classes = np.concatenate([np.where(own, np.arange(len(frequent)), n_own + shapes), n_own + rare]).astype(np.int64)
        self.seen = np.concatenate([counts > 0, rare < 0])
        self.base_logs = np.concatenate([np.log10((counts + 0.5) / self.base), 0.0 * rare])
        self.share_logs = np.concatenate([np.where(own, 0.0, np.log10((counts + 0.5) / self.mass[shapes])), 0.0 * rare])
        self.numbers = _Numbers(self.words)

    def __getstate__(self):
        return self.__dict__ | {"numbers": None}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.numbers = _Numbers(self.words)

    def read(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words, numbers, where each text begins) of texts one after the other, each with its end."""
        ws: list[bytes] = []
        begins = []
        for t in texts:
            begins.append(len(ws))
            ws += words(t)
            ws.append(END)
        return ws, np.fromiter(map(self.numbers.__getitem__, ws), np.int64, len(ws)), np.array(begins, np.int64)


class _Numbers(dict):
    """The number of each word, rare ones as they are met; those go when there are too many."""

    def __init__(self, frequent: list[bytes], most: int = 300_000):
        super().__init__(zip(frequent, range(len(frequent))))
        self.frequent, self.most = frequent, most + len(frequent)

    def __missing__(self, word: bytes) -> int:
        number = self.get(name(word)) if len(word) > 16 else None
        if number is None:
            number = len(self.frequent) + shape(word)
        if len(self) > self.most:
            self.clear()
            self.update(zip(self.frequent, range(len(self.frequent))))
            if word in self:
                return self[word]
        self[word] = number
        return number


class LogBilinear:
    def __init__(self, size: int, unigram: np.ndarray, dim: int = DIM, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.r = rng.normal(0, 0.1, (size + 1, dim)).astype(np.float32)  # the last is for the start of a text
        self.q = rng.normal(0, 0.1, (size, dim)).astype(np.float32)
        self.c = np.ones((2, dim), np.float32)
        self.b = np.log(unigram).astype(np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.q, self.c, self.b]

    def vector(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, v: np.ndarray) -> LogBilinear:
        at = 0
        for p in self.parts():
            p[...] = v[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.r[one] * self.c[0] + self.r[two] * self.c[1]

    def norms(self, rows: int = 512) -> np.ndarray:
        """log of the sum over all classes for each context (class before, class before that)."""
        second = (self.r * self.c[1]) @ self.q.T
        high = second.max(1)
        second = np.exp(second - high[:, None]).T
        out = np.empty((len(self.r), len(self.r)), np.float32)
        for i in range(0, len(out), rows):
            first = (self.r[i : i + rows] * self.c[0]) @ self.q.T + self.b
            top = first.max(1, keepdims=True)
            out[i : i + rows] = np.log(np.maximum(np.exp(first - top) @ second, 1e-37)) + top + high
        return out

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities of the targets."""
        return np.einsum("ij,ij->i", self.hidden(one, two), self.q[target]) + self.b[target] - norms[one, two]


class Trainer:
    """Noise-contrastive steps with AdaGrad; one set of noise classes serves a whole batch."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, rate: float, seed: int):
        self.m, self.rate = model, rate
        self.noise_log = np.log(unigram * NOISE).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.rng = np.random.default_rng(seed)
        self.seen = [np.full(p.shape, 1.0, np.float32) for p in model.parts()]

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        m = self.m
        d = m.r.shape[1]
        h = m.hidden(one, two)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(m.q) - 1)
        qt, qn = m.q[target], m.q[noise]
        real = np.einsum("ij,ij->i", h, qt) + m.b[target] - self.noise_log[target]
        fake = h @ qn.T
        fake += m.b[noise] - self.noise_log[noise]
        g_real = 1 / (1 + np.exp(np.clip(real, -30, 30)))  # pulls up
        g_fake = -1 / (1 + np.exp(-np.clip(fake, -30, 30)))  # pushes down
        gh = g_real[:, None] * qt + g_fake @ qn
        self._add(1, np.concatenate([target, noise]), np.concatenate([g_real[:, None] * h, g_fake.T @ h]))
        self._add(3, np.concatenate([target, noise]), np.concatenate([g_real, g_fake.sum(0)])[:, None])
        places = np.stack([(gh * m.r[one]).sum(0), (gh * m.r[two]).sum(0)])
        self._add(0, np.concatenate([one, two]), np.concatenate([gh * m.c[0], gh * m.c[1]]))
        self._add(2, np.arange(2), places)

    def _add(self, part: int, ids: np.ndarray, rows: np.ndarray) -> None:
        """One step on the rows of a part that have gradients; rows for the same id are added up."""
        at, inverse = np.unique(ids, return_inverse=True)
        d = rows.shape[1]
        g = np.bincount((inverse[:, None] * d + np.arange(d)).ravel(), weights=rows.ravel(), minlength=len(at) * d).reshape(len(at), d)
        p, seen = (x[part].reshape(-1, d) for x in (self.m.parts(), self.seen))
        seen[at] += g * g
        p[at] += self.rate * g / np.sqrt(seen[at])


def _contexts(classes: np.ndarray, begins: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before, class before that, class) for each token of texts one after the other."""
    one = np.concatenate([[start], classes[:-1]])
    one[begins] = start
    two = np.concatenate([[start], one[:-1]])
    two[begins] = start
    return one, two, classes


def _training(vocabulary, start: np.ndarray, rate: float):
    def run(batches):
        v = vocabulary.value
        model = LogBilinear(v.size, v.unigram).load(start)
        trainer = Trainer(model, v.unigram, rate, 1000 + TaskContext.get().partitionId())
        total = 0
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = [b for d, b in zip(part.column("doc_id").to_pylist(), as_bytes(part.column("text"))) if not held_out(d)]
                if texts:
                    _, numbers, begins = v.read(texts)
                    total += _steps(trainer, *_contexts(v.classes[numbers], begins, v.size))
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([model.vector().astype("<f4").tobytes()], pa.binary())], ["n", "v"])

    return run


def _steps(trainer: Trainer, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> int:
    """One pass over these tokens in random order."""
    order = trainer.rng.permutation(len(target))
    for i in range(0, len(order), BATCH):
        k = order[i : i + BATCH]
        trainer.step(one[k], two[k], target[k])
    return len(target)


def _average(batches):
    total, mean = 0, None
    for batch in batches:
        for n, raw in zip(batch.column("n").to_pylist(), batch.column("v").to_pylist()):
            x = np.frombuffer(raw, "<f4").astype(np.float64)
            total += n
            mean = x if mean is None else mean + (x - mean) * (n / total)
    if mean is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([mean.astype("<f4").tobytes()], pa.binary())], ["n", "v"])


def _train(docs: DataFrame, vocabulary, rounds: int) -> np.ndarray:
    v = vocabulary.value
    params = LogBilinear(v.size, v.unigram).vector()
    for k in range(rounds):
        each = docs.mapInArrow(tidy(_training(vocabulary, params, 0.05 / (k + 1)), pause_gc=True), "n bigint, v binary")
        width = max(1, round(each.rdd.getNumPartitions() ** 0.5))  # averages of averages: no task takes all
        mean = each.repartition(width).mapInArrow(tidy(_average), "n bigint, v binary").repartition(1).mapInArrow(tidy(_average), "n bigint, v binary").collect()
        if mean:
            params = np.frombuffer(mean[0].v, "<f4").copy()
    return params


def learn(docs: DataFrame, own_classes: int | None = None, frequent: int = FREQUENT) -> tuple[DataFrame, Vocabulary]:
    """(counts of all training words, vocabulary). docs has doc_id and text; own_classes sets the number of words with classes of their own."""
    counts = cut(docs.mapInArrow(tidy(_count, pause_gc=True), "w binary, shape int, c bigint").groupBy("w").agg(F.min("shape").alias("shape"), F.sum("c").alias("c")))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # how often a word must occur to be among the frequent ones: from how many words there are in each bin of log counts
    level = F.floor(F.log2("c") * 16).cast("int")
    least, held = 0, 0
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # a bin for each sixteenth of a power of two
        if held + r["count"] > frequent:
            least = r.level + 1
            break
        held += r["count"]
    rows = [(bytes(r.w), r["shape"], r.c) for r in counts.where(level >= least).toLocalIterator()]  # frequent at most
    if all(w != END for w, _, _ in rows):  # the end is always known by itself
        rows.append((END, 0, sum(r.c for r in counts.where(F.col("w") == F.lit(bytearray(END))).collect())))
    rows.sort(key=lambda r: (r[0] != END, -r[2], r[0]))
    n_own = min(len(rows), 1 + (class_count(total) if own_classes is None else own_classes))
    mass = {r["shape"]: r.m for r in counts.groupBy("shape").agg((F.sum("c") + 0.5 * F.count("*")).alias("m")).collect()}
    return counts, Vocabulary(rows, n_own, mass, total, distinct)


_SCORED = ["uid", "doc_id", "w", "shape", "k", "known", "base", "model"]


def _scoring(vocabulary, params: np.ndarray, norms):
    """For each document one row of what the task knows and a row for each rare word."""

    def run(batches):
        v, table = vocabulary.value, norms.value
        model = LogBilinear(v.size, v.unigram).load(params)
        index = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                texts = as_bytes(part.column("text"))
                if not texts:
                    continue
                ws, numbers, begins = v.read(texts)
                logs = model.log_probabilities(*_contexts(v.classes[numbers], begins, v.size), table).astype(np.float64) / math.log(10) + v.share_logs[numbers]
                total = lambda x: np.add.reduceat(x, begins)  # noqa: E731  no text is without a token
                uid = np.arange(index, index + len(texts))
                index += len(texts)
                known, base = total(v.seen[numbers].astype(np.int64)), total(v.base_logs[numbers])
                tokens = np.diff(np.append(begins, len(ws)))
                main = [pa.array(uid), part.column("doc_id"), pa.array([b" %d" % u for u in uid.tolist()], pa.binary()), pa.nulls(len(uid), pa.int32()), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(total(logs), pa.float64())]
                yield pa.RecordBatch.from_arrays(main, _SCORED)
                at = np.flatnonzero(numbers >= len(v.words))
                owner = np.searchsorted(begins, at, "right") - 1
                times = Counter(zip(owner.tolist(), [ws[i] for i in at.tolist()], (numbers[at] - len(v.words)).tolist()))
                owners, rare, shapes = zip(*times) if times else ((), (), ())
                where, n = pa.array(owners, pa.int64()), len(rare)
                less = [main[0].take(where), main[1].take(where), pa.array([name(w) for w in rare], pa.binary()), pa.array(shapes, pa.int32()), pa.array(times.values(), pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())]
                yield pa.RecordBatch.from_arrays(less, _SCORED)

    return run


class Model:
    """What fit() learns: a table of all training words' counts, the vocabulary and the parameters."""

    def __init__(self, counts: DataFrame, vocabulary: Vocabulary, params: np.ndarray):
        self.counts, self.vocabulary, self.params = counts, vocabulary, params


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def fit(docs: DataFrame, rounds: int = 1, id_col: str = "doc_id", text_col: str = "text", own_classes: int | None = None, frequent: int = FREQUENT) -> Model:
    """Learn from the documents that aren't held out (crc32 of doc_id as text, mod 5, is not 1); null texts count as empty, and repeated rows as often as they occur."""
    docs = _narrow(docs, id_col, text_col)
    counts, v = learn(docs, own_classes, frequent)
    shared = docs.sparkSession.sparkContext.broadcast(v)
    params = _train(docs, shared, rounds)
    shared.unpersist()
    return Model(counts, v, params)


def score_with(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of score() under a model that is there already."""
    docs, v, context = _narrow(docs, id_col, text_col), model.vocabulary, docs.sparkSession.sparkContext
    norms = LogBilinear(v.size, v.unigram).load(model.params).norms()
    seen = docs.mapInArrow(tidy(_scoring(context.broadcast(v), model.params, context.broadcast(norms)), pause_gc=True), "uid bigint, doc_id bigint, w binary, shape int, k bigint, known bigint, base double, model double")
    rare = seen.join(model.counts.where(~F.col("w").isin([bytearray(END)])).select("w", "c"), "w", "left")
    log_mass = F.element_at(F.array(*[F.lit(float(x)) for x in np.log10(v.mass)]), F.col("shape") + 1)
    each = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    is_rare = F.col("shape").isNotNull()
    return (
        rare.groupBy("uid", "doc_id")
        .agg(
            F.sum(F.when(~is_rare, F.col("k"))).alias("n_tokens"),
            F.sum(F.when(is_rare, F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).otherwise(F.col("known"))).cast("bigint").alias("n_known"),
            F.sum(F.when(is_rare, F.col("k") * (each - float(np.log10(v.base)))).otherwise(F.col("base"))).alias("base_score"),
            F.sum(F.when(is_rare, F.col("k") * (each - log_mass)).otherwise(F.col("model"))).alias("score"),
        )
        .select("doc_id", (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(v.total).cast("bigint").alias("train_tokens"), "base_score", "score")
    )


def score(docs: DataFrame, rounds: int = 1, id_col: str = "doc_id", text_col: str = "text", own_classes: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (A-Z lower-cased, parted by ASCII white space) and one end. Documents with
    crc32(doc_id as text) mod 5 = 1 are held out of counts and training. base_score is the unigram
    log10 probability with half a count added, score the model's. Null and empty texts are one end
    token; a null id counts as the empty text for the rule; repeated rows are kept and counted as
    often as they occur; an empty table gives an empty result; other columns are ignored. With no
    training text, both scores come from the added halves alone. Counts and base_score are exact;
    the model's parameters, and so score, depend a little on how the rows lie in partitions, as each
    task trains on its own rows before the average.
    """
    return score_with(docs, fit(docs, rounds, id_col, text_col, own_classes, frequent), id_col, text_col)
