"""Retrieval: exact cosine, BM25 over an inverted index, rank fusion and group union."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize
from ..sources.files import bound_batches

K1, B, RRF = 1.2, 0.75, 60


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def _vectors(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the places of the vectors that have it, and those as rows of a matrix; vectors that are empty, null or hold a null are left out."""
    lists = column.to_pylist()
    places: dict[int, list[int]] = {}
    for i, v in enumerate(lists):
        if v and None not in v:
            places.setdefault(len(v), []).append(i)
    return {n: (np.array(at), np.array([lists[i] for i in at], dtype="float64")) for n, at in places.items()}


def _summed(products: np.ndarray) -> np.ndarray:
    """Row sums from left to right, as cosine() adds."""
    return np.add.accumulate(products, axis=1)[:, -1]


def _contenders(score: np.ndarray, k: int, digits: int) -> np.ndarray:
    """Where a row's k best by (rounded score, place) may be: a score so near a half that its rounding isn't sure counts with either. Places whose score is -9 are none."""
    width = score.shape[1]
    if width <= k:
        return score > -9
    scaled, sure = score * 10.0**digits, 1e-9 * 10.0**digits
    place = np.arange(width)
    least = np.floor(scaled - sure + 0.5) * width - place
    kth = np.partition(least, width - k, axis=1)[:, width - k, None]
    return (np.floor(scaled + sure + 0.5) * width - place >= kth) & (score > -9)


def nearest(questions: DataFrame, items: DataFrame, question: str, item: str, group: str, k: int, digits: int = 4, per_deal: int = 20_000, block: int = 2_000_000) -> DataFrame:
    """(question, item, group, score) of the items that can be among a question's k best of its group by cosine() rounded to so many digits, then by item; every pair is looked at.

    questions (question, group, qe) and items (item, group, embedding) are dealt into groups of bounded
    size, all pairs of which meet as matrix products, a bounded block at a time; the scores of what
    is left are added up as cosine() does. An item never meets the question of its own id.
    """
    bound_batches(items.sparkSession)
    n, m = (-(-df.count() // per_deal) or 1 for df in (items, questions))
    deal = lambda df, key, own, parts, other, others: df.where(F.col(group).isNotNull()).withColumn(own, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
    # both sides' deals are ints: a cogroup doesn't cast its keys, and unlike types are hashed apart
    asked = deal(questions.select(question, F.col(group).cast(items.schema[group].dataType).alias(group), "qe"), question, "_q", m, "_i", n).groupBy(group, "_q", "_i")
    held = deal(items.select(item, group, "embedding"), item, "_i", n, "_q", m).groupBy(group, "_q", "_i")
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"`{question}` {kind(questions, question)}, `{item}` {kind(items, item)}, `{group}` {kind(items, group)}, score double"

    def run(q: pa.Table, e: pa.Table) -> pa.Table:
        e = e.sort_by(item)  # places then order as the items do
        ids, names = e.column(item), q.column(question)
        own = {v: j for j, v in enumerate(ids.to_pylist())}
        vectors = _vectors(e.column("embedding"))
        norms = {size: np.sqrt(_summed(v * v)) for size, (_, v) in vectors.items()}
        wide, left, right, scores = e.num_rows, [], [], []

        def meet(at: np.ndarray, mine: np.ndarray | None) -> None:
            """Questions at these places, with vectors of one length or none."""
            step = max(1, block // max(1, wide))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                score = np.full((len(part), wide), -3.0)  # a pair without a score comes last
                if mine is not None and mine.shape[1] in vectors:
                    place, theirs = vectors[mine.shape[1]]
                    v = mine[lo : lo + step]
                    with np.errstate(all="ignore"):
                        length = np.sqrt(_summed(v * v))[:, None] * norms[mine.shape[1]]
                        near = v @ theirs.T / length
                    near = np.where(length == 0, -3.0, np.where(np.isnan(near), 2.0, near))  # NaN is above all numbers
                    score[:, place] = near
                for i, j in enumerate(part):
                    if (same := own.get(names[int(j)].as_py())) is not None:
                        score[i, same] = -9.0
                i, j = np.nonzero(_contenders(score, k, digits))
                exact, has = np.zeros(len(i)), score[i, j] > -3
                if has.any():
                    inner = np.searchsorted(place, j[has])
                    with np.errstate(all="ignore"):
                        exact[has] = _summed(v[i[has]] * theirs[inner]) / length[i[has], inner]
                left.append(part[i])
                right.append(j)
                scores.append(pa.array(exact, pa.float64(), mask=~has))

        if wide and q.num_rows:
            known = _vectors(q.column("qe"))
            for at, mine in known.values():
                meet(at, mine)
            rest = np.setdiff1d(np.arange(q.num_rows), np.concatenate([np.zeros(0, int), *(at for at, _ in known.values())]))
            meet(rest, None)
        at = np.concatenate([np.zeros(0, int), *left])
        to = np.concatenate([np.zeros(0, int), *right])
        return pa.table({question: names.take(pa.array(at)), item: ids.take(pa.array(to)), group: q.column(group).take(pa.array(at)), "score": pa.chunked_array(scores, pa.float64())})

    return asked.cogroup(held).applyInArrow(run, schema)


def terms(text: Column) -> Column:
    return F.filter(F.split(normalize(text), r"[^\p{L}\p{N}_]+"), lambda t: F.length(t) > 0)


def postings(chunks: DataFrame, chunk: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(term, chunk, tf, size): the inverted index, with each chunk's number of terms, and further columns of the chunk to filter by."""
    keep = keep or []
    listed = chunks.select(chunk, *keep, terms(F.col(text)).alias("ts"))
    return listed.select(chunk, *keep, F.size("ts").alias("size"), F.explode("ts").alias("term")).groupBy("term", chunk, *keep, "size").agg(F.count("*").alias("tf"))


def bm25(index: DataFrame, queries: DataFrame, chunk: str, query: str, within: list[str] | None = None) -> DataFrame:
    """(query, chunk, score) from queries (query, term); rows only where a term is shared.

    With within, queries have these columns too and meet only chunks that agree in them (a document
    filter); how rare a term is and how long chunks are is still said of the whole index. The index
    is read once for its statistics and once for its hits, without a job in between.
    """
    within = within or []
    sizes = index.groupBy(chunk).agg(F.first("size").alias("size")).agg(F.count("*").alias("n"), F.avg("size").alias("mean"))
    asked = queries.select(query, "term", *within).distinct()
    frequency = index.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    n, mean = sizes.select("n").scalar(), F.coalesce(sizes.select("mean").scalar(), F.lit(1.0))  # subqueries, not joins
    hits = index.join(asked, ["term", *within]).join(frequency, "term")
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / mean))
    return hits.groupBy(query, *within, chunk).agg(F.sum(idf * weight).alias("score"))


def hybrid(index: DataFrame, inverted: DataFrame, questions: DataFrame, query: str, chunk: str, doc: str, k: int) -> DataFrame:
    """The k best chunks of one document for each question (query, doc, question, embedding): nearest vectors and BM25, fused by rank.

    Both rankings join on the document first, so that a question meets that document's chunks only.
    """
    keys = [query, doc]
    near = questions.select(*keys, F.col("embedding").alias("qe")).join(index.select(doc, chunk, "embedding"), doc).select(*keys, chunk, F.coalesce(cosine(F.col("qe"), F.col("embedding")), F.lit(0.0)).alias("score"))
    words = bm25(inverted, questions.select(*keys, F.explode(terms(F.col("question"))).alias("term")), chunk, query, [doc])
    rank = lambda df: top_k(df.withColumn("score", F.round("score", 6)), keys, k, chunk)
    fused = fuse(rank(near), rank(words), [*keys, chunk]).withColumn("score", F.round("score", 6))
    return top_k(fused, keys, k, chunk)


def top_k(scored: DataFrame, groups: list[str], k: int, item: str, score: str = "score") -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc(score), F.col(item))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fuse(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists with column rank."""
    share = lambda df: df.select(*keys, (1.0 / (RRF + F.col("rank"))).alias("share"))
    return share(a).unionByName(share(b)).groupBy(*keys).agg(F.sum("share").alias("score"))


def group_union(hits: DataFrame, groups: list[str], chunk: str) -> DataFrame:
    """The chunks that any field of a group found, with their best score, in chunk order (unknown order last)."""
    best = hits.groupBy(*groups, chunk).agg(F.max("score").alias("score"), F.min("chunk_index").alias("chunk_index"))
    order = Window.partitionBy(*groups).orderBy(F.coalesce("chunk_index", F.lit(1_000_000)), chunk)
    return best.withColumn("pos", F.row_number().over(order) - 1)


def context(found: Column, count: Column, full: Column, least: int = 3) -> Column:
    """Retrieved text if enough chunks were found, else the full text."""
    return F.when(count >= least, found).otherwise(full)
