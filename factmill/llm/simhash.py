"""SimHash near-duplicates by segment popcounts.

A fingerprint is mapped to the bit counts of its segments. The Manhattan distance of two such
vectors never exceeds the Hamming distance of the fingerprints, so fingerprints within a radius lie
in grid cells within that radius. The segments are taken in one or more groups: if the whole
vectors are within the radius, at least one group is within its share of it, and each group is
range-joined on its own grid: every fingerprint probes the cells about its own, half of them, as
the relation is symmetric. What meets in a cell is verified by the exact Hamming distance inside
the join, so candidates that fail are never written. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bound_batches, broadcast_if_small, by_place, cut, keyed, release, slices, tidy
from .components import components

SEED = 42


def words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes.split() parts at 0x20 and 0x09-0x0D."""
    return text.lower().split()


def shingle_hashes(ws: list[bytes], width: int) -> np.ndarray:
    """XXH64 of the shingles in order, repeats included; fewer words than width are one shingle."""
    if not ws:
        return np.zeros(0, "<u8")
    joined = b" ".join(ws)
    if len(ws) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    lengths = np.fromiter(map(len, ws), np.int64, len(ws)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends + 1 - lengths)[: len(ws) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], "<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; none gives zero."""
    n = len(hashes)
    if not n:
        return 0
    count = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += np.ones(len(bits), np.float32).dot(bits.astype(np.float32)).astype(np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = [fingerprint(shingle_hashes(words(b), width)) for b in as_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.array(out, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp) with fp a signed 64-bit integer; null and empty texts have fingerprint zero."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(_fingerprints(width)), "doc_id bigint, fp bigint")


def _ball(dims: int, radius: int) -> list[tuple[int, ...]]:
    """Integer vectors of that many dimensions with Manhattan length up to radius, one of each pair v, -v."""
    out: list[dict[int, int]] = [{}]
    layer = [{}]
    for _ in range(radius):
        layer = [{**v, i: v.get(i, 0) + s} for v, i, s in product(layer, range(dims), (1, -1)) if v.get(i, 0) * s >= 0]
        out += layer
    whole = {tuple(v.get(i, 0) for i in range(dims)) for v in out}
    return sorted(v for v in whole if v >= (0,) * dims)


def _ball_size(dims: int, radius: int) -> int:
    return sum(2**k * math.comb(dims, k) * math.comb(radius, k) for k in range(min(dims, radius) + 1))


def plan_grid(n: int, radius: int) -> tuple[int, int]:
    """(groups, bits of a segment) with the least expected work for n evenly spread fingerprints; any choice gives the same links."""
    best = None
    for groups in (1, 2, 3, 4):
        for bits in (2, 4, 8):
            dims, share = 64 // groups // bits, radius // groups
            meet = math.comb(2 * bits, bits) / 4**bits
            ball = _ball_size(dims, share)
            if ball > 1500:
                continue
            cost = n * groups * ball / 2 * 10 + n * n / 2 * groups * ball * meet**dims
            best = min(best or (cost, groups, bits), (cost, groups, bits))
    return best[1:]


def _around(group: int, cell: Column, offsets: list[int]) -> Column:
    each = F.array(*[F.lit(o).cast("bigint") for o in sorted(set(offsets))])
    return F.transform(each, lambda o: F.struct(F.lit(group).alias("g"), (cell + o).alias("cell")))


def _cells(radius: int, groups: int, bits: int) -> tuple[Column, Column]:
    """Arrays of (g, cell) for a column fp: the cell of each group, and the half of the cells about it that it probes."""
    total = 64 // bits
    cuts = [total * g // groups for g in range(groups + 1)]
    width = max(3, bits.bit_length())  # of a packed count
    own, probes = [], []
    for g in range(groups):
        segments = range(cuts[g], cuts[g + 1])
        lanes = [i % (60 // width) * width for i in range(len(segments))]  # shared lanes only add candidates
        count = lambda s: F.bit_count(F.shiftrightunsigned("fp", s * bits).bitwiseAND((1 << bits) - 1)).cast("bigint")
        cell = sum((count(s) * F.lit(1 << lane).cast("bigint") for s, lane in zip(segments, lanes)), F.lit(0).cast("bigint"))
        offsets = [sum(d << lane for d, lane in zip(v, lanes)) for v in _ball(len(segments), radius // groups)]
        own.append(F.struct(F.lit(g).alias("g"), cell.alias("cell")))
        probes.append(_around(g, cell, offsets))
    return F.array(*own), F.flatten(F.array(*probes))


def links(nodes: DataFrame, radius: int, groups: int, bits: int) -> DataFrame:
    """(u, v) with u < v for the distinct fingerprints of nodes (fp) that differ in at most radius bits."""
    own, probes = _cells(radius, groups, bits)
    left = nodes.select(F.col("fp").alias("a"), F.explode(probes).alias("at")).select("a", "at.g", "at.cell")
    right = nodes.select(F.col("fp").alias("b"), F.explode(own).alias("at")).select("b", "at.g", "at.cell")
    near = left.join(right, (left.g == right.g) & (left.cell == right.cell) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius) & (F.col("a") != F.col("b")))
    return near.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, grid: tuple[int, int] | None = None) -> DataFrame:
    """One row per document: doc_id, fp, component_id, component_size.

    Documents whose fingerprints differ in at most radius bits are linked, and component_id is the
    smallest doc_id that can be reached over links (null if all are null). Null and empty texts
    have fingerprint zero and are linked like any others; repeated rows are kept; an empty table
    gives an empty result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    marked = cut(fingerprints(docs, id_col, text_col, width))
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    groups, bits = grid or plan_grid(nodes.count(), radius)
    roots = components(links(nodes.select("fp"), radius, groups, bits))
    homes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = homes.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("component_size"))
    homes = homes.select("fp", "root").join(named, "root").select("fp", "component_id", "component_size")
    return marked.join(homes, "fp").select("doc_id", "fp", "component_id", "component_size")


#: Residues whose parities a set of shingles is judged by, as 64-bit words.
PARITY_WORDS = 8


def parities(shingles: np.ndarray) -> list[int]:
    """Of a set of shingle hashes, how many end in each of 512 values, modulo 2: two sets differ in at least as many shingles as bits."""
    size = 64 * PARITY_WORDS
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


#: Bands of minima: sets of similarity s meet in one with probability 1 - (1 - s ** ROWS) ** BANDS, whatever their edits look like (0.8: all but 3 in a million).
BANDS, ROWS = 32, 5
_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(shingles: np.ndarray) -> list[int]:
    """A key for each band: the least of the shingle hashes under ROWS orders, digested with the band's number; none of an empty set."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1 << 10):
        np.minimum(least, np.multiply.outer(_MULTIPLIERS, shingles[at : at + (1 << 10)]).min(1), out=least)
    rows = least.tobytes()
    return [xxhash.xxh64_intdigest(rows[8 * ROWS * i : 8 * ROWS * (i + 1)], i) for i in range(BANDS)]


_MARKED = "key binary, doc_id bigint, node binary, fp bigint, bands array<bigint>, parity array<bigint>, size int"


def _row_marks(width: int, print_width: int):
    def run(batches):
        for batch in batches:
            rows = []
            for part in slices(batch, "text"):
                for key, d, b in zip(part.column("key").to_pylist(), part.column("doc_id").to_pylist(), as_bytes(part.column("text"))):
                    ws = words(b)
                    shingles = np.unique(shingle_hashes(ws, width))
                    met = np.array(bands(shingles), np.uint64).view(np.int64)
                    rows.append((key, d, xxhash.xxh3_128_digest(b" ".join(ws)), fingerprint(shingle_hashes(ws, print_width)), met, parities(shingles), len(shingles)))
            keys, ids, nodes, fps, met, odd, sizes = zip(*rows) if rows else ((),) * 7
            arrays = [pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(nodes, pa.binary()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(met, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64())), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "node", "fp", "bands", "parity", "size"])

    return run


def _first_texts(batches):
    seen = set()  # of this task
    for batch in batches:
        for part in slices(batch, "text"):
            out = {}
            for b in as_bytes(part.column("text")):
                plain = b" ".join(words(b))
                node = xxhash.xxh3_128_digest(plain)
                if node not in seen:
                    seen.add(node)
                    out[node] = plain
            yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.binary()), pa.array(out.values(), pa.binary())], ["node", "plain"])


def _shingle_sets(width: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "plain"):
                sets = [np.unique(shingle_hashes(b.split(), width)).view(np.int64) for b in as_bytes(part.column("plain"))]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) for the wanted nodes (materialised), by one more pass over the texts."""
    read = texts.mapInArrow(tidy(_first_texts), "node binary, plain binary").join(broadcast_if_small(wanted, 40), "node", "left_semi")
    once = read.groupBy("node").agg(F.min("plain").alias("plain"))  # tasks have met the same text
    return cut(once.mapInArrow(tidy(_shingle_sets(width)), "node binary, shingles array<bigint>"))


#: Most texts on a side of a block of comparisons, and most bytes of their shingles.
BLOCK_TEXTS, BLOCK_BYTES = 128, 8 << 20


def _compared(similarity: float):
    """For rows (cell, kind, a, b, shingles), sorted: the sets of a cell (kind 0) come before its pairs (kind 1)."""

    def run(batches):
        cell, held = None, {}
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            column = batch.column("shingles")
            bounds, values = column.offsets.to_numpy(), column.values.to_numpy()
            for i, (c, kind, a, b) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("cell", "kind", "a", "b")))):
                if c != cell:
                    cell, held = c, {}
                if not kind:
                    held[a] = np.sort(values[bounds[i] : bounds[i + 1]])
                    continue
                x, y = sorted((held[a], held[b]), key=len)
                common = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x) if len(x) else 0
                if common >= similarity * (len(x) + len(y) - common):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["a", "b"])

    return run


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets of shingles have at least that Jaccard similarity.

    Pairs come with the key of what they met in. The nodes of a key are dealt into blocks of bounded
    size, and two blocks are one unit of work, to which each of their sets goes once, not with every pair.
    """
    pairs = cut(pairs.groupBy("a", "b").agg(F.min("key").alias("key")))
    both = F.explode(F.array("a", "b")).alias("node")
    ends = pairs.select("key", both).distinct().join(sets.select("node", F.size("shingles").alias("n")), "node")
    need = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")
    blocks = cut(ends.groupBy("key").agg(need).where("blocks > 1"))
    at = lambda c: F.pmod(F.xxhash64(c), F.coalesce("blocks", F.lit(1)))
    dealt = cut(pairs.join(broadcast_if_small(blocks, 24), "key", "left").select(F.xxhash64("key", at("a"), at("b")).alias("cell"), "a", "b"))
    needed = dealt.select("cell", both).distinct().join(sets, "node")
    rows = needed.select("cell", F.lit(0).alias("kind"), F.col("node").alias("a"), F.lit(None).cast("binary").alias("b"), "shingles")
    rows = rows.unionByName(dealt.select("cell", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("array<bigint>").alias("shingles")))
    units = rows.repartition("cell").sortWithinPartitions("cell", "kind")
    alike = cut(units.mapInArrow(tidy(_compared(similarity)), "a binary, b binary"))
    release(pairs, blocks, dealt)
    return alike


#: What a side of a candidate pair is judged by before its shingles are looked at.
_JUDGED = ("size", *(f"p{i}" for i in range(PARITY_WORDS)))


def _not_apart(u: str, v: str, similarity: float) -> Column:
    """For columns of _JUDGED with two prefixes: no more shingles surely apart than the similarity allows."""
    apart = sum((F.bit_count(F.col(f"{u}{p}").bitwiseXOR(F.col(f"{v}{p}"))) for p in _JUDGED[1:]), F.lit(0))
    apart = F.greatest(apart, F.abs(F.col(f"{u}size") - F.col(f"{v}size")))
    return apart * (1 + similarity) <= (F.col(f"{u}size") + F.col(f"{v}size")) * (1 - similarity) + 1e-6


def _side(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """df with the columns of a pair's side renamed by a prefix."""
    return df.select(*keep, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keep])


def _met_in_bands(nodes: DataFrame) -> DataFrame:
    """(band, node, size, p0 ...) for the bands, and the fingerprints as one band more, that several nodes have."""
    every = F.array_append("bands", F.xxhash64("fp"))
    each = nodes.where("size > 0").select("node", F.explode(every).alias("band"))
    again = cut(each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"))
    met = each.join(broadcast_if_small(again, 16), "band")
    met = cut(met.join(nodes.select("node", *_JUDGED), "node").select("band", "node", *_JUDGED))
    release(again)
    return met


def _star_pairs(met: DataFrame, similarity: float, heads: int = 3) -> DataFrame:
    """(key, a, b): nodes and heads that share a band and may be alike, heads being a few of the band's nodes, chosen by digest."""
    picks = [F.min(F.struct(F.xxhash64(F.lit(i), "node").alias("order"), "node", *_JUDGED)) for i in range(heads)]
    picked = cut(met.groupBy("band").agg(F.array_distinct(F.transform(F.array(*picks), lambda x: x.dropFields("order"))).alias("heads")).select("band", F.explode("heads").alias("h")))
    v = picked.select("band", *[F.col(f"h.{c}").alias(f"v_{c}") for c in ("node", *_JUDGED)])
    near = _side(met, "u_", ("band",)).join(v, "band").where(_not_apart("u_", "v_", similarity) & (F.col("u_node") != F.col("v_node")))
    return near.select(F.xxhash64("v_node").alias("key"), F.least("u_node", "v_node").alias("a"), F.greatest("u_node", "v_node").alias("b")).distinct()


def _parted(df: DataFrame, parts: DataFrame) -> DataFrame:
    """df (node ...) with the part that the links so far have put each node into."""
    return df.join(parts.select("node", "root"), "node", "left").withColumn("part", F.xxhash64(F.coalesce("root", "node"))).drop("root")


def _band_pairs(met: DataFrame, parts: DataFrame, similarity: float) -> DataFrame:
    """(key, a, b): nodes of different parts that share a band and may be alike. The largest part of a band never meets itself."""
    placed = cut(_parted(met, parts))
    counted = placed.groupBy("band", "part").agg(F.count("*").alias("n"))
    largest = counted.groupBy("band").agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.count("*").alias("parts")).where("parts > 1").select("band", "largest")
    placed = cut(placed.join(largest, "band").withColumn("loose", F.col("part") != F.col("largest")).drop("largest"))
    u, v = _side(placed.where("loose").drop("loose"), "u_", ("band",)), _side(placed, "v_", ("band",))
    once = ~F.col("v_loose") | (F.col("u_node") < F.col("v_node"))
    near = u.join(v, "band").where((F.col("u_part") != F.col("v_part")) & once & _not_apart("u_", "v_", similarity))
    return near.select(F.col("band").alias("key"), F.least("u_node", "v_node").alias("a"), F.greatest("u_node", "v_node").alias("b")).distinct()


def _grid_pairs(nodes: DataFrame, parts: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(key, a, b): nodes of different parts whose fingerprints differ in at most radius bits and that may be alike, by a range-join of the popcount grid.

    Equal fingerprints of a part go by its least node.
    """
    each = _parted(nodes.where("size > 0").select("node", "fp"), parts)
    each = cut(each.groupBy("fp", "part").agg(F.min("node").alias("node")))
    groups, bits = plan_grid(each.count(), radius)
    own, probes = _cells(radius, groups, bits)

    def side(at: Column, n: str) -> DataFrame:
        return each.select(F.col("fp").alias(f"{n}_fp"), F.col("part").alias(f"{n}_part"), F.col("node").alias(f"{n}_node"), F.explode(at).alias("at")).select("at.g", "at.cell", f"{n}_fp", f"{n}_part", f"{n}_node")

    near = side(probes, "u").join(side(own, "v"), ["g", "cell"]).where((F.bit_count(F.col("u_fp").bitwiseXOR(F.col("v_fp"))) <= radius) & (F.col("u_part") != F.col("v_part")))
    near = cut(near.select(F.least("u_node", "v_node").alias("a"), F.greatest("u_node", "v_node").alias("b")).distinct())
    judged = nodes.select("node", *_JUDGED)
    both = near.join(_side(judged, "u_").withColumnRenamed("u_node", "a"), "a").join(_side(judged, "v_").withColumnRenamed("v_node", "b"), "b")
    return both.where(_not_apart("u_", "v_", similarity)).select(F.xxhash64("a").alias("key"), "a", "b")


def near_links(docs: DataFrame, nodes: DataFrame, width: int, radius: int, similarity: float) -> DataFrame:
    """(u, v): enough of the pairs of nodes (materialised) of at least that similarity to connect what all of them connect. docs has text."""
    met = _met_in_bands(nodes)
    wanted = cut(met.select("node").distinct())
    sets = _sets(docs, wanted, width)
    first = _alike(_star_pairs(met, similarity), sets, similarity)
    stars = components(first.select(F.col("a").alias("u"), F.col("b").alias("v")))
    parts = cut(stars)
    near = cut(_grid_pairs(nodes, parts, radius, similarity).unionByName(_band_pairs(met, parts, similarity)))
    more = cut(near.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(sets.select("node"), "node", "left_anti"))
    others = _sets(docs, more, width)
    second = _alike(near, sets.unionByName(others), similarity)
    links_ = cut(first.unionByName(second).select(F.col("a").alias("u"), F.col("b").alias("v")))
    release(met, wanted, sets, first, parts, near, more, others, second)
    return links_


def drop_near_copies(docs: DataFrame, width: int = 5, radius: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", print_width: int = 2) -> DataFrame:
    """docs less its near copies: of each group, the row with the smallest doc_id stays.

    Texts with the same words are one. Others are linked if their sets of shingles of width words
    have a Jaccard similarity of at least similarity, and groups are what links connect. Compared
    are texts whose fingerprints over shingles of print_width words differ in at most radius bits,
    found by the popcount grid, and texts that share a band of minima of their shingles (BANDS): at
    a similarity of 0.8 fingerprints are 5 of 64 bits apart in the median and often more, where the
    grid can't tell them from strangers, while the bands miss 3 pairs in a million whatever their
    edits look like. Every comparison is exact. Texts of a band are first compared with a few of them; then only texts that these links
    have not put into one part, and whose shingles are not surely too far apart, are compared, so
    that a large group doesn't meet itself whole.

    Null counts as empty, and empty texts are one; ids that are null or no integers come after all
    others; rows that repeat whole are one document; of texts with equal ids the one with the least
    row digest stays. An empty table gives an empty result. All columns pass through, whatever their names.
    """
    bound_batches(docs.sparkSession)
    names = docs.columns
    text_at, id_at = names.index(text_col), names.index(id_col)
    rows = keyed(by_place(docs), text_at, id_at)
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    marked = rows.select("key", F.expr(f"try_cast(c{id_at} AS bigint)").alias("doc_id"), F.col(f"c{text_at}").alias("text"))
    marks = cut(marked.mapInArrow(tidy(_row_marks(width, print_width)), _MARKED))
    parity = [F.element_at("parity", i + 1).alias(f"p{i}") for i in range(PARITY_WORDS)]
    nodes = cut(marks.groupBy("node").agg(F.first(F.struct("fp", "bands", "size", *parity)).alias("m")).select("node", "m.*"))
    links_ = near_links(texts, nodes, width, radius, similarity)
    release(nodes)
    roots = components(links_)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("key").alias("key"))
    homes = cut(marks.select("key", "doc_id", "node").join(roots, "node", "left").select("key", "doc_id", F.coalesce("root", "node").alias("root")))
    stays = cut(homes.groupBy("root").agg(F.min(order).alias("stays"), F.count("*").alias("n")).where("n > 1").select("root", "stays.key").withColumnRenamed("key", "stays"))  # by itself, so that a hot group can be split
    gone = cut(homes.join(stays, "root").where("key <> stays").select("key").distinct())
    repeats = not marks.groupBy("key").count().where("count > 1").isEmpty()
    release(marks, links_, homes, stays)
    left = rows.join(broadcast_if_small(gone, 40), "key", "left_anti")
    if repeats:
        left = left.dropDuplicates(["key"])
    return left.drop("key").toDF(*names)
