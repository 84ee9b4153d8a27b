"""Sharding by sampled splitters, in DataFrame operations only.

Records are put in the order of (digest of the text, id): equal texts lie together, a hot text is
spread over its ids, and the order has nothing to do with the order of arrival. Keys drawn with
chances in proportion to their records' sizes give splitters at the quantiles of the sample. The
ranges between splitters are summed, and those that are overfull, or that a shard's bound falls into
too far from both of their ends, are subdivided by keys drawn in them. Shards are then runs of whole
ranges: a record's shard follows from the splitters about it and from nothing else.
"""

from __future__ import annotations

import bisect
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, release

#: Keys drawn for each range, the multiple of a range's fair share beyond which it is subdivided, and how far from its place, in shares of a shard, a bound may lie.
SAMPLES, OVERFULL, TOLERANCE = 8, 2.0, 0.001
#: Ranges that one with a bound in it is subdivided into, and the most rounds of that.
PARTS, ROUNDS = 64, 8
LAST = 2**63 - 1
_PREFIX = 3  # hex digits of the digest that splitters are looked up by

#: A place in the order; a record lies at (digest, id, number), (digest, null, null) is before all records of a text and (digest, LAST, LAST) behind them.
Key = tuple[str, int | None, int | None]
_KEY = "struct<k:string,d:bigint,u:bigint>"


def _table(df: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """A small table of driver rows, without Python or RDDs in its plan."""
    return df.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _order(key: Key) -> tuple:
    return (key[0], key[1] is not None, key[1] or 0, key[2] is not None, key[2] or 0)


def _ranged(df: DataFrame, splitters: list[Key]) -> DataFrame:
    """df with rid, the number of splitters at or before each record; they are looked up by the digest's beginning, and there in two levels."""
    by_prefix: dict[str, list[Key]] = {}
    for s in splitters:
        by_prefix.setdefault(s[0][:_PREFIX], []).append(s)
    rows, before, named = [], 0, lambda s: {"k": s[0], "d": s[1], "u": s[2]}
    for i in range(16**_PREFIX):
        prefix = format(i, f"0{_PREFIX}x")
        mine = by_prefix.get(prefix, [])
        step = max(1, math.isqrt(len(mine)))
        blocks = [list(map(named, mine[j : j + step])) for j in range(0, len(mine), step)]
        rows.append({"p": prefix, "before": before, "step": step, "heads": [b[0] for b in blocks], "blocks": blocks})
        before += len(mine)
    table = _table(df, rows, f"p:string,before:int,step:int,heads:array<{_KEY}>,blocks:array<array<{_KEY}>>")
    key = F.struct(F.col("k"), F.col("doc_id").alias("d"), F.col("u"))
    at = F.size(F.filter("heads", lambda s: s <= key))
    within = F.size(F.filter(F.element_at("blocks", F.greatest(at, F.lit(1))), lambda s: s <= key))
    found = F.col("before") + F.when(at == 0, 0).otherwise((at - 1) * F.col("step") + within)
    return df.withColumn("p", F.substring("k", 1, _PREFIX)).join(F.broadcast(table), "p").withColumn("rid", found).select(*df.columns, "rid")


def _drawn(df: DataFrame, per_byte: Column, seed: int) -> list[Key]:
    """Keys of records, each drawn with a chance in proportion to its size."""
    draw = F.pmod(F.xxhash64("k", "doc_id", "u", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    return sorted(((r.k, r.doc_id, r.u) for r in df.where(draw < F.col("size") * per_byte).select("k", "doc_id", "u").collect()), key=_order)


def _quantiles(keys: list[Key], parts: int, whole: bool = True) -> list[Key]:
    """Splitters at the quantiles of a sample; whole: before and behind all records of a text, so that equal texts stay together and a large group gets a range of its own."""
    picked = [keys[len(keys) * i // parts] for i in range(1, parts)] if len(keys) >= parts else keys
    if not whole:
        return picked
    return sorted({s for k, _, _ in picked for s in ((k, None, None), (k, LAST, LAST))}, key=_order)


def _sums(ranged: DataFrame) -> list:
    """One row for each range, in order: bytes, rows and whether it holds several texts or several records."""
    sums = ranged.groupBy("rid").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), (F.min("k") != F.max("k")).alias("texts"))
    return sorted(sums.collect())


def _bounds(sums: list, total: int, shards: int, tolerance: float) -> tuple[list[int], set[int]]:
    """(first range of each shard but the first, ranges that a bound falls into beyond the tolerance); bounds lie between ranges, the nearer end counts."""
    ends = [0]
    for r in sums:
        ends.append(ends[-1] + r.bytes)
    firsts, torn = [], set()
    for s in range(1, shards if sums else 1):
        ideal = total * s / shards
        i = min(max(0, bisect.bisect_left(ends, ideal) - 1), len(sums) - 1)  # ends[i] < ideal <= ends[i + 1]
        low, high = ideal - ends[i], ends[i + 1] - ideal
        firsts.append(sums[i].rid if low <= high else sums[i].rid + 1)
        if min(low, high) > tolerance:
            torn.add(i)
    return firsts, torn


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 500_000, whole_group_share: float = 0.01) -> DataFrame:
    """Deal records into shards of near equal bytes.

    A record's size is the UTF-8 length of its text plus 8; a null text counts as empty. A bound
    between shards lies no farther from its even place than a thousandth of a shard, half the
    largest record, or half the group of equal texts that it falls into where that group holds at
    most whole_group_share of a shard: such groups stay in one shard, larger ones are cut by their
    ids. Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in key order)
    and grown_shard (null). Repeated rows are kept, each with its own slot; null ids sort first; an
    empty table gives an empty result; other columns of docs are ignored, whatever their names.

    What reaches the driver: one row of totals, SAMPLES keys for each rows_per_range records (at
    least 8 ranges for each shard), PARTS keys for each bound, and one sum for each range.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = cut(
        docs.select(
            F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
            (F.octet_length(text).cast("bigint") + 8).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("k"),
            F.monotonically_increasing_id().alias("u"),  # tells rows apart that repeat whole; fixed, as the table is written
        )
    )
    n, total = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(8 * shards, math.ceil(n / rows_per_range))
    share, fair = max(total, 1) / shards, max(total, 1) / ranges
    splitters = _quantiles(_drawn(narrow, F.lit(SAMPLES / fair), 1), ranges)
    for turn in range(ROUNDS):
        ranged = _ranged(narrow, splitters)
        sums = _sums(ranged)
        firsts, torn = _bounds(sums, total, shards, TOLERANCE * share)
        parts = {}
        for i, r in enumerate(sums):
            full = r.bytes > OVERFULL * fair + 4096 or r.rows > 2 * rows_per_range
            divisible = r.rows > 1 and (r.texts or full or r.bytes > whole_group_share * share)
            if divisible and (full or i in torn):
                parts[r.rid] = (PARTS if i in torn else math.ceil(r.bytes / fair) + 1, r)
        if not parts or turn == ROUNDS - 1:
            break
        rates = _table(narrow, [{"rid": rid, "rate": SAMPLES * p / r.bytes} for rid, (p, r) in parts.items()], "rid:int,rate:double")
        drawn = _drawn(ranged.join(F.broadcast(rates), "rid"), F.col("rate"), 2 + turn)
        homes: dict[int, list[Key]] = {}
        keys = [_order(s) for s in splitters]
        for key in drawn:
            homes.setdefault(bisect.bisect_right(keys, _order(key)), []).append(key)
        grown = set(splitters)
        for rid, mine in homes.items():
            p, r = parts[rid]
            grown.update(_quantiles(mine, p, whole=bool(r.texts)))
        if len(grown) == len(splitters):
            break
        splitters = sorted(grown, key=_order)
    placed, rows, shard_ = [], 0, 0
    for r in sums:
        new = bisect.bisect_right(firsts, r.rid)
        if new != shard_:
            shard_, rows = new, 0
        placed.append({"rid": r.rid, "shard": shard_, "before": rows})
        rows += r.rows
    homes = F.broadcast(_table(narrow, placed, "rid:int,shard:int,before:bigint"))
    dealt = cut(ranged.join(homes, "rid"))
    release(narrow)
    slot = F.col("before") + F.row_number().over(Window.partitionBy("rid").orderBy("k", "doc_id", "u")) - 1
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
