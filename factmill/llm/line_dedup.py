"""Line deduplication over overlapping windows of three lines, and of passages over windows of fifty words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bound_batches, broadcast_if_small, by_place, cut, keyed, release, slices, tidy

LINES = 3
#: Words of a passage's window, and of the runs by which windows that may be repeated are found.
PASSAGE, ANCHOR = 50, 16


def window_digests(text: bytes, lines: int = LINES) -> list[bytes]:
    """A 128-bit digest of each run of so many lines; blank runs have an empty one."""
    rows = text.split(b"\n")
    out = []
    for i in range(len(rows) - lines + 1):
        run = b"\n".join(rows[i : i + lines])
        out.append(xxhash.xxh3_128_digest(run) if run.strip() else b"")
    return out


def _windows(lines: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                ws = [window_digests(b, lines) for b in as_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(ws, pa.list_(pa.binary()))], ["doc_id", "key", "ws"])

    return run


def _later(windows: DataFrame) -> DataFrame:
    """(key, starts): for rows (doc_id, key, pos, w), where the windows of each document start that occurred before, in (doc_id, key, pos) order."""
    at = F.struct(F.col("doc_id"), F.col("key"), F.col("pos"))
    repeated = cut(windows.groupBy("w").agg(F.min(at).alias("first"), F.max(at).alias("last")).where(F.col("first") != F.col("last")).select("w", "first"))
    later = windows.join(broadcast_if_small(repeated, 120), "w").where(at != F.col("first"))
    starts = cut(later.groupBy("key").agg(F.collect_set("pos").alias("starts")))
    release(repeated)
    return starts


def later_lines(rows: DataFrame, lines: int = LINES) -> DataFrame:
    """(key, starts) for rows (doc_id, key, text): the first lines of the windows that occurred before, in (doc_id, line) order."""
    seen = rows.mapInArrow(tidy(_windows(lines)), "doc_id bigint, key binary, ws array<binary>")
    return _later(seen.select("doc_id", "key", F.posexplode("ws").alias("pos", "w")).where(F.length("w") > 0))


def covered_lines(starts: list[int], lines: int = LINES) -> bytearray:
    """One byte a line up to the last that runs of so many lines, starting at these, cover: 1 if covered. In one pass, whatever the number of runs."""
    out = bytearray(max(starts) + lines)
    for s in starts:
        out[s : s + lines] = b"\1" * lines
    return out


def _covered(lines: int):
    def run(batches):
        for batch in batches:
            gone = [np.frombuffer(covered_lines(s, lines), np.bool_) for s in batch.column("starts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(gone, pa.list_(pa.bool_()))], ["key", "gone"])

    return run


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES) -> DataFrame:
    """docs with its text less the repeated passages, and columns lines_in, lines_removed.

    A passage is a window of three consecutive lines (split at line feeds only). Windows are found
    across the whole table; the occurrence that comes first by (doc_id, line) stays, and every line
    that a later occurrence covers goes, overlapping windows merged. Windows of blank lines don't
    count; a text of fewer lines has no window and stays as it is; a null text stays null, and a
    text that loses all its lines becomes empty. Ids that are null or no integers come first. Rows
    that agree in id and text are one document: they are treated alike, not as copies of each other.
    An empty table gives an empty result; the time for a text is linear in its lines and windows.
    All other columns pass through, whatever their names (the added ones replace columns of the same
    name).
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lines_in", "lines_removed")])
    names = docs.columns
    text_at, id_at = names.index(text_col), names.index(id_col)
    rows = keyed(by_place(docs), text_at, id_at)
    starts = later_lines(rows.select(F.expr(f"try_cast(c{id_at} AS bigint)").alias("doc_id"), "key", F.col(f"c{text_at}").alias("text")), lines)
    gone = cut(starts.mapInArrow(tidy(_covered(lines)), "key binary, gone array<boolean>"))
    release(starts)
    text = F.col(f"c{text_at}")
    whole = F.split(text, "\n", -1)
    joined = rows.join(broadcast_if_small(gone, 60, "gone", item_bytes=1), "key", "left")
    left = F.filter(whole, lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    joined = joined.withColumn("left", F.when(F.col("gone").isNotNull() & text.isNotNull(), left))
    out = [F.when(F.col("left").isNull(), text).otherwise(F.array_join("left", "\n")).alias(c) if c == f"c{text_at}" else F.col(c) for c in by_place(docs).columns]
    total = F.coalesce(F.size(whole), F.lit(0))
    removed = F.when(F.col("left").isNull(), 0).otherwise(F.size(whole) - F.size("left"))
    return joined.select(*out, total.alias("lines_in"), removed.alias("lines_removed")).toDF(*names, "lines_in", "lines_removed")


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end, in bytes; what parts them is 0x20 and 0x09-0x0D."""
    b = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse


def anchors(text: bytes, passage: int = PASSAGE, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first words) of runs of so many words: one at least of each run of passage words, chosen by its content alone (winnowing).

    Equal passages therefore hold anchors of equal hashes, wherever they stand.
    """
    ws = text.split()
    n = len(ws) - anchor + 1
    if len(ws) < passage:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, ws), np.uint64, len(ws))
    powers = np.cumprod(np.full(len(ws), _FACTOR, np.uint64))
    back = np.cumprod(np.full(n, pow(_FACTOR, -1, 2**64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    runs = (sums[anchor:] - sums[:n]) * back
    runs ^= runs >> np.uint64(31)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(29)
    each, least = passage - anchor + 1, []
    for at in range(0, n - each + 1, 1 << 14):
        part = np.lib.stride_tricks.sliding_window_view(runs[at : at + (1 << 14) + each - 1], each)
        least.append(part.argmin(1) + np.arange(at, at + len(part)))
    places = np.unique(np.concatenate(least))
    return runs[places].view(np.int64), places


def _anchors(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            found = [anchors(b) for b in as_bytes(part.column("text"))]
            hs, at = [h for h, _ in found], [p for _, p in found]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(hs, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int64()))], ["key", "hs", "at"])


def _passages(batches):
    """For rows (doc_id, key, text, at): digests of the windows of PASSAGE words that hold one of the anchors at these words."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            starts, ws = [], []
            for b, at in zip(as_bytes(part.column("text")), part.column("at").to_pylist()):
                words = b.split()
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                first = np.asarray(at, np.int64)[:, None] - np.arange(PASSAGE - ANCHOR + 1)
                first = np.unique(first[(first >= 0) & (first <= len(words) - PASSAGE)])
                bounds = zip(np.where(first > 0, ends[first - 1] + 1, 0).tolist(), ends[first + PASSAGE - 1].tolist())
                starts.append(first)
                ws.append([xxhash.xxh3_128_digest(joined[x:y]) for x, y in bounds])
            arrays = [part.column("doc_id"), part.column("key"), pa.array(starts, pa.list_(pa.int64())), pa.array(ws, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "starts", "ws"])


def covered_words(starts: list[int], words: int = PASSAGE) -> list[int]:
    """The stretches of words that runs of so many words cover, as starts and ends one after the other."""
    out: list[int] = []
    for s in sorted(starts):
        if out and s <= out[-1]:
            out[-1] = s + words
        else:
            out += [s, s + words]
    return out


def _stretches(batches):
    for batch in batches:
        gone = [covered_words(s) for s in batch.column("starts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(gone, pa.list_(pa.int32()))], ["key", "gone"])


def without_words(text: bytes, gone: list[int]) -> bytes:
    """text less these stretches of words (starts and ends); where one goes, the longer break of its two sides stays."""
    a, z = word_places(text)
    out, at = [], 0  # at: a byte
    for i, j in zip(gone[::2], gone[1::2]):  # words i to j - 1 go
        j = min(j, len(a))
        before = z[i - 1] if i else 0
        after = a[j] if j < len(a) else len(text)
        out.append(text[at:before])
        if i and j < len(a):
            out.append(max(text[before : a[i]], text[z[j - 1] : after], key=lambda s: s.count(b"\n")))
        at = after
    return b"".join([*out, text[at:]])


def _without_passages(names: list[str], text_at: int):
    def run(batches):
        for batch in batches:
            texts = [t if g is None else without_words(t.encode(), g).decode() for t, g in zip(batch.column(text_at).to_pylist(), batch.column("gone").to_pylist())]
            columns = [pa.array(texts, pa.string()) if i == text_at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its text less the repeated passages of PASSAGE words or more, wherever lines end.

    A passage is a run of PASSAGE consecutive words, white space apart. Of equal passages across the
    whole table the one that comes first by (doc_id, word) stays, and every word that a later one
    covers goes. None is missed: every passage holds an anchor that its equals hold too, and all
    windows about repeated anchors are compared by 128-bit digests. Shorter repeats stay. Rows that
    agree in id and text are one document; ids that are null or no integers come first; null texts
    stay null, an empty table gives an empty result, and all columns pass through, whatever their
    names.
    """
    bound_batches(docs.sparkSession)
    names = docs.columns
    text_at, id_at = names.index(text_col), names.index(id_col)
    rows = keyed(by_place(docs), text_at, id_at)
    narrow = rows.select(F.expr(f"try_cast(c{id_at} AS bigint)").alias("doc_id"), "key", F.col(f"c{text_at}").alias("text"))
    found = narrow.select("key", "text").mapInArrow(tidy(_anchors), "key binary, hs array<bigint>, at array<bigint>").where(F.size("hs") > 0)
    found = cut(found.select("key", F.explode(F.arrays_zip("hs", "at")).alias("x")).select("key", "x.hs", F.col("x.at").cast("int").alias("at")))
    one = F.xxhash64("key", "at")  # a row that repeats whole holds nothing twice
    again = cut(found.groupBy("hs").agg(F.min(one).alias("low"), F.max(one).alias("high")).where("low <> high").select("hs"))
    places = cut(found.join(broadcast_if_small(again, 16), "hs").groupBy("key").agg(F.collect_set("at").alias("at")))
    release(found, again)
    held = narrow.join(broadcast_if_small(places, 60, "at", item_bytes=8), "key").select("doc_id", "key", "text", "at")
    seen = held.mapInArrow(tidy(_passages), "doc_id bigint, key binary, starts array<bigint>, ws array<binary>")
    spread = seen.select("doc_id", "key", F.explode(F.arrays_zip("starts", "ws")).alias("x")).select("doc_id", "key", F.col("x.starts").cast("int").alias("pos"), F.col("x.ws").alias("w"))
    windows = cut(spread.distinct())  # rows that repeat whole have the same windows
    starts = _later(windows)
    gone = cut(starts.mapInArrow(tidy(_stretches), "key binary, gone array<int>"))
    release(places, windows, starts)
    joined = rows.join(broadcast_if_small(gone, 60, "gone", item_bytes=8), "key", "left").drop("key")
    placed = joined.columns[:-1]
    return joined.mapInArrow(tidy(_without_passages(placed, text_at)), joined.drop("gone").schema).toDF(*names)


SQL = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
e AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM l),
w AS (SELECT doc_id, i, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS w FROM e WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM w WHERE w IS NOT NULL AND trim(w, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM f, (SELECT unnest([0, 1, 2]) AS k) WHERE r > 1),
k AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.i) FILTER (WHERE c.i IS NULL) AS text, count(*) AS lines_in, count(c.i) AS lines_removed
      FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.i = c.i GROUP BY e.doc_id)
SELECT l.doc_id, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(k.lines_in, 0)::INT AS lines_in, coalesce(k.lines_removed, 0)::INT AS lines_removed
FROM l LEFT JOIN k ON l.doc_id = k.doc_id
"""
