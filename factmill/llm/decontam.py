"""Benchmark decontamination by pigeonhole edit matching.

With an error budget of k edits, an item cut into k + 1 pieces leaves at least one piece untouched
in any copy within the budget. All pieces of a block of items are looked for at once by an
Aho-Corasick automaton; around each hit, Myers' bit-parallel distance decides.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, bound_batches, slices, tidy
from .myers import best_end, masks

#: Edits allowed for each character of a normalised item.
ERROR_RATE = 0.06
#: Normalised characters of the items that one pass over the documents looks for.
BLOCK_CHARS = 1_000_000

_WORD = re.compile(r"\w+")
_built: dict = {}


def normalise(text: str | None) -> str:
    """Lower-cased words (letters, digits, underscores) joined by single spaces."""
    return " ".join(_WORD.findall((text or "").lower()))


def budget(item: str, rate: float) -> int:
    return int(len(item) * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces, as even as can be, with where they begin."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


class Matcher:
    """Finds items [(item_id, normalised text)] in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, budget(t, rate), masks(t)) for i, t in items if t]
        at: dict[str, list[tuple[int, int]]] = {}
        for j, (_, t, k, _) in enumerate(self.items):
            for a, piece in pieces(t, k):
                at.setdefault(piece, []).append((j, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, budget, end) of each item within its budget of a part of text.

        An item without a budget has to stand between word bounds.
        """
        if not self.items or not text:
            return []
        found: dict[int, tuple[int, int]] = {}
        tried = set()
        for end, (length, places) in self.automaton.iter(text):
            for j, a in places:
                if j in found:
                    continue
                start = end + 1 - length - a
                if (j, start) in tried:
                    continue
                tried.add((j, start))
                _, item, k, peq = self.items[j]
                n = len(item)
                if start >= 0 and text.startswith(item, start):
                    if k or (text[start - 1 : start] in ("", " ") and text[start + n : start + n + 1] in ("", " ")):
                        found[j] = (0, start + n)
                    continue
                if k:
                    low = max(0, start - k)
                    distance, at = best_end(peq, n, text[low : max(0, start) + n + k])
                    if distance <= k:
                        found[j] = (distance, low + at)
        return [(self.items[j][0], d, self.items[j][2], e) for j, (d, e) in sorted(found.items())]


def _matcher(shared, rate: float, name: str) -> Matcher:
    """The automaton of a block of items, by the block's name: a worker may see several."""
    if name not in _built:
        _built.clear()
        _built[name] = Matcher(shared.value, rate)
    return _built[name]


def forget() -> None:
    """Drop the automata: a worker lives on for other stages."""
    _built.clear()


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", chars: int = BLOCK_CHARS):
    """Normalised items in lists of bounded size, read partition by partition; the whole set never lies on the driver at once."""
    block, held = [], 0
    for r in items.select(F.col(id_col).cast("bigint"), F.col(text_col)).toLocalIterator():
        text = normalise(r[1])
        if text:
            block.append((r[0], text))
            held += len(text)
        if held >= chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, budget, match_end): items found in documents within rate edits a character.

    Both sides are normalised to lower-cased words, so case, punctuation and line breaks don't
    count. Null and empty texts on either side match nothing; repeated rows on either side are each
    reported; match_end counts characters of the normalised document. An item is reported once for
    a document, at the first place that was verified. Very large item sets take several passes.
    """
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, distance int, budget int, match_end int"
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], schema)
    for n, block in enumerate(item_blocks(items, item_id_col, item_text_col, block_chars)):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, shared=shared, name=name):
            for batch in batches:
                for part in slices(batch, "text"):
                    rows = [(d, *m) for d, t in zip(part.column("doc_id").to_pylist(), as_text(part.column("text"))) for m in _matcher(shared, rate, name).find(normalise(t))]
                    cols = list(zip(*rows)) or [[]] * 5
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "distance", "budget", "match_end"])

        found = narrow.mapInArrow(tidy(run), schema)
        out = found if n == 0 else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, all columns, that match no item; the same rules as matches()."""
    bound_batches(docs.sparkSession)
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, shared=shared, name=name):
            for batch in batches:
                keep = [not _matcher(shared, rate, name).find(normalise(t)) for t in as_text(batch.column(at))]
                yield batch.filter(pa.array(keep, pa.bool_()))
            forget()

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs
