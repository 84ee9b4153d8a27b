"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can't be merged over, so every such pair
in a text is a certain cut. What lies between two cuts is encoded by itself, and the ids of the
fragments are concatenated. Words and fragments recur, so both are kept in bounded caches.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, bound_batches, slices, tidy

#: Entries of a worker's caches; a full cache is emptied, which costs time only.
CACHE_ENTRIES = 100_000

_loaded: dict = {}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Counts(dict):
    """The number of ids of each word that a worker has met; emptied when full."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, word: str) -> int:
        letters = "".join(map(self.codec.letters.__getitem__, word.encode()))
        ids, _ = self.codec._pieces(self.codec.cut(letters))
        if len(self) >= 2 * CACHE_ENTRIES:
            self.clear()
        self[word] = n = ids.count(" ") + 1 if ids else 0
        return n


class Codec:
    """Encodes and decodes as the vocabulary file says: NFC, lower case, words, bytes as letters, merges, a word-end mark."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.last = Tokenizer.from_file(path).model
        inner = {"version": spec["version"], "added_tokens": [], "model": spec["model"] | {"end_of_word_suffix": None}}
        self.inner = Tokenizer.from_str(json.dumps(inner)).model if self.end else self.last
        del inner, spec["model"]
        kinds = {n["type"] for n in spec["normalizer"]["normalizers"]}
        if kinds != {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"not a word vocabulary: {sorted(kinds)}")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # \s as Unicode's White_Space property, which the library's engine takes
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"), regex.V0)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {s: (str(i), s) for s, i in special.items()}
        self.mark = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.letters = byte_letters()
        self.inside, self.closing = self._pairs()
        self.names = {str(i): t for t, i in self.vocab.items()} | {i: s for i, s in self.special.values()}
        del self.vocab
        self.ids: dict[str, str] = {}
        self.forms: dict[str, str] = {}
        self.fragments: dict[tuple[str, bool], tuple[str, str]] = {}
        self.counts = _Counts(self)

    def _pairs(self) -> tuple[set[str], set[str]]:
        """Letter pairs inside tokens; pairs that end a token with the word-end mark."""
        inside, closing = set(), set()
        for token in self.vocab:
            closed = bool(self.end) and token.endswith(self.end) and token != self.end
            body = token[: -len(self.end)] if closed else token
            pairs = [body[i : i + 2] for i in range(len(body) - 1)]
            if closed and pairs:
                closing.add(pairs.pop())
            inside.update(pairs)
        return inside, closing

    def cut(self, letters: str) -> list[str]:
        """The fragments of a word between its forced boundaries."""
        out, start, last = [], 0, len(letters) - 2
        for i in range(len(letters) - 1):
            if letters[i : i + 2] not in (self.closing if i == last else self.inside):
                out.append(letters[start : i + 1])
                start = i + 1
        out.append(letters[start:])
        return out

    def _word(self, word: str) -> None:
        letters = "".join(map(self.letters.__getitem__, word.encode()))
        parts = self.cut(letters)
        self.ids[word], self.forms[word] = self._pieces(parts)

    def _pieces(self, parts: list[str]) -> tuple[str, str]:
        """Ids and tokens of a word's fragments, each encoded by itself; only what is part of a longer word is kept."""
        ids, forms = [], []
        for i, part in enumerate(parts):
            closes = i == len(parts) - 1
            known = self.fragments.get((part, closes))
            if known is None:
                tokens = (self.last if closes else self.inner).tokenize(part)
                known = (" ".join([str(t.id) for t in tokens]), " ".join([t.value for t in tokens]))
                if len(parts) > 1:
                    if len(self.fragments) >= CACHE_ENTRIES:
                        self.fragments.clear()
                    self.fragments[(part, closes)] = known
            ids.append(known[0])
            forms.append(known[1])
        return " ".join(ids), " ".join(forms)

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids joined by spaces, their decoded text). Without a decoder, decoding joins the tokens by spaces."""
        if self.mark and "<|" in text:
            ids, forms = [], []
            for piece in self.mark.split(text):
                a, b = self.special.get(piece) or self._plain(piece)
                if a:
                    ids.append(a)
                    forms.append(b)
            return " ".join(ids), " ".join(forms)
        return self._plain(text)

    def _split(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # letters are lowered one by one, so a final sigma is not special
            text = text.replace("Σ", "σ")
        return self.words.findall(text.lower())

    def _plain(self, text: str) -> tuple[str, str]:
        found = self._split(text)
        if len(self.ids) >= CACHE_ENTRIES:
            self.ids.clear()
            self.forms.clear()
        known = self.ids
        for w in set(found).difference(known):
            self._word(w)
        return " ".join([known[w] for w in found]), " ".join([self.forms[w] for w in found])

    def count(self, text: str) -> int:
        """How many ids a text has; each word is encoded once."""
        if self.mark and "<|" in text:
            return sum(1 if piece in self.special else self._count(piece) for piece in self.mark.split(text))
        return self._count(text)

    def _count(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self._split(text)))

    def decode(self, ids: str) -> str:
        """The decoded text of decimal ids joined by spaces."""
        return " ".join([self.names[i] for i in ids.split()])


def codec(path: str) -> Codec:
    """One codec for each worker and vocabulary."""
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def forget() -> None:
    """Drop the codecs: a worker lives on for other stages."""
    _loaded.clear()


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, keep_decoded: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and if kept ids (array<int>) and decoded.

    The digests are of the decimal ids joined by single spaces and of the decoded text. Null counts
    as empty: no ids, empty text. Strings of special tokens inside a text become their tokens, as
    the library's default has it. Repeated rows are kept; an empty table gives an empty result;
    other columns are ignored. path must be readable where the work runs.
    """
    bound_batches(docs.sparkSession)
    path = path or word_vocabulary()
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "") + (", decoded string" if keep_decoded else "")

    def run(batches):
        c = codec(path)
        try:
            for batch in batches:
                for part in slices(batch, "text", 1 << 20):
                    counts, a, b, all_ids, texts = [], [], [], [np.zeros(0, np.int32)], []
                    for text in as_text(part.column("text")):
                        ids, form = c.encode(text)
                        counts.append(ids.count(" ") + 1 if ids else 0)
                        a.append(hashlib.sha256(ids.encode()).hexdigest())
                        b.append(hashlib.sha256(form.encode()).hexdigest())
                        if keep_ids:
                            all_ids.append(np.fromstring(ids, np.int32, sep=" ") if ids else np.zeros(0, np.int32))
                        if keep_decoded:
                            texts.append(form)
                    cols = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                    if keep_ids:
                        offsets = pa.array(np.cumsum([len(i) for i in all_ids]), pa.int32())
                        cols += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(all_ids)))]
                        names.append("ids")
                    if keep_decoded:
                        cols.append(pa.array(texts, pa.string()))
                        names.append("decoded")
                    yield pa.RecordBatch.from_arrays(cols, names)
        finally:
            forget()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)
