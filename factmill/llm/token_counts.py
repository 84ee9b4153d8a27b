"""Token counts through a digest cache.

A text's normalised digest and the digest of the tokenizer file name a stored count. Only distinct
texts without one are encoded; their counts are appended to the cache, a Parquet table in shared
storage, and every document takes its count from there.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Codec
from .common import as_bytes, bound_batches, cut, slices, tidy

_loaded: dict = {}


def ignores_outer_space(path: str) -> bool:
    """Whether the tokenizer file itself says that white space outside of a text makes no token: it splits by words and takes what is between them out."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    normal = {n["type"]: n for n in (spec.get("normalizer") or {}).get("normalizers", [])}
    collapses = normal.get("Replace", {}).get("pattern", {}).get("Regex") == r"\s+" and normal["Replace"].get("content") == " "
    return collapses and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))


def normalised(text: bytes, strip: bool) -> bytes:
    """What a text is known by: its exact bytes, less outer ASCII white space where the tokenizer makes nothing of it."""
    return text.strip() if strip else text


def digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def tokenizer_digest(path: str) -> bytes:
    with open(path, "rb") as f:
        return hashlib.blake2b(f.read(), digest_size=16).digest()


class _Counter:
    """Counts the tokens of texts as the library for the file does; for vocabularies of words by forced boundaries, word by word, which takes half the time."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            if ignores_outer_space(path):
                count = Codec(path).count
                self.count = lambda texts: list(map(count, texts))
                return
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.count = lambda texts: [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            p = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda texts: [len(ids) for ids in p.encode(texts, num_threads=1)]


def _counter(path: str) -> _Counter:
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark
        _loaded[path] = _Counter(path)
    return _loaded[path]


def _digests(strip: bool):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                raw = as_bytes(part.column("text"))
                found = [digest(normalised(b, strip)) for b in raw]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary()), pa.array([len(b) for b in raw], pa.int64())], ["doc_id", "digest", "n_bytes"])

    return run


def _contents(strip: bool):
    def run(batches):
        seen = set()  # of this task: a hot text leaves it once
        for batch in batches:
            for part in slices(batch, "text"):
                out = {}
                for b in as_bytes(part.column("text")):
                    b = normalised(b, strip)
                    d = digest(b)
                    if d not in seen:
                        seen.add(d)
                        out[d] = b
                yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.binary()), pa.array([v.decode() for v in out.values()], pa.string())], ["digest", "text"])

    return run


def _encoded(path: str, version: bytes):
    def run(batches):
        seen = set()  # equal digests are in one partition
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                fresh = {}
                for d, t in zip(part.column("digest").to_pylist(), as_bytes(part.column("text"))):
                    if d not in seen:
                        seen.add(d)
                        fresh[d] = t.decode()
                counts = _counter(path).count(list(fresh.values()))
                yield pa.RecordBatch.from_arrays([pa.array(fresh.keys(), pa.binary()), pa.array([version] * len(fresh), pa.binary()), pa.array(counts, pa.int64())], ["digest", "tokenizer", "n_tokens"])

    return run


CACHE_SCHEMA = "digest binary, tokenizer binary, n_tokens bigint"


def _cached(spark, cache: str, version: bytes) -> DataFrame | None:
    """The stored counts of this tokenizer version, one for each digest; None where there is no cache yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(cache)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == F.lit(bytearray(version)))
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two jobs may have stored the same text


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Counts are the library's for the file at path (tokenizers for .json, sentencepiece for .model)
    without added begin or end tokens, truncation or padding. Null counts as empty: zero tokens.
    A count is stored under the text's exact bytes (less outer white space only where the tokenizer
    file says that it makes no token) and the digest of the tokenizer file, so tokenizers can share a cache.
    cache is a folder that driver and executors share; it is made if it isn't there and grows by
    the distinct texts that it lacks. Repeated rows are kept; an empty table gives an empty result;
    other columns are ignored. Losing an executor repeats tasks; a cache file appears only whole.
    """
    bound_batches(docs.sparkSession)
    spark, version, strip = docs.sparkSession, tokenizer_digest(path), ignores_outer_space(path)
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    wanted = docs.mapInArrow(tidy(_digests(strip)), "doc_id bigint, digest binary, n_bytes bigint")
    contents = docs.mapInArrow(tidy(_contents(strip)), "digest binary, text string")
    stored = _cached(spark, cache, version)
    if stored is not None:
        contents = contents.join(stored.select("digest"), "digest", "left_anti")
    contents.repartition("digest").mapInArrow(tidy(_encoded(path, version)), CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = cut(_cached(spark, cache, version))  # by itself, so that a hot text's partition of the join can be split
    return wanted.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
