"""Evidence: where a quote is, how well its block was read, and the row that says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import trust as R
from ..functions.fuzzy import ratio
from ..sources.files import bound_batches


#: Bytes of short quotes that are broadcast at a time.
BLOCK_BYTES = 4 << 20


def locate(df: DataFrame, threshold: float = 0.85, autojunk: bool = True) -> DataFrame:
    """df (value, quote, text) with match_type: na_null, exact, normalized, fuzzy or not_found.

    The tiers are columns; only rows that need the fuzzy comparison go through Python, in a branch
    of their own.
    """
    bound_batches(df.sparkSession)
    tier = F.when(F.col("value").isNull(), "na_null").otherwise(T.locate(F.col("quote"), F.col("text")))
    staged = df.withColumn("match_type", tier)
    window = T.fuzzy_window(T.normalize(F.col("quote")), T.normalize(F.col("text")))
    rest = staged.where("match_type is null").withColumn("_r", ratio(T.normalize(F.col("quote")), window, autojunk))
    fuzzy = rest.withColumn("match_type", F.when(F.col("_r") >= threshold, "fuzzy").otherwise("not_found")).drop("_r")
    return staged.where("match_type is not null").unionByName(fuzzy)


def containing(texts: DataFrame, quotes: DataFrame, doc: str, quote: str, text: str = "t", needle: str = "q") -> DataFrame:
    """Pairs of texts (doc, t ...) and quotes (quote, q ...), both normalised, where t holds q.

    A quote's inner words stand whole in any text that holds it, so the two meet on the inner word
    that the fewest texts hold. Quotes of two words or less have none: they are a stated set that is
    held against all texts, in broadcast blocks of bounded size. Empty quotes meet nothing.
    """
    parts = F.split(needle, " ")
    asked = quotes.where(F.length(needle) > 0).withColumn("_inner", F.array_distinct(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))))
    words = asked.select(F.explode("_inner").alias("_w")).distinct()
    held = texts.select(doc, F.explode(F.array_distinct(F.split(text, " "))).alias("_w")).join(words, "_w", "left_semi")
    counts = held.groupBy("_w").agg(F.count("*").alias("_n"))
    rare = asked.select(quote, F.explode("_inner").alias("_w")).join(counts, "_w", "left").groupBy(quote).agg(F.min_by("_w", F.struct(F.coalesce("_n", F.lit(0)), F.col("_w"))).alias("_w"))
    found = held.join(rare, "_w").select(doc, quote)
    out = texts.join(found, doc).join(quotes, quote).where(F.contains(text, needle))
    few = asked.where(F.size("_inner") == 0).drop("_inner")
    held_bytes = few.agg(F.coalesce(F.sum(F.octet_length(needle) + 64), F.lit(0))).first()[0]
    blocks = -(-held_bytes // BLOCK_BYTES)
    for k in range(blocks):
        block = few.where(F.pmod(F.xxhash64(needle), F.lit(blocks)) == k)
        out = out.unionByName(texts.join(F.broadcast(block), F.contains(text, needle)).select(out.columns))
    return out


def block_confidence(quotes: DataFrame, blocks: DataFrame, doc: str, keys: list[str]) -> DataFrame:
    """quotes (doc, keys, quote) with conf_min and page of the first block, by index, that holds the quote."""
    q = quotes.withColumn("_q", T.normalize(F.col("quote")))
    b = blocks.select(F.col(doc).alias("_d"), "block_index", "conf_min", "page", T.normalize(F.col("text")).alias("_t"))
    hits = q.join(b, (F.col(doc) == F.col("_d")) & (F.length("_q") > 0) & F.contains("_t", "_q")).groupBy(doc, *keys).agg(F.min_by(F.struct("conf_min", "page"), "block_index").alias("_b"))
    return quotes.join(hits, [doc, *keys], "left").select(*quotes.columns, F.col("_b.conf_min").alias("conf_min"), F.col("_b.page").alias("page"))


#: A state of a field on its way, as the audit trail has it.
STEP = "struct<stage:string,verdict:string,rationale:string,value_after:string,evidence_text_after:string,match_type_after:string,source_verified_after:string,trust_after:string,page_after:int>"


def step(stage: str, verdict: Column | None = None, rationale: Column | None = None, trust: Column | None = None) -> Column:
    """The present state of a field as one step of its trail."""
    none = F.lit(None).cast("string")
    state = [F.lit(stage), none if verdict is None else verdict, none if rationale is None else rationale, "value", "evidence_text", "match_type", "source_verified", F.col("trust") if trust is None else trust, "evidence_page"]
    return F.struct(*state).cast(STEP)


def retrusted(df: DataFrame, judged: bool) -> DataFrame:
    """df with its trust derived again from the columns it has now."""
    c = F.col
    return df.withColumn("trust", R.trust(c("value"), c("match_type"), c("judge_verdict"), c("judge_error").isNotNull(), F.lit(judged), c("type_validation"), c("source_verified")))


def finalize(df: DataFrame, judged: bool = True, longest: int = 600, threshold: float = 0.7) -> DataFrame:
    """Evidence rows from (value, quote, match_type, judge_verdict, judge_rationale, judge_error, type_validation, evidence_confidence, evidence_page, document_flag, extraction_strategy).

    Adds source_verified and trust, evidence_text (the quote, cut last) and steps: what it was like
    when extracted, its trust without a judge, and after the judge.
    """
    source = R.source_verified(F.col("document_flag"), F.col("evidence_confidence"), threshold)
    placed = df.withColumns({"source_verified": source, "evidence_text": F.substring("quote", 1, longest)})
    rated = retrusted(placed, judged)
    none = F.lit(None).cast("string")
    alone = R.trust(F.col("value"), F.col("match_type"), none, F.lit(False), F.lit(False), F.col("type_validation"), F.col("source_verified"))
    how = F.concat(F.lit("extracted via "), F.coalesce("extraction_strategy", F.lit("default")))
    return rated.withColumn("steps", F.array(step("extract", None, how, alone), step("judge", F.col("judge_verdict"), F.col("judge_rationale"))))


def to_escalate(df: DataFrame, doc: str, position: str, most: int | None, conf: str = "conf_min") -> DataFrame:
    """Rows that need a look at the page, the least certain first; at most so many for each document (negative or None: all)."""
    gate = df.where(R.escalates(F.col("match_type"), F.col("trust"), F.col(conf), F.col("document_flag")))
    order = Window.partitionBy(doc).orderBy(*R.uncertainty(F.col("match_type"), F.col("trust"), F.col(conf)), position)
    ranked = gate.withColumn("rank", F.row_number().over(order))
    return ranked if most is None or most < 0 else ranked.where(F.col("rank") <= most)
