"""Chunking: windows, table splits and greedy packing of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.text import collapse, is_blank, strip, token_length


def window_starts(length: Column, size: int, overlap: int) -> Column:
    """Where windows begin; the first that reaches the end is the last."""
    step = max(1, size - overlap)
    count = F.when(length > size, F.ceil((length - size) / step).cast("int")).otherwise(0)
    return F.when(length > 0, F.transform(F.sequence(F.lit(0), count), lambda i: i * step)).otherwise(F.array().cast("array<int>"))


def char_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of so many tokens, at four characters each, over collapsed text; outer white space goes from each.

    The text is cut once into pieces of a step each, and a window is put together from the pieces it
    spans: looking for every window's start from the beginning would take quadratic time.
    """
    width, step = size * 4, max(1, size * 4 - overlap * 4)
    span = -(-width // step)

    def cut(plain: Column, pieces: Column) -> Column:
        count = F.size(window_starts(F.length(plain), width, overlap * 4))
        at = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: strip(F.substring(F.array_join(F.slice(pieces, i, F.lit(span)), ""), 1, width)))

    # each is bound once by a transform over one element; inside the lambda it would be made anew for every window
    once = F.transform(F.array(collapse(text)), lambda p: F.struct(p.alias("plain"), F.regexp_extract_all(p, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)).alias("pieces")))
    windows = F.flatten(F.transform(once, lambda o: cut(o["plain"], o["pieces"])))
    return F.filter(windows, lambda w: F.length(w) > 0)


def token_windows(ids: Column, size: int, overlap: int) -> Column:
    """Windows of so many tokens over an array of tokens; the first that reaches the end is the last."""
    return F.transform(window_starts(F.size(ids), size, overlap), lambda s: F.slice(ids, s + 1, F.lit(size)))


def split_table(markdown: Column, size: int) -> Column:
    """A table in pieces of whole rows, each with the header and its rule; a row that is too long stands alone."""
    lines = F.filter(F.split(markdown, "\n"), lambda x: x != "")
    head = F.concat(F.element_at(lines, 1), F.lit("\n"), F.element_at(lines, 2))
    whole = lambda part: F.concat(head, F.lit("\n"), part)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def add(state: Column, row: Column) -> Column:
        more = F.concat_ws("\n", state["open"], row)
        fits = state["open"].isNull() | (token_length(whole(more)) <= size)
        return F.struct(
            F.when(fits, state["done"]).otherwise(F.concat(state["done"], F.array(whole(state["open"])))).alias("done"),
            F.when(fits, more).otherwise(row).alias("open"),
        )

    pieces = F.aggregate(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), start, add, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(whole(s["open"])))))
    return F.when(F.size(lines) < 3, F.array(markdown)).otherwise(pieces)


def units(blocks: DataFrame, size: int, overlap: int, tokenizer: str | None = None) -> DataFrame:
    """Blocks cut to the budget: long prose into windows, long tables by rows, figures never; column part orders the cuts.

    With a tokenizer file prose is measured and cut in its tokens, else in estimated ones.
    """
    measured = blocks.where(~is_blank(F.col("text"))).withColumn("text", strip(F.col("text")))
    rest = [c for c in blocks.columns if c != "text"]
    if tokenizer is None:
        measured = measured.withColumn("_n", token_length(F.col("text")))
        windows = char_windows(F.col("text"), size, overlap)
    else:
        measured = measured.withColumn("_ids", tokens.encode(F.col("text"), tokenizer)).withColumn("_n", F.size("_ids"))
        windows = None
    over = F.col("_n") > size
    rows = F.when(over & (F.col("type") == "table"), split_table(F.col("text"), size)).otherwise(F.array("text"))
    if windows is not None:
        return measured.select(*rest, F.posexplode(F.when(over & (F.col("type") == "prose"), windows).otherwise(rows)).alias("part", "text"))
    long = over & (F.col("type") == "prose")
    whole = measured.where(~long).select(*rest, F.posexplode(rows).alias("part", "text"))
    cut = measured.where(long).select(*rest, F.posexplode(token_windows(F.col("_ids"), size, overlap)).alias("part", "_w"))
    return whole.unionByName(cut.withColumn("text", strip(tokens.decode(F.col("_w"), tokenizer))).where(~is_blank(F.col("text"))).select(*rest, "part", "text"))


def pack(ordered: Column, size: int) -> Column:
    """Greedy packing of an ordered array of units (tokens, atomic, ...) into an array of arrays.

    A unit opens a new pack if the budget would be passed or it is atomic; an atomic one is alone.
    """
    unit = ordered  # array<struct>
    none = F.slice(unit, 1, 0)
    start = F.struct(F.slice(F.array(none), 1, 0).alias("done"), none.alias("open"), F.lit(0).cast("bigint").alias("held"))

    def add(s: Column, u: Column) -> Column:
        flush = (F.size(s["open"]) > 0) & ((s["held"] + u["tokens"] > size) | u["atomic"])
        done = F.when(flush, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"])
        now = F.when(flush, F.array(u)).otherwise(F.concat(s["open"], F.array(u)))
        held = F.when(flush, u["tokens"].cast("bigint")).otherwise(s["held"] + u["tokens"])
        return F.struct(
            F.when(u["atomic"], F.concat(done, F.array(now))).otherwise(done).alias("done"),
            F.when(u["atomic"], none).otherwise(now).alias("open"),
            F.when(u["atomic"], F.lit(0).cast("bigint")).otherwise(held).alias("held"),
        )

    return F.aggregate(unit, start, add, lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def chunks(df: DataFrame, doc: str, size: int) -> DataFrame:
    """Chunks from units (doc, block_index, part, type, text, section, page, table_id, figure_uri).

    The first section that isn't empty heads the text; page is the first unit's; a type of its own only if all units
    share it; table and figure references only where the unit is alone.
    """
    atomic = F.col("type").isin("table", "figure")
    unit = F.struct("block_index", "part", "type", "text", "section", "page", "table_id", "figure_uri", token_length(F.col("text")).alias("tokens"), atomic.alias("atomic"))
    packed = df.groupBy(doc).agg(F.array_sort(F.collect_list(unit)).alias("us")).select(doc, F.posexplode(pack(F.col("us"), size)).alias("chunk_index", "us"))
    body = F.array_join(F.transform("us", lambda u: u["text"]), "\n\n")
    section = F.try_element_at(F.filter(F.transform("us", lambda u: u["section"]), lambda s: F.coalesce(s, F.lit("")) != ""), F.lit(1))
    kinds = F.array_distinct(F.transform("us", lambda u: u["type"]))
    alone = F.size("us") == 1
    return packed.select(
        doc, "chunk_index",
        F.when(section.isNotNull(), F.concat(F.lit("## "), section, F.lit("\n\n"), body)).otherwise(body).alias("text"),
        F.when(F.size(kinds) == 1, kinds[0]).otherwise("mixed").alias("block_type"),
        section.alias("section"), F.col("us")[0]["page"].alias("page"),
        F.when(alone & (kinds[0] == "table"), F.col("us")[0]["table_id"]).alias("table_id"), F.when(alone & (kinds[0] == "figure"), F.col("us")[0]["figure_uri"]).alias("figure_uri"),
        F.size("us").alias("n_units"),
    ).withColumn("char_count", F.length("text"))
