"""Layout: from paragraphs, tables, figures and words with spans to ordered blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, is_blank, strip

NOISE = ("pageHeader", "pageFooter", "pageNumber")
HEADINGS = ("title", "sectionHeading")
FAR = 2**62  # where elements without a span are put


def span_start(spans: Column) -> Column:
    return F.coalesce(F.array_min(F.transform(spans, lambda s: s["offset"])), F.lit(FAR))


def span_end(spans: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(spans, lambda s: s["offset"] + s["length"])), F.lit(FAR))


def area_fraction(polygon: Column, width: Column, height: Column) -> Column:
    """A figure's bounding box as a share of its page; null without three points or with an empty area."""
    xs = F.filter(polygon, lambda v, i: i % 2 == 0)
    ys = F.filter(polygon, lambda v, i: i % 2 == 1)
    box = (F.array_max(xs) - F.array_min(xs)) * (F.array_max(ys) - F.array_min(ys))
    page = width * height
    return F.when((F.size(polygon) >= 6) & (box > 0) & (page > 0), box / page)


#: What a layout service says of a document: text, and elements by their spans in it.
_SPANS = "array<struct<offset:bigint,length:bigint>>"
_REGIONS = "array<struct<page:int,polygon:array<double>>>"
RESULT = (
    f"content string, paragraphs array<struct<role:string,content:string,regions:{_REGIONS},spans:{_SPANS}>>, "
    f"tables array<struct<row_count:int,column_count:int,regions:{_REGIONS},spans:{_SPANS},cells:array<struct<row:int,col:int,row_span:int,col_span:int,kind:string,text:string>>>>, "
    f"figures array<struct<id:string,caption:string,ocr:string,regions:{_REGIONS},spans:{_SPANS}>>, "
    "pages array<struct<width:double,height:double,words:array<struct<offset:bigint,length:bigint,confidence:double>>>>"
)


def first_page(regions: Column) -> Column:
    """The page of an element's first region; null without any."""
    return F.get(regions, F.lit(0))["page"]


def word_confidences(results: DataFrame, doc: str) -> DataFrame:
    """(doc, at, end, conf) of the words that have a place and a confidence, from results (doc, result)."""
    pages = results.select(doc, F.explode("result.pages").alias("p"))
    words = pages.select(doc, F.explode("p.words").alias("w")).where("w.confidence is not null and w.offset is not null")
    return words.select(doc, F.col("w.offset").alias("at"), (F.col("w.offset") + F.coalesce("w.length", F.lit(0))).alias("end"), F.col("w.confidence").alias("conf"))


def figure_text(figure: Column, described: Column, most: int) -> Column:
    """A figure's block: its caption, what a model says of it (if any) and the text read in it, without repeats."""
    words = caption(F.array(figure["caption"], described, figure["ocr"]), F.lit("no caption"), most)
    return F.concat(F.lit("[FIGURE p."), F.coalesce(first_page(figure["regions"]).cast("string"), F.lit("None")), F.lit(" — "), words, F.lit("]"))


def build(results: DataFrame, doc: str, least_fraction: float = 0.02, most_caption: int = 2000, uri_prefix: Column | None = None, described: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(blocks, tables) in reading order from results (doc, result as RESULT has it).

    Paragraphs that start inside a table or figure, page furniture, empty tables and figures that
    take less than least_fraction of their page go. described (doc, figure_id, words) holds what a
    model says of figures; those with an image (an id) lie under uri_prefix.
    """
    span = F.named_struct(F.lit("start"), span_start(F.col("e.spans")), F.lit("end"), span_end(F.col("e.spans")))
    placed = lambda df: df.withColumn("at", span).withColumns({"start": F.col("at.start"), "end": F.col("at.end")})
    none = F.lit(None).cast("string")
    paragraphs = placed(results.select(doc, F.posexplode("result.paragraphs").alias("idx", "e")).withColumn("role", F.col("e.role")))
    covered = results.select(doc, F.explode(F.concat(F.coalesce(F.transform("result.tables", lambda t: t["spans"]), F.array()), F.coalesce(F.transform("result.figures", lambda f: f["spans"]), F.array()))).alias("s")).where(F.size("s") > 0)
    prose = drop_covered(drop_noise(paragraphs), covered.select(doc, span_start(F.col("s")).alias("lo"), span_end(F.col("s")).alias("hi")), doc)
    prose = prose.select(doc, F.lit("prose").alias("kind"), "role", "start", "end", "idx", first_page(F.col("e.regions")).alias("page"), strip(F.col("e.content")).alias("text"), none.alias("table_id"), none.alias("figure_uri"))

    tables = placed(results.select(doc, F.posexplode("result.tables").alias("table_index", "e")))
    cells = tables.select(doc, "table_index", F.coalesce("e.row_count", F.lit(0)).alias("n_rows"), F.coalesce("e.column_count", F.lit(0)).alias("n_cols"), F.posexplode_outer("e.cells").alias("seq", "c")).select(doc, "table_index", "n_rows", "n_cols", "seq", "c.*")
    key = [doc, "table_index"]
    written = table_markdown(cells, key).join(table_cells(cells.where("row is not null"), key), key, "left")
    whole = tables.join(written, key).withColumn("table_id", F.concat(F.lit("t"), F.col("table_index").cast("string")))
    listed = whole.select(doc, "table_id", "table_index", first_page(F.col("e.regions")).alias("page"), F.coalesce("e.row_count", F.lit(0)).alias("n_rows"), F.coalesce("e.column_count", F.lit(0)).alias("n_cols"), "markdown", F.coalesce("cells_json", F.lit("[]")).alias("cells_json"))
    as_tables = whole.select(doc, F.lit("table").alias("kind"), none.alias("role"), "start", "end", F.col("table_index").alias("idx"), first_page(F.col("e.regions")).alias("page"), F.col("markdown").alias("text"), "table_id", none.alias("figure_uri"))

    figures = placed(results.select(doc, F.col("result.pages").alias("pages"), F.posexplode("result.figures").alias("idx", "e"))).withColumn("page", first_page(F.col("e.regions")))
    on = F.get("pages", F.col("page") - 1)
    figures = drop_decorative(figures.withColumn("fraction", F.when(F.col("page") > 0, area_fraction(F.get("e.regions", F.lit(0))["polygon"], on["width"], on["height"]))), least_fraction)
    if described is not None:
        figures = figures.withColumn("figure_id", F.col("e.id")).join(described.select(doc, "figure_id", "words"), [doc, "figure_id"], "left")
    else:
        figures = figures.withColumn("words", none)
    uri = figure_uri(F.when(F.col("e.id").isNotNull(), uri_prefix) if uri_prefix is not None else none, F.col("page"), F.col("idx"))
    as_figures = figures.select(doc, F.lit("figure").alias("kind"), none.alias("role"), "start", "end", "idx", "page", figure_text(F.col("e"), F.col("words"), most_caption).alias("text"), none.alias("table_id"), uri.alias("figure_uri"))

    ordered = blocks(prose.unionByName(as_tables).unionByName(as_figures), doc)
    sure = span_confidence(ordered.select(doc, "block_index", "start", "end"), word_confidences(results, doc), doc).drop("start", "end")
    return ordered.join(sure, [doc, "block_index"], "left").withColumnRenamed("kind", "type").drop("role", "start", "end", "idx"), listed


def span_confidence(blocks: DataFrame, words: DataFrame, doc: str) -> DataFrame:
    """blocks (doc, start, end) with conf_min and conf_mean of the words that start inside; null without any.

    An interval join keyed on the document, so that only its own words are looked at.
    """
    w = words.where("conf is not null and at is not null").select(F.col(doc), F.col("at"), F.col("conf"))
    joined = blocks.alias("b").join(w.alias("w"), (F.col(f"b.{doc}") == F.col(f"w.{doc}")) & (F.col("w.at") >= F.col("b.start")) & (F.col("w.at") < F.col("b.end")), "left")
    keys = [F.col(f"b.{c}") for c in blocks.columns]
    return joined.groupBy(*keys).agg(F.min("w.conf").alias("conf_min"), F.avg("w.conf").alias("conf_mean"))


def document_quality(words: DataFrame, doc: str, high: float = 0.9, least: float = 0.6) -> DataFrame:
    """(doc, di_quality, di_quality_flag): the share of words read with high confidence; low if it is under least."""
    share = F.avg((F.col("conf") >= high).cast("int"))
    return words.where("conf is not null").groupBy(doc).agg(share.alias("di_quality")).withColumn("di_quality_flag", F.when(F.col("di_quality") < least, "low").otherwise("ok"))


def pages_quality(pages: Column, high: float = 0.9, least: float = 0.6) -> tuple[Column, Column]:
    """document_quality() of one document's pages, as columns of its own row."""
    words = F.flatten(F.filter(F.transform(pages, lambda p: p["words"]), lambda w: w.isNotNull()))
    sure = F.transform(F.filter(words, lambda w: w["confidence"].isNotNull() & w["offset"].isNotNull()), lambda w: w["confidence"])
    share = F.when(F.size(sure) > 0, F.size(F.filter(sure, lambda c: c >= high)) / F.size(sure))
    return share, F.when(share < least, "low").when(share.isNotNull(), "ok")


def cell_text(text: Column) -> Column:
    return F.trim(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|")))


def table_markdown(cells: DataFrame, table: list[str]) -> DataFrame:
    """(table, markdown) from cells (table, n_rows, n_cols, row, col, seq, text).

    The grid is dense; cells outside it are left out, and of cells in one place the last by seq
    counts. Tables without rows or columns give an empty string.
    """
    inside = cells.where((F.col("row") >= 0) & (F.col("row") < F.col("n_rows")) & (F.col("col") >= 0) & (F.col("col") < F.col("n_cols")))
    placed = inside.groupBy(*table, "row", "col").agg(F.max_by(cell_text(F.col("text")), F.col("seq")).alias("text"), F.max("n_cols").alias("n_cols"))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    # a row at a time: looking cells up in a map of the whole grid would take the square of its size
    rows = placed.groupBy(*table, "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("at"), F.max("n_cols").alias("n_cols"))
    rows = rows.select(*table, "row", line(F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda c: F.coalesce(F.try_element_at("at", c), F.lit("")))).alias("line"))
    grid = rows.groupBy(*table).agg(F.map_from_entries(F.collect_list(F.struct("row", "line"))).alias("at"))
    shape = cells.groupBy(*table).agg(F.max("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"))
    joined = shape.join(grid, table, "left")
    empty = line(F.array_repeat(F.lit(""), F.col("n_cols")))
    body = F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), lambda r: F.coalesce(F.try_element_at("at", r), empty))
    lines = joined.withColumn("body", F.when((F.col("n_rows") > 0) & (F.col("n_cols") > 0), body))
    rule = line(F.array_repeat(F.lit("---"), F.col("n_cols")))
    whole = F.array_join(F.concat(F.slice("body", 1, 1), F.array(rule), F.slice("body", F.lit(2), F.greatest(F.col("n_rows"), F.lit(1)))), "\n")
    return lines.select(*table, F.coalesce(F.when(F.col("body").isNotNull(), whole), F.lit("")).alias("markdown"))


def table_cells(cells: DataFrame, table: list[str]) -> DataFrame:
    """(table, cells_json) with row, col, spans of one at least, kind and text, in reading order."""
    cell = F.struct("row", "col", F.greatest(F.coalesce("row_span", F.lit(1)), F.lit(1)).alias("row_span"), F.greatest(F.coalesce("col_span", F.lit(1)), F.lit(1)).alias("col_span"), F.coalesce("kind", F.lit("content")).alias("kind"), cell_text(F.col("text")).alias("text"))
    return cells.groupBy(*table).agg(F.to_json(F.array_sort(F.collect_list(cell))).alias("cells_json"))


def caption(pieces: Column, fallback: Column, most: int) -> Column:
    """Pieces in order less those that hold, or are held in, an earlier one; joined by a dash and cut at most."""
    clean = F.filter(F.transform(pieces, collapse), lambda p: F.length(p) > 0)
    kept = F.aggregate(clean, F.array().cast("array<string>"), lambda out, p: F.when(F.exists(out, lambda o: F.contains(o, p) | F.contains(p, o)), out).otherwise(F.concat(out, F.array(p))))
    return F.substring(F.when(F.size(kept) > 0, F.array_join(kept, " — ")).otherwise(fallback), 1, most)


def drop_covered(paragraphs: DataFrame, ranges: DataFrame, doc: str) -> DataFrame:
    """Paragraphs that don't start inside a table or figure [lo, hi) of their document."""
    cond = (F.col(f"p.{doc}") == F.col(f"r.{doc}")) & (F.col("p.start") >= F.col("r.lo")) & (F.col("p.start") < F.col("r.hi"))
    return paragraphs.alias("p").join(ranges.alias("r"), cond, "left_anti")


def drop_noise(paragraphs: DataFrame) -> DataFrame:
    return paragraphs.where(F.col("role").isNull() | ~F.col("role").isin(*NOISE))


def drop_decorative(figures: DataFrame, least: float) -> DataFrame:
    return figures.where(F.col("fraction").isNull() | (F.col("fraction") >= least))


def figure_uri(prefix: Column, page: Column, index: Column) -> Column:
    return F.when(prefix.isNotNull(), F.format_string("%s/p%s_f%s.png", prefix, page, index)).otherwise(F.format_string("page=%s&figure=%s", page, index))


def blocks(elements: DataFrame, doc: str) -> DataFrame:
    """Blocks in reading order from elements (doc, kind, role, start, idx, page, text, ...).

    kind is prose, table or figure; elements sort by where they start, then prose before table
    before figure, then as they came. Blank ones go. Headings open a section that holds until the
    next one. block_index counts from 0; char_count is the text's length.
    """
    kind = F.when(F.col("kind") == "prose", 0).when(F.col("kind") == "table", 1).otherwise(2)
    order = Window.partitionBy(doc).orderBy("start", kind, "idx")
    heading = F.when(F.col("role").isin(*HEADINGS), F.col("text"))
    return elements.where(~is_blank(F.col("text"))).withColumns(
        {
            "section": F.last(heading, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "block_index": F.row_number().over(order) - 1,
            "char_count": F.length("text"),
        }
    )


def blocks_to_text(df: DataFrame, doc: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("block_index", "text")))
    return df.where(~is_blank(F.col("text"))).groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n").alias("text"))
