"""Layout of files: text, blocks and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import strip
from ..operators import layout, scd2
from ..sources import providers
from ..sources.snapshots import Store
from .common import KEY, live, replaced, stamped

TEXT, BLOCKS, TABLES = "silver_text", "silver_blocks", "silver_tables"


def todo(store: Store, active: DataFrame, forced=None) -> DataFrame:
    """Files never treated, or treated with other content, other code or an error; and those that are forced."""
    rest = scd2.changed(active, store.read(TEXT), KEY, ["content_hash", "code_hash"], "extraction_error") if store.exists(TEXT) else active
    return scd2.apply_force(active, rest, forced, KEY)


def analysed(files: DataFrame, provider: providers.Provider = providers.layout_of_text) -> DataFrame:
    """files (relative_path, content ...) with ok, error and the layout as a struct in place of their content; to be staged, so that it is asked for and parsed once."""
    return providers.call(files, "content", provider).withColumn("result", F.from_json("payload", layout.RESULT)).drop("content", "payload")


def described(results: DataFrame, describe: providers.Provider) -> DataFrame:
    """(relative_path, figure_id, words): what a model says of each figure that has an image; a call that fails says nothing."""
    figures = results.select(KEY, F.explode("result.figures").alias("f")).where("f.id is not null")
    asked = figures.select(KEY, F.col("f.id").alias("figure_id"), F.to_json(F.struct(F.col("f.id").alias("figure"), F.col("f.caption").alias("caption"), F.col("f.ocr").alias("ocr"))).alias("request"))
    return providers.call(asked, "request", describe).where("ok").select(KEY, "figure_id", F.col("payload").alias("words"))


def extract(files: DataFrame, provider: providers.Provider = providers.layout_of_text, quality: float = 0.6, describe: providers.Provider | None = None, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(text, blocks, tables) of files (relative_path, content ...), or of what analysed() made of them.

    A file that can't be analysed has its error in extraction_error and neither blocks nor tables.
    """
    results = files if "result" in files.columns else analysed(files, provider)
    good = results.where("ok").select(KEY, "result")
    told = described(good, describe) if describe else None
    blocks, tables = layout.build(good, KEY, described=told, **options)
    ok, content = F.col("ok"), strip(F.col("result.content"))
    # blocks tell of a text only where there is no content or where there are figures; no other row meets them
    odd = F.coalesce(F.length(content) == 0, F.lit(True)) | F.coalesce(F.size("result.figures") > 0, F.lit(False))
    few, _ = layout.build(good.where(odd), KEY, described=told, **options)
    text = layout.blocks_to_text(few, KEY).withColumnRenamed("text", "rebuilt")
    figures = few.where("type = 'figure'").select(KEY).distinct().withColumn("has_figures", F.lit(True))
    share, flag = layout.pages_quality(F.col("result.pages"), least=quality)

    def row(df: DataFrame, rebuilt: Column, has_figures: Column) -> DataFrame:
        return df.select(
            *[c for c in files.columns if c not in ("content", "ok", "result", "error")],
            F.when(ok, F.when(F.length(content) > 0, content).otherwise(F.coalesce(rebuilt, F.lit("")))).alias("extracted_text"),
            F.when(ok, F.coalesce(F.size("result.pages"), F.lit(0))).alias("page_count"),
            F.when(ok, F.coalesce(F.size("result.tables") > 0, F.lit(False))).alias("has_tables"),
            F.when(ok, F.coalesce(has_figures, F.lit(False))).alias("has_figures"),
            F.when(ok, share).alias("di_quality"), F.when(ok, flag).alias("di_quality_flag"), F.col("error").alias("extraction_error"),
        )

    plain = row(results.where(~odd), F.lit(None).cast("string"), F.lit(None).cast("boolean"))
    rows = plain.unionByName(row(results.where(odd).join(text, KEY, "left").join(figures, KEY, "left"), F.col("rebuilt"), F.col("has_figures")))
    return rows, blocks, tables


def run(store: Store, files: DataFrame, code: str, now: Column, provider: providers.Provider = providers.layout_of_text, forced=None, **options) -> int:
    """Analyse what changed in files (the live inventory with content) and commit text, blocks and tables together."""
    active = files.withColumn("code_hash", F.lit(code)).withColumn("version_id", ids.version_id(F.col(KEY), F.col("content_hash"), F.col("code_hash")))
    pending = todo(store, active, forced).select(KEY, "file_name", "content_hash", "code_hash", "version_id", "content")
    read = store.staged(analysed(pending, provider))
    text, blocks, tables = extract(read, **options)
    versions = read.select(KEY, "file_name", "content_hash", "code_hash", "version_id")
    known = lambda df, name, suffix: stamped(df.join(versions, KEY).withColumn(name, ids.safe_key(F.col(KEY), suffix, F.col("version_id"))), now)
    blocks, tables = known(blocks, "block_id", F.col("block_index")), known(tables, "table_uid", F.col("table_id"))
    text = text.withColumn("valid_from", now)
    if store.exists(TEXT):
        before = store.read(TEXT)
        text = scd2.tombstone(scd2.evolve(before, text) if read.isEmpty() else scd2.merge(before, text, KEY), active, KEY, now)
    else:
        text = scd2.fresh(text)
    done = store.commit(**{TEXT: text, BLOCKS: replaced(store, BLOCKS, blocks, read, active, now), TABLES: replaced(store, TABLES, tables, read, active, now)})
    store.clear()
    return done


def figure_images(store: Store, figures: DataFrame, images: providers.Provider, root: str) -> DataFrame:
    """(relative_path, figure_uri, written): images of figures (relative_path, figure_id, figure_uri) fetched as hex and written under root; one that fails is skipped."""
    fetched = providers.call(figures, "figure_id", images)

    def save(frames):
        import os

        for f in frames:
            written = []
            for ok, payload, uri in zip(f["ok"], f["payload"], f["figure_uri"]):
                try:
                    if not ok:
                        raise OSError(uri)
                    path = os.path.join(root, *uri.split("/"))
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    with open(path, "wb") as out:
                        out.write(bytes.fromhex(payload))
                    written.append(True)
                except (OSError, ValueError):
                    written.append(False)
            yield f[[KEY, "figure_uri"]].assign(written=written)

    return fetched.mapInPandas(save, f"{KEY} string, figure_uri string, written boolean")


def inventory(store: Store, contents: DataFrame) -> DataFrame:
    """The live inventory with the files' contents (relative_path, content)."""
    return live(store, "bronze_files").select(KEY, "file_name", "content_hash").join(contents.select(KEY, "content"), KEY)
