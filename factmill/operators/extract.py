"""Field extraction: strategies, prompts, responses, unions of partial lists and the wide row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank

STRATEGIES = ("rag", "retrieve_classify", "map_reduce", "tables", "full_text")


def strategy(kind: Column, source: Column, override: Column) -> Column:
    """The override (an unknown one is an error), else what the source says, else the kind's default."""
    known = F.when(override.isin(*STRATEGIES), override).otherwise(F.raise_error(F.concat(F.lit("unknown strategy: "), override)))
    by_kind = F.when(kind == "boolean", "retrieve_classify").when(kind == "list", "map_reduce").when(kind == "struct_list", "full_text").otherwise("rag")
    return F.when(override.isNotNull(), known).when(source == "tables", "tables").otherwise(by_kind)


def group_fields(fields: DataFrame) -> DataFrame:
    """(strategy, fields): names in the order of the configuration."""
    listed = F.array_sort(F.collect_list(F.struct("position", "field_name")))
    return fields.groupBy("strategy").agg(F.transform(listed, lambda f: f["field_name"]).alias("fields"), F.min("position").alias("first")).orderBy("first").drop("first")


def prompt(questions: Column, text: Column, most: int = 3_000_000) -> Column:
    """Questions (struct field_name, question) as bullets over the text, which is cut at most."""
    bullets = F.array_join(F.transform(questions, lambda q: F.concat(F.lit("- "), q["field_name"], F.lit(": "), q["question"])), "\n")
    return F.concat(F.lit("Fields:\n"), bullets, F.lit("\n\nText:\n"), F.substring(F.coalesce(text, F.lit("")), 1, most))


#: Declared kinds of scalars, as a JSON schema and as Spark have them; others are strings.
JSON_KINDS = {"boolean": "boolean", "integer": "integer", "number": "number", "float": "number", "double": "number"}
SPARK_KINDS = {"boolean": "boolean", "integer": "int", "number": "double", "float": "double", "double": "double"}


def _closed(properties: dict) -> dict:
    """An object of exactly these properties."""
    return {"type": "object", "properties": properties, "required": [*properties], "additionalProperties": False}


def _nullable(kind: str | None, item_fields: Iterable[dict] = ()) -> dict:
    """What a value of a declared kind looks like, or null."""
    kind = (kind or "string").lower()
    items = {"list": {"type": "string"}, "struct_list": _closed({i["name"]: _nullable(i.get("type")) for i in item_fields})}
    return {"type": ["array", "null"], "items": items[kind]} if kind in items else {"type": [JSON_KINDS.get(kind, "string"), "null"]}


def response_schema(fields: Iterable[dict]) -> dict:
    """A strict response format that asks for a value and its evidence, null where there is none, for each field."""
    asked = {f["field_name"]: _closed({"value": _nullable(f.get("type"), f.get("item_fields") or ()), "evidence": _nullable("string")}) for f in fields}
    return {"type": "json_schema", "json_schema": {"name": "field_values", "strict": True, "schema": _closed(asked)}}


def wide_schema(fields: Iterable[dict]) -> dict[str, str]:
    """The Spark type of each field's column in the wide table; lists and struct lists are kept as JSON text."""
    return {f["field_name"]: SPARK_KINDS.get((f.get("type") or "string").lower(), "string") for f in fields}


def parse(response: Column, field: Column) -> Column:
    """(value, quote, quoted) of a field in a JSON response: an object with value or evidence, or the bare value.

    Objects without either are values themselves. quoted tells whether the value was a JSON string.
    A missing field, a null value and a quote that is blank or no string are null.
    """
    entry = F.try_variant_get(F.try_parse_json(response), "$", "map<string,variant>")[field]
    shape = lambda v: F.schema_of_variant(v)
    parts = F.try_variant_get(entry, "$", "map<string,variant>")
    asked = F.coalesce(F.map_contains_key(parts, "value") | F.map_contains_key(parts, "evidence"), F.lit(False))
    raw = F.when(asked, parts["value"]).otherwise(entry)
    quote = F.when(asked & (shape(parts["evidence"]) == "STRING"), F.try_variant_get(parts["evidence"], "$", "string"))
    is_text = F.coalesce(shape(raw) == "STRING", F.lit(False))
    value = F.when(shape(raw) != "VOID", F.when(is_text, F.try_variant_get(raw, "$", "string")).otherwise(F.to_json(raw)))
    return F.struct(value.alias("value"), F.when(~is_blank(quote), quote).alias("quote"), is_text.alias("quoted"))


def render_tables(tables: DataFrame, doc: str) -> DataFrame:
    """(doc, rendered): each table under its number and page, a blank line between."""
    one = F.concat(F.lit("[Table "), F.col("table_index").cast("string"), F.lit(", page "), F.coalesce(F.col("page").cast("string"), F.lit("?")), F.lit("]\n"), F.col("markdown"))
    parts = F.array_sort(F.collect_list(F.struct("table_index", one.alias("text"))))
    return tables.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n").alias("rendered"))


def union_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One list for each key from partial lists (keys, chunk_index, items, quote).

    Items are the same if their trimmed lower-case forms are, objects (JSON text) if they have the
    same members in whatever order; the first spelling by (chunk, place) stays, in that order. The
    quote is the first that isn't blank, whichever chunk it is from. An empty union is null.
    """
    item = F.col("item")
    members = F.when(item.startswith("{"), F.from_json(item, "map<string,string>"))
    ordered = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(members))))
    # distinct first, so that a frequent item is one row for each task before the shuffle
    spread = partials.select(*keys, "chunk_index", F.posexplode("items").alias("pos", "item")).where(F.length(F.trim("item")) > 0)
    first = spread.groupBy(*keys, F.lower(F.coalesce(ordered, F.trim("item"))).alias("same")).agg(F.min(F.struct("chunk_index", "pos", "item")).alias("f"))
    listed = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["item"]).alias("value"))
    quotes = partials.where(F.length(F.trim(F.coalesce("quote", F.lit("")))) > 0).groupBy(*keys).agg(F.min_by("quote", "chunk_index").alias("quote"))
    return partials.select(*keys).distinct().join(listed, keys, "left").join(quotes, keys, "left")


def items_json(items: Column) -> Column:
    """A list of items as one JSON array: objects as they are, everything else as strings."""
    quoted = lambda x: F.substring(F.to_json(F.array(x)), 2, 2**31 - 1)
    each = F.transform(items, lambda x: F.when(x.startswith("{") & F.from_json(x, "map<string,string>").isNotNull(), x).otherwise(F.regexp_replace(quoted(x), r"\]$", "")))
    return F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))


def wide(tall: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """A column for each configured field; the names come from the configuration, so no job looks for them."""
    return tall.groupBy(*keys).pivot("field_name", names).agg(F.first("value"))


def admit(tasks: DataFrame, groups: list[str], order: str, cost: str, budget: int) -> DataFrame:
    """Number the waves in which tasks run, in order, so that no wave's clamped costs pass the budget.

    A wave depends on all before it, so each group is one sequence; groups are dealt over the tasks,
    sorted there and read as a stream, so that no group has to fit in memory.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tasks.schema) + ", clamped bigint, wave bigint"

    def run(frames):
        group, wave, held = None, 0, 0
        for frame in frames:
            clamped, waves = [], []
            for key, c in zip(zip(*(frame[g] for g in groups)), frame[cost]):
                c = min(int(c), budget)
                if key != group:
                    group, wave, held = key, 0, 0
                elif held + c > budget:
                    wave, held = wave + 1, 0
                held += c
                clamped.append(c)
                waves.append(wave)
            yield frame.assign(clamped=clamped, wave=waves)

    return tasks.repartition(*groups).sortWithinPartitions(*groups, order).mapInPandas(run, schema)
