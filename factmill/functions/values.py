"""Typed values: reading them from strings and JSON, writing them, and checking their form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import strip

NUMBER = r"-?\d+(?:\.\d+)?"
#: What a decimal may look like; casts alone would also take a trailing d or f.
_DECIMAL = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)$"
INTEGERS, NUMBERS = ("integer",), ("number", "float", "double")


def to_integer(value: Column, quoted: Column) -> Column:
    """A whole number; one that came as a JSON number drops its fraction, one in quotes must have none."""
    plain = strip(value)
    whole = F.when(F.regexp_like(plain, F.lit(r"^[+-]?\d+$")), plain.try_cast("bigint"))
    return F.when(quoted, whole).otherwise(F.coalesce(whole, plain.try_cast("double").try_cast("bigint")))


def to_double(value: Column) -> Column:
    plain = strip(value)
    return F.when(F.regexp_like(plain, F.lit(_DECIMAL)), plain.try_cast("double"))


def to_flag(value: Column, quoted: Column) -> Column:
    """True for true, 1 and yes; a bare JSON number that isn't zero is true as well; all else is false, null stays null."""
    plain = F.lower(strip(value))
    known = plain.isin("true", "1", "yes")
    return F.when(value.isNotNull(), known | F.when(quoted, False).otherwise(F.coalesce(plain.try_cast("double") != 0, F.lit(False))))


def to_items(value: Column) -> Column:
    """The items of a JSON list without its nulls, or else the parts between commas."""
    parts = F.filter(F.transform(F.split(value, ","), strip), lambda x: F.length(x) > 0)
    return F.coalesce(F.filter(json_list(value), lambda x: x.isNotNull()), parts)


def coerce(value: Column, kind: Column, quoted: Column | None = None) -> Column:
    """A value, written as its declared kind has it; null where it can't be read.

    value is a string; quoted tells whether it was one in the response too (it is taken for one if
    nothing is said) or a bare JSON number, flag or list. A boolean that isn't known is false; a list
    is a JSON array without nulls, or else parts between commas. Kinds: boolean, integer, number
    (float, double), list; everything else is a string and stays as it is.
    """
    quoted = F.lit(True) if quoted is None else quoted
    kind = F.lower(F.coalesce(kind, F.lit("string")))
    return (
        F.when(value.isNull(), None)
        .when(kind == "boolean", to_flag(value, quoted).cast("string"))
        .when(kind.isin(*INTEGERS), to_integer(value, quoted).cast("string"))
        .when(kind.isin(*NUMBERS), to_double(value).cast("string"))
        .when(kind == "list", F.to_json(to_items(value)))
        .otherwise(value)
    )


def json_list(value: Column) -> Column:
    """A JSON array as strings (what isn't a string is its JSON); null if it isn't one."""
    return F.when(strip(value).startswith("["), F.from_json(value, "array<string>"))


#: How the items of a struct list are written, by declared kind.
_WRITTEN = {"boolean": lambda v: to_flag(v, F.lit(True)), "list": to_items} | {k: lambda v: to_integer(v, F.lit(False)) for k in INTEGERS} | {k: to_double for k in NUMBERS}


def coerce_structs(value: Column, fields: Iterable[str | tuple[str, str | None]]) -> Column:
    """A JSON array of objects with the declared keys only, each written as its kind has it; entries that aren't objects go.

    fields are names, or (name, kind). Null where value isn't a JSON array.
    """
    declared = [(f, None) if isinstance(f, str) else f for f in fields]
    schema = "struct<" + ",".join(f"`{n}`:string" for n, _ in declared) + ">"
    objects = F.filter(json_list(value), lambda x: F.coalesce(strip(x).startswith("{"), F.lit(False)))

    def written(text: Column) -> Column:
        row = F.from_json(text, schema)
        return F.struct(*[_WRITTEN.get((k or "string").lower(), lambda v: v)(row[n]).alias(n) for n, k in declared])

    if not declared:
        return F.when(objects.isNotNull(), F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit("{}"), F.size(objects)), ","), F.lit("]")))
    return F.to_json(F.transform(objects, written), {"ignoreNullFields": "false"})


def stringify(value: Column, nested: bool = False) -> Column:
    """A value as text: strings as they are, flags and numbers as JSON has them, arrays and structs (nested) as JSON."""
    return F.to_json(value) if nested else value.cast("string")


def pattern_that_compiles(pattern: str | None) -> str | None:
    """The pattern, or None where it is no regular expression: a fault in the configuration is not held against values."""
    if not pattern:
        return None
    try:
        SparkSession.active().sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException:
        return None
    return pattern


def _elements(value: Column) -> Column:
    """The elements of a JSON array as variants; null if the value isn't one."""
    return F.when(strip(value).startswith("["), F.try_variant_get(F.try_parse_json(value), "$", "array<variant>"))


def _is_kind(element: Column, *kinds: str) -> Column:
    shape = F.schema_of_variant(element)
    out = F.lit(False)
    for k in kinds:
        out = out | shape.startswith(k)
    return element.isNotNull() & F.coalesce(out, F.lit(False))


def validate(value: Column, kind: Column, pattern: Column | str | None = None) -> Column:
    """'valid', 'invalid' or 'not_applicable' (null, blank or empty values) for values written as strings.

    A string is trimmed before it meets its pattern, which need match a part of it only; a pattern
    given as a str that is no regular expression counts as none (for columns of patterns see
    pattern_that_compiles). A list's items may be anything but lists and objects.
    """
    plain = strip(value)
    kind = F.lower(F.coalesce(kind, F.lit("string")))
    if isinstance(pattern, str):
        pattern = F.lit(pattern_that_compiles(pattern))
    fits = F.lit(True) if pattern is None else F.coalesce(pattern == "", F.lit(True)) | F.regexp_like(plain, F.coalesce(pattern, F.lit("")))
    items = _elements(value)
    lists = F.when(items.isNull(), "invalid").when(F.size(items) == 0, "not_applicable").when(F.exists(items, lambda x: _is_kind(x, "OBJECT", "ARRAY")), "invalid").otherwise("valid")
    return (
        F.when(value.isNull(), "not_applicable")
        .when(kind == "boolean", F.when(plain.isin("true", "false"), "valid").otherwise("invalid"))
        .when(kind.isin(*INTEGERS), F.when(F.regexp_like(plain, F.lit(r"^-?\d+$")), "valid").otherwise("invalid"))
        .when(kind.isin(*NUMBERS), F.when(F.regexp_like(plain, F.lit(_DECIMAL)), "valid").otherwise("invalid"))
        .when(kind == "list", lists)
        .when(F.length(plain) == 0, "not_applicable")
        .otherwise(F.when(fits, "valid").otherwise("invalid"))
    )


def validate_structs(value: Column, fields: Iterable[str]) -> Column:
    """Each entry has to be an object, with one declared key at least that is neither null nor empty (if any are declared)."""
    items, names = _elements(value), list(fields)

    def filled(e: Column) -> Column:
        out = F.lit(not names)
        for n in names:
            part = F.try_variant_get(e, f"$['{n}']", "variant")
            out = out | F.coalesce(~_is_kind(part, "VOID") & (part.try_cast("string").isNull() | (part.try_cast("string") != "")) & part.isNotNull(), F.lit(False))
        return out

    good = F.forall(items, lambda e: _is_kind(e, "OBJECT") & filled(e))
    return F.when(value.isNull(), "not_applicable").when(items.isNull(), "invalid").when(F.size(items) == 0, "not_applicable").otherwise(F.when(good, "valid").otherwise("invalid"))


def to_bool(value: Column) -> Column:
    """True, false or null: unlike coerce(), a word it doesn't know is null."""
    plain = F.lower(strip(value))
    return F.when(plain.isin("true", "1", "yes", "y"), True).when(plain.isin("false", "0", "no", "n"), False)


def to_number(value: Column) -> Column:
    """The first signed decimal, thousands separators dropped."""
    found = F.regexp_extract(F.regexp_replace(value, ",", ""), NUMBER, 0)
    return F.when(found != "", found.try_cast("double"))


#: Date formats that are tried in this order.
DATE_FORMATS = ("d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d/M/yyyy", "M/d/yyyy")


def to_date(value: Column) -> Column:
    """Year, month and day between dashes or slashes anywhere in the text, else the whole text in one of the known formats, else the text itself."""
    parts = [F.regexp_extract(value, r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", i) for i in (1, 2, 3)]
    found = F.when(parts[0] != "", F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0")))
    tries = [F.date_format(F.try_to_timestamp(strip(value), F.lit(f)), "yyyy-MM-dd") for f in DATE_FORMATS]
    return F.coalesce(found, *tries, strip(value))


def as_list(value: Column) -> Column:
    """JSON array, or the parts between commas, semicolons and line feeds; blanks dropped."""
    parts = F.coalesce(F.filter(json_list(value), lambda x: x.isNotNull()), F.split(value, r"[,\n;]"))
    return F.filter(F.transform(F.coalesce(parts, F.array().cast("array<string>")), strip), lambda x: F.length(x) > 0)
