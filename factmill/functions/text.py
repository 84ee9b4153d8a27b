"""Text columns: normal forms, lengths in tokens, location of quotes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, spelt out because \s differs between engines.
SPACE = r"[ \t\n\r\f\x0B]+"
BLANKS = " \t\n\r\f\x0b"
#: Characters of a quote that have to be found literally before its surroundings are compared.
ANCHOR = 40
SLACK = 20


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def collapse(text: Column) -> Column:
    """White space as single spaces, none outside."""
    return strip(F.regexp_replace(text, SPACE, " "))


def normalize(text: Column) -> Column:
    return F.lower(collapse(text))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(strip(text)) == 0)


def token_length(text: Column) -> Column:
    """Estimated tokens: a fourth of the characters, one at least, none for no text."""
    return F.when(text.isNull() | (F.length(text) == 0), 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int")))


def call_tokens(text: Column, reserve: int = 2000) -> Column:
    """Tokens that a model call is expected to take, with room for its answer."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 4).cast("int") + reserve)


def slice_spans(content: Column, spans: Column, most: int) -> Column:
    """The parts of content that spans (offset, length) cover, each collapsed, joined by a space and cut at most."""
    parts = F.transform(spans, lambda s: collapse(F.substr(content, s["offset"] + 1, s["length"])))
    return F.substring(F.array_join(F.filter(parts, lambda p: F.length(p) > 0), " "), 1, most)


def locate(quote: Column, text: Column) -> Column:
    """'exact', 'normalized', or null where only a fuzzy comparison can tell; 'not_found' for a blank quote."""
    return (
        F.when(is_blank(quote) | text.isNull(), "not_found")
        .when(F.contains(text, quote), "exact")
        .when(F.contains(normalize(text), normalize(quote)), "normalized")
    )


def fuzzy_window(quote: Column, text: Column) -> Column:
    """The stretch of normalised text that a normalised quote is to be compared with; null if no anchor is in the text.

    The anchor is the quote's beginning, or, for a quote of over twice its length, the stretch at the middle.
    """
    size = F.length(quote)
    middle = F.floor(size / 2).cast("int")
    head = F.call_function("instr", text, F.substr(quote, F.lit(1), F.lit(ANCHOR)))
    mid = F.call_function("instr", text, F.substr(quote, middle + 1, F.lit(ANCHOR)))
    start = F.when(head > 0, head).when((size > 2 * ANCHOR) & (mid > 0), F.greatest(mid - middle, F.lit(1)))
    return F.substr(text, start, size + SLACK)
