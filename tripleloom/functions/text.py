"""Text functions on columns, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Blank as the surveyed rules see it: Unicode white space and the ASCII separators.
BLANK = r"[\s\x1c-\x1f]"

NAMED = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"(?U)^{BLANK}+|{BLANK}+$", "")


def collapse_blanks(x: Column) -> Column:
    return strip(F.regexp_replace(x, f"(?U){BLANK}+", " "))


def character_name(x: Column) -> Column:
    """NULL gives '', the list separator '|' gives '/', blanks collapse."""
    return collapse_blanks(F.replace(F.coalesce(x, F.lit("")), F.lit("|"), F.lit("/")))


def slug(x: Column, sep: str = "-") -> Column:
    """Lower-case IRI segment: every run outside a-z and 0-9 becomes one separator."""
    dashed = F.regexp_replace(F.lower(x), "[^a-z0-9]+", sep)
    return F.btrim(dashed, F.lit(sep))


def json_cell(x: Column, schema: T.DataType, strict: bool = True) -> Column:
    """Array held as JSON text; empty text is the empty array. Strict parsing fails on bad JSON."""
    text = F.coalesce(F.nullif(x, F.lit("")), F.lit("[]"))
    return F.from_json(text, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def json_names(x: Column, strict: bool = True) -> Column:
    return F.transform(json_cell(x, NAMED, strict), lambda item: strip(item["name"]))


def first_or_blank(items: Column) -> Column:
    return F.coalesce(F.try_element_at(items, F.lit(1)), F.lit(""))


def year_of_date_text(x: Column) -> Column:
    return F.substring(x, 1, 4)


def whole_part(x: Column) -> Column:
    return F.split_part(x, F.lit("."), F.lit(1))


def last_segment(iri: Column) -> Column:
    return F.substring_index(iri, "/", -1)


def cut_prefix(x: Column, prefix: str) -> Column:
    return F.substring(x, len(prefix) + 1, 2147483647)


def percent_decode(x: Column) -> Column:
    """Percent-decoding that keeps '+' and leaves a '%' without two hex digits alone."""
    guarded = F.replace(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(x, F.lit("%")), F.url_decode(guarded)).otherwise(x)


def str_after(x: Column, mark: str) -> Column:
    at = F.instr(x, mark)
    return F.when(at > 0, F.substring(x, at + F.lit(len(mark)), F.lit(2147483647))).otherwise(F.lit(""))


def year_value(lexical: Column) -> Column:
    """Year of a date or dateTime text; anything else is unbound (NULL)."""
    return F.year(F.try_to_timestamp(lexical)).cast("long")


def name_of_resource(value: Column, kind: Column, space: str) -> Column:
    """An IRI under `space` reads as words; a literal is taken as it is."""
    words = F.regexp_replace(str_after(value, space), "_", " ")
    return F.when(kind == "iri", words).otherwise(value)
