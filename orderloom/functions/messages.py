"""JSON message inspection on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import strip


# Closes the one-element list a line is wrapped in; any text that no line contains.
_END = "end-of-line-9f1c6a52-0d0e-4c56-9a53-6f5b7c1f6d2e"


def _wrapped(line: Column) -> Column:
    """The line as the first of two list elements.

    A JSON parser stops after the first complete value, so text behind it would go
    unnoticed; inside a list it breaks the list or moves the end marker.
    """
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit(f',"{_END}"]')))


def is_valid_json(line: Column) -> Column:
    """True for a line that is exactly one JSON value."""
    marker = F.try_variant_get(_wrapped(line), "$[1]", "string")
    return F.coalesce(marker == _END, F.lit(False))


def document(line: Column) -> Column:
    """The parsed line as VARIANT, NULL when it is not valid JSON."""
    return F.when(is_valid_json(line), F.try_variant_get(_wrapped(line), "$[0]", "variant"))


def text_key(doc: Column, name: str) -> Column:
    """The member ``name`` if it is a non-blank JSON string, else NULL."""
    member = F.try_variant_get(doc, f"$.{name}", "variant")
    value = F.try_variant_get(doc, f"$.{name}", "string")
    return F.when((F.schema_of_variant(member) == "STRING") & (F.length(strip(value)) > 0), value)

