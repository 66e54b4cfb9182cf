"""Values out of knowledge-base claims.

A claim list is ``array<struct<mainsnak: struct<datavalue: struct<value: string>>>>`` where
``value`` keeps the raw JSON text: an object with ``text``, ``id`` or ``time``, or a bare string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: address prefix of an image file.
IMAGE_PREFIX = "https://commons.wikimedia.org/wiki/Special:FilePath/"


def first_value(claims: Column, prop: str) -> Column:
    """Raw value of the first claim of a property, NULL when absent."""
    return F.get(F.try_element_at(claims, F.lit(prop)), F.lit(0))["mainsnak"]["datavalue"]["value"]


def values(claims: Column, prop: str) -> Column:
    """Raw values of all claims of a property, in order."""
    return F.transform(
        F.try_element_at(claims, F.lit(prop)), lambda c: c["mainsnak"]["datavalue"]["value"]
    )


def is_object(value: Column) -> Column:
    return F.startswith(F.ltrim(value), F.lit("{"))


def field(value: Column, name: str) -> Column:
    return F.when(is_object(value), F.get_json_object(value, f"$.{name}"))


def claim_date(value: Column, length: int = 10) -> Column:
    """Time of a claim without the leading plus, cut to ``length`` characters; else empty."""
    return F.coalesce(
        F.substring(F.ltrim(field(value, "time"), F.lit("+")), 1, length), F.lit("")
    )


def claim_id(value: Column) -> Column:
    return F.nullif(field(value, "id"), F.lit(""))


def claim_string(value: Column, label: Column) -> Column:
    """Text of a claim: its ``text``, else the label of its ``id``, else the bare value.

    ``label`` is the label looked up for ``claim_id(value)``; the id itself stands in for a
    missing label.
    """
    return F.coalesce(field(value, "text"), label, claim_id(value), value)


# ---- payloads whose shape drifts: VARIANT values ------------------------------------------------


def variant_kind(value: Column) -> Column:
    """Kind of a VARIANT: object, array, string, number, boolean or null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean").when(value.isNull() | F.is_variant_null(value), "null").otherwise("number")
    )


def variant_field(value: Column, name: str, kind: str = "string") -> Column:
    """A field of an object in the wanted type, whatever type it came in; NULL if absent, of another shape or not convertible."""
    return F.try_variant_get(value, f"$.{name}", kind)


def variant_text(value: Column) -> Column:
    """Text of a claim value: its ``text``, else its ``id``, else the value itself, an object as JSON."""
    return F.coalesce(variant_field(value, "text"), variant_field(value, "id"), F.try_variant_get(value, "$", "string"))


def image_url(file_name: Column, prefix: str = IMAGE_PREFIX) -> Column:
    """Address of an image file; empty when there is none."""
    return F.coalesce(
        F.concat(F.lit(prefix), F.replace(file_name, F.lit(" "), F.lit("_"))), F.lit("")
    )


def first_image(images: Column) -> Column:
    """Address of the first image of a list of structs; empty when there is none."""
    return F.coalesce(F.get(images, F.lit(0))["url"], F.lit(""))
