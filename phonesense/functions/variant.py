"""Typed access to the probe JSON documents held as VARIANT.

``try_variant_get`` gives the coercions the probe data needs: a missing key or
JSON null is NULL, a number read as string becomes its text, a numeric string
read as double converts and a non-numeric one becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(key: str) -> str:
    """Path of a top-level key; bracket form so any key text is legal."""
    escaped = key.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{escaped}']"


def get_field(doc, key: str, type_name: str) -> Column:
    """Field ``key`` of a VARIANT object as ``type_name`` (NULL when absent or
    not convertible)."""
    return F.try_variant_get(_col(doc), json_path(key), type_name)


def get_string(doc, key: str) -> Column:
    return get_field(doc, key, "string")


def get_double(doc, key: str) -> Column:
    return get_field(doc, key, "double")


def get_boolean(doc, key: str) -> Column:
    return get_field(doc, key, "boolean")


def get_array(doc, key: str) -> Column:
    """Array under ``key`` as ``ARRAY<VARIANT>``; NULL when the key is missing,
    JSON null, or holds a non-array value, so an explode yields no rows."""
    return get_field(doc, key, "array<variant>")


def parse_payload(payload, mode: str = "FAILFAST") -> Column:
    """Parse a payload of comma-joined JSON objects (no enclosing brackets)
    into a VARIANT array.

    ``FAILFAST`` raises on malformed text; ``PERMISSIVE`` turns it into NULL.
    A NULL payload gives NULL, an empty one an empty array.
    """
    text = F.concat(F.lit("["), _col(payload), F.lit("]"))
    mode = mode.upper()
    if mode == "FAILFAST":
        return F.parse_json(text)
    if mode == "PERMISSIVE":
        return F.try_parse_json(text)
    raise ValueError(f"mode must be FAILFAST or PERMISSIVE, got {mode!r}")


def fields_select(doc, fields) -> list[Column]:
    """``[(out_name, key, type), ...]`` -> list of aliased getters."""
    return [get_field(doc, key, type_name).alias(name) for name, key, type_name in fields]
