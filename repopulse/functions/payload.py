"""JSON expressions: slimming a payload to its scalars, and telling objects from bad lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT_MAP = "map<string, variant>"


def is_blank(line: Column) -> Column:
    return ~line.rlike(r"\S")


def is_json_object(line: Column) -> Column:
    """True for a line that is one JSON object; false for broken text, arrays and scalars.

    The parser stops at the end of the first value, so that alone says nothing about the rest.
    """
    return F.json_object_keys(line).isNotNull() & is_one_value(line)


def is_one_value(line: Column) -> Column:
    """True if nothing follows the line's first JSON value.

    In brackets such a line is a list of one, and as a member of an object it leaves one key. A tail
    can close the list early or the object early, but a bracket that closes the one breaks the other.
    """
    listed = F.json_array_length(F.concat(F.lit("["), line, F.lit("]")))
    member = F.size(F.json_object_keys(F.concat(F.lit('{"x":'), line, F.lit("}"))))
    return F.coalesce((listed == 1) & (member == 1), F.lit(False))


def is_scalar(value: Column) -> Column:
    """String, number or boolean: neither JSON null nor a nested object or array."""
    is_object = F.try_variant_get(value, "$", VARIANT_MAP).isNotNull()
    is_array = F.try_variant_get(value, "$", "array<variant>").isNotNull()
    return value.isNotNull() & ~F.is_variant_null(value) & ~is_object & ~is_array


def scalars(fields: Column) -> Column:
    """Scalar entries of a variant map, in order; empty when there is no map.

    Of entries with one key the last counts, be it a scalar or not.
    """
    empty = F.from_json(F.lit("{}"), VARIANT_MAP)
    return F.coalesce(F.map_filter(last_per_key(fields), lambda _, value: is_scalar(value)), empty)


def last_per_key(fields: Column) -> Column:
    """A parsed JSON object may hold a key several times; only the last stays."""
    keys = F.map_keys(fields)
    size = F.size(keys)
    repeats = F.size(F.array_distinct(keys)) < size

    def is_last(entry: Column, i: Column) -> Column:
        behind = F.slice(keys, i + 2, F.greatest(size - i - 1, F.lit(0)))
        return ~F.array_contains(behind, entry["key"])

    last = F.map_from_entries(F.filter(F.map_entries(fields), is_last))
    return F.when(repeats, last).otherwise(fields)


def slim_payload(json_text: Column) -> Column:
    """The scalar part of a payload as JSON text; `{}` when the payload is no object."""
    kept = F.to_json(scalars(F.from_json(json_text, VARIANT_MAP)))
    return F.coalesce(kept, F.lit("{}"))
