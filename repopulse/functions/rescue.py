"""What a JSON line holds beyond the typed row that was read from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_MAP = "map<string, string>"
ENTRIES = "array<struct<key: string, value: string>>"


CORRUPT = "_corrupt_record"


def raw_texts(json_text: Column) -> Column:
    """Every key of a JSON object with the text of its value; null for anything else."""
    return F.from_json(json_text, RAW_MAP)


def typed(line: Column, schema: T.StructType) -> Column:
    """The typed struct of a line, with a last member CORRUPT: the line, if a value did not fit."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(line, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})


def objects(line: Column, schema: T.StructType) -> Column:
    """The nested objects of a line as raw maps."""
    inner = [f"`{f.name}` {RAW_MAP}" for f in schema.fields if isinstance(f.dataType, T.StructType)]
    return F.from_json(line, ", ".join(inner))


def is_clean(keys: Column, typed: Column, objects: Column, schema: T.StructType) -> Column:
    """Whether a line holds nothing but its schema: no unknown key, no value that did not fit.

    True for nearly every line, and much cheaper to tell than what a line has lost.
    """
    clean = keys.isNotNull() & typed[CORRUPT].isNull() & _only(keys, schema)
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            inner = F.map_keys(objects[field.name])
            clean = clean & F.coalesce(_only(inner, field.dataType), F.lit(True))
    return clean


def _only(keys: Column, schema: T.StructType) -> Column:
    known = F.array(*[F.lit(name) for name in schema.names])
    return F.size(F.array_except(keys, known)) == 0


def _entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _misfits(raw: Column, typed: Column, schema: T.StructType) -> Column:
    """Entries of one object that the typed struct does not hold. JSON nulls hold nothing."""

    def lost(entry: Column) -> Column:
        key = entry["key"]
        case = F
        for field in schema.fields:
            case = case.when(key == field.name, typed.getField(field.name).isNull())
        return entry["value"].isNotNull() & case.otherwise(True)

    return F.filter(F.map_entries(raw), lost)


def _below(name: str, entries: Column) -> Column:
    def dotted(entry: Column) -> Column:
        return _entry(F.concat(F.lit(f"{name}."), entry["key"]), entry["value"])

    return F.transform(entries, dotted)


def misfits(raw: Column, objects: Column, typed: Column, schema: T.StructType) -> Column:
    """(path, raw text) of all values of a line that its typed struct does not hold.

    Paths are dotted. Each object is walked once.
    """
    nothing = F.array().cast(ENTRIES)
    parts = [_misfits(raw, typed, schema)]
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            member = typed.getField(field.name)
            inner = _misfits(objects[field.name], member, field.dataType)
            parts.append(F.when(member.isNotNull(), _below(field.name, inner)))
    return F.concat(*[F.coalesce(part.cast(ENTRIES), nothing) for part in parts])


def rescued(
    line: Column, keys: Column, alone: Column, lost: Column, source_file: Column
) -> Column:
    """JSON text of the lost values with the file they came from; null when nothing was lost.

    A line that is no JSON object at all, or not only one, is kept whole.
    """
    broken = F.array(_entry(F.lit(CORRUPT), line)).cast(ENTRIES)
    origin = F.array(_entry(F.lit("_file_path"), source_file)).cast(ENTRIES)
    kept = F.when(keys.isNull() | ~alone, broken).when(F.size(lost) > 0, lost)
    return F.when(kept.isNotNull(), F.to_json(_first_per_key(F.concat(kept, origin))))


def _first_per_key(entries: Column) -> Column:
    """A JSON line may repeat a key; a map may not."""
    keys = entries.getField("key")
    repeats = F.size(F.array_distinct(keys)) < F.size(keys)
    first = F.filter(entries, lambda entry, i: F.array_position(keys, entry["key"]) == i + 1)
    return F.map_from_entries(F.when(repeats, first).otherwise(entries))
