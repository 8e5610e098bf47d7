"""JSON object operators over string columns.

JSON text is the stored form because it can be grouped and compared; VARIANT is used only inside an
expression, where it keeps the type of every value (8 is not "8").
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(key: str) -> str:
    return "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _field(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, _path(key), "variant")


def text(doc: Column, key: str) -> Column:
    """Value of a key as text (the ``->>`` operator)."""
    return F.get_json_object(doc, _path(key))


def fragment(doc: Column, key: str) -> Column:
    """Value of a key as a JSON fragment (the ``->`` operator)."""
    return F.to_json(_field(F.try_parse_json(doc), key))


def number(doc: Column, key: str, to: str = "int") -> Column:
    """Value of a key read as a number; null when it does not parse."""
    return text(doc, key).try_cast(to)


def as_text_map(doc: Column) -> Column:
    return F.from_json(doc, "map<string,string>")


def as_typed_map(doc: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), "$", "map<string,variant>")


def has_key(doc: Column, key: str) -> Column:
    """The ``?`` operator; a key with a null value is present."""
    return F.coalesce(F.map_contains_key(as_text_map(doc), F.lit(key)), F.lit(False))


def has_any(doc: Column, keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [has_key(doc, k) for k in keys], F.lit(False))


def has_all(doc: Column, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [has_key(doc, k) for k in keys], F.lit(True))


def _matches(doc: Column, pattern: Any) -> Column:
    if isinstance(pattern, dict):
        is_object = F.schema_of_variant(doc).startswith("OBJECT")
        return reduce(
            lambda acc, kv: acc & _matches(_field(doc, kv[0]), kv[1]), pattern.items(), is_object
        )
    if isinstance(pattern, list):
        items = F.try_variant_get(doc, "$", "array<variant>")
        return reduce(
            lambda acc, p: acc & F.exists(items, lambda x: _matches(x, p)),
            pattern,
            items.isNotNull(),
        )
    if isinstance(pattern, (int, float)) and not isinstance(pattern, bool):
        is_text = F.schema_of_variant(doc) == "STRING"
        return ~is_text & (F.try_variant_get(doc, "$", "double") == F.lit(float(pattern)))
    return F.to_json(doc) == F.lit(json.dumps(pattern, ensure_ascii=False))


def contains(doc: Column, pattern: dict) -> Column:
    """The ``@>`` operator: every key and nested value of the pattern is in the document."""
    return F.coalesce(_matches(F.try_parse_json(doc), pattern), F.lit(False))


def _sorted_json(typed: Column) -> Column:
    keys = F.array_sort(F.map_keys(typed))
    return F.to_json(
        F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(typed, k)))
    )


def canonical(doc: Column) -> Column:
    """The same object with its keys sorted."""
    return _sorted_json(as_typed_map(doc))


def merge(old: Column, new: Column) -> Column:
    """Shallow merge (the ``||`` operator): the new value wins, also when it is null."""
    delta = as_typed_map(new)
    both = F.map_zip_with(
        as_typed_map(old),
        delta,
        lambda k, was, now: F.when(F.map_contains_key(delta, k), now).otherwise(was),
    )
    return (
        F.when(new.isNull(), canonical(old)).when(old.isNull(), canonical(new))
        .otherwise(_sorted_json(both))
    )


def build_object(**fields: Column) -> Column:
    """One JSON object from named columns, keys sorted; null fields are kept."""
    return F.to_json(
        F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}
    )


def object_agg(key: Column, fragment: Column) -> Column:
    """Aggregate (key, JSON fragment) rows of a group into one object with sorted keys.

    Keys must be unique within the group; rows with a null key are left out.
    """
    pairs = F.array_sort(
        F.collect_list(F.when(key.isNotNull(), F.struct(key.alias("k"), fragment.alias("v"))))
    )
    typed = F.transform(pairs, lambda p: F.struct(p["k"], F.try_parse_json(p["v"]).alias("v")))
    return F.to_json(F.map_from_entries(typed))


def array_elements(doc: Column, schema: str) -> Column:
    """One row per element of a JSON array."""
    return F.explode(F.from_json(doc, schema))
