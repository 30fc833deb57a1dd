"""JSON objects with fields that nobody has declared.

A VARIANT sorts the keys of an object, so order is taken from the text: a map
parsed from it holds its members as they come.  Values stay VARIANT and are
written back unchanged, whatever their type.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillgate.functions import validation as val

_KEEP_NULLS = {"ignoreNullFields": "false"}


def json_text(value: Column) -> Column:
    """Any value as JSON text; SQL null as ``null``."""
    listed = F.to_json(F.array(value), _KEEP_NULLS)
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def members(text: Column) -> Column:
    """``key, value`` of an object's members in order; null unless the text is
    exactly one object.  Of equal keys the first gives the place and the last
    the value."""
    parsed = F.map_entries(F.from_json(text, "map<string,variant>"))
    keys = F.transform(parsed, lambda m: m["key"])

    def one(m: Column, i: Column) -> Column:
        last = F.element_at(F.filter(parsed, lambda x: x["key"] == m["key"]), -1)
        return F.struct(m["key"].alias("key"), last["value"].alias("value"), (F.array_position(keys, m["key"]) == i + 1).alias("first"))

    kept = F.filter(F.transform(parsed, one), lambda m: m["first"])
    return F.when(val.is_object(val.parse_exact(text)), kept)


def merge_object(text: Column, new: dict[str, Column], drop: list[str] | None = None) -> Column:
    """The object with the members of ``new`` (any type) in place of those of
    the same name, or behind all others, and without those named in ``drop``.

    All other members keep their values and their order.  A text that is not
    one object counts as an empty one.
    """
    values = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), json_text(v).alias("text")) for k, v in new.items()]))
    gone = F.array(*[F.lit(x) for x in drop or []]).cast("array<string>")
    have = F.filter(F.coalesce(members(text), F.from_json(F.lit("[]"), "array<struct<key:string,value:variant,first:boolean>>")),
                    lambda m: ~F.array_contains(gone, m["key"]))
    old = F.transform(have, lambda m: F.concat(json_text(m["key"]), F.lit(":"), F.coalesce(values[m["key"]], json_text(m["value"]))))
    names = F.transform(have, lambda m: m["key"])
    added = F.filter(F.array(*[F.lit(k) for k in new]), lambda k: ~F.array_contains(names, k))
    tail = F.transform(added, lambda k: F.concat(json_text(k), F.lit(":"), values[k]))
    return F.concat(F.lit("{"), F.array_join(F.concat(old, tail), ","), F.lit("}"))
