"""Strict JSON parsing and the check of the structured output."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Marks the end of the text under test, see parse_exact.
_END = "end-of-text-7d1f"


def parse_exact(text: Column) -> Column:
    """Parse JSON text to VARIANT, null when it is not exactly one JSON value.

    ``try_parse_json`` stops at the end of the first value and ignores what
    follows it.  Putting the text in front of an end mark in an array makes
    trailing prose, a second value or a stray bracket invalid.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    whole = (F.try_variant_get(wrapped, "$[1]", "string") == F.lit(_END)) & F.try_variant_get(
        wrapped, "$[2]", "variant"
    ).isNull()
    return F.when(whole, F.try_variant_get(wrapped, "$[0]", "variant"))


def field(value: Column, name: str) -> Column:
    """Member of an object; SQL null when absent, variant null when null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def has_field(value: Column, name: str) -> Column:
    return field(value, name).isNotNull()


def has_member(value: Column, name: str) -> Column:
    """Whether an object has this member, and not as null; any name will do."""
    # a path cannot hold every name
    member = F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(name))
    return member.isNotNull() & ~F.is_variant_null(member)


def field_type(value: Column, name: str) -> Column:
    return F.schema_of_variant(field(value, name))


def text_field(value: Column, name: str) -> Column:
    """Member as a string; null unless it *is* a JSON string."""
    return F.when(
        field_type(value, name) == "STRING", F.try_variant_get(value, f"$.{name}", "string")
    )


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT<")), F.lit(False))


def string_list(value: Column, name: str) -> Column:
    """Member as ``array<string>``; null unless every element is a string."""
    kind = field_type(value, name)
    items = F.try_variant_get(value, f"$.{name}", "array<string>")
    return F.when(
        ((kind == "ARRAY<STRING>") & F.forall(items, lambda x: x.isNotNull()))
        | ((kind == "ARRAY<VOID>") & (F.size(items) == 0)),
        items,
    )


def is_valid_output(value: Column) -> Column:
    """Object with ``normal_statements`` (strings only) and ``schedule``
    (a string); other keys are allowed, empty list and text too."""
    return string_list(value, "normal_statements").isNotNull() & F.coalesce(
        field_type(value, "schedule") == "STRING", F.lit(False)
    )


def structured_output(value: Column) -> Column:
    """The checked struct, null when the value does not pass."""
    return F.when(
        is_valid_output(value),
        F.struct(
            string_list(value, "normal_statements").alias("normal_statements"),
            text_field(value, "schedule").alias("schedule"),
        ),
    )


# Type texts and literals that count as "no output" when given
# instead of an object.
_EMPTY_JSON = ["null", "{}", "[]", '""', "0", "0.0", "false"]


def is_missing_output(value: Column) -> Column:
    """True for absent, null and empty values of any JSON type."""
    return value.isNull() | F.to_json(value).isin(_EMPTY_JSON)
