"""Columns of mixed type: real type tests, nested paths and list-or-text fields on VARIANT.

A document whose fields may hold one type in one row and another in the next is one VARIANT column
(``parsed``); ``at`` reads a nested path (C-35), ``kind`` and ``is_number`` test the type that a row
really has (F-13), and ``as_list`` gives a list whether the field is one or the text of one (R-09,
C-03).  All of it runs in the JVM but for texts that only the Python-literal parser reads.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetric.functions.cleaning import NAMED_ITEM, literal_list

#: Fixed value: the int type of the document store has 32 bits.
INT_LOW, INT_HIGH = -(2**31), 2**31 - 1


def parsed(c) -> Column:
    """JSON text as VARIANT; text that is no JSON is NULL."""
    return F.try_parse_json(c)


def at(v: Column, *path: str) -> Column:
    """The value at a nested path, as VARIANT (NULL where a step is absent)."""
    return F.variant_get(v, "$" + "".join(f'["{p}"]' for p in path), "variant")


def type_name(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return type_name(v).startswith("OBJECT")


def is_array(v: Column) -> Column:
    return type_name(v).startswith("ARRAY")


def is_string(v: Column) -> Column:
    return type_name(v) == "STRING"


def is_number(v: Column) -> Column:
    """F-13: a number of any width, not a text that looks like one."""
    name = type_name(v)
    return name.isin("BIGINT", "DOUBLE", "FLOAT") | name.startswith("DECIMAL")


def _long(v: Column) -> Column:
    return F.try_variant_get(v, "$", "bigint")


def _date(v: Column, t: Column) -> Column:
    """A date is written ``{"$date": ISO text}``."""
    text = F.when(t.startswith("OBJECT"), F.try_variant_get(v, '$["$date"]', "string"))
    return text.try_cast(T.TimestampType()).isNotNull()


# The names of the document store's types, told from a value and its type name.
KINDS = {
    "null": lambda v, t: t == "VOID",
    "string": lambda v, t: t == "STRING",
    "int": lambda v, t: (t == "BIGINT") & _long(v).between(INT_LOW, INT_HIGH),
    "double": lambda v, t: t.isin("DOUBLE", "FLOAT") | t.startswith("DECIMAL"),
    "bool": lambda v, t: t == "BOOLEAN",
    "date": _date,
    "object": lambda v, t: t.startswith("OBJECT"),
    "array": lambda v, t: t.startswith("ARRAY"),
}


def kind(v: Column, *names: str, known: Column | None = None) -> Column:
    """Whether a value has one of the named types; ``known`` is its type name, where that is at hand."""
    t = type_name(v) if known is None else known
    test = KINDS[names[0]](v, t)
    for name in names[1:]:
        test = test | KINDS[name](v, t)
    return F.coalesce(test, F.lit(False))


def items(v: Column) -> Column:
    """The items of an array as a list of VARIANT; NULL for any other value."""
    return F.try_variant_get(F.when(is_array(v), v), "$", "array<variant>")


def as_list(v: Column, element: T.DataType = NAMED_ITEM) -> Column:
    """R-09: ``array<element>`` of a field that is a list, or the JSON or literal text of one.
    Anything else, and an absent field, is an empty list."""
    text = F.when(is_string(v), F.try_variant_get(v, "$", "string"))
    listed = F.from_json(F.when(is_array(v), F.to_json(v)), T.ArrayType(element))
    empty = F.array().cast(T.ArrayType(element))
    return F.when(is_array(v), F.coalesce(listed, empty)).when(is_string(v), literal_list(text, element)).otherwise(empty)
