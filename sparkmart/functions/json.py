"""JSON text columns: parse once per column, then address fields.

Parsing is FAILFAST, so malformed text, empty text included, stops the run
instead of turning into nulls. A valid document of another kind is no error: a
field of anything but an object is null, and a value that isn't a list is read
as a list of it, an object as the list of its values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"mode": "FAILFAST"}


def _starts(text: Column, mark: str) -> Column:
    # most documents begin with the mark; only the others are trimmed
    return text.startswith(mark) | F.ltrim(text, F.lit(" \t\n\r")).startswith(mark)


def _kind(text: Column) -> Column:
    """The document's type; malformed text stops the run. Only asked for the odd document."""
    return F.schema_of_variant(F.parse_json(text))


def parse_object(text: Column, ddl: str) -> Column:
    """Parse an object into a struct. ``ddl`` lists the fields to keep."""
    # null, but only known once the document has been read
    other = F.nullif(F.substring(_kind(text), 1, 0), F.lit(""))
    document = F.when(_starts(text, "{"), text).otherwise(other)
    return F.from_json(document, f"struct<{ddl}>", _STRICT)


def parse_array(text: Column, element: str) -> Column:
    """Parse an array; ``element`` is the DDL type of one element.

    An object gives its values, any other document (JSON ``null`` too) one null
    element.
    """
    kind = f"array<{element}>"
    values = F.map_values(F.from_json(text, "map<string,string>", _STRICT))
    if element != "string":
        values = F.transform(
            values, lambda v: F.when(_starts(v, "{"), F.from_json(v, element, _STRICT))
        )
    return (
        F.when(_starts(text, "["), F.from_json(text, kind, _STRICT))
        .when(_starts(text, "{"), values)
        .when(_kind(text).isNotNull(), F.array(F.lit(None)).cast(kind))
    )


def parse_objects(text: Column, ddl: str) -> Column:
    """Parse an array of objects into an array of structs."""
    return parse_array(text, f"struct<{ddl}>")


def first(items: Column) -> Column:
    """First element, null when the array is empty or missing."""
    return F.get(items, F.lit(0))


def sum_items(
    items: Column,
    value: Callable[[Column], Column],
    dtype: str,
    where: Callable[[Column], Column] | None = None,
) -> Column:
    """Sum ``value`` over a nested array inside the row, without a shuffle.

    Null values are skipped; an empty or missing array sums to zero.
    """
    kept = F.filter(items, where) if where else items
    zero = F.lit(0).cast(dtype)
    total = F.aggregate(
        kept, zero, lambda acc, item: (acc + F.coalesce(value(item), zero)).cast(dtype)
    )
    return F.coalesce(total, zero)


def sum_or_null(items: Column, value: Callable[[Column], Column], dtype: str) -> Column:
    """As the aggregate ``sum``: null where the array holds no value that isn't null."""
    return F.aggregate(
        items,
        F.lit(None).cast(dtype),
        lambda acc, item: F.coalesce((acc + value(item)).cast(dtype), acc, value(item).cast(dtype)),
    )
