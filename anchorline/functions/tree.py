"""Nested values as bounded JSON text for logs, by their schema: no row passes through Python."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Caps:
    """The most characters of a text, items of a list or map, and levels of nesting that a log keeps."""

    text: int = 120_000
    items: int = 200
    depth: int = 12


DEEPER, BINARY_NOTE = "…", "binary omitted from log"


def _quoted(text: Column) -> Column:
    """A JSON string."""
    inside = F.to_json(F.array(text))
    return F.substring(inside, F.lit(2), F.char_length(inside) - 2)


def _short(text: Column, most: int) -> Column:
    more = F.char_length(text) - most
    return F.when(more > 0, F.concat(F.left(text, F.lit(most)), F.lit(f"\n{DEEPER} ("), more.cast("string"), F.lit(" more chars)"))).otherwise(text)


def _left_over(size: Column, most: int, what: str) -> Column:
    return F.concat(F.lit("("), (size - most).cast("string"), F.lit(f" more {what})"))


def sanitised_json(value: Column, kind: T.DataType, caps: Caps | None = None, depth: int = 0) -> Column:
    """JSON text of ``value``, of type ``kind``, with long texts, lists and maps cut and noted, binaries as their size, and
    what lies too deep as an ellipsis. Nulls are null; numbers and booleans stay; other atoms are their text.

    The order of a map's entries is the map's own.
    """
    caps = caps or Caps()
    if depth > caps.depth:
        return F.lit(f'"{DEEPER}"')
    inner = lambda x, t: sanitised_json(x, t, caps, depth + 1)
    if isinstance(kind, T.StructType):
        names = kind.fieldNames()
        parts = [F.concat(_quoted(F.lit(f.name)), F.lit(":"), inner(value.getField(f.name), f.dataType)) for f in kind.fields[: caps.items]]
        if len(names) > caps.items:
            parts.append(F.lit(f'"{DEEPER}":"({len(names) - caps.items} more keys)"'))
        out = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        items = F.transform(F.slice(value, 1, caps.items), lambda x: inner(x, kind.elementType))
        more = F.when(F.size(value) > caps.items, F.array(F.concat(F.lit(f'"{DEEPER} '), _left_over(F.size(value), caps.items, "items"), F.lit('"')))).otherwise(F.array().cast("array<string>"))
        out = F.concat(F.lit("["), F.array_join(F.concat(items, more), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.slice(F.map_entries(value), 1, caps.items), lambda e: F.concat(_quoted(e["key"].cast("string")), F.lit(":"), inner(e["value"], kind.valueType)))
        more = F.when(F.size(value) > caps.items, F.array(F.concat(F.lit(f'"{DEEPER}":"'), _left_over(F.size(value), caps.items, "keys"), F.lit('"')))).otherwise(F.array().cast("array<string>"))
        out = F.concat(F.lit("{"), F.array_join(F.concat(entries, more), ","), F.lit("}"))
    elif isinstance(kind, T.BinaryType):
        out = F.concat(F.lit('{"_type":"bytes","size":'), F.octet_length(value).cast("string"), F.lit(f',"note":"{BINARY_NOTE}"}}'))
    elif isinstance(kind, T.BooleanType | T.IntegralType | T.FractionalType) and not isinstance(kind, T.DecimalType):
        out = value.cast("string")
    else:
        out = _quoted(_short(value.cast("string"), caps.text))
    return F.when(value.isNull(), F.lit("null")).otherwise(out)
