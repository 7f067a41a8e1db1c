"""Fields from JSON text by dotted path.

The text is parsed to a variant, so a document that does not parse yields null for every field
instead of whatever precedes the error, and the text ``"0"`` is told apart from the number ``0``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# JSON values that count as absent
_EMPTY = ('""', "0", "0.0", "-0.0", "false", "null", "[]", "{}")


def json_path(c: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(F.col(c) if isinstance(c, str) else c), "$." + path, kind)


def json_truthy(c: Column | str, path: str) -> Column:
    """The trimmed text of the field, or null if it is missing, empty, zero or false."""
    raw = F.to_json(json_path(c, path, "variant"))
    return F.when(~raw.isin(list(_EMPTY)), strip(json_path(c, path)))


def json_first(c: Column | str, paths: Sequence[str], default: str | None = None) -> Column:
    """The first usable field among several paths, else the default."""
    options = [json_truthy(c, path) for path in paths]
    if default is not None:
        options.append(F.lit(default))
    return F.coalesce(*options)


def json_fields(c: Column | str, fields: Mapping[str, str], kind: str = "double") -> list[Column]:
    """One column per ``name: path``, as ``kind``; what does not convert is null."""
    return [json_path(c, path, kind).alias(name) for name, path in fields.items()]
