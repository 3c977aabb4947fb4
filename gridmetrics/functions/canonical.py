"""Canonical JSON text of run parameters, and the key made of it.

The text is that of a JSON writer with sorted names, a blank after every comma
and colon, and characters beyond ASCII kept; the key is the first 16
hexadecimal digits of its SHA-256. ``json_key`` gives it on the driver,
``canonical_json`` and ``json_key_column`` for whole tables of parameters.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_DIGITS = 16
_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r", '"': '\\"'}


def json_text(params: Mapping[str, Any]) -> str:
    return json.dumps(params, sort_keys=True, ensure_ascii=False)


def json_key(params: Mapping[str, Any]) -> str:
    return hashlib.sha256(json_text(params).encode("utf-8")).hexdigest()[:KEY_DIGITS]


def _quoted(c: Column) -> Column:
    """A JSON string: quotes, backslashes and the characters below a blank are escaped."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for code in [34, *range(32)]:
        out = F.replace(out, F.lit(chr(code)), F.lit(_SHORT.get(chr(code), f"\\u{code:04x}")))
    return F.concat(F.lit('"'), F.when(c.rlike(r'[\x00-\x1f"\\]'), out).otherwise(c), F.lit('"'))


def _value(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        text = _quoted(c)
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        text = c.cast("string")
    elif isinstance(kind, T.NullType):
        text = F.lit(None).cast("string")
    elif isinstance(kind, T.ArrayType):
        items = F.transform(c, lambda x: _value(x, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(kind, T.StructType):
        names = sorted(f.name for f in kind.fields)
        members = [F.concat(F.lit(json.dumps(n, ensure_ascii=False) + ": "), _value(c[n], kind[n].dataType)) for n in names]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        members = F.transform(F.array_sort(F.transform(F.map_keys(c), lambda k: k)),
                              lambda k: F.concat(_quoted(k), F.lit(": "), _value(c[k], kind.valueType)))
        text = F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))
    else:
        raise TypeError(f"no canonical JSON text for {kind.simpleString()}: give it as text")
    return F.when(c.isNull(), F.lit("null")).otherwise(text)


def canonical_json(params: Column, kind: T.DataType) -> Column:
    """The canonical JSON text of a column of the given type (texts, whole
    numbers, booleans, and arrays, structs and text-keyed maps of these)."""
    return _value(params, kind)


def json_key_column(params: Column, kind: T.DataType) -> Column:
    return F.substring(F.sha2(canonical_json(params, kind), 256), 1, KEY_DIGITS)
