"""Python-literal list-of-dict text -> typed arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def repair_json(c) -> Column:
    """``': None'`` -> ``': null'``, then every backslash removed.

    Single-quoted strings stay: the JSON reader accepts them.  An escaped quote
    becomes unbalanced and a bare ``True``/``False`` is not JSON, so such a cell
    parses to NULL as a whole (same rule as the original loader).
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(c, ": None", ": null"), r"\\", "")


def parse_array(c, schema: DataType) -> Column:
    """Repaired text -> ``array<struct>``; a malformed cell -> NULL (PERMISSIVE)."""
    if isinstance(schema, StructType):
        schema = ArrayType(schema)
    return F.from_json(repair_json(c), schema, {"mode": "PERMISSIVE"})
