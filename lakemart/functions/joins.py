"""Joins on key columns that treat NULL keys as equal (``<=>``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` where a NULL key matches a NULL key; the
    key columns appear once (coalesced for outer joins), like a USING join."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    j = left.join(r, cond, how)
    key_cols = [F.coalesce(left[k], r[f"_r_{k}"]).alias(k) for k in keys]
    rest = [left[c] for c in left.columns if c not in keys] + [r[c] for c in r.columns
                                                                if c not in [f"_r_{k}" for k in keys]]
    return j.select(*key_cols, *rest)
