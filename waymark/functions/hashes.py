"""Canonical JSON and digests: identical content gives identical bytes."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain(value: Any) -> Any:
    """What strict JSON can hold: NaN and infinities are null, whole floats stay floats, dates are ISO text."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, frozenset)):
        return [plain(v) for v in (sorted(value) if isinstance(value, (set, frozenset)) else value)]
    return value.isoformat() if hasattr(value, "isoformat") else value


def canonical(value: Any) -> str:
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def digest(value: Any) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def row_digest(*columns: Column) -> Column:
    """A digest of a row's columns, null told from empty."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]), 256)


def table_digest(df: DataFrame, columns: Iterable[str]) -> Column:
    """An aggregate over df that doesn't depend on the order of its rows: use in df.agg().

    The number of rows and the sums of four parts of their digests, 240 bits in all, which tasks add up on their own.
    """
    row = row_digest(*[F.col(c) for c in columns])
    part = lambda at: F.sum(F.conv(F.substring(row, at, 15), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)"))
    return F.sha2(F.concat_ws("|", F.count("*").cast("string"), *[part(at).cast("string") for at in (1, 16, 31, 46)]).cast("binary"), 256)


def site_key(values: Column) -> Column:
    """16 hexadecimal digits that name a set of values."""
    return F.substring(F.sha1(F.array_join(F.array_sort(F.array_distinct(values)), "|").cast("binary")), 1, 16)


def component_label(rank: Column) -> Column:
    return F.format_string("component_%06d", rank)
