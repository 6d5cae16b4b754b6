"""Per-row data quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filled(value: Column, kind: T.DataType) -> Column:
    """Not NULL, not empty, not zero, not false."""
    if isinstance(kind, (T.NumericType,)):
        test = value != 0
    elif isinstance(kind, T.BooleanType):
        test = value
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(value) > 0
    elif isinstance(kind, T.StringType):
        test = value != ""
    else:
        test = value.isNotNull()
    return F.coalesce(test, F.lit(False))


def completeness(schema: T.StructType, names: Sequence[str]) -> Column:
    """Share of the named columns that carry a value, 0-1."""
    hits = [F.when(filled(F.col(n), schema[n].dataType), 1).otherwise(0) for n in names]
    return sum(hits, F.lit(0)) / F.lit(len(hits))


def _missing(value: Column) -> Column:
    return value.isNull() | (value.cast("string") == "")


def deduction_score(required: Sequence[Column], duration: Column, body: Column) -> Column:
    """100 less 10 per missing field, 20 for a negative duration, 10 for a negative size."""
    lost = sum([F.when(_missing(c), 10.0).otherwise(0.0) for c in required], F.lit(0.0))
    lost = lost + F.when(duration < 0, 20.0).otherwise(0.0) + F.when(body < 0, 10.0).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.lit(100.0) - lost)


def unit_score(required: Sequence[Column], duration_s: Column, status: Column) -> Column:
    """1 less 0.2 per missing field, 0.1 for an impossible duration, 0.1 for an odd status."""
    tenths = sum([F.when(_missing(c), 2).otherwise(0) for c in required], F.lit(0))
    tenths = tenths + F.when((duration_s < 0) | (duration_s > 300), 1).otherwise(0)
    tenths = tenths + F.when((status != "") & ~status.rlike(r"^[1-5]\d{2}$"), 1).otherwise(0)
    return F.greatest(F.lit(0.0), (F.lit(10) - tenths) / F.lit(10.0))


def issues(required: Mapping[str, Column], duration_ms: Column, body: Column) -> Column:
    """Array of problem codes: missing fields, over 60 s, over 100 MB."""
    found = [F.when(_missing(c), F.lit(f"missing_{name}")) for name, c in required.items()]
    found.append(F.when(duration_ms > 60000, F.lit("excessive_duration")))
    found.append(F.when(body > 100 * 1024 * 1024, F.lit("excessive_size")))
    return F.array_compact(F.array(*found))


def issue_score(found: Column) -> Column:
    return F.greatest(F.lit(0), F.lit(100) - F.size(found) * 20)
