"""Column edits, scaling and merging. Everything here is a projection or a union: no shuffle,
except one aggregate per fit and the optional de-duplication."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import number, shifted
from millrace.operators.gather import column_moments


def recode(df: DataFrame, column: str, values: Mapping[float, float]) -> DataFrame:
    """Replace listed values; others, and missing ones, stay."""
    return df.replace(dict(values), subset=[column])


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    if old not in df.columns:
        raise ValueError(f"no column {old}")
    return df.withColumnRenamed(old, new)


def class_rows(df: DataFrame, label: str, value: float) -> DataFrame:
    return df.filter(F.col(label) == value)


def to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def merge_tables(tables: Sequence[DataFrame], dedup: bool = False) -> DataFrame:
    """Rows of all tables, columns matched by name, absent columns NULL, copies kept."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return merged.dropDuplicates() if dedup else merged


def assemble(
    df: DataFrame, features: Sequence[str], output: str = "features", missing: str = "error"
) -> DataFrame:
    """Add the feature vector. ``missing``: 'error', 'skip' (drop the row) or 'keep' (NaN)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=missing)
    return assembler.transform(df)


@dataclass(frozen=True)
class Scaler:
    """Fitted ``(offset, width)`` per column. Applies to any table with these columns."""

    ranges: Mapping[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: shifted(number(c), offset, width) for c, (offset, width) in self.ranges.items()}
        )


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean and population deviation, in one reading, whatever the number of columns: tasks work them
    out per Arrow batch and pack them into one row each.

    A constant column is shifted by its value and gets width 1, so it scales to 0. Constancy is
    read off the extremes, which carry no rounding error. A column without values scales to NULL.
    """
    found = column_moments(df, [number(c) for c in columns])
    ranges: dict[str, tuple[float | None, float | None]] = {}
    for i, c in enumerate(columns):
        n, mean, m2, low, high = (float(found[k][i]) for k in ("n", "mean", "m2", "low", "high"))
        if n == 0:
            ranges[c] = (None, None)
        else:
            ranges[c] = (low, 1.0) if low == high else (mean, math.sqrt(m2 / n) if m2 >= 0 else math.nan)
    return Scaler(ranges)


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Minimum and range, in one aggregate. A constant column scales to NULL; values outside
    the fitted range are not clipped."""
    stats = _stats(df, columns, ("min", "max"))
    return Scaler(
        {c: (low, None if low is None else high - low) for c, (low, high) in stats.items()}
    )


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest value per column."""
    return _stats(df, columns, ("min", "max"))


def _stats(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> dict[str, tuple]:
    exprs = [
        getattr(F, name)(number(c)).alias(f"{i}_{name}")
        for i, c in enumerate(columns)
        for name in names
    ]
    row = df.agg(*exprs).first()
    return {c: tuple(row[f"{i}_{name}"] for name in names) for i, c in enumerate(columns)}
