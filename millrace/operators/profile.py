"""Data profile: first rows, value counts, column facts, histograms, correlations.

Histograms and correlations take two readings of a table: means and extremes, then bin counts and
products around the means. Tasks add both up per Arrow batch and pack them into one row each. A whole
profile (``first_scan``, ``second_scan``) needs no more than these two either.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import NumericType

from millrace.functions.expressions import number
from millrace.operators.gather import column_moments, gather, matrix, merged_moments, moments_of, no_moments
from millrace.operators.prepare import column_ranges


def head_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in key order: a top-n per task, then one merge of at most n rows per task."""
    return df.orderBy(*keys).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per present value, most frequent first; NULL and NaN are not present."""
    kind = dict(df.dtypes)[column]
    present = number(column) if kind in ("double", "float") else F.col(column)
    counts = df.filter(present.isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def _per_column(df: DataFrame, facts: dict[str, list[Column]], common: list[Column]) -> DataFrame:
    """One aggregate over the table, turned into one row per column of the table."""
    names = df.columns
    flat = [facts[f][i].alias(f"{f}_{i}") for f in facts for i in range(len(names))]
    row = df.agg(*flat, *common)
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            *[F.col(f"{f}_{i}").alias(f) for f in facts],
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return row.select(F.inline(F.array(*entries)), *[c for c in row.columns if c.startswith("all_")])


def table_profile(df: DataFrame) -> DataFrame:
    """Column, type, non-null count and row count of the table."""
    facts = {"non_null": [F.count(F.nanvl(c, F.lit(None)) if t in ("double", "float") else F.col(c))
                          for c, t in df.dtypes]}
    return _per_column(df, facts, [F.count("*").alias("all_rows")]).withColumnRenamed("all_rows", "n_rows")


def null_flags(df: DataFrame) -> DataFrame:
    """Whether a column has any missing value. An empty table has none."""
    facts = {"has_null": [F.coalesce(F.max(_missing(c, t)), F.lit(False)) for c, t in df.dtypes]}
    return _per_column(df, facts, []).drop("type")


def _missing(column: str, kind: str) -> Column:
    gone = F.col(column).isNull()
    return (gone | F.isnan(column)) if kind in ("double", "float") else gone


# -- two readings -----------------------------------------------------------------------------


def bin_edges(low: float, high: float, bins: int) -> list[float]:
    """Inner and outer edges of equal-width bins."""
    step = (high - low) / bins
    return [i * step + low for i in range(bins)] + [high]


@dataclass
class Scan:
    """What the first reading of a table finds; moments are of the numeric columns, in table order."""

    schema: T.StructType
    n_rows: int
    present: list[int]
    numeric: list[str]
    moments: dict
    label_counts: dict
    label: str
    head: list[tuple]


def first_scan(df: DataFrame, label: str, keys: Sequence[str], n: int = 5) -> Scan:
    """Row and value counts, moments, the counts of every label and the first rows in key order.

    The label should be one of few values: a state holds them all. Rows of equal keys come in any order.
    """
    names, numeric = df.columns, numeric_columns(df)
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    width = len(numeric)
    order = [(k, "ascending") for k in keys]

    def start() -> dict:
        return {"rows": 0, "present": np.zeros(len(names), np.int64), "labels": Counter(), "head": None, **no_moments(width)}

    def first(rows: pa.Table) -> pa.Table:
        return rows.take(pc.sort_indices(rows, order, null_placement="at_start")[:n]) if order else rows.slice(0, n)

    def add(state: dict, batch: pa.RecordBatch) -> None:
        x = np.full((batch.num_rows, width), np.nan)
        for i, name in enumerate(numeric):
            x[:, i] = batch.column(name).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        gone = [batch.column(c).null_count for c in names]
        for i, name in enumerate(names):
            if name in floats:
                gone[i] = int(np.isnan(x[:, numeric.index(name)]).sum())
        state["rows"] += batch.num_rows
        state["present"] = state["present"] + batch.num_rows - np.array(gone, np.int64)
        for entry in pc.value_counts(batch.column(label)):
            value = entry["values"].as_py()
            if value is not None and value == value:
                state["labels"][value] += entry["counts"].as_py()
        rows = pa.Table.from_batches([batch])
        state["head"] = first(rows if state["head"] is None else pa.concat_tables([state["head"], rows]))
        state.update(merged_moments(state, moments_of(x)))

    def merge(a: dict, b: dict) -> dict:
        heads = [s["head"] for s in (a, b) if s["head"] is not None]
        return {
            "rows": a["rows"] + b["rows"], "present": a["present"] + b["present"], "labels": a["labels"] + b["labels"],
            "head": first(pa.concat_tables(heads)) if heads else None, **merged_moments(a, b),
        }

    found = gather(df, start, add, merge)
    moments = {k: found[k] for k in no_moments(0)}
    head = [tuple(r.values()) for r in found["head"].to_pylist()] if found["head"] is not None else []
    return Scan(df.schema, found["rows"], found["present"].tolist(), numeric, moments, dict(found["labels"]), label, head)


@dataclass
class Shapes:
    """What the second reading finds: bin counts, and six sums for every pair of columns."""

    columns: list[str]
    edges: dict[str, list[float]]
    counts: np.ndarray
    sums: np.ndarray


def second_scan(df: DataFrame, columns: Sequence[str], moments: dict, bins: int = 10, pairs: bool = True) -> Shapes:
    """Bin counts between the extremes, and with ``pairs`` products around the means, of these columns."""
    columns, width = list(columns), len(columns)
    edges = {}
    for c, low, high in zip(columns, moments["low"].tolist(), moments["high"].tolist(), strict=True):
        if low <= high:
            edges[c] = bin_edges(low, high, bins) if math.isfinite(low) and math.isfinite(high) else []
    inner = [np.array(edges[c][1:-1]) if edges.get(c) else None for c in columns]
    flat = [bool(edges.get(c)) and edges[c][0] == edges[c][-1] for c in columns]
    centre = np.where(np.isfinite(moments["mean"]), moments["mean"], 0.0)

    def start() -> dict:
        return {"counts": np.zeros((width, bins), np.int64), "sums": np.zeros((6, width, width) if pairs else (0,))}

    def add(state: dict, batch: pa.RecordBatch) -> None:
        x = matrix(batch, width)
        for i, cuts in enumerate(inner):
            if cuts is not None:
                own = x[:, i][~np.isnan(x[:, i])]
                place = np.full(len(own), bins // 2) if flat[i] else np.searchsorted(cuts, own, "right")
                state["counts"][i] += np.bincount(place, minlength=bins)
        if pairs:
            x -= centre
            here = ~np.isnan(x)
            x[~here] = 0.0
            mask, total = here.astype(np.float64), state["sums"]
            total[0] += mask.T @ mask
            total[1] += x.T @ mask
            total[3] += (x * x).T @ mask
            total[5] += x.T @ x

    def merge(a: dict, b: dict) -> dict:
        return {k: a[k] + b[k] for k in a}

    found = gather(df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(columns)]), start, add, merge)
    return Shapes(columns, edges, found["counts"], found["sums"])


def _local(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def histogram_table(spark: SparkSession, shapes: Shapes, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, bin, low, high, n``; a column that holds an infinite value has no bins and is an error."""
    rows = []
    for i, c in enumerate(shapes.columns):
        if columns is not None and c not in columns:
            continue
        ends = shapes.edges.get(c)
        if ends == []:
            raise ValueError(f"column {c} holds an infinite value")
        for k, n in enumerate(shapes.counts[i].tolist()):
            rows.append((c, k + 1, *(ends[k : k + 2] if ends else (None, None)), n))
    return _local(spark, rows, "column string, bin int, low double, high double, n long")


def correlation_table(spark: SparkSession, shapes: Shapes, columns: Sequence[str] | None = None) -> DataFrame:
    """``col_x, col_y, r`` of every ordered pair; NULL where a side is constant."""
    n, sa, _, qa, _, ab = shapes.sums
    sb, qb = sa.T, qa.T
    with np.errstate(all="ignore"):
        r = (n * ab - sa * sb) / (_root(n * qa, sa) * _root(n * qb, sb))
    rows = [
        (x, y, float(r[i, j]) if np.isfinite(r[i, j]) else None)
        for i, x in enumerate(shapes.columns) for j, y in enumerate(shapes.columns)
        if columns is None or (x in columns and y in columns)
    ]
    return _local(spark, rows, "col_x string, col_y string, r double")


def _root(squares: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Scaled deviation; what is only rounding noise counts as none."""
    rest = squares - total * total
    return np.where(rest > 1e-13 * squares, np.sqrt(np.maximum(rest, 0.0)), 0.0)


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between the extremes of each (numeric) column; empty bins included.

    Bins are half open, the last one is closed. A constant column falls into its middle bin, a column
    without values has empty bins without edges.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    ends = [(math.inf, -math.inf) if low is None else (low, high) for low, high in column_ranges(df, columns).values()]
    low, high = np.array(ends).reshape(-1, 2).T
    extremes = {"low": low, "high": high, "mean": np.zeros(len(columns))}
    return histogram_table(df.sparkSession, second_scan(df, columns, extremes, bins, pairs=False))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of every ordered pair of (numeric) columns, over the rows where both are present.

    NULL where a side is constant. Products are around the means, so that large offsets do not cancel.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    moments = column_moments(df, [number(c) for c in columns])
    return correlation_table(df.sparkSession, second_scan(df, columns, moments))
