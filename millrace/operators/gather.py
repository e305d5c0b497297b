"""Summaries that tasks pack into one row each and Spark merges in a tree.

A task adds its Arrow batches to a state (a dict of numbers and arrays) and emits it as one binary row.
The rows of every ``GROUPS``-th task meet in one merge, and the merged ones in a last, so a merge takes
one state after another and the driver gets one, whatever the number of tasks.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

GROUPS = 64
_PACKED = "slot int, state binary"


def gather(
    df: DataFrame, start: Callable[[], dict], add: Callable[[dict, pa.RecordBatch], None], merge: Callable[[dict, dict], dict]
) -> dict:
    """The state of the whole table; that of no rows for an empty one."""
    slots = GROUPS if df.rdd.getNumPartitions() > GROUPS else 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            add(state, batch)
        context = TaskContext.get()
        slot = (context.partitionId() if context else 0) % slots
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([pickle.dumps(state)])], names=["slot", "state"])

    def merged(rows: pa.Table) -> pa.Table:
        state = start()
        for packed in rows.column("state"):
            state = merge(state, pickle.loads(packed.as_py()))
        return pa.table({"slot": pa.array([0], pa.int32()), "state": pa.array([pickle.dumps(state)])})

    tree = df.mapInArrow(summed, _PACKED).groupBy("slot").applyInArrow(merged, _PACKED)
    if slots > 1:  # merged states all have slot 0
        tree = tree.groupBy("slot").applyInArrow(merged, _PACKED)
    found = tree.select("state").collect()
    return pickle.loads(found[0]["state"]) if found else start()


# -- moments --------------------------------------------------------------------------------


def matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    """The first columns of a batch, all double, with NaN where a value is missing."""
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[:columns]])


def no_moments(width: int) -> dict:
    """Per column: values present, their mean, squared distances from it, and extremes."""
    zero = np.zeros(width)
    return {"n": zero, "mean": zero, "m2": zero, "low": np.full(width, np.inf), "high": np.full(width, -np.inf)}


def moments_of(x: np.ndarray) -> dict:
    here = ~np.isnan(x)
    n = here.sum(0).astype(np.float64)
    with np.errstate(invalid="ignore"):
        mean = np.where(here, x, 0.0).sum(0) / np.maximum(n, 1.0)
        m2 = np.where(here, (x - mean) ** 2, 0.0).sum(0)
    low = np.where(here, x, np.inf).min(0, initial=np.inf)
    return {"n": n, "mean": mean, "m2": m2, "low": low, "high": np.where(here, x, -np.inf).max(0, initial=-np.inf)}


def merged_moments(a: dict, b: dict) -> dict:
    """Both together; means are merged pairwise, so nothing cancels however far they are from zero."""
    n = a["n"] + b["n"]
    with np.errstate(invalid="ignore"):
        share = b["n"] / np.maximum(n, 1.0)
        apart = b["mean"] - a["mean"]
        mean = np.where(a["n"] == 0, b["mean"], np.where(b["n"] == 0, a["mean"], a["mean"] + apart * share))
        m2 = a["m2"] + b["m2"] + np.where((a["n"] > 0) & (b["n"] > 0), apart * apart * a["n"] * share, 0.0)
    return {"n": n, "mean": mean, "m2": m2, "low": np.minimum(a["low"], b["low"]), "high": np.maximum(a["high"], b["high"])}


def column_moments(df: DataFrame, columns: list) -> dict:
    """Moments of the given columns (expressions, double, NULL or NaN where missing) in one reading."""
    width = len(columns)

    def add(state: dict, batch: pa.RecordBatch) -> None:
        state.update(merged_moments(state, moments_of(matrix(batch, width))))

    if not width:
        return no_moments(0)
    return gather(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), lambda: no_moments(width), add, merged_moments)
