"""Column builders for scoring, losses and scaling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """The value as a double with NaN read as missing (NULL)."""
    return F.nanvl(as_column(c).cast("double"), F.lit(None).cast("double"))


def dot_text(weights: Sequence[float], features: Sequence[str]) -> str:
    """``w0 + w1*x1 + ... + wd*xd`` as an expression text; the weights carry the bias first.

    One text is parsed at once, where building the same from Column objects takes a call to the
    JVM per operation.
    """
    if len(weights) != len(features) + 1:
        raise ValueError(f"{len(weights)} weights for {len(features)} features and a bias")
    bias, *rest = [_double_text(w) for w in weights]
    return " + ".join([bias, *[f"{w} * `{x}`" for w, x in zip(rest, features)]])


def _double_text(value: float) -> str:
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"


def dot(weights: Sequence[float], features: Sequence[str]) -> Column:
    return F.expr(dot_text(weights, features))


def with_bias(features: Sequence[str | Column]) -> Column:
    """Feature array with a leading constant 1."""
    return F.array(F.lit(1.0), *[as_column(x).cast("double") for x in features])


def logistic_loss(y: Column, z: Column) -> Column:
    """``log(1 + exp(-y*z))`` in the form that does not overflow."""
    margin = -y * z
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))


def logistic_slope(y: Column, z: Column) -> Column:
    """Derivative of the logistic loss in ``z``; times ``x_j`` it is the gradient entry."""
    return -y / (F.lit(1.0) + F.exp(y * z))


def signed_label(label: str | Column) -> Column:
    """0 becomes -1, every other value stays."""
    label = as_column(label).cast("double")
    return F.when(label == 0.0, F.lit(-1.0)).otherwise(label)


def binary_label(label: str | Column) -> Column:
    """1 where the label equals 1, else 0 (a missing label gives 0)."""
    return F.when(as_column(label) == 1.0, 1).otherwise(0).cast("int")


def hard_class(z: str | Column) -> Column:
    """-1, 0 or 1."""
    return F.signum(as_column(z)).cast("int")


def shifted(x: str | Column, offset: float | None, width: float | None) -> Column:
    """``(x - offset) / width``; NULL when the width is zero or unknown."""
    if offset is None or width is None:
        return F.lit(None).cast("double")
    return F.try_divide(as_column(x) - F.lit(float(offset)), F.lit(float(width)))


def coefficient_line(term: str | Column, value: str | Column) -> Column:
    """``(name,0.123456)``."""
    return F.format_string("(%s,%f)", as_column(term), as_column(value))
