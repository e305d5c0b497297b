"""Reproducible row order from a hash of the row key.

The hash is a 32-digit hex string whose text order is the order of the rows. A *cut* is a hex
prefix: rows whose hash sorts below it are on one side. Comparing text needs no number parsing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 32  # hex digits of an md5
ABOVE_ALL = "g"  # sorts after every hex digit


def row_hash(keys: Sequence[str | Column], seed: int | str = 0) -> Column:
    """md5 of ``seed:key1:key2...``.

    NULL has a text of its own, and in keys of several parts a colon or backslash within a part is
    escaped, so different keys never have the same text.
    """
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    if len(parts) > 1:
        parts = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p, F.lit("\\N")) for p in parts]))


def cut_at(share: float, digits: int = 13) -> str:
    """The cut below which a ``share`` of a uniform hash lies (13 digits = 52 bits)."""
    top = 16**digits
    step = int(share * top)
    return ABOVE_ALL if step >= top else f"{max(step, 0):0{digits}x}"
