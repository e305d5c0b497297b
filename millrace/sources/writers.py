"""Table sinks. Each writes from the executors, a directory of files per call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import coefficient_line


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header in every file and no index column."""
    df.write.option("header", True).mode(mode).csv(path)


def write_splits(
    df: DataFrame, path: str, columns: Sequence[str], part: str = "part", mode: str = "errorifexists",
    form: str = "parquet",
) -> None:
    """All parts in one pass, one folder per part, as parquet or (``form="csv"``) as CSV with headers.

    ``columns`` should hold the key, so that feature and label projections of the same files
    can be tied together again. No shuffle: a task writes at most one file per part.
    """
    if form not in ("parquet", "csv"):
        raise ValueError("form must be 'parquet' or 'csv'")
    writer = df.select(*columns, F.col(part).alias("part")).write.mode(mode).partitionBy("part")
    writer.format(form).option("header", True).save(path)


def write_libsvm(
    df: DataFrame, path: str, label: str, features: Sequence[str], mode: str = "errorifexists"
) -> None:
    """Labelled vectors as text. A missing feature value is an error."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    vectors = assembler.transform(df).select(F.col(label).cast("double").alias("label"), "features")
    vectors.write.format("libsvm").mode(mode).save(path)


def write_coefficients(coefficients: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(term,value)`` lines; the table has one row per weight, so one file."""
    lines = coefficients.orderBy("position").select(coefficient_line("term", "value").alias("value"))
    lines.coalesce(1).write.mode(mode).text(path)


def write_history(history: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One row per training iteration."""
    history.coalesce(1).write.mode(mode).parquet(path)
