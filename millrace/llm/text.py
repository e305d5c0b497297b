"""Helpers shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

# A word is a run of bytes other than these; bytes.split() without arguments cuts at just these.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it from being a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def filled(column: str | Column) -> Column:
    """A text column in which NULL is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def strings(texts: pa.Array) -> Iterator[str]:
    """The texts of an Arrow column, one at a time; NULL is empty."""
    for value in texts:
        yield value.as_py() or ""


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8, one at a time; NULL is empty."""
    for value in texts.cast(pa.binary()):
        yield value.as_py() or b""


_SPACE = {bytes: re.compile(rb"[ \t-\r]"), str: re.compile(r"[ \t-\r]")}


def blocks(text, block: int = BLOCK) -> Iterator:
    """A text (str or bytes) in order, in parts of about ``block`` characters cut at ASCII white space.

    A very long text is so never held as one list of words, which takes many times its size.
    """
    start, size = 0, len(text)
    while start < size:
        cut = _SPACE[type(text)].search(text, start + block) if start + block < size else None
        end = cut.start() if cut else size
        yield text[start:end]
        start = end


def word_blocks(data: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in order, block by block."""
    for part in blocks(data, block):
        yield part.split()


def read_file(path: str) -> bytes:
    """A vocabulary file, read on the driver and sent to the tasks with the job."""
    return Path(path).read_bytes()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffle files of the job are dropped at
    its end, since the table replaces them."""
    spark = df.sparkSession
    path = scratch_path(spark, "text")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
