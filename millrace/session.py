"""Session helpers: local sessions for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "millrace", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A session for one machine. On a cluster the session comes from spark-submit instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must be able to reach.

    A machine-local folder is made only for a session within one process that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    made = getattr(context, "_millrace_folder", None)
    if made is None:
        made = context._millrace_folder = tempfile.mkdtemp(prefix="millrace-")
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/millrace-{name}-{uuid.uuid4().hex}"


def set_checkpoint_folder(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; a folder the session already has is left alone."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def freeze(df: DataFrame) -> DataFrame:
    """Store ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage, so generated row ids never change, also when executors are lost; and later
    passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def store_with_row_id(df: DataFrame, column: str = "row_id") -> DataFrame:
    """Store a table that has no unique key together with a row id to use as one.

    One pass, no shuffle. The ids are as stable as the written table; survey rows, of which many
    are equal, can then be split and drawn by them.
    """
    return freeze(df.withColumn(column, F.monotonically_increasing_id()))


def keep(df: DataFrame) -> DataFrame:
    """Persist for repeated passes: blocks that do not fit in memory go to executor disks."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def keep_spread(df: DataFrame) -> DataFrame:
    """The same, dealt out first where the rows lie in fewer partitions than the session has cores, as
    after reading a small stored table: every pass would leave the other cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return keep(df if df.rdd.getNumPartitions() >= cores else df.repartition(cores))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly over all cores, for many passes. A stored table lies in as many parts as it has
    row groups with rows, whatever its number of partitions, and a small one in one part."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def dealt(df: DataFrame, keys, partitions: int | None) -> DataFrame:
    """``df`` dealt over ``partitions`` by its keys and sorted by them in each.

    Learners that draw per partition then see the same rows in the same places however the input is
    laid out, so equal tables, seeds and ``partitions`` give equal models. ``None`` leaves the layout.
    """
    return df if partitions is None else df.repartition(partitions, *keys).sortWithinPartitions(*keys)
