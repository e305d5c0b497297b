"""Feature frames over the TPC-H-like test tables: key, label and numeric features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_FEATURES = ["o_totalprice", "n_lines", "sum_qty", "avg_disc", "avg_tax"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_FEATURES = ["value", "hour"]
DOC_FEATURES = ["n_chars", "toxic"]
BAND_FEATURES = ["price_band", "n_lines", "disc_band", "tax_band"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders_with_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with totals of their lines.

    Lines are pre-aggregated per order before the join, on both sides of the shuffle, so an order
    with very many lines costs one row per map task.
    """
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.avg("l_discount").alias("avg_disc"),
            F.avg("l_tax").alias("avg_tax"),
        )
    )
    orders = table(spark, folder, "orders")
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ORDER_FEATURES]
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", *filled
    )


def order_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Binary label: urgent orders (about one in five)."""
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).cast("int")
    return _orders_with_lines(spark, folder).select("o_orderkey", urgent.alias("label"), *ORDER_FEATURES)


def order_frame_3(spark: SparkSession, folder: str) -> DataFrame:
    """Three-level label: order status F, O, P as 0, 1, 2."""
    status = F.col("o_orderstatus")
    level = F.when(status == "F", 0.0).when(status == "O", 1.0).when(status == "P", 2.0)
    return _orders_with_lines(spark, folder).select("o_orderkey", level.alias("label_012"), *ORDER_FEATURES)


def line_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Lines have no unique key. Label: returned lines."""
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int")
    return table(spark, folder, "lineitem").select(returned.alias("label"), *LINE_FEATURES)


def heavy_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with more than 100 units, a label that the number of lines nearly gives away. The other
    features are in bands, few enough for a tree to cut between any two."""
    bands = {
        "label": (F.col("sum_qty") > 100).cast("int"),
        "price_band": F.floor(F.col("o_totalprice") / 20000.0).cast("double"),
        "disc_band": F.floor(F.col("avg_disc") * 200.0 + 1e-6).cast("double"),
        "tax_band": F.floor(F.col("avg_tax") * 200.0 + 1e-6).cast("double"),
    }
    return _orders_with_lines(spark, folder).withColumns(bands).select("o_orderkey", "label", "o_totalprice", *BAND_FEATURES)


def event_frame(spark: SparkSession, folder: str) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", 1).otherwise(0).cast("int")
    hour = F.hour("ts").cast("double")
    return table(spark, folder, "events").select(
        "event_id", bought.alias("label"), "value", hour.alias("hour")
    )


def embedding_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Ten classes, and class 0 against the rest as the binary label; features are one array."""
    first = F.when(F.col("label") == 0, 1).otherwise(0).cast("int")
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").alias("class"), first.alias("label"), "embedding"
    )


def doc_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents; only the length column of the documents is read."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    marks = table(spark, folder, "labels").select(
        "doc_id", F.col("quality").alias("label"), F.col("toxic").cast("double").alias("toxic")
    )
    return marks.join(docs, "doc_id", "inner").select("doc_id", "label", *DOC_FEATURES)
