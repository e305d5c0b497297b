"""Queries on reading, writing, column edits, scaling and merging."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import binary_label, signed_label
from millrace.operators import prepare, profile, sampling
from millrace.plans.registry import FE, FF, FL, ORDER_FEATURES, query, r, rounded, split_at, zscored
from millrace.session import scratch_path
from millrace.sources import frames, readers, writers


@query(f"""WITH {FF} SELECT o_orderkey,
  CASE WHEN label_012 = 2 THEN 1.0::DOUBLE ELSE label_012 END AS label_binary,
  CAST(CASE WHEN label_012 = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_level_1 FROM ff""")
def recode_rename(spark: SparkSession, folder: str) -> DataFrame:
    df = frames.order_frame_3(spark, folder).withColumn("is_level_1", binary_label("label_012"))
    df = prepare.rename(prepare.recode(df, "label_012", {2.0: 1.0}), "label_012", "label_binary")
    return df.select("o_orderkey", "label_binary", "is_level_1")


@query(f"""WITH {FF} SELECT o_orderkey, label_binary, o_totalprice, {r('avg_tax', 'avg_tax')} FROM (
  SELECT o_orderkey, CASE WHEN label_012 = 2 THEN 1.0::DOUBLE ELSE label_012 END AS label_binary,
    o_totalprice, avg_tax FROM ff
  UNION ALL SELECT o_orderkey, label::DOUBLE, o_totalprice, -1.0::DOUBLE FROM ff)""")
def merge_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The second table has its columns in another order and lacks one."""
    first = prepare.recode(frames.order_frame_3(spark, folder), "label_012", {2.0: 1.0})
    first = prepare.rename(first, "label_012", "label_binary")
    second = prepare.to_double(frames.order_frame(spark, folder), ["label"])
    second = prepare.rename(second, "label", "label_binary").drop("avg_tax").select(
        "o_totalprice", "label_binary", "o_orderkey"
    )
    merged = prepare.merge_tables([first.select("o_orderkey", "label_binary", "o_totalprice", "avg_tax"), second])
    return rounded(merged.fillna(-1.0, subset=["avg_tax"]), ["avg_tax"])


@query(f"""WITH {FF}, {zscored('ff', 'zs', ORDER_FEATURES, 'o_orderkey')}
SELECT o_orderkey, {', '.join(r(c, c) for c in ORDER_FEATURES)} FROM zs""")
def zscore_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = frames.order_frame(spark, folder).drop("label")
    return rounded(prepare.fit_zscore(df, ORDER_FEATURES).transform(df), ORDER_FEATURES)


_TRAIN_STATS = ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS l_{c}, max({c}) AS h_{c}" for c in ["value", "hour"]
)


@query(f"""WITH {FE}, {split_at('fe', 'sp', 'event_id', 'floor(n * 0.8::DOUBLE)')},
st AS (SELECT {_TRAIN_STATS} FROM sp WHERE part = 'train')
SELECT event_id, part, {r('(value - m_value) / s_value', 'value')}, {r('(hour - m_hour) / s_hour', 'hour')}
FROM sp, st""")
def zscore_from_train(spark: SparkSession, folder: str) -> DataFrame:
    parts = sampling.split_exact(frames.event_frame(spark, folder), ["event_id"]).drop("label")
    scaler = prepare.fit_zscore(parts.filter("part = 'train'"), frames.EVENT_FEATURES)
    return rounded(scaler.transform(parts), frames.EVENT_FEATURES)


@query(f"""WITH {FE}, {split_at('fe', 'sp', 'event_id', 'round_even(n * 0.75::DOUBLE, 0)', 1)},
st AS (SELECT {_TRAIN_STATS} FROM sp WHERE part = 'train')
SELECT event_id, part, {r('(value - l_value) / (h_value - l_value)', 'value')},
  {r('(hour - l_hour) / (h_hour - l_hour)', 'hour')} FROM sp, st""")
def minmax_from_train(spark: SparkSession, folder: str) -> DataFrame:
    size = sampling.nearest_size(0.75)
    parts = sampling.split_exact(frames.event_frame(spark, folder), ["event_id"], size, seed=1).drop("label")
    scaler = prepare.fit_minmax(parts.filter("part = 'train'"), frames.EVENT_FEATURES)
    return rounded(scaler.transform(parts), frames.EVENT_FEATURES)


@query(f"WITH {FL} SELECT l_quantity, l_tax FROM fl")
def drop_select_columns(spark: SparkSession, folder: str) -> DataFrame:
    return readers.features_only(frames.line_frame(spark, folder), "label").select("l_quantity", "l_tax")


@query(f"WITH {FE} SELECT event_id, label FROM fe")
def labels_only(spark: SparkSession, folder: str) -> DataFrame:
    return readers.labels_only(frames.event_frame(spark, folder), "label", "event_id")


@query(f"WITH {FE} SELECT event_id, CASE WHEN label = 0 THEN -1.0::DOUBLE ELSE label::DOUBLE END AS y FROM fe")
def signed_labels(spark: SparkSession, folder: str) -> DataFrame:
    return frames.event_frame(spark, folder).select("event_id", signed_label("label").alias("y"))


@query("""SELECT event_id, label::DOUBLE AS label, user_id::DOUBLE AS user_id FROM (
  SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label, user_id FROM events)""")
def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    df = frames.table(spark, folder, "events").select("event_id", bought.alias("label"), "user_id")
    return prepare.to_double(df, ["label", "user_id"])


@query(f"""WITH {FF}, {FL}, {FE}
SELECT 'orders' AS name, count(*) AS n_rows, 7::INTEGER AS n_columns FROM ff
UNION ALL SELECT 'lineitem', count(*), 5 FROM fl
UNION ALL SELECT 'events over 20 partitions', count(*), 4 FROM fe""")
def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        "orders": frames.order_frame(spark, folder),
        "lineitem": frames.line_frame(spark, folder),
        "events over 20 partitions": readers.spread(frames.event_frame(spark, folder), 20),
    }
    shapes = [profile.table_shape(df).withColumn("name", F.lit(name)) for name, df in tables.items()]
    return prepare.merge_tables(shapes)


@query(f"""WITH {FF} SELECT i::INTEGER AS position, name, any_value(total)::BIGINT AS n_rows
FROM (SELECT unnest(range(5)) AS i,
  unnest(['{"','".join(ORDER_FEATURES)}']) AS name, (SELECT count(*) FROM ff) AS total) GROUP BY i, name""")
def feature_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names in table order, next to the row count they describe."""
    df = frames.order_frame(spark, folder)
    names = readers.feature_names(df, "label", "o_orderkey")
    return df.agg(F.count("*").alias("n_rows")).select(
        F.posexplode(F.array(*[F.lit(n) for n in names])).alias("position", "name"), "n_rows"
    )


# -- round trips --------------------------------------------------------------------------


@query(f"""WITH {FF} SELECT o_orderkey, label::DOUBLE AS label, o_totalprice, sum_qty,
{r('avg_tax', 'avg_tax')} FROM ff""")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["o_orderkey", "label", "o_totalprice", "sum_qty", "avg_tax"]
    path = scratch_path(spark, "csv")
    writers.write_csv(frames.order_frame(spark, folder).select(*columns), path)
    return rounded(readers.read_csv(spark, path, columns, types={"o_orderkey": "long"}), ["avg_tax"])


@query(f"WITH {FE} SELECT event_id::BIGINT AS event_id, label, value, hour FROM fe")
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_csv(frames.event_frame(spark, folder), path)
    read = readers.read_csv_inferred(spark, path)
    return read.withColumns({"event_id": F.col("event_id").cast("long"), "label": F.col("label").cast("int")})


_THREE_PARTS = f"""WITH {FF}, sp AS (SELECT *, row_number() OVER (ORDER BY md5('2:' || o_orderkey)) AS rank,
  count(*) OVER () AS n FROM ff)
SELECT o_orderkey, label, o_totalprice, sum_qty, CASE WHEN rank <= n - ceil(n * 0.3::DOUBLE) THEN 'train'
  WHEN rank <= n - ceil(ceil(n * 0.3::DOUBLE) * 0.5::DOUBLE) THEN 'test' ELSE 'validation' END AS part FROM sp"""


def _split_files(spark: SparkSession, folder: str, form: str) -> DataFrame:
    """Three parts written once; features and labels of each are read apart and joined by key."""
    features = ["o_totalprice", "sum_qty"]
    df = frames.order_frame(spark, folder).select("o_orderkey", "label", *features)
    path = scratch_path(spark, "splits")
    parts = sampling.split_three_way(df, ["o_orderkey"])
    writers.write_splits(parts, path, df.columns, form=form)
    schema = parts.schema if form == "csv" else None
    joined = []
    for part in ("train", "test", "validation"):
        x = readers.read_split(spark, path, part, ["o_orderkey", *features], schema)
        y = readers.read_split(spark, path, part, ["o_orderkey", "label"], schema)
        joined.append(x.join(y, "o_orderkey").withColumn("part", F.lit(part)))
    return prepare.merge_tables(joined)


@query(_THREE_PARTS)
def split_files_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _split_files(spark, folder, "parquet")


@query(_THREE_PARTS)
def split_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _split_files(spark, folder, "csv")


@query(f"""WITH {FE} SELECT event_id, label::FLOAT::DOUBLE AS label, i::INTEGER AS position,
round(CASE i WHEN 0 THEN 1.0 WHEN 1 THEN value::FLOAT::DOUBLE ELSE hour END, 3) AS entry
FROM fe, range(3) AS t(i)""")
def labelled_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Label and array of features with a leading 1, taken apart again by position."""
    df = frames.event_frame(spark, folder)
    arrays = readers.labelled_arrays(df, "label", frames.EVENT_FEATURES, ["event_id"], bias=True)
    flat = arrays.select("event_id", F.col("label").cast("double"), F.posexplode("features").alias("position", "entry"))
    return flat.withColumn("entry", F.round(F.col("entry").cast("double"), 3))


@query(f"""WITH {FL} SELECT label::DOUBLE AS label, l_quantity, l_extendedprice, l_discount, l_tax FROM fl""")
def assembled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Feature vector of named columns, taken apart again."""
    df = prepare.assemble(frames.line_frame(spark, folder), frames.LINE_FEATURES)
    x = vector_to_array("features")
    return df.select(
        F.col("label").cast("double"), *[x[i].alias(c) for i, c in enumerate(frames.LINE_FEATURES)]
    )


@query(f"""WITH {FE} SELECT label::DOUBLE AS label, value, hour, count(*) AS n FROM fe GROUP BY ALL""")
def libsvm_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "libsvm")
    writers.write_libsvm(frames.event_frame(spark, folder), path, "label", frames.EVENT_FEATURES)
    x = vector_to_array("features")
    read = readers.read_libsvm(spark, path, 2).select("label", x[0].alias("value"), x[1].alias("hour"))
    return read.groupBy("label", "value", "hour").agg(F.count("*").alias("n"))


@query(f"""WITH {FE} SELECT event_id, x.label AS label, y.value AS value
FROM (SELECT event_id, label FROM fe) AS x JOIN (SELECT event_id, value FROM fe) AS y USING (event_id)""")
def join_features_labels(spark: SparkSession, folder: str) -> DataFrame:
    df = frames.event_frame(spark, folder)
    labels, features = readers.labels_only(df, "label", "event_id"), df.select("event_id", "value")
    return features.join(labels, "event_id", "inner").select("event_id", "label", "value")
