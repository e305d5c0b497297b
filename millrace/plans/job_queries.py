"""Queries that run whole jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import models, prepare
from millrace.plans import jobs
from millrace.plans.registry import FF, ORDER_FEATURES, query, r, rounded
from millrace.session import freeze, scratch_path
from millrace.sources import frames, readers, writers

_SCALED = ["o_totalprice", "sum_qty", "avg_disc"]
_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
_OUT = ", ".join(r(f"({c} - m_{c}) / s_{c}", c) for c in _SCALED)
_MERGED = f"""{FF}, mg AS (SELECT o_orderkey,
  CASE WHEN label_012 = 2 THEN 1.0::DOUBLE ELSE label_012 END AS label, o_totalprice, sum_qty, avg_disc FROM ff
  UNION ALL SELECT o_orderkey, label::DOUBLE, o_totalprice, sum_qty, avg_disc FROM ff),
st AS (SELECT {_STATS} FROM mg)"""


_KEY_TYPE = {"o_orderkey": "long"}


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    three = frames.order_frame_3(spark, folder).select("o_orderkey", "label_012", *_SCALED)
    binary = frames.order_frame(spark, folder)
    return three, binary.select("o_orderkey", F.col("label").cast("double"), *_SCALED)


@query(f"WITH {_MERGED} SELECT o_orderkey, label, {_OUT} FROM mg, st")
def train_table_job(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV files in, one scaled CSV table out, read back."""
    three, binary = _tables(spark, folder)
    paths = [scratch_path(spark, name) for name in ("three", "binary", "train")]
    writers.write_csv(three, paths[0])
    writers.write_csv(binary, paths[1])
    table, _ = jobs.train_table(
        readers.read_csv(spark, paths[0], three.columns, types=_KEY_TYPE),
        readers.read_csv(spark, paths[1], binary.columns, types=_KEY_TYPE),
        _SCALED, "label_012", "label",
    )
    writers.write_csv(table, paths[2])
    return rounded(readers.read_csv(spark, paths[2], table.columns, types=_KEY_TYPE), _SCALED)


# Rows of the second table as they are, and its null flags as rows (column, flag).
_FLAGS = " UNION ALL ".join(
    f"SELECT NULL::BIGINT, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, '{c}', count(*) > count({c}) FROM hl"
    for c in ["o_orderkey", "label", *_SCALED]
)
# Orders without lines have no quantity here.
_HOLED = "hl AS (SELECT o_orderkey, label::DOUBLE AS label, o_totalprice, CASE WHEN n_lines > 0 THEN sum_qty END AS sum_qty, avg_disc FROM ff)"


def _second_sql(stats: str) -> str:
    return f"""WITH {stats} SELECT o_orderkey, label, {_OUT}, NULL AS "column", NULL AS has_null FROM hl, st UNION ALL {_FLAGS}"""


def _second_table(spark: SparkSession, folder: str, scaler: prepare.Scaler | None) -> DataFrame:
    """The scaled table, written and read back, and its null flags below it."""
    held = F.when(F.col("n_lines") > 0, F.col("sum_qty"))
    df = frames.order_frame(spark, folder).withColumns({"sum_qty": held, "label": F.col("label").cast("double")})
    df = df.select("o_orderkey", "label", *_SCALED)
    path = scratch_path(spark, "second")
    _, flags = jobs.test_table(df, _SCALED, scaler, path)
    table = readers.read_csv(spark, path, df.columns, types=_KEY_TYPE)
    return rounded(prepare.merge_tables([table, flags]), _SCALED)


@query(_second_sql(f"{_MERGED}, {_HOLED}"))
def test_table_job(spark: SparkSession, folder: str) -> DataFrame:
    """The second table on the scale of the first."""
    _, scaler = jobs.train_table(*_tables(spark, folder), _SCALED, "label_012", "label")
    return _second_table(spark, folder, scaler)


_OWN = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)


@query(_second_sql(f"{FF}, {_HOLED}, st AS (SELECT {_OWN} FROM hl)"))
def test_table_own_scale(spark: SparkSession, folder: str) -> DataFrame:
    """The second table by its own statistics."""
    return _second_table(spark, folder, None)


_HEAD = "SELECT row_number() OVER (ORDER BY o_orderkey) AS k, * FROM ff ORDER BY o_orderkey LIMIT 5"
_LOOK = ["label", *ORDER_FEATURES]
_LOOK_BINS = " UNION ALL ".join(
    f"""SELECT '{fact}', '{c} ' || (1 + {" + ".join(f"({c} >= {i} * ((high - low) / 10) + low)::INTEGER" for i in range(1, 10))}), count(*)::DOUBLE
FROM ff, (SELECT min({c}) AS low, max({c}) AS high FROM ff) GROUP BY ALL""" for c, fact in [("label", "label_histogram"), *[(c, "histogram") for c in ORDER_FEATURES]]
)
_FACTS = " UNION ALL ".join([
    *[f"SELECT 'head' AS fact, k || ' {c}' AS item, round({c}, 6) + 0.0::DOUBLE AS value FROM ({_HEAD})" for c in ["o_orderkey", *_LOOK]],
    *[f"SELECT 'non_null', '{c}', count({c})::DOUBLE FROM ff" for c in ["o_orderkey", *_LOOK]],
    *[f"SELECT 'has_null', '{c}', (count(*) > count({c}))::INTEGER::DOUBLE FROM ff" for c in ["o_orderkey", *_LOOK]],
    "SELECT 'label_count', label::VARCHAR, count(*)::DOUBLE FROM ff GROUP BY label",
    _LOOK_BINS,
    *[f"SELECT 'correlation', '{a} {b}', round(corr({a}, {b}), 6) + 0.0::DOUBLE FROM ff" for a in ORDER_FEATURES for b in ORDER_FEATURES],
])


@query(f"WITH {FF} SELECT fact, item, value FROM ({_FACTS}) WHERE value IS NOT NULL")
def profile_job(spark: SparkSession, folder: str) -> DataFrame:
    """All seven profile tables of the order frame as (fact, item, value); bins without rows are left out."""
    df = freeze(frames.order_frame(spark, folder))
    shown = jobs.profile_tables(df, "label", ORDER_FEATURES, ["o_orderkey"])

    def facts(table: str, fact: str, item: Column, value: Column) -> DataFrame:
        return shown[table].select(F.lit(fact).alias("fact"), item.alias("item"), value.cast("double").alias("value"))

    column, place = F.col("column"), F.row_number().over(Window.orderBy("o_orderkey"))
    head = shown["head"].withColumn("k", place)
    named = [F.struct(F.concat_ws(" ", "k", F.lit(c)).alias("item"), F.round(F.col(c), 6).cast("double").alias("value")) for c in df.columns]
    shown["head"] = head.select(F.inline(F.array(*named)))
    bins = F.concat_ws(" ", column, "bin")
    return prepare.merge_tables([
        facts("head", "head", F.col("item"), F.col("value") + 0.0),
        facts("profile", "non_null", column, F.col("non_null")),
        facts("null_flags", "has_null", column, F.col("has_null").cast("int")),
        facts("label_counts", "label_count", F.col("label").cast("string"), F.col("n")),
        facts("label_histogram", "label_histogram", bins, F.col("n")).filter("value > 0"),
        facts("histograms", "histogram", bins, F.col("n")).filter("value > 0"),
        facts("correlation", "correlation", F.concat_ws(" ", "col_x", "col_y"), F.round("r", 6) + 0.0).filter("value IS NOT NULL"),
    ])


# -- models with a known answer ---------------------------------------------------------------

_HALF_DAY = """SELECT event_id, CAST(CASE WHEN hour(ts) >= 12 THEN 1 ELSE 0 END AS INTEGER) AS label,
CAST(CASE WHEN hour(ts) >= 12 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM events"""


def _half_day(spark: SparkSession, folder: str, step: int) -> DataFrame:
    """Events labelled by their half of the day; the feature is the hour in steps."""
    hour = F.hour("ts")
    afternoon = F.when(hour >= 12, 1).otherwise(0)
    return frames.table(spark, folder, "events").select(
        "event_id", afternoon.alias("label"), F.floor(hour / step).cast("double").alias("clock")
    )


@query(_HALF_DAY)
def forest_separable(spark: SparkSession, folder: str) -> DataFrame:
    """A label that one threshold explains: every tree finds it."""
    df = _half_day(spark, folder, 1)
    scored = models.score(models.fit_forest(df, ["clock"]), df, ["clock"])
    return scored.select("event_id", "label", F.col("prediction").cast("int").alias("prediction"))


@query(_HALF_DAY)
def boosted_separable(spark: SparkSession, folder: str) -> DataFrame:
    """The same for boosted trees, with as many feature values as they have bins."""
    df = _half_day(spark, folder, 3)
    scored = models.score(models.fit_boosted(df, ["clock"]), df, ["clock"])
    return scored.select("event_id", "label", F.col("prediction").cast("int").alias("prediction"))
