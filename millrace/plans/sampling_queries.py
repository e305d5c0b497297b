"""Queries on splits, samples, shuffles and balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import row_hash
from millrace.operators import prepare, sampling
from millrace.plans.registry import FE, FL, FLOOR_80, oversampled, query, split_at
from millrace.session import store_with_row_id
from millrace.sources import frames

_KEY = ["o_orderkey"]
_ORDERS = """fo AS (SELECT o_orderkey,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS label, o_totalprice FROM orders)"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).cast("int")
    return frames.table(spark, folder, "orders").select("o_orderkey", urgent.alias("label"), "o_totalprice")


@query(f"""WITH {FE} SELECT event_id, label, value, md5('7:' || event_id) AS place FROM fe ORDER BY place""")
def shuffle_rows(spark: SparkSession, folder: str) -> DataFrame:
    df = frames.event_frame(spark, folder).select("event_id", "label", "value")
    return sampling.shuffle_rows(df, ["event_id"], 7).withColumn("place", row_hash(["event_id"], 7))


@query(f"""WITH {_ORDERS}, {split_at('fo', 'sp', 'o_orderkey', FLOOR_80)}
SELECT o_orderkey, label, o_totalprice, part FROM sp""")
def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_exact(_orders(spark, folder), _KEY)


@query(f"""WITH {_ORDERS}, {split_at('fo', 'sp', 'o_orderkey', 'n - ceil(n * 0.25::DOUBLE)', 101)}
SELECT o_orderkey, label, o_totalprice, part FROM sp""")
def split_exact_test_share(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_exact(_orders(spark, folder), _KEY, sampling.rest_size(0.25), seed=101)


@query(f"""WITH {_ORDERS} SELECT o_orderkey, label, o_totalprice,
CASE WHEN ('0x' || substr(md5('0:' || o_orderkey), 1, 13))::BIGINT < floor(0.7::DOUBLE * 4503599627370496)
  THEN 'train' ELSE 'test' END AS part FROM fo""")
def split_hash(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_hash(_orders(spark, folder), _KEY, 0.7)


@query(f"""WITH {FE} SELECT event_id, label, value, hour,
CASE WHEN ('0x' || substr(md5('1:' || event_id), 1, 13))::BIGINT < floor(0.75::DOUBLE * 4503599627370496)
  THEN 'train' ELSE 'test' END AS part FROM fe""")
def split_hash_seeded(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_hash(frames.event_frame(spark, folder), ["event_id"], 0.75, seed=1)


@query(f"""WITH {FL} SELECT floor(count(*) * 0.8::DOUBLE)::BIGINT AS n_train,
count(*) - floor(count(*) * 0.8::DOUBLE)::BIGINT AS n_test, sum(l_quantity) AS quantity FROM fl""")
def split_without_key(spark: SparkSession, folder: str) -> DataFrame:
    """Lines repeat and have no key: part sizes are exact and no quantity is lost."""
    parts = sampling.split_exact(store_with_row_id(frames.line_frame(spark, folder)), ["row_id"])
    sizes = [F.count_if(F.col("part") == p).alias(f"n_{p}") for p in ("train", "test")]
    return parts.agg(*sizes, F.sum("l_quantity").alias("quantity"))


@query(f"""WITH {FL}, n AS (SELECT label, count(*) AS n FROM fl GROUP BY label)
SELECT label, (SELECT max(n) FROM n) AS n_rows, n AS n_originals FROM n""")
def oversample_without_key(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.oversample(store_with_row_id(frames.line_frame(spark, folder)), "label", ["row_id"])
    return df.groupBy("label").agg(F.count("*").alias("n_rows"), F.count_if(F.col("copy") == 0).alias("n_originals"))


@query("""WITH keys AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY l_orderkey),
placed AS (SELECT *, sum(c) OVER (ORDER BY md5('0:' || l_orderkey)) AS upto, floor(sum(c) OVER () * 0.8::DOUBLE) AS k FROM keys)
SELECT l_orderkey, greatest(0, least(c, k - (upto - c)))::BIGINT AS n_train, c AS n_rows FROM placed""")
def split_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by order: whole orders lie on either side, only the one at the cut is divided, exactly."""
    lines = frames.table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    parts = sampling.split_exact(lines, ["l_orderkey"])
    return parts.groupBy("l_orderkey").agg(F.count_if(F.col("part") == "train").alias("n_train"), F.count("*").alias("n_rows"))


@query("""WITH fl AS (SELECT l_partkey, (l_returnflag = 'R')::INTEGER AS label, l_quantity FROM lineitem),
n AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM fl)
SELECT label, count(*) AS n_originals, (SELECT greatest(p, q) FROM n) - count(*) AS n_drawn,
  sum(l_quantity)::DOUBLE AS quantity, label = (SELECT (p < q)::INTEGER FROM n) AS each_row_draws_by_itself
FROM fl GROUP BY label""")
def oversample_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by part: keys repeat, so rows of one key must not be drawn together."""
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int")
    lines = frames.table(spark, folder, "lineitem").select("l_partkey", returned.alias("label"), "l_quantity")
    rows = sampling.oversample(store_with_row_id(lines, "line"), "label", ["l_partkey"])
    drawn = F.count_if(F.col("copy") > 0)
    per_row = rows.groupBy("label", "l_partkey", "line", "l_quantity").agg(drawn.alias("d"))
    per_key = per_row.groupBy("label", "l_partkey").agg(
        F.count("*").alias("c"), F.sum("d").alias("s"), F.sum("l_quantity").alias("q"), (F.max("d") != F.min("d")).alias("apart"),
    )
    found = per_key.groupBy("label").agg(
        F.sum("c").alias("n_originals"), F.sum("s").alias("n_drawn"), F.sum("q").alias("quantity"),
        F.count_if("apart").alias("apart"), F.count_if(F.col("c") > 1).alias("several"),
    )
    alone = F.coalesce(F.col("apart") > 0.5 * F.col("several"), F.lit(False)).alias("each_row_draws_by_itself")
    return found.select("label", "n_originals", "n_drawn", F.col("quantity").cast("double"), alone)


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM orders")
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    """Both parts of Spark's own split together are the table."""
    parts = sampling.split_random(_orders(spark, folder), 0.7, seed=1)
    return prepare.merge_tables(parts).agg(
        F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys")
    )


@query(f"""WITH {_ORDERS}, ranked AS (SELECT *, count(*) OVER () AS n,
  row_number() OVER (ORDER BY md5('2:' || o_orderkey)) AS rank FROM fo)
SELECT o_orderkey, label, o_totalprice, CASE WHEN rank <= n - ceil(n * 0.3::DOUBLE) THEN 'train'
  WHEN rank <= n - ceil(ceil(n * 0.3::DOUBLE) * 0.5::DOUBLE) THEN 'test' ELSE 'validation' END AS part FROM ranked""")
def split_three_way(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_three_way(_orders(spark, folder), _KEY)


_SAMPLE = split_at("fo", "sp", "o_orderkey", "round_even(n * 0.75::DOUBLE, 0)", 1)


@query(f"""WITH {_ORDERS}, {_SAMPLE} SELECT o_orderkey, label, o_totalprice, part = 'train' AS sampled FROM sp""")
def sample_complement(spark: SparkSession, folder: str) -> DataFrame:
    taken, others = sampling.sample_exact(_orders(spark, folder), _KEY)
    return prepare.merge_tables(
        [taken.withColumn("sampled", F.lit(True)), others.withColumn("sampled", F.lit(False))]
    )


@query(f"""WITH {_ORDERS}, {_SAMPLE} SELECT o_orderkey, label, o_totalprice FROM sp WHERE part = 'test'""")
def complement_by_key(spark: SparkSession, folder: str) -> DataFrame:
    df = _orders(spark, folder)
    taken, _ = sampling.sample_exact(df, _KEY)
    return sampling.complement(df, taken, _KEY)


@query(f"""WITH {_ORDERS} SELECT p AS n_pos, q AS n_neg, abs(p - q) AS difference,
CAST(CASE WHEN p < q THEN 1 ELSE 0 END AS INTEGER) AS minority FROM (
  SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM fo)""")
def class_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.class_sizes(_orders(spark, folder), "label")


@query(f"""WITH {_ORDERS} SELECT label = 1 AS positive, o_orderkey, o_totalprice FROM fo WHERE label IN (0, 1)""")
def class_partition(spark: SparkSession, folder: str) -> DataFrame:
    df = _orders(spark, folder)
    return prepare.merge_tables(
        [
            prepare.class_rows(df, "label", value).select(F.lit(value == 1).alias("positive"), *_KEY, "o_totalprice")
            for value in (1, 0)
        ]
    )


@query(f"""WITH {_ORDERS}, {oversampled('fo', 'os', 'o_orderkey')}
SELECT o_orderkey, label, o_totalprice, copy FROM os""")
def oversample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.oversample(_orders(spark, folder), "label", _KEY)


@query(f"""WITH {_ORDERS}, {split_at('fo', 'sp', 'o_orderkey', FLOOR_80)},
{oversampled('sp', 'os', 'o_orderkey', "part = 'train'")}
SELECT o_orderkey, label, o_totalprice, part, copy FROM os""")
def oversample_train_part(spark: SparkSession, folder: str) -> DataFrame:
    parts = sampling.split_exact(_orders(spark, folder), _KEY)
    return sampling.oversample(parts, "label", _KEY, within=F.col("part") == "train")
