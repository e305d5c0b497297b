"""Queries on first rows, counts, column facts, histograms and correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import profile
from millrace.plans.registry import FF, FL, ORDER_FEATURES, query, r, rounded
from millrace.sources import frames
from millrace.sources.frames import LINE_FEATURES


@query(f"""WITH {FF} SELECT o_orderkey, label, o_totalprice, n_lines, sum_qty FROM ff ORDER BY o_orderkey LIMIT 5""")
def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    df = frames.order_frame(spark, folder).select("o_orderkey", "label", "o_totalprice", "n_lines", "sum_qty")
    return profile.head_rows(df, ["o_orderkey"])


@query("""SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL
GROUP BY o_orderstatus ORDER BY n DESC, o_orderstatus""")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(frames.table(spark, folder, "orders"), "o_orderstatus")


_KINDS = [("label", "int"), *[(c, "double") for c in LINE_FEATURES]]


@query(f"WITH {FL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS n_rows FROM fl" for c, t in _KINDS))
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.table_profile(frames.line_frame(spark, folder))


@query(f"WITH {FL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) > count({c}) AS has_null FROM fl" for c, _ in _KINDS))
def null_flags(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_flags(frames.line_frame(spark, folder))


def _histogram_sql(columns: list[str]) -> str:
    """Bin numbers by comparison with the inner edges ``i * width / 10 + low``."""
    parts = []
    for c in columns:
        edges = [f"({i} * ((high - low) / 10) + low)" for i in range(1, 10)]
        bin_of = "1 + " + " + ".join(f"({c} >= {e})::INTEGER" for e in edges)
        parts.append(f"""SELECT '{c}' AS "column", i::INTEGER AS bin,
  {r("(i - 1) * ((high - low) / 10) + low", "low", 4)},
  {r("CASE i WHEN 10 THEN high ELSE i * ((high - low) / 10) + low END", "high", 4)},
  (SELECT count(*) FROM fl WHERE {bin_of} = i) AS n
FROM (SELECT min({c}) AS low, max({c}) AS high FROM fl), range(1, 11) AS t(i)""")
    return f"WITH {FL} " + " UNION ALL ".join(parts)


@query(_histogram_sql(["l_extendedprice"]))
def histogram_one(spark: SparkSession, folder: str) -> DataFrame:
    df = profile.histogram(frames.line_frame(spark, folder), ["l_extendedprice"])
    return rounded(df, ["low", "high"], 4)


@query(_histogram_sql(["label", *LINE_FEATURES]))
def histogram_all(spark: SparkSession, folder: str) -> DataFrame:
    df = profile.histogram(frames.line_frame(spark, folder), ["label", *LINE_FEATURES])
    return rounded(df, ["low", "high"], 4)


@query(f"WITH {FF} " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_x, '{b}' AS col_y, {r(f'corr({a}, {b})', 'r')} FROM ff"
    for a in ["label", *ORDER_FEATURES] for b in ["label", *ORDER_FEATURES]))
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    df = frames.order_frame(spark, folder)
    return rounded(profile.correlation_matrix(df, ["label", *ORDER_FEATURES]), ["r"])


WIDE_COLUMNS = 64


@query(f"""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v,
  unnest(range({WIDE_COLUMNS})) AS i FROM embeddings)
SELECT 'e' || a.i AS col_x, 'e' || b.i AS col_y, {r('corr(a.v, b.v)', 'r')}
FROM e AS a JOIN e AS b USING (vec_id) GROUP BY a.i, b.i""")
def correlation_matrix_wide(spark: SparkSession, folder: str) -> DataFrame:
    """All entries of the vectors as columns; pair moments come from Arrow batches."""
    names = [f"e{i}" for i in range(WIDE_COLUMNS)]
    df = frames.embedding_frame(spark, folder).select(
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    )
    return rounded(profile.correlation_matrix(df, names), ["r"])
