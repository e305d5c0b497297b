"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits, so results are rounded."""
    return df.withColumns({c: round_column(c, digits) for c in columns})


def round_column(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def r(expression: str, name: str, digits: int = 6) -> str:
    """The SQL side of ``round_column``."""
    return f"round({expression}, {digits}) + 0.0::DOUBLE AS {name}"


# -- SQL building blocks ------------------------------------------------------------------

ORDER_FEATURES = ["o_totalprice", "n_lines", "sum_qty", "avg_disc", "avg_tax"]

# The order frame with both labels.
FF = """ff AS (
  SELECT o_orderkey,
    CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS label,
    CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE
      WHEN 'P' THEN 2.0::DOUBLE END AS label_012,
    o_totalprice,
    coalesce(n_lines, 0)::DOUBLE AS n_lines, coalesce(sum_qty, 0)::DOUBLE AS sum_qty,
    coalesce(avg_disc, 0)::DOUBLE AS avg_disc, coalesce(avg_tax, 0)::DOUBLE AS avg_tax
  FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
      avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""

# The line frame.
FL = """fl AS (
  SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS label,
    l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)"""

# The event frame.
FE = """fe AS (
  SELECT event_id, CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS label,
    value, hour(ts)::DOUBLE AS hour FROM events)"""


def zscored(source: str, name: str, columns: Sequence[str], keep: str) -> str:
    """``name`` holds ``keep`` and the scaled columns of ``source``, by its own statistics."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in columns)
    scaled = ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in columns)
    return (
        f"{name}_stats AS (SELECT {stats} FROM {source}), "
        f"{name} AS (SELECT {keep}, {scaled} FROM {source}, {name}_stats)"
    )


def split_at(source: str, name: str, key: str, rows: str, seed: int = 0) -> str:
    """The first ``rows`` rows in hash order are 'train', the others 'test'."""
    return (
        f"{name} AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{seed}:' || {key})) "
        f"<= {rows} THEN 'train' ELSE 'test' END AS part "
        f"FROM (SELECT *, count(*) OVER () AS n FROM {source}))"
    )


FLOOR_80 = "floor(n * 0.8::DOUBLE)"


def oversampled(source: str, name: str, key: str, within: str = "TRUE", seed: int = 0) -> str:
    """``source`` plus the drawn rows of its smaller class, for rates of at most one stream."""
    return f"""{name}_sizes AS (
  SELECT abs(p - q) AS d, least(p, q) AS m, CASE WHEN p < q THEN 1 ELSE 0 END AS c FROM (
    SELECT count(*) FILTER (WHERE label = 1 AND {within}) AS p,
      count(*) FILTER (WHERE label = 0 AND {within}) AS q FROM {source})),
{name}_rate AS (SELECT *, (d + 6.0::DOUBLE * sqrt(d) + 6.0::DOUBLE) / m AS rate FROM {name}_sizes),
{name}_steps AS (
  SELECT i, sum(exp(-rate + i * ln(rate) - lgamma(i + 1))) OVER (ORDER BY i) AS share
  FROM {name}_rate, range(0, 60) AS steps(i)),
{name}_cuts AS (
  SELECT list(printf('%013x', floor(share * 4503599627370496)::BIGINT) ORDER BY i) AS cuts
  FROM {name}_steps WHERE share < 1),
{name}_draws AS (
  SELECT s.*, unnest(range(1, 1 + len(list_filter(cuts,
    lambda cut: cut <= md5('{seed}:draw:' || {key} || ':1'))))) AS copy
  FROM {source} AS s, {name}_rate, {name}_cuts WHERE label = c AND {within}),
{name}_kept AS (
  SELECT * FROM {name}_draws
  QUALIFY row_number() OVER (ORDER BY md5('{seed}:keep:' || {key} || ':' || copy))
    <= (SELECT d FROM {name}_sizes)),
{name} AS (SELECT *, 0::BIGINT AS copy FROM {source} UNION ALL SELECT * FROM {name}_kept)"""


def descent(source: str, columns: Sequence[str], alpha: str, lam: float, updates: int) -> str:
    """Chained updates from zero weights; ``b{k}`` holds the weights after update k, ``g{k}`` the
    sums before it, ``m{k}`` loss and counts after it. ``source`` needs y and part."""
    width = range(len(columns) + 1)
    xs = ["1.0::DOUBLE", *columns]
    parts = ["b0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{j}" for j in width) + ")"]
    score = " + ".join(f"w{j} * {x}" for j, x in enumerate(xs))
    for k in range(1, updates + 1):
        sums = ", ".join(f"sum(slope * {x}) AS s{j}" for j, x in enumerate(xs))
        parts.append(
            f"g{k} AS (SELECT {sums} FROM (SELECT *, -y / (1 + exp(y * ({score}))) AS slope "
            f"FROM {source}, b{k - 1} WHERE part = 'train'))"
        )
        full = [f"(s{j} + 2 * {lam}::DOUBLE * w{j})" for j in width]
        steps = ", ".join(f"w{j} - ({alpha}) * {full[j]} AS w{j}" for j in width)
        norm = " + ".join(f"{f} * {f}" for f in full)
        parts.append(f"b{k} AS (SELECT {steps}, sqrt({norm}) AS norm FROM b{k - 1}, g{k})")
        cells = ", ".join(
            f"1 + count(*) FILTER (WHERE part = '{p}' AND z {sign} 0 AND y = {y}) AS {p}_{cell}"
            for p in ("train", "test")
            for cell, sign, y in (("tp", ">", 1), ("fp", ">", -1), ("tn", "<", -1), ("fn", "<", 1))
        )
        size = " + ".join(f"w{j} * w{j}" for j in width)
        parts.append(
            f"m{k} AS (SELECT {k} AS iteration, any_value(norm) AS norm, "
            f"sum(ln(1 + exp(-y * z))) FILTER (WHERE part = 'train') "
            f"+ {lam}::DOUBLE * any_value({size}) AS loss, {cells} "
            f"FROM (SELECT *, {score} AS z FROM {source}, b{k}))"
        )
    return ", ".join(parts)


def history_rows(updates: int | None) -> str:
    """History rows of ``descent``, or of ``long_descent`` without a number, without the step size."""
    rates = []
    for p in ("train", "test"):
        tp, fp, tn, fn = (f"{p}_{c}" for c in ("tp", "fp", "tn", "fn"))
        rates.append(r(f"({tp} + {tn}) / ({tp} + {fp} + {tn} + {fn})::DOUBLE", f"{p}_accuracy"))
        rates.append(r(f"{tp} / ({tp} + {fp})::DOUBLE", f"{p}_precision"))
        rates.append(r(f"{tp} / ({tp} + {fn})::DOUBLE", f"{p}_recall"))
    columns = ", ".join([r("loss", "loss", 4), r("norm", "grad_norm", 4), *rates])
    union = " UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(1, updates + 1)) if updates else "FROM ms"
    return f"SELECT iteration::INTEGER AS iteration, {columns} FROM ({union})"


def long_descent(source: str, columns: Sequence[str], alpha: str, lam: float, updates: int, eps: float) -> str:
    """The same as a recursion: ``bs`` holds the weights after update k and the norm before it, until
    ``updates`` or the first norm of at most ``eps``; ``ms`` loss and counts per update. Needs WITH RECURSIVE."""
    width = range(len(columns) + 1)
    xs = ["1.0::DOUBLE", *columns]
    score = " + ".join(f"w{j} * {x}" for j, x in enumerate(xs))
    weights = ", ".join(f"w{j}" for j in width)
    sums = ", ".join(f"sum(slope * {x}) + 2 * {lam}::DOUBLE * any_value(w{j}) AS s{j}" for j, x in enumerate(xs))
    steps = ", ".join(f"w{j} - ({alpha}) * s{j}" for j in width)
    norm = " + ".join(f"s{j} * s{j}" for j in width)
    cells = ", ".join(
        f"1 + count(*) FILTER (WHERE part = '{p}' AND z {sign} 0 AND y = {y}) AS {p}_{cell}"
        for p in ("train", "test")
        for cell, sign, y in (("tp", ">", 1), ("fp", ">", -1), ("tn", "<", -1), ("fn", "<", 1))
    )
    size = " + ".join(f"w{j} * w{j}" for j in width)
    return f"""bs(k, {weights}, norm) AS (SELECT 0, {", ".join("0.0::DOUBLE" for _ in width)}, NULL::DOUBLE
  UNION ALL SELECT k + 1, {steps}, sqrt({norm}) FROM (
    SELECT k, {", ".join(f"any_value(w{j}) AS w{j}" for j in width)}, {sums} FROM (
      SELECT *, -y / (1 + exp(y * ({score}))) AS slope FROM {source}, bs
      WHERE part = 'train' AND k < {updates} AND (norm IS NULL OR norm > {eps})) GROUP BY k)),
ms AS (SELECT k AS iteration, any_value(norm) AS norm, sum(ln(1 + exp(-y * z))) FILTER (WHERE part = 'train')
  + {lam}::DOUBLE * any_value({size}) AS loss, {cells} FROM (SELECT *, {score} AS z FROM {source}, bs WHERE k > 0) GROUP BY k)"""
