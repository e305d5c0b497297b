"""SQL that trains: greedy Gini trees, boosted trees and the forward pass of perceptrons.

Written as chains of named tables, so that a learner can be held against what it should have learnt.
"""

from __future__ import annotations

from collections.abc import Sequence


def gini_tree(rows: str, features: Sequence[str], depth: int) -> str:
    """Named tables of a greedy tree over ``rows`` (key ``id``, ``label`` 0/1, ``fit`` true for training rows).

    ``t{depth}`` holds every row with the path of its leaf (root 1, children 2i and 2i + 1), ``node{d}`` the
    nodes of a level with their counts and best split, if they have one. Cuts are the middles of
    neighbouring values; of equal gains the first feature and the lowest cut win.
    """
    values = " UNION ALL ".join(f"SELECT DISTINCT {k} AS f, {c}::DOUBLE AS v FROM {rows} WHERE fit" for k, c in enumerate(features))
    listed = ", ".join(f"{c}::DOUBLE" for c in features)
    parts = [
        f"cut AS MATERIALIZED (SELECT f, (v + lag(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS c FROM ({values}))",
        f"t0 AS MATERIALIZED (SELECT id, label, fit, [{listed}] AS x, 1::BIGINT AS path FROM {rows})",
    ]
    gini = "(1.0::DOUBLE - ({0} / {1}::DOUBLE) * ({0} / {1}::DOUBLE) - ({2} / {1}::DOUBLE) * ({2} / {1}::DOUBLE))"
    for d in range(depth):
        whole = gini.format("(n - p)", "n", "p")
        left, right = gini.format("(ln - lp)", "ln", "lp"), gini.format("(rn - rp)", "rn", "rp")
        parts += [
            f"size{d} AS MATERIALIZED (SELECT path, count(*) AS n, sum(label) AS p FROM t{d} WHERE fit GROUP BY path)",
            f"""bin{d} AS MATERIALIZED (SELECT path, f, v, count(*) AS n, sum(label) AS p FROM (
                SELECT path, label, unnest(x) AS v, unnest(range(len(x))) AS f FROM t{d} WHERE fit) GROUP BY path, f, v)""",
            f"""side{d} AS (SELECT s.path, s.n, s.p, cut.f, cut.c, sum(b.n) AS ln, sum(b.p) AS lp
                FROM size{d} s JOIN bin{d} b USING (path) JOIN cut ON cut.f = b.f AND b.v <= cut.c
                WHERE s.p > 0 AND s.p < s.n GROUP BY s.path, s.n, s.p, cut.f, cut.c HAVING sum(b.n) < s.n)""",
            f"""gain{d} AS (SELECT *, {whole} - (ln / n::DOUBLE) * {left} - (rn / n::DOUBLE) * {right} AS gain
                FROM (SELECT *, n - ln AS rn, p - lp AS rp FROM side{d}))""",
            f"""best{d} AS MATERIALIZED (SELECT path, f, c, gain FROM gain{d} WHERE gain > 0
                QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, c) = 1)""",
            f"""t{d + 1} AS MATERIALIZED (SELECT id, label, fit, x, CASE WHEN b.path IS NULL THEN t.path
                WHEN x[f + 1] <= c THEN 2 * t.path ELSE 2 * t.path + 1 END AS path
                FROM t{d} t LEFT JOIN best{d} b ON b.path = t.path)""",
        ]
    parts.append(
        f"leaf AS MATERIALIZED (SELECT path, count(*) AS n, sum(label) AS p, CASE WHEN 2 * sum(label) > count(*) THEN 1 ELSE 0 END "
        f"AS prediction FROM t{depth} WHERE fit GROUP BY path)"
    )
    return ", ".join(parts)


def boosted_trees(
    rows: str, features: Sequence[str], rounds: int, leaves: int = 4, rate: float = 0.35, bins: int = 8,
    min_curvature: float = 6.0, l2: float = 1.0,
) -> str:
    """Named tables of boosting over ``rows`` (``id``, ``label``, ``part``; training rows are 'train').

    ``m{r}`` holds every row with its margin after round r.
    """
    cuts = ", ".join(
        f"(SELECT list(DISTINCT v ORDER BY v) FROM (SELECT {c}::DOUBLE AS v, row_number() OVER (ORDER BY {c}) AS k, "
        f"count(*) OVER () AS n FROM {rows} WHERE part = 'train') WHERE k IN ({', '.join(f'ceil({i} * n / {bins}.0::DOUBLE)' for i in range(1, bins))})) AS c{j}"
        for j, c in enumerate(features)
    )
    own = ", ".join(f"len(list_filter(c{j}, lambda t: t < {c}::DOUBLE))" for j, c in enumerate(features))
    parts = [
        f"cuts AS MATERIALIZED (SELECT {cuts})",
        f"m0 AS MATERIALIZED (SELECT id, label, part, [{own}] AS b, 0.0::DOUBLE AS m FROM {rows}, cuts)",
    ]
    for r in range(1, rounds + 1):
        parts.append(
            f"r{r}s0 AS MATERIALIZED (SELECT *, p - label AS g, p * (1 - p) AS h, 0 AS leaf "
            f"FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM m{r - 1}))"
        )
        for s in range(leaves - 1):
            at = f"r{r}s{s}"
            parts += [
                f"""{at}h AS (SELECT leaf, f, bin, sum(g) AS g, sum(h) AS h FROM (
                    SELECT leaf, g, h, unnest(b) AS bin, unnest(range({len(features)})) AS f FROM {at} WHERE part = 'train')
                    GROUP BY leaf, f, bin)""",
                f"""{at}c AS (SELECT leaf, f, bin, sum(g) OVER w AS g, sum(h) OVER w AS h, sum(g) OVER (PARTITION BY leaf, f) AS tg,
                    sum(h) OVER (PARTITION BY leaf, f) AS th FROM {at}h WINDOW w AS (PARTITION BY leaf, f ORDER BY bin))""",
                f"""{at}b AS MATERIALIZED (SELECT leaf AS split, f, bin FROM (SELECT *,
                    g * g / (h + {l2}) + (tg - g) * (tg - g) / (th - h + {l2}) - tg * tg / (th + {l2}) AS gain FROM {at}c
                    WHERE h >= {min_curvature} AND th - h >= {min_curvature}) WHERE gain > 1e-6
                    ORDER BY gain DESC, leaf, f, bin LIMIT 1)""",
                f"""r{r}s{s + 1} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN leaf = split AND b[f + 1] > bin THEN {s + 1} ELSE leaf END AS leaf)
                    FROM {at} t LEFT JOIN {at}b ON true)""",
            ]
        last = f"r{r}s{leaves - 1}"
        parts += [
            f"w{r} AS MATERIALIZED (SELECT leaf, -{rate} * sum(g) / (sum(h) + {l2}) AS w FROM {last} WHERE part = 'train' GROUP BY leaf)",
            f"m{r} AS MATERIALIZED (SELECT id, label, part, b, m + w AS m FROM {last} JOIN w{r} USING (leaf))",
        ]
    return ", ".join(parts)


def metrics(rows: str) -> str:
    """``part, n_rows, accuracy, precision, recall`` of (part, label, prediction) rows."""
    def share(hits: str, whole: str) -> str:
        return f"round(coalesce(count(*) FILTER (WHERE {hits}) / nullif(count(*) FILTER (WHERE {whole}), 0)::DOUBLE, 0), 9) + 0.0::DOUBLE"

    both = "label = 1 AND prediction = 1"
    return (
        f"SELECT part, count(*) AS n_rows, {share('label = prediction', 'true')} AS accuracy, "
        f"{share(both, 'prediction = 1')} AS precision, {share(both, 'label = 1')} AS recall FROM {rows} GROUP BY part"
    )


def formula_weights(layers: Sequence[int]) -> list[float]:
    """Weights that SQL can write down as well: whole thousandths from -0.5 to 0.5, by their place."""
    size = sum((i + 1) * o for i, o in zip(layers, layers[1:]))
    return [((k * 7919 + k * k % 997 * 31) % 1001 - 500) / 1000.0 for k in range(size)]


def forward_pass(rows: str, layers: Sequence[int]) -> str:
    """Named tables of a perceptron with ``formula_weights`` over ``rows`` (with an array ``x``).

    ``net`` holds every row with its class probabilities as the list ``q``.
    """
    weight = "(((k * 7919 + k * k % 997 * 31) % 1001 - 500) / 1000.0::DOUBLE)"
    parts, at, source, value = [], 0, rows, "x"
    for d, (i, o) in enumerate(zip(layers, layers[1:])):
        table = (
            f"(SELECT list(row ORDER BY j) FROM (SELECT j, list({weight} ORDER BY i) AS row FROM ("
            f"SELECT j, i, CASE WHEN i < {i} THEN {at} + i * {o} + j ELSE {at + i * o} + j END AS k "
            f"FROM range({o}) a(j), range({i + 1}) b(i)) GROUP BY j))"
        )
        parts.append(f"w{d} AS MATERIALIZED (SELECT {table} AS w)")
        dot = f"list_transform(w, lambda r: list_dot_product(r, list_append({value}, 1.0::DOUBLE)))"
        last = d == len(layers) - 2
        made = dot if last else f"list_transform({dot}, lambda z: 1 / (1 + exp(-z)))"
        parts.append(f"l{d} AS MATERIALIZED (SELECT t.* EXCLUDE (x), {made} AS x FROM {source} t, w{d})")
        source, value, at = f"l{d}", "x", at + (i + 1) * o
    parts.append(
        f"net AS MATERIALIZED (SELECT * EXCLUDE (e), list_transform(e, lambda v: v / list_sum(e)) AS q "
        f"FROM (SELECT * EXCLUDE (x), list_transform(x, lambda z: exp(z - list_max(x))) AS e FROM {source}))"
    )
    return ", ".join(parts)
