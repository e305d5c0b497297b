"""Queries that train: forests, boosted trees and perceptrons against SQL that does the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import boosting, evaluate, model_walk, models, prepare, sampling
from millrace.plans import jobs
from millrace.plans.learner_sql import boosted_trees, formula_weights, forward_pass, gini_tree, metrics
from millrace.plans.registry import FF, ORDER_FEATURES, query, r, rounded, split_at, zscored
from millrace.session import freeze, scratch_path, spread
from millrace.sources import frames
from millrace.sources.frames import BAND_FEATURES

_KEY = ["o_orderkey"]
# One greedy tree, however many are asked for: what SQL can grow as well.
_GREEDY = {"subset": "all", "bootstrap": False}

_HEAVY = f"""{FF}, hv AS (SELECT o_orderkey, (sum_qty > 100)::INTEGER AS label, o_totalprice,
  floor(o_totalprice / 20000.0::DOUBLE) AS price_band, n_lines, floor(avg_disc * 200 + 1e-6) AS disc_band,
  floor(avg_tax * 200 + 1e-6) AS tax_band FROM ff)"""


def _below(seed: int, share: float) -> str:
    return f"md5('{seed}:' || o_orderkey) < printf('%013x', floor({share}::DOUBLE * 4503599627370496)::BIGINT)"


def _heavy(spark: SparkSession, folder: str) -> DataFrame:
    """The joined frame, stored once: the jobs read it several times."""
    return freeze(frames.heavy_frame(spark, folder))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return freeze(frames.order_frame(spark, folder))


# -- forests --------------------------------------------------------------------------------

_ONE_TREE = f"""WITH {_HEAVY}, ro AS (SELECT o_orderkey AS id, label, true AS fit, {", ".join(BAND_FEATURES)} FROM hv),
{gini_tree("ro", BAND_FEATURES, 2)},
low AS (SELECT path, count(*) AS n, sum(label) AS p FROM t2 GROUP BY path),
kept1 AS (SELECT b.path, f, c FROM best1 b JOIN low x ON x.path = 2 * b.path JOIN low y ON y.path = 2 * b.path + 1
  WHERE (2 * x.p > x.n) <> (2 * y.p > y.n)),
kept0 AS (SELECT b.path, f, c FROM best0 b JOIN size1 x ON x.path = 2 JOIN size1 y ON y.path = 3
  WHERE (2 * x.p > x.n) <> (2 * y.p > y.n) OR EXISTS (FROM kept1)),
inner_nodes AS (SELECT * FROM kept0 UNION ALL SELECT k.* FROM kept1 k, kept0),
every AS (SELECT path, n, p FROM size0 UNION ALL SELECT path, n, p FROM size1
  UNION ALL SELECT path, n, p FROM low WHERE path >= 4)
SELECT e.path::BIGINT AS path, coalesce(f, -1)::INTEGER AS feature, c AS threshold, n::BIGINT AS n_rows, p::BIGINT AS n_positive
FROM every e LEFT JOIN inner_nodes i ON i.path = e.path
WHERE e.path = 1 OR e.path // 2 IN (SELECT path FROM inner_nodes)"""


@query(_ONE_TREE)
def forest_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of one greedy tree of depth 2: the splits of best Gini gain. Sister leaves of one
    prediction are one leaf."""
    df = _heavy(spark, folder)
    model = models.fit_forest(df, BAND_FEATURES, trees=1, depth=2, **_GREEDY)
    nodes = model_walk.Trees.read(model_walk.node_table(spark, model)).paths()
    rows = [(n["path"], n["feature"], n["threshold"], int(sum(n["counts"])), int(n["counts"][1])) for n in nodes]
    return spark.createDataFrame(rows, "path long, feature int, threshold double, n_rows long, n_positive long")


_HASHED = f"""sp AS (SELECT *, CASE WHEN {_below(0, 0.7)} THEN 'train' ELSE 'test' END AS part FROM hv)"""


@query(f"""WITH {_HEAVY}, {_HASHED} SELECT part, count(*) AS n_rows, count(*) AS n_same_probability,
count(*) AS n_same_prediction FROM sp GROUP BY part""")
def forest_walk(spark: SparkSession, folder: str) -> DataFrame:
    """A forest of 20 drawn trees, stored, read as a node table and walked without its class: every row
    gets what the model itself gives it."""
    df = sampling.split_hash(_heavy(spark, folder), _KEY)
    model = models.fit_forest(df.filter("part = 'train'"), BAND_FEATURES)
    scored = models.score(model, df, BAND_FEATURES).withColumn("own", evaluate.class_probabilities())
    walked = model_walk.walk(scored, model_walk.Trees.read(model_walk.node_table(spark, model)), BAND_FEATURES, "walked")
    return _agreement(walked)


def _agreement(df: DataFrame) -> DataFrame:
    """Rows per part, and those with equal probabilities ``own`` and ``walked`` and the prediction of the latter."""
    apart = F.aggregate(F.zip_with("own", "walked", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: F.greatest(s, x))
    best = F.array_position("walked", F.array_max("walked")) - 1
    return df.groupBy("part").agg(
        F.count("*").alias("n_rows"),
        F.count_if(apart < 1e-9).alias("n_same_probability"),
        F.count_if(best == F.col("prediction")).alias("n_same_prediction"),
    )


def _scored(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "part", "label", F.col("prediction").cast("int").alias("prediction"))


@query(f"""WITH {_HEAVY}, {_HASHED}, ro AS (SELECT o_orderkey AS id, label, part = 'train' AS fit, part,
  {", ".join(BAND_FEATURES)} FROM sp), {gini_tree("ro", BAND_FEATURES, 4)}
SELECT id AS o_orderkey, part, ro.label, prediction FROM ro JOIN t4 USING (id) JOIN leaf USING (path)""")
def forest_score(spark: SparkSession, folder: str) -> DataFrame:
    df = sampling.split_hash(_heavy(spark, folder), _KEY)
    model = models.fit_forest(df.filter("part = 'train'"), BAND_FEATURES, **_GREEDY)
    return _scored(models.score(model, df, BAND_FEATURES), *_KEY)


_OWN = f"""cut AS (SELECT *, {_below(9, 0.8)} AS own FROM hv), first AS (SELECT * FROM cut WHERE own),
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in BAND_FEATURES)} FROM first),
zs AS (SELECT o_orderkey, label, own, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in BAND_FEATURES)} FROM cut, st)"""


def _two_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The orders of the forest jobs, and as their second table a fifth of all orders, set apart by key
    before anything is fitted; both scaled by the statistics of the first."""
    parts = sampling.split_hash(_heavy(spark, folder), _KEY, 0.8, seed=9)
    first, second = (parts.filter(F.col("part") == p).drop("part") for p in ("train", "test"))
    scaler = prepare.fit_zscore(first, BAND_FEATURES)
    return freeze(scaler.transform(first)), freeze(scaler.transform(second))


_FOREST_PARTS = f"""WITH {_HEAVY}, {_OWN.replace("cut AS", "owned AS").replace("FROM cut", "FROM owned")},
sp AS (SELECT *, CASE WHEN NOT own THEN 'second' WHEN {_below(1, 0.7)} THEN 'train' ELSE 'test' END AS part FROM zs)"""


def _forest_sql(parts: str, depth: int) -> str:
    return f"""{parts}, ro AS (SELECT o_orderkey AS id, label, part = 'train' AS fit, part, {", ".join(BAND_FEATURES)} FROM sp),
{gini_tree("ro", BAND_FEATURES, depth)},
pr AS (SELECT part, ro.label, prediction FROM ro JOIN t{depth} USING (id) JOIN leaf USING (path))
{metrics("pr")}"""


_RATES = ["accuracy", "precision", "recall"]


@query(_forest_sql(_FOREST_PARTS, 4))
def forest_job(spark: SparkSession, folder: str) -> DataFrame:
    """The forest job with every tree greedy: metrics of train, test and second table."""
    df, second = _two_tables(spark, folder)
    return rounded(jobs.forest_job(df, second, BAND_FEATURES, "label", _KEY, partitions=16, **_GREEDY).metrics, _RATES, 9)


_LARGE_PARTS = f"""WITH {_HEAVY}, {_OWN.replace("cut AS", "owned AS").replace("FROM cut", "FROM owned")},
ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY md5('101:' || o_orderkey)) AS rank,
  count(*) OVER (PARTITION BY own) AS n FROM zs),
sp AS (SELECT * EXCLUDE (n), CASE WHEN NOT own THEN 'second' WHEN rank <= n - ceil(n * 0.25::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM ranked)"""


@query(_forest_sql(_LARGE_PARTS, 30))
def large_forest_job(spark: SparkSession, folder: str) -> DataFrame:
    """100 trees of depth 30, every tree greedy."""
    df, second = _two_tables(spark, folder)
    return rounded(jobs.large_forest_job(df, second, BAND_FEATURES, "label", _KEY, partitions=16, **_GREEDY).metrics, _RATES, 9)


def _scored_rows(counts: DataFrame) -> DataFrame:
    """Rows per part and label that a job scored, whatever it predicted."""
    return counts.groupBy("part", "label").agg(F.sum("n").alias("n"))


@query(f"""{_FOREST_PARTS} SELECT part, label::DOUBLE AS label, count(*) AS n FROM sp GROUP BY part, label""")
def forest_job_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Drawn trees: all rows of both parts and of the second table are scored, once."""
    df, second = _two_tables(spark, folder)
    return _scored_rows(jobs.forest_job(df, second, BAND_FEATURES, "label", _KEY, partitions=16).counts)


_CLOCK = ["a", "b"]


@query(f"""WITH ev AS (SELECT event_id, (value >= 30 AND hour(ts) >= 8)::INTEGER AS label, least(floor(value / 10), 30) AS a, hour(ts)::DOUBLE AS b FROM events),
st AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM ev),
ro AS (SELECT 'e' || event_id AS id, NULL::BIGINT AS doc_id, label, true AS fit, (a - ma) / sa AS a, (b - mb) / sb AS b FROM ev, st
  UNION ALL SELECT 'd' || doc_id, doc_id, quality, false, (floor(n_chars / 200) - ma) / sa, (toxic * 23.0::DOUBLE - mb) / sb
  FROM labels JOIN documents USING (doc_id), st), {gini_tree("ro", _CLOCK, 4)}
SELECT doc_id, 'second' AS part, ro.label::INTEGER AS label, prediction FROM ro JOIN t4 USING (id) JOIN leaf USING (path) WHERE doc_id IS NOT NULL""")
def score_second_table(spark: SparkSession, folder: str) -> DataFrame:
    """A model of the events applied to documents, scaled by the statistics of the events."""
    value, hour = F.col("value"), F.hour("ts")
    events = frames.table(spark, folder, "events").select(
        ((value >= 30) & (hour >= 8)).cast("int").alias("label"),
        F.least(F.floor(value / 10), F.lit(30)).cast("double").alias("a"), hour.cast("double").alias("b"),
    )
    docs = frames.doc_frame(spark, folder).select(
        "doc_id", F.col("label").cast("int").alias("label"), F.floor(F.col("n_chars") / 200).cast("double").alias("a"),
        (F.col("toxic") * 23.0).alias("b"),
    )
    scaler = prepare.fit_zscore(events, _CLOCK)
    model = models.fit_forest(scaler.transform(events), _CLOCK, **_GREEDY)
    scored = models.score(model, scaler.transform(docs), _CLOCK).withColumn("part", F.lit("second"))
    return _scored(scored, "doc_id")


# -- boosted trees --------------------------------------------------------------------------

_BOOST = ["o_totalprice", "n_lines", "disc_band", "tax_band"]
_EXACT = {"accuracy": 1_000_000}  # quantiles as exact as SQL's
_BOOST_ROWS = f"""WITH {_HEAVY}, ranked AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('2:' || o_orderkey)) AS rank FROM hv),
ro AS (SELECT o_orderkey AS id, label, {", ".join(_BOOST)}, CASE WHEN rank <= n - ceil(n * 0.3::DOUBLE) THEN 'train'
  WHEN rank <= n - ceil(ceil(n * 0.3::DOUBLE) * 0.5::DOUBLE) THEN 'test' ELSE 'validation' END AS part FROM ranked)"""
_ROUNDS = 20
_BOOSTED = f"{_BOOST_ROWS}, {boosted_trees('ro', _BOOST, _ROUNDS)}"


@query(f"""{_BOOST_ROWS}, {boosted_trees("ro", _BOOST, 2)} SELECT id AS o_orderkey, part,
{r("m1.m", "margin_1")}, {r("m2.m", "margin_2")} FROM m1 JOIN m2 USING (id, part)""")
def boosted_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Margins after the first and the second round."""
    parts = freeze(sampling.split_three_way(_heavy(spark, folder).select(*_KEY, "label", *_BOOST), _KEY))
    model = boosting.fit(parts.filter("part = 'train'"), _BOOST, rounds=2, **_EXACT)
    first = boosting.Boosted(model.features, model.cuts, model.base, model.trees[:1])
    scored = boosting.score(model, boosting.score(first, parts).select(*_KEY, "part", *_BOOST, F.col("margin").alias("margin_1")))
    return rounded(scored.select(*_KEY, "part", "margin_1", F.col("margin").alias("margin_2")), ["margin_1", "margin_2"])


@query(f"""{_BOOSTED} SELECT id AS o_orderkey, part, label, (m > 0)::INTEGER AS prediction, {r("1 / (1 + exp(-m))", "probability")} FROM m{_ROUNDS}""")
def boosted_score(spark: SparkSession, folder: str) -> DataFrame:
    """20 rounds on the written training part, applied to all written parts."""
    job = jobs.boosted_job(_heavy(spark, folder), _BOOST, "label", _KEY, scratch_path(spark, "splits"), **_EXACT)
    scored = job.scored.withColumn("p", F.col("probability"))
    return rounded(_scored(scored, *_KEY, "p").withColumnRenamed("p", "probability"), ["probability"])


@query(f"""{_BOOSTED}, pr AS (SELECT part, label, (m > 0)::INTEGER AS prediction FROM m{_ROUNDS}) {metrics("pr")}""")
def boosted_job(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the three parts; training reads the parts written as CSV."""
    path = scratch_path(spark, "splits")
    job = jobs.boosted_job(_heavy(spark, folder), _BOOST, "label", _KEY, path, form="csv", **_EXACT)
    return rounded(job.metrics, _RATES, 9)


@query(f"""{_BOOST_ROWS} SELECT part, label::DOUBLE AS label, count(*) AS n FROM ro GROUP BY part, label""")
def boosted_job_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the three written parts are scored, once, at the settings of the job."""
    path = scratch_path(spark, "splits")
    return _scored_rows(jobs.boosted_job(_heavy(spark, folder), _BOOST, "label", _KEY, path).counts)


_CURVE = " UNION ALL ".join(
    f"""SELECT part, {k}::INTEGER AS iteration, count(*) AS n_rows, {r("avg(ln(1 + exp(CASE WHEN label = 1 THEN -m ELSE m END)))", "log_loss")},
{r("avg(((m > 0)::INTEGER = label)::INTEGER)", "accuracy")} FROM m{k} GROUP BY part""" for k in range(_ROUNDS + 1)
)


@query(f"{_BOOSTED} {_CURVE}")
def boosting_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and accuracy of all three parts after every round."""
    parts = freeze(sampling.split_three_way(_heavy(spark, folder).select(*_KEY, "label", *_BOOST), _KEY))
    model = boosting.fit(parts.filter("part = 'train'"), _BOOST, rounds=_ROUNDS, **_EXACT)
    return rounded(boosting.curve(model, parts), ["log_loss", "accuracy"])


# -- perceptrons ----------------------------------------------------------------------------
# Weights of the checked nets are given by a formula, as starting weights of a fit without steps.

_LOSS = "-ln(greatest(least(q[label + 1], 1 - 1e-15), 1e-15))"
_GUESS = "list_position(q, list_max(q)) - 1"
_NET = "SELECT *, " + _GUESS + " AS prediction, " + _LOSS + " AS loss FROM net"


def _fixed(layers: list[int]) -> dict:
    return {"initial": formula_weights(layers), "iterations": 0}


def _summary(rows: str) -> str:
    """The metrics of ``evaluate.summary_metrics`` with log-loss, per part."""
    return f"""sized AS (SELECT part, label, prediction, count(*) AS n, sum(loss) AS loss, sum(count(*)) OVER (PARTITION BY part, label) AS actual,
  sum(count(*)) OVER (PARTITION BY part, prediction) AS predicted FROM {rows} GROUP BY part, label, prediction)
SELECT part, sum(n)::BIGINT AS n_rows, {r("sum(n) FILTER (WHERE label = prediction) / sum(n)", "accuracy")},
{r("coalesce(sum(actual * n / predicted) FILTER (WHERE label = prediction) / sum(n), 0)", "weighted_precision")},
{r("coalesce(sum(n) FILTER (WHERE label = prediction) / sum(n), 0)", "weighted_recall")},
{r("coalesce(coalesce(sum(n) FILTER (WHERE label = 1 AND prediction = 1), 0) / sum(n) FILTER (WHERE label = 1), 0)", "recall_positive")},
{r("coalesce(coalesce(sum(n) FILTER (WHERE label = 0 AND prediction = 0), 0) / sum(n) FILTER (WHERE label = 0), 0)", "recall_negative")},
{r("sum(loss) / sum(n)", "log_loss")} FROM sized GROUP BY part"""


_TEN = [64, 64, 64, 10]


@query(f"""WITH ro AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x,
  CASE WHEN md5('1:' || vec_id) < printf('%013x', floor(0.75::DOUBLE * 4503599627370496)::BIGINT) THEN 'train' ELSE 'test' END AS part FROM embeddings),
{forward_pass("ro", _TEN)}, pr AS ({_NET})
SELECT vec_id, part, label, prediction::INTEGER AS prediction, {r("q[1]", "p_first")}, {r("q[10]", "p_last")} FROM pr""")
def perceptron_score(spark: SparkSession, folder: str) -> DataFrame:
    """Ten classes of vectors, features from an array column: predictions and probabilities of a fixed net."""
    df = frames.embedding_frame(spark, folder).drop("label").withColumnRenamed("class", "label")
    df = sampling.split_hash(df, ["vec_id"], 0.75, seed=1)
    model = models.fit_perceptron(df.filter("part = 'train'"), "embedding", layers=_TEN, **_fixed(_TEN))
    scored = models.score(model, df, "embedding").withColumn("q", evaluate.class_probabilities())
    ends = scored.withColumns({"p_first": F.get("q", F.lit(0)), "p_last": F.get("q", F.lit(9))})
    return rounded(ends.select("vec_id", "part", "label", F.col("prediction").cast("int"), "p_first", "p_last"), ["p_first", "p_last"])


_WIDE = [len(ORDER_FEATURES), 64, 64, len(ORDER_FEATURES)]
_NARROW = [len(ORDER_FEATURES), 64, 64, 2]
_SUMS = ["accuracy", "weighted_precision", "weighted_recall", "recall_positive", "recall_negative", "log_loss"]
_X = "[" + ", ".join(f"{c}::DOUBLE" for c in ORDER_FEATURES) + "] AS x"


@query(f"""WITH {FF}, {zscored("ff", "zs", ORDER_FEATURES, "o_orderkey, label")},
ro AS (SELECT o_orderkey, label, 'test' AS part, {_X} FROM zs WHERE NOT {_below(1, 0.75)}),
{forward_pass("ro", _WIDE)}, pr AS ({_NET}), {_summary("pr")}""")
def perceptron_job(spark: SparkSession, folder: str) -> DataFrame:
    """The job on scaled orders with an output as wide as the input, weights given: all test metrics."""
    df = _orders(spark, folder)
    df = prepare.fit_zscore(df, ORDER_FEATURES).transform(df)
    job = jobs.perceptron_job(df, ORDER_FEATURES, "label", _KEY, layers=_WIDE, **_fixed(_WIDE))
    return rounded(job.metrics, _SUMS)


_SAMPLED = f"""WITH {FF}, {split_at('ff', 'sp', 'o_orderkey', 'round_even(n * 0.75::DOUBLE, 0)', 1)}"""
_RANGES = ", ".join(f"min({c}) AS a_{c}, max({c}) - min({c}) AS w_{c}" for c in ORDER_FEATURES)
_SCALED = ", ".join(f"({c} - a_{c}) / w_{c} AS {c}" for c in ORDER_FEATURES)


@query(f"""{_SAMPLED}, st AS (SELECT {_RANGES} FROM sp WHERE part = 'train'),
mm AS (SELECT o_orderkey, label, part, {_SCALED} FROM sp, st), ro AS (SELECT o_orderkey, label, part, {_X} FROM mm),
{forward_pass("ro", _NARROW)}, pr AS ({_NET}), {_summary("pr")}""")
def perceptron_minmax_job(spark: SparkSession, folder: str) -> DataFrame:
    """The job on an exact sample, scaled to its ranges, weights given: metrics of both parts."""
    job = jobs.perceptron_minmax_job(_orders(spark, folder), ORDER_FEATURES, "label", _KEY, **_fixed(_NARROW))
    return rounded(job.metrics, _SUMS)


@query(f"""{_SAMPLED} SELECT part, label::DOUBLE AS label, count(*) AS n FROM sp GROUP BY part, label""")
def perceptron_job_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A trained net: all rows of the sample and of its complement are scored, once."""
    job = jobs.perceptron_minmax_job(_orders(spark, folder), ORDER_FEATURES, "label", _KEY)
    return _scored_rows(job.counts)


@query(f"""WITH {FF}, sp AS (SELECT CASE WHEN {_below(1, 0.75)} THEN 'train' ELSE 'test' END AS part FROM ff)
SELECT part, count(*) AS n_rows, count(*) AS n_same_probability, count(*) AS n_same_prediction FROM sp GROUP BY part""")
def perceptron_walk(spark: SparkSession, folder: str) -> DataFrame:
    """A net of two layers of 64 after five steps, applied from its weight vector by built-in functions
    alone: every row gets what the model itself gives it. The net takes long for a row, so the rows are dealt
    out over all cores first."""
    df = _orders(spark, folder)
    df = sampling.split_hash(prepare.fit_zscore(df, ORDER_FEATURES).transform(df), _KEY, 0.75, seed=1)
    model = models.fit_perceptron(df.filter("part = 'train'"), ORDER_FEATURES)
    scored = models.score(model, spread(df), ORDER_FEATURES).withColumn("own", evaluate.class_probabilities())
    inputs = F.array(*[F.col(c).cast("double") for c in ORDER_FEATURES])
    walked = model_walk.feed_forward(scored, inputs, model.weights.toArray().tolist(), list(model.getLayers()), "walked")
    return _agreement(walked)


_TWO = [64, 64, 64, 2]


@query(f"""WITH ro AS (SELECT vec_id, (label = 0)::INTEGER AS label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings),
{forward_pass("ro", _TWO)}, pr AS ({_NET}) SELECT {r("avg(loss)", "first_loss")}, true AS falls, true AS resumes FROM pr""")
def perceptron_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Training loss per iteration from given weights: the loss before the first step, whether no step
    raises it, and whether a fit from the weights reached goes on where they were."""
    df = models.vectors(frames.embedding_frame(spark, folder), "embedding").cache()
    # The learner's loss is a mean over blocks of rows; blocks of one row make it the mean over rows.
    settings = {"layers": _TWO, "block_rows": 1}
    model = models.fit_perceptron(df, "embedding", initial=formula_weights(_TWO), iterations=10, **settings)
    losses = [row["loss"] for row in models.training_curve(model, spark).orderBy("iteration").collect()]
    again = models.fit_perceptron(df, "embedding", initial=model.weights.toArray().tolist(), iterations=1, **settings)
    resumed = models.training_curve(again, spark).orderBy("iteration").first()["loss"]
    falls = len(losses) > 2 and all(b <= a for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    row = (losses[0], falls, abs(resumed - losses[-1]) < 1e-9)
    return rounded(spark.createDataFrame([row], "first_loss double, falls boolean, resumes boolean"), ["first_loss"])
