"""Hard-negative mining with anchor spanning-tree bounds.

Anchors travel to all rows in groups of bounded size. The anchors of a group hang in a minimum spanning
tree. Walking it from the root, the score of a row with a child anchor lies within the score (or its
bounds) with the parent plus or minus the length of the edge times the norm of the row. A row whose
bounds miss all windows of the child is not scored with it; the others are, exactly. A window is a range
of scores of which the best few rows are wanted; its lower end rises as a task finds rows, so bounds cut
ever more.

A group takes two readings of the rows: one finds the positives, whose window is open, the next the
negatives, whose windows the positives give. Every task returns a few rows per anchor and window, of
which the best are kept. Nothing is grouped by label, so a label of any size is spread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.clusters import finite
from millrace.llm.text import discard, stored, unused

GROUP = 2048  # anchors sent together; half a megabyte at 64 components
CHUNK = 2048  # rows bounded together: two numbers per anchor of the group
EXACT = 1 << 52  # products of norms up to this are exact in floating point
LARGEST = 1 << 62


@dataclass
class Tree:
    """A minimum spanning tree: anchors in walking order, the place of each one's parent, edge lengths."""

    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(vectors: np.ndarray) -> Tree:
    """Prim's algorithm over all distances; the tree starts at the first anchor."""
    points = vectors.astype(np.float64)
    n = len(points)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    best, via = np.full(n, np.inf), np.zeros(n, np.int64)
    waiting, at = np.ones(n, bool), 0
    for place in range(n):
        if place:
            at = int(np.where(waiting, best, np.inf).argmin())
            parent[place], edge[place] = via[at], best[at]
        order[place], waiting[at] = at, False
        apart = np.sqrt(((points - points[at]) ** 2).sum(1))
        nearer = waiting & (apart < best)
        best[nearer], via[nearer] = apart[nearer], place
    return Tree(order, parent, edge * (1 + 1e-9))


class Windows:
    """Per anchor, ranges of scores and the best rows found in each; ties go to the smaller key."""

    def __init__(self, low: list[list[int]], high: list[list[int]], take: int):
        self.low, self.high, self.take = low, high, take
        self.found: list[list[list[tuple[int, int, int]]]] = [[[] for _ in ends] for ends in low]

    def needed(self, anchor: int, w: int) -> int:
        """The smallest score that may still enter a window."""
        full = self.found[anchor][w]
        return max(self.low[anchor][w], -full[-1][0]) if len(full) == self.take else self.low[anchor][w]

    def overlap(self, anchor: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows whose bounds meet a window."""
        hit = np.zeros(len(low), bool)
        for w, top in enumerate(self.high[anchor]):
            hit |= (high >= self.needed(anchor, w)) & (low <= top)
        return hit

    def add(self, anchor: int, scores: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
        for w, top in enumerate(self.high[anchor]):
            inside = np.flatnonzero((scores >= self.needed(anchor, w)) & (scores <= top))
            if len(inside):
                best = inside[np.lexsort((rows[inside], keys[inside], -scores[inside]))[: self.take]]
                fresh = zip((-scores[best]).tolist(), keys[best].tolist(), rows[best].tolist(), strict=True)
                self.found[anchor][w] = sorted([*self.found[anchor][w], *fresh])[: self.take]


def scores_of(vector: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Whole inner products; as floating point where that is exact."""
    return rows @ vector if not exact else np.rint(rows.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)


def walk(tree: Tree, anchors: np.ndarray, vectors: np.ndarray, norms: np.ndarray, allowed, windows: Windows, keys, rows) -> int:
    """One chunk of rows against all anchors of a group; the number of scores worked out.

    ``allowed`` gives the rows that may enter the windows of an anchor.
    """
    n, size = len(vectors), len(anchors)
    low, high = np.empty((size, n)), np.empty((size, n))
    exact = float(norms.max(initial=0)) * float(np.sqrt((anchors.astype(np.float64) ** 2).sum(1).max(initial=0))) < EXACT
    scored = 0
    for place, at in enumerate(tree.order.tolist()):
        if tree.parent[place] < 0:
            chosen = np.arange(n)
        else:
            # Half a point and a part of a billion more than rounding can take.
            reach = tree.edge[place] * norms * (1 + 1e-9) + 0.5
            low[place], high[place] = low[tree.parent[place]] - reach, high[tree.parent[place]] + reach
            chosen = np.flatnonzero(windows.overlap(at, low[place], high[place]) & allowed(at))
        if not len(chosen):
            continue
        scored += len(chosen)
        found = scores_of(anchors[at], vectors[chosen], exact)
        low[place, chosen] = high[place, chosen] = found
        if tree.parent[place] < 0:
            fits = allowed(at)
            chosen, found = chosen[fits], found[fits]
        windows.add(at, found, keys[chosen], rows[chosen])
    return scored


_FOUND = "anchor int, place int, score bigint, key bigint, row bigint"
_SCHEMA = pa.schema(
    [("anchor", pa.int32()), ("place", pa.int32()), ("score", pa.int64()), ("key", pa.int64()), ("row", pa.int64())]
)


def _search(tree: Tree, anchors: np.ndarray, labels, own_rows, low, high, take: int, same: bool):
    """Task code: all rows of a task against one group; ``same`` asks for rows of the anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(low, high, take)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                vectors = _matrix(part.column("v"), anchors.shape[1])
                label = part.column("label").to_numpy(zero_copy_only=False)
                keys = part.column("key").to_numpy(zero_copy_only=False)
                rows = part.column("row").to_numpy(zero_copy_only=False)
                norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))

                def allowed(at: int, label=label, rows=rows) -> np.ndarray:
                    return (label == labels[at]) & (rows != own_rows[at]) if same else label != labels[at]

                walk(tree, anchors, vectors, norms, allowed, windows, keys, rows)
        found = [
            (at, place, -score, key, row)
            for at, ranges in enumerate(windows.found)
            for place, best in enumerate(ranges)
            for score, key, row in best
        ]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    made = np.zeros((len(column), dim), np.int64)
    made[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return made


def _best(found: DataFrame, take: int) -> DataFrame:
    """The first ``take`` rows of each window and their ranks; a sort that spills, cut short in the map tasks."""
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "key", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= take)


def mine(
    df: DataFrame,
    key: str,
    vector: str,
    label: Column,
    anchor: Column,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 5,
    least: int = 80,
    most: int = 100,
) -> DataFrame:
    """Per anchor, positive and rank: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``.

    Scores are inner products of ``floor(scale * x)``; higher ones come first, then smaller keys. Anchors
    are the rows for which ``anchor`` is true. Positives are the first ``n_positives`` other rows of an
    anchor's label; negatives, per positive, the first ``n_negatives`` rows of other labels whose score is
    ``least`` to ``most`` hundredths of the positive's. Rows with a NULL key, label or vector, or with a
    NULL, NaN or infinite component, take no part. Rows are told apart even where they repeat a key:
    repeated anchors give repeated results. A shorter vector counts as filled up with zeros. Anchors
    without positives, and positives without negatives, give no rows. Other columns are dropped. Scores
    that may pass 62 bits are an error.
    """
    spark = df.sparkSession
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    fits = F.col(key).isNotNull() & label.isNotNull() & finite(F.col(vector))
    row, = unused(df, "row")
    named = df.filter(fits).withColumn(row, F.monotonically_increasing_id())
    rows = stored(named.select(
        F.col(row).alias("row"), F.col(key).cast("long").alias("key"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), whole.alias("v"),
    ))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.count_if("anchor").alias("n"), F.max(F.size("v")).alias("dim"), F.max(norm).alias("norm")).first()
    if not facts["n"]:
        discard(rows)
        return spark.createDataFrame([], _RESULT)
    if facts["norm"] >= LARGEST:
        raise ValueError("vector components are too large for exact whole-number scores")
    dim = max(facts["dim"], 1)
    groups = math.ceil(facts["n"] / (GROUP // 2))
    # Anchors of one label and near keys stand together; neighbouring ranges make one group, and one that
    # came out too large is divided by hash.
    anchors = rows.filter("anchor").repartitionByRange(groups, "label", "key", "row")
    anchors = stored(anchors.withColumn("part", F.spark_partition_id()))
    parts = []
    for first, last, n in _runs(anchors.groupBy("part").agg(F.count("*")).orderBy("part").toLocalIterator()):
        cuts = math.ceil(n / GROUP)
        for cut in range(cuts):
            chosen = F.col("part").between(first, last) & (F.pmod(F.xxhash64("row"), F.lit(cuts)) == cut)
            parts.append(_group(rows, anchors.filter(chosen), dim, n_positives, n_negatives, least, most))
    discard(anchors, rows)
    found = parts[0]
    for other in parts[1:]:
        found = found.union(other)
    return found


def _runs(sizes) -> Iterator[tuple[int, int, int]]:
    """Neighbouring parts of together at most GROUP anchors: first part, last part, anchors."""
    run = None
    for part, n in sizes:
        if run and run[2] + n <= GROUP:
            run = (run[0], part, run[2] + n)
        else:
            if run:
                yield run
            run = (part, part, n)
    if run:
        yield run


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _group(rows: DataFrame, anchors: DataFrame, dim: int, n_positives: int, n_negatives: int, least: int, most: int) -> DataFrame:
    """The result for one group of anchors, stored."""
    spark = rows.sparkSession
    local = anchors.select("row", "key", "label", "v").orderBy("row").toArrow().combine_chunks()
    if not local.num_rows:
        return spark.createDataFrame([], _RESULT)
    vectors = _matrix(local["v"].combine_chunks(), dim)
    ids, labels, own = (local[c].to_numpy() for c in ("key", "label", "row"))
    tree, n = spanning_tree(vectors), len(vectors)
    everything = [[-LARGEST]] * n, [[LARGEST]] * n
    candidates = rows.select("row", "key", "label", "v")
    search = _search(tree, vectors, labels, own, *everything, n_positives, True)
    positives: list[list[tuple]] = [[] for _ in range(n)]
    for r in _best(candidates.mapInArrow(search, _FOUND), n_positives).toLocalIterator():
        positives[r["anchor"]].append((r["rank"], r["score"], r["key"]))
    positives = [[own_pair[1:] for own_pair in sorted(found)] for found in positives]
    # least * positive <= 100 * negative <= most * positive, in whole numbers
    low = [[-((-least * score) // 100) for score, _ in own_list] for own_list in positives]
    high = [[most * score // 100 for score, _ in own_list] for own_list in positives]
    search = _search(tree, vectors, labels, own, low, high, n_negatives, False)
    best = _best(candidates.mapInArrow(search, _FOUND), n_negatives)
    flat = [
        (at, place, int(ids[at]), key, score)
        for at, own_list in enumerate(positives)
        for place, (score, key) in enumerate(own_list)
    ]
    if not flat:
        return spark.createDataFrame([], _RESULT)
    pairs = spark.createDataFrame(pa.table(
        [pa.array(c, t) for c, t in zip(zip(*flat, strict=True), [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
        names=["anchor", "place", "anchor_id", "positive_id", "positive_score"],
    ))
    return stored(best.join(pairs, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    ))
