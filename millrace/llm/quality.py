"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are computed once per document. A boosted ensemble of small trees,
fitted on a bounded sample of labelled documents, is flattened into node arrays, and a batch of
documents walks all trees at once in numpy. On chosen statistics the score may only fall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import SPACES, blocks, filled, strings

WINDOW = 8
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "stop_share", "bang_share", "other_mark_share", "words_per_line",
)
# More symbols, repeated lines or repeated windows never raise the score.
FALLING = ("symbols_per_word", "dup_line_share", "repeat_share")


# -- statistics ---------------------------------------------------------------------------


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    codes, width = ids.astype(np.int64), 1
    while width < window:  # codes of runs twice as long, until they are exact names of windows
        pair = codes[:-width] * (int(codes.max()) + 1) + codes[width:]
        codes = np.unique(pair, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(codes)[codes] > 1
    edges = np.zeros(n + window, np.int64)
    starts = np.flatnonzero(twice)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts and the features of one whole text."""
    data = text.encode()
    seen = np.zeros(256, np.int64)
    names: dict[bytes, int] = {}
    ids = []
    for part in blocks(data):
        seen += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        ids.append(np.fromiter([names.setdefault(w, len(names)) for w in part.split()], np.int32))
    ids = np.concatenate(ids) if ids else np.empty(0, np.int32)
    n = len(ids)
    spaces = int(sum(seen[b] for b in SPACES))
    chars = int(seen.sum() - seen[0x80:0xC0].sum())
    symbols = int(sum(seen[ord(c)] for c in SYMBOLS))
    lines = [line for line in data.split(b"\n") if line and line.strip(SPACES)]
    repeated_lines = len(lines) - len(set(lines))
    repeats = repeated_words(ids)
    counts = [n, chars - spaces, symbols, repeated_lines, repeats]
    words, letters = max(n, 1), max(chars - spaces, 1)
    upper = int(seen[65:91].sum())
    marks = int(seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum())
    plain = int(sum(seen[ord(c)] for c in ".,!")) + symbols
    short = sum(1 for w in names if len(w) <= 3)
    return counts, [
        np.log1p(n), (chars - spaces) / words, symbols / words, repeated_lines / max(len(lines), 1), repeats / words,
        len(names) / words, upper / letters, int(seen[48:58].sum()) / letters, short / max(len(names), 1),
        int(seen[33]) / words, max(marks - plain, 0) / words, n / max(len(lines), 1),
    ]


# -- boosted trees ------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """All trees in one set of node arrays; a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality for the rows of ``x``, all trees walked together."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


class _Builder:
    """Collects the nodes of trees as they are grown."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def leaf(self, value: float) -> int:
        at = len(self.feature)
        for column, entry in (
            (self.feature, 0), (self.threshold, np.inf), (self.left, at), (self.right, at), (self.value, value),
        ):
            column.append(entry)
        return at

    def split(self, at: int, feature: int, threshold: float, left: int, right: int) -> None:
        self.feature[at], self.threshold[at], self.left[at], self.right[at] = feature, threshold, left, right
        self.value[at] = 0.0


def fit_forest(
    x: np.ndarray, y: np.ndarray, falling: tuple[int, ...] = (), trees: int = 60, depth: int = 3, rate: float = 0.2,
    bins: int = 64, penalty: float = 1.0, least: float = 1.0,
) -> Forest:
    """Boosting on the log-loss by Newton steps over quantile bins.

    Features in ``falling`` are monotonic: a split on one of them is allowed only if its right side
    gets the lower value, and the middle of the two then bounds everything grown below.
    """
    build, roots = _Builder(), []
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows], weight[rows]
        clipped = lambda a, b: np.clip(-a / (b + penalty), low, high)
        gain = lambda a, b, v: -(a * v + 0.5 * (b + penalty) * v * v)
        own = float(clipped(g.sum(), h.sum()))
        at = build.leaf(own * rate)
        best = (1e-6, 0, 0, 0.0, 0.0)
        if level < depth and len(rows) > 1:
            for j, cut in enumerate(cuts):
                if not len(cut):
                    continue
                gs = np.bincount(binned[rows, j], g, len(cut) + 1).cumsum()
                hs = np.bincount(binned[rows, j], h, len(cut) + 1).cumsum()
                lv, rv = clipped(gs[:-1], hs[:-1]), clipped(gs[-1] - gs[:-1], hs[-1] - hs[:-1])
                won = gain(gs[:-1], hs[:-1], lv) + gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1], rv)
                won -= gain(gs[-1], hs[-1], own)
                allowed = (hs[:-1] >= least) & (hs[-1] - hs[:-1] >= least)
                if j in falling:
                    allowed &= lv >= rv
                won[~allowed] = -np.inf
                k = int(won.argmax())
                if won[k] > best[0]:
                    best = (float(won[k]), j, k, float(lv[k]), float(rv[k]))
        gained, j, k, lv, rv = best
        if gained <= 1e-6:
            step[rows] = own * rate
            return at
        middle = (lv + rv) / 2 if j in falling else None
        goes_left = binned[rows, j] <= k
        left = grow(rows[goes_left], level + 1, low if middle is None else middle, high)
        right = grow(rows[~goes_left], level + 1, low, high if middle is None else middle)
        build.split(at, j, float(cuts[j][k]), left, right)
        return at

    for _ in range(trees if 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-score))
        gradient, weight, step = p - y, p * (1 - p), np.zeros(len(y))
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        score = score + step
    arrays = [np.asarray(c) for c in (build.feature, build.threshold, build.left, build.right, build.value)]
    arrays[0], arrays[2], arrays[3] = (a.astype(np.int64) for a in (arrays[0], arrays[2], arrays[3]))
    return Forest(*arrays, np.asarray(roots, np.int64), depth, base)


# -- Spark --------------------------------------------------------------------------------

_COUNT_TYPE = ", ".join(f"{c} bigint" for c in COUNTS)


def _described(forest: Forest | None):
    """A column function: counts and, with a forest, the log-odds; without one, the features."""
    last = "score double" if forest else "features array<double>"

    @F.arrow_udf(f"struct<{_COUNT_TYPE}, {last}>")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [statistics(t) for t in strings(texts)]
            counts = np.asarray([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            x = np.asarray([f for _, f in found], np.float64).reshape(-1, len(FEATURES))
            columns = [pa.array(c) for c in counts.T]
            if forest:
                columns.append(pa.array(forest.score(x)))
            else:
                columns.append(pa.array(list(x), pa.list_(pa.float64())))
            yield pa.StructArray.from_arrays(columns, names=[*COUNTS, "score" if forest else "features"])

    return describe


def labelled_sample(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` keys with a label of 0 or 1, those with the smallest hashes.

    A key with several labels takes the worst. Rows with a NULL key or label are left out.
    """
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    worst = marked.groupBy(key).agg(F.min(label).cast("double").alias("label"))
    return worst.orderBy(F.xxhash64(key), key).limit(rows)


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = 20_000, key: str = "doc_id", text: str = "text", label: str = "quality",
    **settings,
) -> Forest:
    """Fit on at most ``rows`` labelled documents (at 20,000 rows 2 MB of features reach the driver).

    Without usable labels, or with one class only, the forest is a constant.
    """
    sample = labelled_sample(labels, key, label, rows)
    texts = docs.select(F.col(key), filled(text).alias("text"))
    pairs = texts.join(F.broadcast(sample), key)  # at most ``rows`` rows of 16 bytes
    found = pairs.select(F.col(key).alias("k"), "label", _described(None)("text")["features"].alias("x")).toPandas()
    if found.empty:
        return fit_forest(np.zeros((1, len(FEATURES))), np.ones(1))
    found = found.sort_values("k", kind="stable")
    falling = tuple(FEATURES.index(f) for f in FALLING)
    return fit_forest(np.stack(found["x"]), found["label"].to_numpy(), falling, **settings)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def judge(docs: DataFrame, forest: Forest, text: str = "text", threshold: float = 0.0) -> DataFrame:
    """``docs`` with one struct column ``quality``: the counts, ``score`` (log-odds), ``base_failed``, ``kept``.

    One row per input row. A NULL or empty text has no words and fails. ``kept`` needs the base rules
    and a score of ``threshold`` or more.
    """
    described = docs.withColumn("quality", _described(forest)(filled(text)))
    failed = base_failed(F.col("quality.n_words"), F.col("quality.n_repeat_words"))
    passed = ~failed & (F.col("quality.score") >= threshold)
    return described.withColumn(
        "quality", F.col("quality").withField("base_failed", failed).withField("kept", passed)
    )
