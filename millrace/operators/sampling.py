"""Splits, samples, shuffles and balancing, all reproducible by key.

Rows are ordered by a seeded hash of their key. The first k rows in that order are the rows
whose hash lies below a cut, and the cut is found by counting rows per hash prefix. So an exact
split moves no rows: a few passes over the key columns count at most 4096 groups each, and the
part of a row is a comparison with a constant. Where rows of one key lie on both sides, those rows
alone are ordered further, by a hash of their contents and then by a row id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import ABOVE_ALL, DIGITS, cut_at, row_hash
from millrace.session import store_with_row_id

STEP = 3  # hex digits per counting pass: 16**3 groups
ROW_ID = "_row_id"
STREAM_RATE = 8.0  # mean draws per row and stream
BLOCK_STREAMS = 64  # streams of one row that stay together


# -- cuts ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tie:
    """A rank among rows of one hash, of which ``rest`` lie below it."""

    hash: str
    rest: int


def find_cuts(
    df: DataFrame,
    hashed: Column,
    ranks: Callable[[int], Sequence[int]],
    at_least: int = 0,
) -> tuple[int, list[str | Tie]]:
    """Row count n, and for each rank k in ``ranks(n)`` the cut with exactly k hashes below it.

    Where equal hashes lie on both sides there is no such cut, but a ``Tie``. With fewer than
    ``at_least`` rows no cut is looked for.
    """
    hashes = df.select(hashed.alias("h"))
    counts = _prefix_counts(hashes, STEP)
    n = sum(counts.values())
    if n < at_least:
        return n, []
    wanted = list(ranks(n))
    cuts: dict[int, str | Tie] = {}
    open_ranks: dict[int, tuple[str, int]] = {}
    for k in wanted:
        _descend(k, "", k, counts, cuts, open_ranks)
    length = STEP
    while open_ranks and length < DIGITS:
        length = min(length + STEP, DIGITS)
        prefixes = sorted({p for p, _ in open_ranks.values()})
        near = F.substring("h", 1, len(prefixes[0])).isin(prefixes)
        counts = _prefix_counts(hashes.filter(near), length)
        pending, open_ranks = open_ranks, {}
        for k, (prefix, rest) in pending.items():
            inside = {p: c for p, c in counts.items() if p.startswith(prefix)}
            _descend(k, prefix, rest, inside, cuts, open_ranks)
    cuts |= {k: Tie(prefix, rest) for k, (prefix, rest) in open_ranks.items()}
    return n, [cuts[k] for k in wanted]


def _prefix_counts(hashes: DataFrame, digits: int) -> dict[str, int]:
    """Rows per hash prefix: at most 16**STEP entries per prefix of the pass before."""
    groups = hashes.groupBy(F.substring("h", 1, digits).alias("p")).agg(F.count("*").alias("c"))
    return {row["p"]: row["c"] for row in groups.collect()}


def _descend(
    k: int,
    prefix: str,
    rest: int,
    counts: dict[str, int],
    cuts: dict[int, str | Tie],
    open_ranks: dict[int, tuple[str, int]],
) -> None:
    """Settle rank k if ``rest`` falls between two groups, else note the group it falls into."""
    before = 0
    for group in sorted(counts):
        if rest == before:
            cuts[k] = group
            return
        if rest < before + counts[group]:
            open_ranks[k] = (group, rest - before)
            return
        before += counts[group]
    cuts[k] = prefix + ABOVE_ALL


# -- splits -------------------------------------------------------------------------------



def floor_size(share: float) -> Callable[[int], int]:
    """``int(n * share)``, as the logistic job cuts."""
    return lambda n: int(n * share)


def nearest_size(share: float) -> Callable[[int], int]:
    """``round(n * share)``, as a fractional sample is sized."""
    return lambda n: round(n * share)


def rest_size(test_share: float) -> Callable[[int], int]:
    """Train rows when the test part takes ``ceil(n * test_share)``."""
    return lambda n: n - math.ceil(n * test_share)


def split_exact(
    df: DataFrame,
    keys: Sequence[str],
    size: Callable[[int], int] = floor_size(0.8),
    seed: int = 0,
    names: Sequence[str] = ("train", "test"),
    part: str = "part",
) -> DataFrame:
    """Shuffle by key hash; the first ``size(n)`` rows are one part, the others the second."""
    return split_ranks(df, keys, lambda n: [size(n)], seed, names, part)


def split_three_way(
    df: DataFrame,
    keys: Sequence[str],
    held_share: float = 0.3,
    second_share: float = 0.5,
    seed: int = 2,
    names: Sequence[str] = ("train", "test", "validation"),
    part: str = "part",
) -> DataFrame:
    """Two chained splits: ``held_share`` off the train rows, of these ``second_share`` off again."""

    def ranks(n: int) -> list[int]:
        held = math.ceil(n * held_share)
        return [n - held, n - math.ceil(held * second_share)]

    return split_ranks(df, keys, ranks, seed, names, part)


def split_ranks(
    df: DataFrame,
    keys: Sequence[str],
    ranks: Callable[[int], Sequence[int]],
    seed: int,
    names: Sequence[str],
    part: str = "part",
) -> DataFrame:
    """Add the part of each row. Part sizes are exact even when keys repeat.

    The rows of a key that lies across a cut are stored and cut among themselves; all other rows are
    placed by their key as ever. Equal tables are cut into equal parts however they are laid out.
    """
    hashed = row_hash(keys, seed)
    _, cuts = find_cuts(df, hashed, ranks)
    tied = sorted({cut.hash for cut in cuts if isinstance(cut, Tie)})
    if not tied:
        return _with_part(df, hashed, cuts, names, part)
    across = hashed.isin(tied)
    content = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    held = df.filter(across).withColumns({"_first": hashed, "_second": content})
    held = store_with_row_id(held, ROW_ID).withColumn("_third", row_hash([ROW_ID], seed))
    cuts = [_cut_within(held, cut, ("_first", "_second", "_third")) if isinstance(cut, Tie) else cut for cut in cuts]
    rest = _with_part(df.filter(~across), hashed, cuts, names, part)
    place = F.concat("_first", "_second", "_third")
    inside = _with_part(held, place, cuts, names, part).drop("_first", "_second", "_third", ROW_ID)
    return rest.unionByName(inside)


def _cut_within(held: DataFrame, tie: Tie, levels: Sequence[str]) -> str:
    """The cut of a rank among the rows of one hash, by the hashes of the next levels."""
    own = held.filter(F.col(levels[0]) == tie.hash)
    _, (cut,) = find_cuts(own, F.col(levels[1]), lambda _: [tie.rest])
    return tie.hash + (_cut_within(own, cut, levels[1:]) if isinstance(cut, Tie) else cut)


def _with_part(
    df: DataFrame, hashed: Column, cuts: Sequence[str], names: Sequence[str], part: str
) -> DataFrame:
    """The hash is a column of its own first, so that several cuts share it."""
    place = F.when(F.col("_hash") < cuts[0], names[0])
    for cut, name in zip(cuts[1:], names[1:]):
        place = place.when(F.col("_hash") < cut, name)
    return df.withColumn("_hash", hashed).withColumn(part, place.otherwise(names[len(cuts)])).drop("_hash")


def split_hash(
    df: DataFrame,
    keys: Sequence[str],
    share: float = 0.7,
    seed: int = 0,
    names: Sequence[str] = ("train", "test"),
    part: str = "part",
) -> DataFrame:
    """Each row by itself with probability ``share``: no job, no counting."""
    return _with_part(df, row_hash(keys, seed), [cut_at(share)], names, part)


def split_random(df: DataFrame, share: float = 0.7, seed: int | None = None) -> list[DataFrame]:
    """Spark's own Bernoulli split, for tables without a key. Sorts every input partition."""
    return df.randomSplit([share, 1.0 - share], seed)


def sample_exact(
    df: DataFrame, keys: Sequence[str], share: float = 0.75, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Sample of ``round(n * share)`` rows without replacement, and all other rows."""
    marked = split_exact(df, keys, nearest_size(share), seed, part="_part")
    inside = F.col("_part") == "train"
    return marked.filter(inside).drop("_part"), marked.filter(~inside).drop("_part")


def complement(df: DataFrame, taken: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``taken``, for samples that were stored by someone else."""
    return df.join(taken.select(*keys).distinct(), list(keys), "left_anti")


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Rows in hash order: a range-partitioned sort."""
    return df.orderBy(row_hash(keys, seed), *keys)


# -- balancing ----------------------------------------------------------------------------


def class_sizes(df: DataFrame, label: str, within: Column | None = None) -> DataFrame:
    """Rows of class 1 and class 0, and how many the smaller lacks."""
    among = F.lit(True) if within is None else within
    sizes = df.agg(
        F.count_if((F.col(label) == 1) & among).alias("n_pos"),
        F.count_if((F.col(label) == 0) & among).alias("n_neg"),
    )
    return sizes.select(
        "n_pos",
        "n_neg",
        F.abs(F.col("n_pos") - F.col("n_neg")).alias("difference"),
        F.when(F.col("n_pos") < F.col("n_neg"), 1).otherwise(0).alias("minority"),
    )


def draw_rate(missing: int, rows: int, slack: float = 6.0) -> float:
    """Mean draws per row so that the total surely reaches ``missing`` (six deviations above)."""
    return (missing + slack * math.sqrt(missing) + slack) / rows


def poisson_cuts(rate: float) -> list[str]:
    """Cuts of a uniform hash: below the k-th one, a Poisson variable is at most k."""
    cuts, term, total, k = [], math.exp(-rate), 0.0, 0
    while True:
        total += term
        cut = cut_at(total)
        if cut == ABOVE_ALL or (k > rate and term < 2.0**-60):
            return cuts
        cuts.append(cut)
        k += 1
        term *= rate / k


def oversample(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int = 0,
    within: Column | None = None,
    copy: str = "copy",
    unique: bool | None = None,
) -> DataFrame:
    """Balance classes 0 and 1 by drawing minority rows with replacement.

    The result is the table plus exactly ``|n_pos - n_neg|`` drawn rows; ``copy`` is 0 for the
    rows of the table and numbers the draws of one row. With ``within`` only those rows are
    counted and drawn.

    Every minority row gets a Poisson number of draws by its own hash, at a rate slightly above
    the need, and of all draws the ones with the smallest hashes are kept, exactly as many as are
    missing. Poisson counts given their sum are multinomial, and dropping random draws keeps that,
    so this equals drawing with replacement. Minority rows are dealt out by key before they are
    multiplied; other rows stay where they are.

    Rows must draw by themselves. Where minority rows repeat a key, which is found out by counting
    keys unless ``unique`` says so, they are stored with a row id that joins their key; which rows are
    drawn then depends on how the table is laid out.
    """
    sizes = class_sizes(df, label, within).first()
    missing, minority = sizes["difference"], sizes["minority"]
    table = df.withColumn(copy, F.lit(0).cast("long"))
    if missing == 0:
        return table
    rows = min(sizes["n_pos"], sizes["n_neg"])
    if rows == 0:
        raise ValueError(f"no row with {label} = {minority} to draw from")
    chosen = F.col(label) == minority if within is None else (F.col(label) == minority) & within
    own, names = df.filter(chosen), list(keys)
    if unique is None:
        unique = own.groupBy(F.unhex(row_hash(keys)).alias("k")).count().filter("count > 1").isEmpty()
    if not unique:
        own, names = store_with_row_id(own, ROW_ID), [*keys, ROW_ID]

    slack = 6.0
    while True:
        drawn = _draws(own, names, draw_rate(missing, rows, slack), seed, copy)
        order = row_hash([*names, copy], f"{seed}:keep")
        found, cuts = find_cuts(drawn, order, lambda n: [missing], at_least=missing)
        if found >= missing:
            break
        slack *= 4.0
    if isinstance(cuts[0], Tie):
        raise ValueError("minority rows repeat a key although unique=True")
    return table.unionByName(drawn.filter(order < cuts[0]).drop(ROW_ID))


def _draws(df: DataFrame, keys: Sequence[str], rate: float, seed: int, copy: str) -> DataFrame:
    """Every row once per draw, numbered by ``copy`` from 1.

    A high rate is served by several streams per row, each with its own hash, since a sum of
    Poisson variables is one. Rows go by key and block of streams to any task before they are
    multiplied, so it does not matter where they lay or how few they are.
    """
    streams = math.ceil(rate / STREAM_RATE)
    cuts = poisson_cuts(rate / streams)
    most = len(cuts)
    blocks = F.sequence(F.lit(0).cast("long"), F.lit((streams - 1) // BLOCK_STREAMS).cast("long"))
    spread = df.withColumn("_block", F.explode(blocks)).repartition(*keys, "_block")
    first = F.col("_block") * BLOCK_STREAMS + 1
    last = F.least(first + (BLOCK_STREAMS - 1), F.lit(streams).cast("long"))
    steps = " ".join(f"WHEN _hash < '{cut}' THEN {k}" for k, cut in enumerate(cuts))
    numbers = F.expr(f"sequence(1L, CAST(CASE {steps} ELSE {most} END AS LONG))")
    return (
        spread.withColumn("_stream", F.explode(F.sequence(first, last)))
        .withColumn("_hash", row_hash([*keys, "_stream"], f"{seed}:draw"))
        .filter(F.col("_hash") >= cuts[0])
        .withColumn("_draw", F.explode(numbers))
        .withColumn(copy, ((F.col("_stream") - 1) * most + F.col("_draw")).cast("long"))
        .drop("_block", "_stream", "_hash", "_draw")
    )
