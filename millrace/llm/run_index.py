"""Suffix-array dedup: run-length indexes over routed pieces of text.

Two equal strings of ``length`` bytes hold the same smallest ANCHOR-byte hash at the same place. So the
windows (strings of ``length`` bytes) of a document are cut into pieces by their smallest hash, about one
piece per 77 windows, and pieces with a common anchor are brought together; all windows of a piece whose
anchor stands nowhere else are unique. Of equal pieces one is kept with its count.

Where an anchor has several different pieces, their bytes go into a run-length index: the
Burrows-Wheeler transform of many pieces, cut into runs, with the text position and its neighbour in
suffix order sampled at both ends of every run. Inside a run the common prefix with a neighbour shrinks
by one per position, so the matching statistics of every position stream from the samples alone, and
each window with a match of ``length`` bytes is marked.

A hot anchor (the first words of a passage that many documents share) has its pieces divided by ranges
of windows and the bytes all windows of the range share, first 16, then single windows, so that equal
parts meet again and are counted once, however many documents hold them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import discard, filled, stored

LENGTH = 200
ANCHOR = 48  # bytes of an anchor
CHUNK = 1 << 20  # positions hashed together
INDEXED = 1 << 20  # bytes of one index
HOT = 1024  # different pieces of an anchor that one index takes
WIDTHS = (16, 1)  # windows per range when a hot anchor is divided

# Rolling hashes: a table of 256 odd numbers per hash, and an odd base with its inverse modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


# -- pieces ---------------------------------------------------------------------------------


class Rolling:
    """Hashes of any stretch of a chunk from running sums."""

    def __init__(self, base: int, size: int = CHUNK + LENGTH):
        rng = np.random.default_rng(base)
        self.table = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self._powers(base, size)
        self.inverse = self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        powers = np.full(size + 1, base, np.uint64)
        powers[0] = 1
        return np.cumprod(powers, dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        found = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=found[1:])
        return found

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = (sums[end] - sums[start]) * self.inverse[start]
        found ^= found >> np.uint64(32)
        found *= _MIX
        return found ^ (found >> np.uint64(29))


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, from running minima to both sides of blocks."""
    n = len(values) - width + 1
    whole = -(-len(values) // width) * width
    blocks = np.full(whole, np.iinfo(values.dtype).max, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Pieces:
    """Runs of windows with one smallest hash: anchor, first window, anchor's place in it, windows, two hashes."""

    anchor: np.ndarray
    start: np.ndarray
    offset: np.ndarray
    windows: np.ndarray
    h1: np.ndarray
    h2: np.ndarray


def cut_pieces(data: bytes, rolling: list[Rolling], length: int) -> Pieces:
    parts = []
    every = np.frombuffer(data, np.uint8)
    for begin in range(0, max(len(every) - length + 1, 0), CHUNK):
        own = every[begin : begin + CHUNK + length - 1]
        sums = rolling[0].sums(own)
        at = np.arange(len(own) - ANCHOR + 1)
        hashes = rolling[0].of(sums, at, at + ANCHOR)
        # The upper 40 bits order the hashes, equal ones by place.
        packed = hashes >> np.uint64(24) << np.uint64(24) | at.astype(np.uint64)
        place = (lowest(packed, length - ANCHOR + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.flatnonzero(np.diff(place, prepend=-1))
        end = np.append(start[1:], len(place))
        ids = [r.of(r.sums(own), start, end + length - 1).view(np.int64) for r in rolling[1:]]
        parts.append((hashes[place[start]].view(np.int64), start + begin, place[start] - start, end - start, *ids))
    if not parts:
        return Pieces(*[np.empty(0, np.int64)] * 6)
    return Pieces(*[np.concatenate(c) for c in zip(*parts, strict=True)])


_PIECES = "array<struct<anchor: bigint, start: bigint, offset: int, windows: int, h1: bigint, h2: bigint>>"


def _cut(length: int):
    @F.arrow_udf(_PIECES)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rolling = [Rolling(base, CHUNK + length) for base in BASES]
        for texts in batches:
            made, ends = [], [0]
            for value in texts:
                made.append(cut_pieces(value.as_py() or b"", rolling, length))
                ends.append(ends[-1] + len(made[-1].anchor))
            columns = [np.concatenate([getattr(m, name) for m in made] or [np.empty(0, np.int64)]) for name in _NAMES]
            arrays = [pa.array(c.astype(t), t) for c, t in zip(columns, _TYPES, strict=True)]
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, names=_NAMES))

    return cut


_NAMES = ["anchor", "start", "offset", "windows", "h1", "h2"]
_TYPES = ["int64", "int64", "int32", "int32", "int64", "int64"]


# -- the run-length index -------------------------------------------------------------------


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of several texts, with samples at the ends of its runs.

    The texts stand one after another, each before a separator. The first byte of a text has a
    preceding symbol of its own, so a run never spans two texts.
    """

    SEPARATOR = 0

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        symbols = np.zeros(int(lengths.sum()) + len(texts), np.int64)
        inside = np.ones(len(symbols), bool)
        inside[self.starts + lengths] = False
        symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        self.size = len(symbols)
        self.ranks, order = suffix_order(symbols)
        before = symbols[order - 1]  # the transform; position 0 starts a text
        breaks = np.ones(self.size + 1, bool)
        first = np.zeros(self.size, bool)
        first[self.starts] = True
        alone = first[order]
        breaks[1:-1] = (before[1:] != before[:-1]) | alone[1:] | alone[:-1]
        heads, tails = np.flatnonzero(breaks[:-1]), np.flatnonzero(breaks[1:])
        self.runs = len(heads)
        # Samples: the position at the head of a run with its neighbour above, at the tail with that below.
        head, tail = heads[heads > 0], tails[tails < self.size - 1]
        self.above = self._samples(order[head], order[head - 1])
        self.below = self._samples(order[tail], order[tail + 1])

    def _samples(self, at: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions in text order, and how far their common prefix with the neighbour reaches."""
        reach = at + self.common(at, other)
        place = np.argsort(at)
        return at[place], reach[place]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix, from the ranks of ever shorter prefixes."""
        found = np.zeros(len(a), np.int64)
        for depth, rank in reversed(self.ranks):
            x, y = a + found, b + found
            fits = np.flatnonzero((x + depth <= self.size) & (y + depth <= self.size))
            fits = fits[rank[x[fits]] == rank[y[fits]]]
            found[fits] += depth
        return found

    def matches(self) -> np.ndarray:
        """For every position, the longest prefix that also starts elsewhere: streamed from the samples."""
        found = np.zeros(self.size, np.int64)
        for at, reach in (self.above, self.below):
            ends = np.zeros(self.size, np.int64)
            ends[at] = reach
            np.maximum.accumulate(ends, out=ends)
            np.maximum(found, ends - np.arange(self.size), out=found)
        return found


PACKED = 7  # symbols of nine bits in one number


def suffix_order(symbols: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Numbers that tell the prefixes of 1, 2, 4, 7, 14, ... symbols apart, and the suffixes in order.

    A round doubles the prefixes and sorts only the suffixes that still share theirs.
    """
    n = len(symbols)
    packed = np.zeros(n, np.int64)
    for k in range(PACKED):
        packed <<= 9
        packed[: n - k] |= symbols[k:]
    ranks = [(k, packed >> (9 * (PACKED - k))) for k in (1, 2, 4)]
    order = np.argsort(packed)
    shared, keys, rank = np.arange(n), packed[order], np.empty(n, np.int64)
    depth = PACKED
    while True:
        fresh = np.flatnonzero(np.diff(keys, prepend=-1))
        sizes = np.diff(np.append(fresh, len(keys)))
        rank[order[shared]] = np.repeat(shared[fresh], sizes)  # the place of the first of its equals
        ranks.append((depth, rank.astype(np.int32)))
        shared = shared[np.repeat(sizes, sizes) > 1]
        if not len(shared):
            return ranks, order
        at = order[shared]
        after = np.full(len(at), -1, np.int64)
        inside = at + depth < n
        after[inside] = rank[at[inside] + depth]
        keys = rank[at] * (n + 1) + after + 1
        place = np.argsort(keys)
        order[shared], keys = at[place], keys[place]
        depth *= 2


def marked_runs(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Per text, the (first, count) runs of its windows that also start elsewhere among the texts."""
    index = RunIndex(texts)
    hit = index.matches() >= length
    found = []
    for start, text in zip(index.starts.tolist(), texts, strict=True):
        own = np.zeros(len(text) - length + 3, np.int8)
        own[1:-1] = hit[start : start + len(text) - length + 1]
        edges = np.diff(own)
        first = np.flatnonzero(edges == 1)
        found.append(np.column_stack([first, np.flatnonzero(edges == -1) - first]))
    return found


_MARKS = "key bigint, h1 bigint, h2 bigint, runs array<struct<first: int, count: int>>"
_MARK_SCHEMA = pa.schema([
    ("key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
    ("runs", pa.list_(pa.struct([("first", pa.int32()), ("count", pa.int32())]))),
])


def _indexed(length: int):
    """Task code: the pieces of a task, sorted by key, in indexes of bounded size that never cut a key."""

    def settle(held: list[tuple]) -> pa.RecordBatch:
        rows = []
        marks = marked_runs([text for *_, text in held], length)
        for (key, h1, h2, rows_of, text), runs in zip(held, marks, strict=True):
            if rows_of > 1:
                runs = [(0, len(text) - length + 1)]
            if len(runs):
                rows.append({"key": key, "h1": h1, "h2": h2, "runs": [{"first": int(a), "count": int(n)} for a, n in runs]})
        return pa.RecordBatch.from_pylist(rows, schema=_MARK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("key", "h1", "h2", "n", "bytes")], strict=True):
                if size >= INDEXED and row[0] != last:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[4]), row[0]
        if held:
            yield settle(held)

    return run


# -- routing --------------------------------------------------------------------------------


def _marks(pieces: DataFrame, length: int, widths: tuple[int, ...]) -> DataFrame:
    """Repeated windows of different pieces (``key, h1, h2, n, offset, windows, bytes``), stored.

    ``offset`` is the place of the anchor in the piece; pieces of one key agree in the anchor.
    """
    sizes = pieces.groupBy("key").agg(F.count("*").alias("different"))
    hot = stored(sizes.filter(F.col("different") > HOT).select("key"))
    columns = ["key", "h1", "h2", "n", "bytes"]
    cool = pieces.join(hot, "key", "left_anti").select(*columns)
    cool = cool.repartition("key").sortWithinPartitions("key", "h1", "h2")
    found = stored(cool.mapInArrow(_indexed(length), _MARKS))
    if hot.isEmpty():
        discard(hot)
        return found
    parts = stored(_divided(pieces.join(hot, "key", "left_semi"), length, widths[0]))
    part = ["part", "p1", "p2"]
    alike = parts.groupBy(*part).agg(
        F.sum("n").alias("n"),
        *[F.first(f"part_{c}").alias(c) for c in ("offset", "windows", "bytes")],
    )
    alike = stored(alike.withColumnsRenamed({"part": "key", "p1": "h1", "p2": "h2"}))
    several, lone = _shared(alike)
    all_of = F.array(F.struct(F.lit(0).alias("first"), F.col("windows").alias("count")))
    again = lone.select("key", "h1", "h2", all_of.alias("runs"))
    used = [hot, parts, alike, found]
    if widths[0] > 1:  # single windows of one part are all alike
        several = stored(several)
        inner = _marks(several, length, widths[1:])
        again, used = again.unionByName(inner), [*used, several, inner]
    again = again.withColumnsRenamed({"key": "part", "h1": "p1", "h2": "p2"})
    back = parts.drop("part_bytes").join(again, part).withColumn("run", F.explode("runs"))
    moved = F.struct((F.col("run.first") + F.col("shift")).alias("first"), F.col("run.count").alias("count"))
    result = stored(found.unionByName(back.groupBy("key", "h1", "h2").agg(F.collect_list(moved).alias("runs"))))
    discard(*used)
    return result


def _shared(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces of keys with several different pieces, and repeated pieces that are the only one of their key."""
    differ = pieces.groupBy("key").agg(F.count("*").alias("different"))
    joined = pieces.join(differ, "key")
    several = joined.filter("different > 1").drop("different")
    return several, joined.filter("different = 1 AND n > 1").drop("different")


def _divided(hot: DataFrame, length: int, width: int) -> DataFrame:
    """Pieces cut at fixed distances from their anchor; parts are named by the bytes that every window of
    their range shares, from the start of the last window to the end of the first."""
    far = F.floor(F.col("offset") / width).cast("int")
    near = F.floor((F.col("offset") - F.col("windows") + 1) / width).cast("int")
    ranges = hot.withColumn("range", F.explode(F.sequence(near, far)))
    last = F.col("offset") - F.col("range") * width
    shift = F.greatest(F.lit(0), last - (width - 1))
    ranges = ranges.withColumn("last", last).withColumn("shift", shift)
    ranges = ranges.withColumn("part_windows", F.least(F.col("windows") - 1, "last") - F.col("shift") + 1)
    shared = F.expr(f"substring(bytes, last + 1, {length - width + 1})")
    own = F.expr(f"substring(bytes, shift + 1, part_windows + {length - 1})")
    ranges = ranges.withColumn("part", F.xxhash64("key", "range", shared)).withColumn("part_bytes", own)
    ranges = ranges.withColumn("part_offset", F.col("offset") - F.col("shift"))
    names = [F.xxhash64(F.lit(k), "part_offset", "part_bytes").alias(f"p{k}") for k in (1, 2)]
    return ranges.select("key", "h1", "h2", "n", "shift", "part", *names, "part_offset", "part_windows", "part_bytes")


# -- the operator ---------------------------------------------------------------------------


def _sliced(length: int):
    """Task code: the bytes of the pieces that a document stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                data, own = batch.column("data")[at].as_py(), batch.column("own")[at].values
                starts, windows = own.field("start").to_numpy(), own.field("windows").to_numpy()
                texts = [data[a : a + n + length - 1] for a, n in zip(starts.tolist(), windows.tolist(), strict=True)]
                columns = [own.field(c) for c in ("key", "h1", "h2", "n", "offset", "windows")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], names=[*_SLICED])

    return run


_SLICED = ("key", "h1", "h2", "n", "offset", "windows", "bytes")
_SPANS = "struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept_sha256: string, spans: array<struct<start: bigint, end: bigint>>>"


def covered(first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Start and end of the maximal stretches that the windows of these runs cover."""
    place = np.argsort(first)
    first, ends = first[place], np.maximum.accumulate((first + count + length - 1)[place])
    fresh = np.append(True, first[1:] > ends[:-1]) if len(first) else np.empty(0, bool)
    return np.column_stack([first[fresh], ends[np.append(fresh[1:], True)] if len(first) else ends])


def _removed(length: int):
    @F.arrow_udf(_SPANS)
    def rest(data: pa.Array, runs: pa.Array) -> pa.Array:
        found = []
        for value, own in zip(data, runs, strict=True):
            text = value.as_py() or b""
            first = own.values.field("first").to_numpy() if own.is_valid else np.empty(0, np.int64)
            count = own.values.field("count").to_numpy() if own.is_valid else np.empty(0, np.int64)
            spans = covered(first, count, length).tolist()
            digest, end = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(text[end:a])
                end = b
            digest.update(text[end:])
            found.append({
                "n_bytes": len(text), "n_removed": sum(b - a for a, b in spans), "n_spans": len(spans),
                "kept_sha256": digest.hexdigest(), "spans": [{"start": a, "end": b} for a, b in spans],
            })
        return pa.array(found, _SPAN_TYPE)

    return rest


_SPAN_TYPE = pa.struct([
    ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """``row`` and ``runs`` (first window, count) of the windows that also start elsewhere, stored.

    ``rows`` is a stored table of ``row``, ``data`` and ``pieces``.
    """
    pieces = rows.select("row", F.inline("pieces")).withColumnRenamed("anchor", "key")
    name = F.struct("h1", "h2")
    sizes = pieces.groupBy("key").agg(F.count("*").alias("n"), F.min(name).alias("a"), F.max(name).alias("b"))
    shared = stored(sizes.filter("n > 1").select("key", (F.col("a") != F.col("b")).alias("differ")))
    placed = stored(pieces.join(shared, "key"))
    several = placed.filter("differ")
    at = F.min(F.struct("row", "start", "offset", "windows")).alias("at")
    stands = several.groupBy("key", "h1", "h2").agg(F.count("*").alias("n"), at)
    own = F.struct("key", "h1", "h2", "n", "at.offset", "at.windows", "at.start")
    stands = stored(stands.groupBy("at.row").agg(F.collect_list(own).alias("own")))
    types = "key bigint, h1 bigint, h2 bigint, n bigint, offset int, windows int, bytes binary"
    taken = rows.select("row", "data").join(stands, "row").select("data", "own")
    taken = stored(taken.mapInArrow(_sliced(length), types))
    marks = _marks(taken, length, WIDTHS)
    run = F.explode("runs").alias("run")
    found = several.join(marks, ["key", "h1", "h2"]).select("row", "start", run)
    first = (F.col("start") + F.col("run.first")).alias("first")
    found = found.select("row", first, F.col("run.count").cast("bigint").alias("count"))
    alike = placed.filter("NOT differ").select("row", F.col("start").alias("first"), F.col("windows").cast("bigint").alias("count"))
    runs = found.union(alike).groupBy("row").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    runs = stored(runs)
    discard(shared, placed, stands, taken, marks)
    return runs


def remove_repeats(docs: DataFrame, key: str, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the removed ``spans``.

    A byte of the UTF-8 text goes if a string of ``length`` bytes over it also starts anywhere else, in
    the same or another row, overlaps included. Every row is a text of its own, also rows that repeat a
    key or have a NULL key; NULL and empty texts have no bytes. Spans may cut through a character: they
    count bytes. Other columns are dropped; an empty table gives an empty result.
    """
    if length < ANCHOR + max(WIDTHS):
        raise ValueError(f"strings of at least {ANCHOR + max(WIDTHS)} bytes are needed")
    data = filled(text).cast("binary")
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), data.alias("data"))
    rows = stored(named.withColumn("pieces", _cut(length)("data")))
    runs = repeated_windows(rows, length)
    joined = rows.select("row", "key", "data").join(runs, "row", "left")
    return joined.withColumn("rest", _removed(length)("data", "runs")).select(F.col("key").alias(key), "rest.*")
