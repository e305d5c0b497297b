"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints within ``d`` bits agree exactly on at least one of ``d + 1`` bit blocks, so the upper
nodes of the index are (block, bits in it): every distinct fingerprint stands below ``d + 1`` of
them. A node that holds too many is divided by further blocks of its free bits, until the number of
free bits itself bounds it; this is exact, however many fingerprints share their bits. Below an
upper node fingerprints are sorted by the Gray rank of their free bits, runs of the sorted list
become lower nodes holding the bits that all their members share, and a search drops a whole run
as soon as the differences gathered on the way down exceed ``d``.

Links of one node are handed on as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.text import filled, stored, utf8, word_blocks

SEED = 42
NODE_ROWS = 4096  # an upper node with more fingerprints is divided
FANOUT = 8
CHUNK = 1 << 16
QUERIES = 1024


# -- fingerprints -------------------------------------------------------------------------


def fingerprint(data: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    ones, total, carried = np.zeros(64, np.int64), 0, []
    blocks = word_blocks(data.lower())  # bytes.lower() changes A-Z only
    words = next(blocks, [])
    while True:
        following = next(blocks, None)
        words = carried + words
        runs = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
        if following is None and not total and not runs and words:
            runs = [b" ".join(words)]
        if runs:
            hashes = np.fromiter([xxhash.xxh64_intdigest(r, SEED) for r in runs], np.dtype(">u8"), len(runs))
            ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
            total += len(runs)
        if following is None:
            break
        carried, words = words[max(0, len(words) - shingle + 1) :], following
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(text: Column, shingle: int) -> Column:
    """The fingerprint of a text column as a signed long; NULL counts as empty."""

    @F.arrow_udf("bigint")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(data, shingle) for data in utf8(texts)], pa.int64())

    return hashed(filled(text))


# -- upper nodes --------------------------------------------------------------------------


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def divided(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` blocks of its free bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    sizes = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(sizes, sizes[1:], strict=False)]


def gray_rank(bits: Column) -> Column:
    """The position of a bit pattern in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def _below(rows: DataFrame, masks: list[int]) -> DataFrame:
    nodes = F.array(*[F.lit(_signed(m)) for m in masks])
    return rows.select("fingerprint", F.explode(nodes).alias("mask")).withColumn(
        "bits", F.col("fingerprint").bitwiseAND(F.col("mask"))
    )


def upper_nodes(distinct: DataFrame, max_bits: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """``fingerprint``, ``mask``, ``bits``: any two fingerprints within ``max_bits`` share a row's node,
    and no node holds more than ``node_rows`` fingerprints unless its free bits allow no more anyway."""
    level, done = {0: distinct}, []
    while level:
        masks = {m: divided(m, max_bits + 1) for m in level}
        rows = None
        for mask, own in level.items():
            part = _below(own, masks[mask])
            rows = part if rows is None else rows.union(part)
        rows = stored(rows)
        counted = rows.groupBy("mask", "bits").count().filter(F.col("count") > node_rows)
        crowded = stored(counted.select("mask", "bits"))
        full = [r.mask & (1 << 64) - 1 for r in crowded.select("mask").distinct().collect()]  # few masks per level
        full = [m for m in full if 64 - m.bit_count() > max_bits + 1]
        if not full:
            done.append(rows)
            break
        dividing = crowded.filter(F.col("mask").isin([_signed(m) for m in full]))
        done.append(rows.join(dividing, ["mask", "bits"], "left_anti"))
        left = stored(rows.join(dividing, ["mask", "bits"], "left_semi"))
        level = {m: left.filter(F.col("mask") == _signed(m)) for m in full}
    nodes = done[0].select("fingerprint", "mask", "bits")
    for more in done[1:]:
        nodes = nodes.union(more.select("fingerprint", "mask", "bits"))
    return nodes


# -- lower nodes and search ---------------------------------------------------------------


class Run:
    """The hierarchical index over one chunk of sorted fingerprints; ``group`` names upper nodes.

    Level 0 is the fingerprints themselves; a node of level k spans FANOUT nodes of level k - 1
    and holds the bits that all fingerprints below it share.
    """

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.levels = [(np.full(len(prints), every), prints, np.arange(len(prints), dtype=np.int64))]
        ones, zeros = prints, ~prints
        owner = group
        while len(owner) > 1:
            place = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
            starts = np.flatnonzero(place % FANOUT == 0)
            if len(starts) == len(owner):
                break
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
            owner = owner[starts]
            self.levels.append((ones | zeros, ones, starts))
        self.tops = owner
        self.sizes = [len(level[0]) for level in self.levels]

    def search(self, query: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query row, fingerprint row) for all fingerprints of the query's group within ``max_bits``."""
        first = np.searchsorted(self.tops, group, side="left")
        count = np.searchsorted(self.tops, group, side="right") - first
        rows = np.repeat(np.arange(len(query)), count)
        nodes = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count) + np.repeat(first, count)
        known = np.zeros(len(rows), np.uint64)  # bits compared on the way down
        gathered = np.zeros(len(rows), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            masks, ones, starts = self.levels[level]
            fresh = masks[nodes] & ~known
            gathered = gathered + np.bitwise_count((query[rows] ^ ones[nodes]) & fresh)
            near = gathered <= max_bits
            rows, nodes, gathered, known = rows[near], nodes[near], gathered[near], masks[nodes[near]]
            if not level:
                return rows, nodes
            below = self.sizes[level - 1]
            ends = np.append(starts[1:], below)
            count = (ends - starts)[nodes]
            first = starts[nodes]
            nodes = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count) + np.repeat(first, count)
            rows, gathered, known = (np.repeat(v, count) for v in (rows, gathered, known))
        raise AssertionError


def spanning_links(prints: np.ndarray, group: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint the row of the first one that it is linked to, over any number of links."""
    index, label = Run(prints, group), np.arange(len(prints))
    for start in range(0, len(prints), QUERIES):
        part = slice(start, start + QUERIES)
        rows, found = index.search(prints[part], group[part], max_bits)
        rows = rows + start
        while True:
            least = np.minimum(label[rows], label[found])
            before = label.copy()
            np.minimum.at(label, label[rows], least)
            np.minimum.at(label, label[found], least)
            label = label[label]
            if np.array_equal(before, label):
                break
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def _linked(max_bits: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: np.ndarray) -> pa.RecordBatch:
            change = np.any(rows[1:, :2] != rows[:-1, :2], axis=1)
            group = np.concatenate([[0], np.cumsum(change)])
            alone = np.bincount(group)[group] == 1
            rows, group = rows[~alone], group[~alone]
            prints = rows[:, 2].copy().view(np.uint64)
            label = spanning_links(prints, group, max_bits) if len(rows) else np.empty(0, np.int64)
            moved = np.flatnonzero(label != np.arange(len(label)))
            ends = [pa.array(rows[at, 2]) for at in (moved, label[moved])]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        held = np.empty((0, 3), np.int64)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("mask", "bits", "fingerprint")]
            held = np.concatenate([held, np.stack(columns, axis=1)])
            if len(held) < CHUNK:
                continue
            last = np.flatnonzero(np.any(held[:, :2] != held[-1, :2], axis=1))
            if len(last):
                yield links(held[: last[-1] + 1])
                held = held[last[-1] + 1 :]
        if len(held):
            yield links(held)

    return search


def link_fingerprints(distinct: DataFrame, max_bits: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints which chains of ``max_bits`` or fewer
    differing bits connect."""
    nodes = upper_nodes(distinct, max_bits, node_rows)
    free = F.col("fingerprint").bitwiseAND(F.bitwise_not(F.col("mask")))
    placed = nodes.withColumn("rank", gray_rank(free)).repartition("mask", "bits")
    ordered = placed.sortWithinPartitions("mask", "bits", "rank", "fingerprint").select("mask", "bits", "fingerprint")
    return ordered.mapInArrow(_linked(max_bits), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str, shingle: int = 3, max_bits: int = 2, text: str = "text", node_rows: int = NODE_ROWS
) -> DataFrame:
    """``key``, ``fingerprint`` (signed long) and ``component_id``, one row per input row.

    The component is the smallest key reachable over links. Rows with a NULL key take part and may
    hold a component together; their id is NULL only if all keys of the component are. Texts without
    words have fingerprint zero and are linked like any other. Other columns are dropped.
    """
    prints = stored(docs.select(F.col(key).alias("key"), fingerprints(F.col(text), shingle).alias("fingerprint")))
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("key").alias("least")))
    roots = components(link_fingerprints(distinct.select("fingerprint"), max_bits, node_rows), "a", "b")
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    least = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(least, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")
