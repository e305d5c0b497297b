"""Substring dedup: difference-cover anchors.

Of all words only those at positions whose remainder by PERIOD is in COVER start an anchor, a run of
``window - PERIOD + 1`` words. COVER is a perfect difference set: whatever the two remainders at
which a common run of ``window`` words starts, some shift below PERIOD takes both into COVER, so the
run shares an anchor that is hashed on both sides. 3/7 of the positions are hashed this way.

Anchors that only one document holds are dropped; around the others the windows are extended and
compared as a whole, by 96-bit hashes of all their words. A hot anchor or window is a skewed join
key, which Spark splits; its documents are reduced to the smallest in the map tasks and never meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import discard, filled, stored, utf8, word_blocks

# A perfect difference set modulo 7.
PERIOD, COVER = 7, (0, 1, 3)

KEPT = 1 << 18
# Odd 64-bit multipliers, one per hash.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) >= KEPT:
            self.clear()
        self[word] = found
        return found


def word_hashes(data: bytes, known: _Hashes) -> np.ndarray:
    parts = [
        np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for words in word_blocks(data) if words
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def run_hashes(words: np.ndarray, starts: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """A hash of the ``length`` words from each start."""
    found = np.zeros(len(starts), np.uint64)
    for k in range(length):
        found = (found + words[starts + k]) * np.uint64(multiplier)
        found ^= found >> np.uint64(29)
    return found


def anchor_starts(n_words: int, anchor: int) -> np.ndarray:
    """Cover positions at which an anchor fits, in order."""
    at = np.arange(max(n_words - anchor + 1, 0))
    return at[np.isin(at % PERIOD, COVER)]


def anchor_start(index: Column) -> Column:
    """The word position of the anchor with this number within its document."""
    residue = F.element_at(F.array(*[F.lit(c) for c in COVER]), (index % len(COVER) + 1).cast("int"))
    return (F.floor(index / len(COVER)) * PERIOD + residue).cast("int")


def _anchors(anchor: int):
    @F.arrow_udf("array<bigint>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Hashes()
        for texts in batches:
            rows = []
            for data in utf8(texts):
                words = word_hashes(data, known)
                rows.append(run_hashes(words, anchor_starts(len(words), anchor), anchor, MULTIPLIERS[0]).view(np.int64))
            yield _lists(rows)

    return hashed


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _windows(window: int, anchor: int):
    @F.arrow_udf("struct<start: array<int>, high: array<bigint>, low: array<int>>")
    def around(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = _Hashes()
        for texts, anchors in batches:
            starts, high, low = [], [], []
            for data, shared in zip(utf8(texts), anchors, strict=True):
                words = word_hashes(data, known)
                at = np.asarray(shared.values, np.int64)
                at = np.unique(at[:, None] - np.arange(window - anchor + 1))
                at = at[(at >= 0) & (at <= len(words) - window)]
                starts.append(at.astype(np.int32))
                high.append(run_hashes(words, at, window, MULTIPLIERS[1]).view(np.int64))
                low.append((run_hashes(words, at, window, MULTIPLIERS[2]) >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.StructArray.from_arrays([_lists(starts), _lists(high), _lists(low)], names=["start", "high", "low"])

    return around


def kept_words(data: bytes, starts: np.ndarray, window: int) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the SHA-256 of the kept ones joined by one space."""
    digest, n, removed, first = hashlib.sha256(), 0, 0, True
    starts = np.sort(starts)
    for words in word_blocks(data):
        if len(starts):
            near = starts[(starts > n - window) & (starts < n + len(words))]
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, np.maximum(near - n, 0), 1)
            np.add.at(edges, np.minimum(near + window - n, len(words)), -1)
            left = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
            kept = words if len(left) == len(words) else [words[i] for i in left]
        else:
            kept = words
        n += len(words)
        removed += len(words) - len(kept)
        if kept:
            digest.update((b"" if first else b" ") + b" ".join(kept))
            first = False
    return n, removed, digest


def _kept(window: int):
    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept_sha256: string>")
    def rest(texts: pa.Array, starts: pa.Array) -> pa.Array:
        found = []
        for data, covered in zip(utf8(texts), starts, strict=True):
            at = np.asarray(covered.values, np.int64) if covered.is_valid else np.empty(0, np.int64)
            n, removed, digest = kept_words(data, at, window)
            found.append((n, removed, digest.hexdigest()))
        n, removed, digests = zip(*found, strict=True) if found else ((), (), ())
        columns = [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        return pa.StructArray.from_arrays(columns, names=["n_words", "n_removed", "kept_sha256"])

    return rest


def repeated_windows(docs: DataFrame, key: str, text: str = "text", window: int = 13) -> DataFrame:
    """``key``, ``text_hash`` and ``starts``: the words at which windows start that also start in a row
    with a smaller key. Rows without such windows are left out; ``text_hash`` tells rows with one key apart.
    """
    anchor = window - PERIOD + 1
    if anchor < 1:
        raise ValueError(f"windows of at least {PERIOD} words are needed")
    named = docs.select(F.col(key).alias("key"), filled(text).alias("text")).filter(F.col("key").isNotNull())
    named = named.withColumn("text_hash", F.xxhash64("text"))
    rows = F.monotonically_increasing_id().alias("row")  # fixed by storing
    hashed = stored(named.select(rows, "key", "text_hash", _anchors(anchor)("text").alias("anchors")))
    ends = hashed.select("key", F.explode("anchors").alias("anchor")).groupBy("anchor")
    shared = stored(ends.agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a < b").select("anchor"))
    placed = hashed.select("row", F.posexplode("anchors").alias("index", "anchor"))
    found = placed.join(shared, "anchor").groupBy("row").agg(F.collect_set(anchor_start(F.col("index"))).alias("near"))
    found = stored(found)
    near = stored(hashed.select("row", "key", "text_hash").join(found, "row").drop("row"))
    discard(hashed, shared, found)
    windows = named.join(near, ["key", "text_hash"]).withColumn("w", _windows(window, anchor)("text", "near"))
    windows = stored(windows.select("key", "text_hash", F.inline(F.arrays_zip("w.start", "w.high", "w.low"))))
    discard(near)
    first = windows.groupBy("high", "low").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    first = stored(first.filter("first < last").select("high", "low", "first"))
    later = windows.join(first, ["high", "low"]).filter("key > first")
    starts = stored(later.groupBy("key", "text_hash").agg(F.collect_set("start").alias("starts")))
    discard(windows, first)
    return starts


def remove_repeats(docs: DataFrame, key: str, text: str = "text", window: int = 13) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``n_removed``, ``kept_sha256`` and the ``starts`` of removed windows.

    A word goes if a window of ``window`` words over it also starts in a row with a smaller key. Rows
    that repeat a key never remove each other's words. A row with a NULL key keeps all its words and
    removes none elsewhere; NULL and empty texts have no words. Other columns are dropped.
    """
    starts = repeated_windows(docs, key, text, window)
    rows = docs.select(F.col(key).alias("key"), filled(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    joined = rows.join(starts, ["key", "text_hash"], "left")
    found = joined.withColumn("rest", _kept(window)("text", "starts"))
    return found.select(F.col("key").alias(key), "rest.*", "starts")
