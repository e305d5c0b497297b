"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are few and documents many, so the items of one block (of bounded size) travel to the
documents. A first pass counts in how many documents each n-gram of the items occurs; those that are
rare for their item become seeds. A second pass cuts out the passages around seeds and aligns each
with its item by words, so edited, reordered and padded copies get a score as well.

Rareness is relative to the item: an item copied into very many documents makes all of its n-grams
frequent, and keeps its seeds.

The texts are read once per block: the first pass keeps the documents that hold any n-gram of the
block, and the second works on these alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import discard, filled, stored, utf8, word_blocks

NGRAM = 3
RARE = 4  # a seed is in at most so many times the documents of its item's median n-gram
MATCH, MISMATCH, GAP = 2, -1, -1
SLACK = 0.5  # of the item's length, on either side of where the seed puts it
BLOCK_CHARS = 16_000_000
KEPT = 1 << 18
TOGETHER = 256  # alignments done at once
SPREAD = np.int64(0x2545F4914F6CDD1D)  # an odd number for n-gram hashes

_INNER = re.compile(r"[^\W_]+(?:['’\-][^\W_]+)*")


def plain(word: bytes) -> list[str]:
    """The comparable parts of a word: lower case, without marks around it."""
    return _INNER.findall(word.decode(errors="replace").lower())


@dataclass(frozen=True)
class Items:
    """The test items of one block: word numbers from 1, n-gram codes, and where n-grams occur."""

    ids: list
    words: list[np.ndarray]
    numbers: dict[str, int]
    codes: np.ndarray  # sorted, distinct
    gram_item: np.ndarray  # one row per occurrence: item, code number, offset
    gram_code: np.ndarray
    gram_offset: np.ndarray

    def code(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the word numbers; n-grams that fall together give seeds that align badly."""
        found = np.zeros(len(at), np.int64)
        for k in range(NGRAM):
            found = (found + words[at + k]) * SPREAD
            found ^= found >> 29
        return found


def index_items(ids: list, texts: list[str]) -> Items:
    numbers: dict[str, int] = {}
    words = []
    for text in texts:
        parts = [p for w in (text or "").encode().split() for p in plain(w)]
        words.append(np.asarray([numbers.setdefault(p, len(numbers) + 1) for p in parts], np.int64))
    empty = Items(ids, words, numbers, *[np.empty(0, np.int64)] * 4)
    starts = [np.arange(max(len(w) - NGRAM + 1, 0)) for w in words]
    all_codes = [empty.code(w, s) for w, s in zip(words, starts, strict=True)]
    joined = np.concatenate(all_codes) if all_codes else np.empty(0, np.int64)
    codes, number = np.unique(joined, return_inverse=True)
    item = np.repeat(np.arange(len(words)), [len(s) for s in starts])
    offset = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return Items(ids, words, numbers, codes, item, number.astype(np.int64), offset)


def rare_seeds(items: Items, documents: np.ndarray) -> np.ndarray:
    """Which n-gram occurrences are seeds, given the number of documents of each code."""
    chosen = np.zeros(len(items.gram_item), bool)
    for k in range(len(items.words)):
        own = np.flatnonzero(items.gram_item == k)
        if len(own):
            counts = documents[items.gram_code[own]]
            chosen[own] = counts <= RARE * max(float(np.median(counts)), 1.0)
    return chosen


class Numbers(dict):
    """The items' number of each word: 0 if no item holds it, minus the place in ``several`` if it has
    several parts."""

    MARKS = b".,;:!?()[]{}<>|*#$%&\"_+=/~"

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers, self.several = numbers, [[]]
        self.encoded = {p.encode(): n for p, n in numbers.items()}

    def __missing__(self, word: bytes) -> int:
        core = word.lower().strip(self.MARKS)
        if core.isalnum():  # ASCII letters and digits only: one part
            found = self.encoded.get(core, 0)
        else:
            own = [self.numbers.get(p, 0) for p in plain(word)]
            if len(own) == 1:
                found = own[0]
            else:
                self.several.append(own)
                return 1 - len(self.several)
        if len(self) >= KEPT:
            self.clear()
        self[word] = found
        return found


class Reader:
    """Turns texts into the items' word numbers; words that no item holds are 0."""

    def __init__(self, items: Items):
        self.items, self.known = items, Numbers(items.numbers)

    def numbers(self, data: bytes) -> np.ndarray:
        parts = []
        for words in word_blocks(data):
            found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            if len(self.known.several) > 1:
                several = self.known.several
                found = np.asarray([n for f in found.tolist() for n in ([f] if f >= 0 else several[-f])], np.int64)
                del several[1:]
            parts.append(found)
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and code numbers of all n-grams of the text that items hold."""
        if len(words) < NGRAM or not len(self.items.codes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        held = words > 0
        at = np.flatnonzero(np.logical_and.reduce([held[k : len(words) - NGRAM + 1 + k] for k in range(NGRAM)]))
        codes = self.items.code(words, at)
        place = np.minimum(np.searchsorted(self.items.codes, codes), len(self.items.codes) - 1)
        same = self.items.codes[place] == codes
        return at[same], place[same]


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each item with its passage, and the passage position where it ends.

    Rows of all alignments advance together; gaps along a row are one running maximum.
    """
    n, width = len(items), max(map(len, passages))
    target = np.zeros((n, width), np.int64)
    for k, p in enumerate(passages):
        target[k, : len(p)] = p
    query = np.full((n, max(map(len, items))), -1, np.int64)
    for k, w in enumerate(items):
        query[k, : len(w)] = w
    slope = -GAP * np.arange(width)
    row, best, end = np.zeros((n, width), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(query.shape[1]):
        alive = query[:, k : k + 1] >= 0
        step = np.where(target == query[:, k : k + 1], MATCH, MISMATCH)
        diagonal = np.zeros_like(row)
        diagonal[:, 1:] = row[:, :-1]
        new = np.maximum(np.maximum(diagonal + step, row + GAP), 0)
        new = np.maximum.accumulate(new + slope, axis=1) - slope
        row = np.where(alive, new, 0)
        top = row.argmax(axis=1)
        value = row[np.arange(n), top]
        better = value > best
        best, end = np.where(better, value, best), np.where(better, top, end)
    return best, end


def passages_of(items: Items, seeds: dict[int, list[tuple[int, int]]], at, codes, length: int) -> list[tuple[int, int, int]]:
    """(item, from, to) around seed hits; overlapping passages of one item become one."""
    found: dict[int, list[list[int]]] = {}
    for position, code in zip(at.tolist(), codes.tolist(), strict=True):
        for item, offset in seeds.get(code, ()):
            size = len(items.words[item])
            slack = int(SLACK * size) + NGRAM
            start, end = max(position - offset - slack, 0), min(position - offset + size + slack, length)
            own = found.setdefault(item, [])
            if own and start <= own[-1][1] - size // 2 and end - own[-1][0] <= 4 * size + 4 * slack:
                own[-1] = [min(own[-1][0], start), max(own[-1][1], end)]
            elif not own or end > own[-1][1]:
                own.append([start, end])
    return [(item, a, b) for item, own in found.items() for a, b in own]


_FOUND = "array<struct<item: int, score: double, from_word: int, to_word: int>>"


def _aligned(sent, threshold: float):
    @F.arrow_udf(_FOUND)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        items, chosen = Items(*sent.value[0]), sent.value[1]
        reader, seeds = Reader(items), {}
        is_seed = np.zeros(len(items.codes), bool)
        is_seed[items.gram_code[chosen]] = True
        for item, code, offset in zip(
            items.gram_item[chosen].tolist(), items.gram_code[chosen].tolist(), items.gram_offset[chosen].tolist(),
            strict=True,
        ):
            seeds.setdefault(code, []).append((item, offset))

        def scored(waiting: list, found: list) -> None:
            if not waiting:
                return
            queries, targets = [items.words[w[1]] for w in waiting], [w[3] for w in waiting]
            best, end = align(queries, targets)
            full = np.asarray([MATCH * len(q) for q in queries])
            good = np.flatnonzero(best >= threshold * full)
            if len(good):
                back = [targets[k][: end[k] + 1][::-1] for k in good]
                _, length = align([queries[k][::-1] for k in good], back)
                for k, n in zip(good.tolist(), length.tolist(), strict=True):
                    row, item, start, _ = waiting[k]
                    stop = start + int(end[k])
                    found[row].append((item, float(best[k] / full[k]), stop - n, stop))
            waiting.clear()

        for texts, held in batches:
            found: list[list] = [[] for _ in range(len(texts))]
            waiting: list = []
            for row, (data, own) in enumerate(zip(utf8(texts), held, strict=True)):
                if not is_seed[own.values.to_numpy()].any():
                    continue
                words = reader.numbers(data)
                at, codes = reader.hits(words)
                for item, a, b in passages_of(items, seeds, at, codes, len(words)):
                    waiting.append((row, item, a, words[a:b]))
                    if len(waiting) == TOGETHER:
                        scored(waiting, found)
            scored(waiting, found)
            rows = [[dict(zip(("item", "score", "from_word", "to_word"), f, strict=True)) for f in own] for own in found]
            kind = pa.struct([("item", pa.int32()), ("score", pa.float64()), ("from_word", pa.int32()), ("to_word", pa.int32())])
            yield pa.array(rows, pa.list_(kind))

    return search


def _held(sent):
    @F.arrow_udf("array<int>")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(Items(*sent.value))
        for texts in batches:
            rows = [np.unique(reader.hits(reader.numbers(data))[1]).astype(np.int32) for data in utf8(texts)]
            yield pa.array(rows, pa.list_(pa.int32()))

    return held


def _blocks(items: DataFrame, key: str, text: str, block_chars: int) -> list[DataFrame]:
    size = items.agg(F.sum(F.char_length(filled(text)))).first()[0] or 0
    parts = size // block_chars + 1
    own = F.pmod(F.xxhash64(key, text), F.lit(parts))
    return [items.filter(own == k) for k in range(parts)]


def contaminated(
    docs: DataFrame, items: DataFrame, key: str, item_key: str, text: str = "text", item_text: str = "text",
    threshold: float = 0.4, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``key``, ``item_key``, ``score`` and the passage ``from_word`` .. ``to_word`` (inclusive), one row per
    document and item whose best alignment reaches ``threshold`` of the score of a full copy.

    Items are compared in blocks of about ``block_chars`` characters, each held whole by the tasks, with
    all documents; any number of blocks gives the same rows. NULL and empty texts and items match
    nothing, nor do items of fewer than three words. Rows that repeat a key count as one document, and
    keys may be NULL. Words are compared in lower case without marks.
    """
    named = docs.select(F.col(key).alias("_key"), filled(text).alias("_text"))
    spark, results = docs.sparkSession, []
    wanted = items.select(F.col(item_key).alias("id"), filled(item_text).alias("text"))
    for block in _blocks(wanted, "id", "text", block_chars):
        rows = block.orderBy("id", "text").collect()  # bounded by block_chars
        index = index_items([r.id for r in rows], [r.text for r in rows])
        sent = spark.sparkContext.broadcast(astuple(index))  # plain values: tasks need no class to load them
        # The only reading of all texts; those that hold no n-gram of the block are left behind.
        near = stored(named.withColumn("_held", _held(sent)("_text")).filter(F.size("_held") > 0))
        counted = near.select(F.explode("_held").alias("code")).groupBy("code").count().toArrow()
        documents = np.zeros(len(index.codes), np.int64)  # one number per n-gram of the block
        documents[counted["code"].to_numpy()] = counted["count"].to_numpy()
        seeded = spark.sparkContext.broadcast((astuple(index), rare_seeds(index, documents)))
        found = near.select("_key", F.explode(_aligned(seeded, threshold)("_text", "_held")).alias("f"))
        names = spark.createDataFrame(list(enumerate(index.ids)), f"item int, id {items.schema[item_key].dataType.simpleString()}")
        results.append(stored(found.select("_key", "f.*").join(F.broadcast(names), "item")))
        discard(near)
    joined = results[0]
    for more in results[1:]:
        joined = joined.union(more)
    best = joined.groupBy("_key", "id").agg(
        F.max(F.struct("score", -F.col("from_word"), -F.col("to_word"))).alias("best")
    )
    return best.select(
        F.col("_key").alias(key), F.col("id").alias(item_key), "best.score",
        (-F.col("best")["col2"]).alias("from_word"), (-F.col("best")["col3"]).alias("to_word"),
    )
