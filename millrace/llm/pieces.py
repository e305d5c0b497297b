"""SentencePiece encoding and decoding: sampled segmentations.

A segmentation is drawn by forward filtering and backward sampling over the lattice of pieces. The
probability of a segmentation is the product of its pieces' weights, a piece weighing
``(1 + rank) ** -alpha`` by its rank in the vocabulary; a character no piece holds is spelled out
in byte pieces. No piece reaches over a space, so the lattice of a text is a chain of word
lattices: the forward sums of a distinct word are computed once, and the words of many texts are
then sampled together, one backward step of every word at a time.

Random numbers are hashes of (seed, row key, word number, step): a row gets the same segmentation
whatever rows it is processed with, in whatever order, and again after a lost task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import filled, read_file, strings, unused

SPACE = "▁"
KEPT = 1 << 20  # characters of word lattices kept by a task before they are dropped
TOGETHER = 1 << 16  # characters whose lattices are built at once, and at least one word
DRAWN = 1 << 19  # characters sampled at once, about
ROWS = 256  # texts of a batch taken out of Arrow at once
LONGEST = 4096  # characters: a longer run without spaces is cut there, so that no lattice grows without bound
STEP = 0x9E3779B97F4A7C15
FACTOR = np.uint64(0xFF51AFD7ED558CCD)
FILTER_BITS = 18
DRAW_BITS = 27
SEPARATOR = "\ud800"  # a lone surrogate, which no text holds


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Vocabulary:
    """Piece numbers, weights and texts; ``byte`` are the 256 byte pieces.

    ``tables`` hold per length the sorted hashes of its pieces, their numbers, and a filter by the
    upper hash bits.
    """

    numbers: dict[str, int]
    weights: np.ndarray
    byte: list[int]
    texts: list[bytes]
    longest: int
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def find(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces of this length stand, and which."""
        if length not in self.tables:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        known, numbers, filled = self.tables[length]
        maybe = np.flatnonzero(filled[hashes >> np.uint64(64 - FILTER_BITS)])
        place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        same = known[place] == hashes[maybe]
        return maybe[same], numbers[place[same]]


def _tables(numbers: dict[str, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    tables = {}
    for length in sorted(set(map(len, numbers))):
        own = [p for p in numbers if len(p) == length]
        marks = mixed(np.frombuffer("".join(own).encode("utf-32-le"), np.uint32).astype(np.uint64)).reshape(-1, length)
        hashes = np.zeros(len(own), np.uint64)
        for k in range(length):
            hashes = hashes * FACTOR + marks[:, k]
        order = np.argsort(hashes)
        filled = np.zeros(1 << FILTER_BITS, bool)
        filled[hashes >> np.uint64(64 - FILTER_BITS)] = True
        tables[length] = hashes[order], np.asarray([numbers[p] for p in own])[order], filled
    return tables


def load(model: bytes, alpha: float) -> Vocabulary:
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    numbers, byte, texts = {}, [0] * 256, []
    for k in range(sp.get_piece_size()):
        piece = sp.id_to_piece(k)
        if sp.is_byte(k):
            byte[int(piece[3:5], 16)] = k
            texts.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(k) or sp.is_unknown(k):
            texts.append(b"")
        else:
            if SPACE not in piece[1:]:
                numbers[piece] = k
            texts.append(piece.replace(SPACE, " ").encode())
    weights = (1.0 + np.arange(len(texts))) ** -alpha
    return Vocabulary(numbers, weights, byte, texts, max(map(len, numbers)), _tables(numbers))


# -- forward filtering --------------------------------------------------------------------


class Growing:
    """An array to add to. Its first room holds what is kept as a rule, and takes memory only where it is
    filled; when it is full it makes half as much room again."""

    def __init__(self, kind: type, room: int = 2 * KEPT):
        self.held, self.size = np.empty(room, kind), 0

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.empty(max(end, 3 * self.size // 2) - self.size, self.held.dtype)])
        self.held[self.size : end] = values
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.size]


class Lattices(dict):
    """Numbers words as they come and holds the lattices of all of them in one set of arrays.

    The node of a word's first ``k`` characters is ``first + k``. The edges into a node are the pieces
    that end there; their ``reach`` lies in (node, node + 1] and grows by each one's share of the
    forward sum, which is what backward sampling draws from. A key is the text between two spaces, or
    a tuple holding a part of a run that was cut, which has no space mark before it.
    """

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v = v
        self.words: list[str] = []
        self.first, self.sizes = Growing(np.int64), Growing(np.int64)
        self.reach, self.length, self.number = (Growing(kind, 8 * KEPT) for kind in (np.float64, np.int8, np.int32))
        self.edge = Growing(np.int32)  # the first edge into each node
        self.nodes = 0

    def __missing__(self, key) -> int:
        self.words.append(key[0] if isinstance(key, tuple) else SPACE + key)
        self[key] = number = len(self.words) - 1
        return number

    def build(self) -> None:
        """Lattices for the words that came since the last call."""
        words = self.words[self.sizes.size :]
        ends = np.cumsum([len(w) + 1 for w in words])
        at = 0
        while at < len(words):
            upto = (ends[at - 1] if at else 0) + TOGETHER
            end = max(int(np.searchsorted(ends, upto, side="right")), at + 1)
            self._build(words[at:end])
            at = end

    def _build(self, words: list[str]) -> None:
        """Lattices of some words, all of them together.

        Before each word stands one separator, so that a character's place is its node.
        """
        v = self.v
        sizes = np.asarray(list(map(len, words)), np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        codes = np.frombuffer((SEPARATOR + SEPARATOR.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32)
        inner = codes == ord(SPACE)  # within a text the space mark is a character to be spelled
        inner[first + 1] = False
        marks = mixed(np.where(inner, ord(SEPARATOR), codes).astype(np.uint64))
        nodes, left = np.arange(len(codes)), np.repeat(first + sizes, sizes + 1) - np.arange(len(codes))
        hashes, ends, starts, numbers = np.zeros(len(codes), np.uint64), [], [], []
        for length in range(1, v.longest + 1):
            inside = np.flatnonzero(left >= length)  # nodes with so many characters of their word after them
            if not len(inside):
                break
            nodes, left = nodes[inside], left[inside]
            hashes = hashes[inside] * FACTOR + marks[nodes + length]  # of these characters
            at, number = v.find(length, hashes)
            starts.append(nodes[at])
            ends.append(nodes[at] + length)
            numbers.append(number)
        single = np.ones(len(codes), bool)
        single[first] = False
        single[ends[0]] = False
        single = np.flatnonzero(single)
        into, out = np.concatenate([*ends, single]), np.concatenate([*starts, single - 1])
        number = np.concatenate([*numbers, np.full(len(single), -1)]).astype(np.int64)
        order = np.argsort(into * (v.longest + 1) + v.longest - (into - out), kind="stable")
        into, out, number = into[order], out[order], number[order]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes + 1)[into]
        end = (into - first[owner]).astype(np.int16)  # narrow integers sort in linear time
        weight = v.weights[number]
        spelled = np.flatnonzero(number < 0)
        weight[spelled] = [
            float(np.prod(v.weights[[v.byte[b] for b in words[w][e - 1].encode()]]))
            for w, e in zip(owner[spelled].tolist(), end[spelled].tolist(), strict=True)
        ]
        total = np.zeros(int((sizes + 1).sum()))
        total[first] = 1.0
        share = np.empty(len(end))
        by_end = np.argsort(end, kind="stable")
        level_ends = np.searchsorted(end[by_end], np.arange(1, sizes.max() + 2))
        for level in range(1, int(sizes.max()) + 1):
            own = by_end[level_ends[level - 1] : level_ends[level]]
            flow = total[out[own]] * weight[own]
            nodes = into[own]
            starts = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
            sums = np.add.reduceat(flow, starts)
            reached = nodes[starts]
            total[reached] = sums
            share[own] = flow / total[nodes]
            if level % 8 == 0:  # only ratios count: keep the sums that are still in reach near 1
                for k in range(min(level, v.longest) + 1):
                    total[reached - k] /= sums
        opens = np.concatenate([[True], into[1:] != into[:-1]])
        place = np.arange(len(into))
        rank = (place - np.maximum.accumulate(np.where(opens, place, 0))).astype(np.int16)
        by_rank = np.argsort(rank, kind="stable")
        rank_ends = np.searchsorted(rank[by_rank], np.arange(rank.max() + 2))
        for r in range(1, int(rank.max()) + 1):
            own = by_rank[rank_ends[r] : rank_ends[r + 1]]
            share[own] += share[own - 1]
        # in steps of 2 ** -DRAW_BITS, which stay exact beside a node number: a word is sampled alike
        # wherever its lattice stands
        reach = np.minimum(np.rint(share * (1 << DRAW_BITS)) / (1 << DRAW_BITS), 1.0)
        reach[np.concatenate([opens[1:], [True]])] = 1.0
        reach += into + self.nodes
        edge = np.zeros(len(total), np.int64)
        edge[into[opens]] = np.flatnonzero(opens) + self.reach.size
        self.edge.add(edge)
        self.first.add(first + self.nodes)
        self.sizes.add(sizes)
        self.reach.add(reach)
        self.length.add(into - out)
        self.number.add(number)
        self.nodes += len(total)


# -- backward sampling --------------------------------------------------------------------


def sample(lattices: Lattices, word: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draw a segmentation for each occurrence: its word number and its random stream.

    Returns in text order the pieces (-1: the character before ``end`` is spelled in bytes) and the
    ``end`` characters they reach, and the number of pieces of each occurrence.
    """
    lattices.build()
    reach, length, number, edge = (g.values for g in (lattices.reach, lattices.length, lattices.number, lattices.edge))
    first = lattices.first.values[word]
    at = first + lattices.sizes.values[word]
    active, steps = np.arange(len(word)), []
    counts = np.zeros(len(word), np.int64)
    while len(active):
        bits = mixed(stream[active] + np.uint64((len(steps) + 1) * STEP % (1 << 64))) >> np.uint64(64 - DRAW_BITS)
        nodes = at[active]
        chosen = _first_reaching(reach, edge[nodes], nodes + (bits.astype(np.float64) + 0.5) / (1 << DRAW_BITS))
        steps.append((active, chosen, (nodes - first[active]).astype(np.int32)))
        counts[active] += 1
        nodes = nodes - length[chosen]
        at[active] = nodes
        active = active[nodes > first[active]]
    last = np.cumsum(counts) - 1
    pieces, ends = np.empty(counts.sum(), np.int32), np.empty(counts.sum(), np.int32)
    for k, (owners, chosen, reached) in enumerate(steps):
        pieces[last[owners] - k] = number[chosen]
        ends[last[owners] - k] = reached
    return pieces, ends, counts


def _first_reaching(reach: np.ndarray, edge: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """The first edge, from ``edge`` on, whose reach is not below what was drawn. Nodes have few edges, so
    walking along them beats a search of all edges."""
    chosen = edge.astype(np.int64)
    left = np.flatnonzero(reach[chosen] < drawn)
    while len(left):
        chosen[left] += 1
        left = left[reach[chosen[left]] < drawn[left]]
    return chosen


class Sampler:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, model: bytes, seed: int, alpha: float):
        self.v, self.seed = load(model, alpha), seed
        self.lattices = Lattices(self.v)

    def encode(self, keys: list, texts: list[str]) -> list[np.ndarray]:
        """Piece numbers per text. Texts are worked through in groups of about DRAWN characters; a
        longer one is cut between words, which changes nothing in the result."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0
        for row, (key, text) in enumerate(zip(keys, texts, strict=True)):
            digest = hashlib.blake2b((f"{self.seed}:{key}" if key is not None else f"{self.seed}").encode(), digest_size=8).digest()
            stream, number = np.uint64(int.from_bytes(digest)), 0
            for words in _between_spaces(text):
                ids = np.fromiter(map(self.lattices.__getitem__, words), np.int64, len(words))
                counter = np.arange(number, number + len(words), dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
                held.append((row, ids, mixed(stream + counter)))
                number += len(words)
                size += sum(map(len, words))
                if size >= DRAWN:
                    self._drawn(held, parts)
                    held, size = [], 0
        self._drawn(held, parts)
        return [np.concatenate(p) if p else np.empty(0, np.int32) for p in parts]

    def _drawn(self, held: list, parts: list[list[np.ndarray]]) -> None:
        if not held:
            return
        word = np.concatenate([h[1] for h in held])
        pieces, ends, counts = sample(self.lattices, word, np.concatenate([h[2] for h in held]))
        spelled = np.flatnonzero(pieces < 0)
        if len(spelled):
            owner = word[np.searchsorted(np.cumsum(counts), spelled, side="right")]
            words = self.lattices.words
            chars = [words[w][e - 1] for w, e in zip(owner.tolist(), ends[spelled].tolist(), strict=True)]
            bytes_ = [[self.v.byte[b] for b in c.encode()] for c in chars]
            sizes = np.ones(len(pieces), np.int64)
            sizes[spelled] = list(map(len, bytes_))
            sums = np.concatenate([[0], np.cumsum(sizes)])
            pieces = np.repeat(pieces, sizes)
            pieces[pieces < 0] = [b for own in bytes_ for b in own]
            counts = np.diff(sums[np.concatenate([[0], np.cumsum(counts)])])
        ends_of = np.cumsum([0, *(len(h[1]) for h in held)])
        cuts = np.concatenate([[0], np.cumsum(counts)])[ends_of]
        for (row, *_), a, b in zip(held, cuts.tolist(), cuts[1:].tolist(), strict=False):
            parts[row].append(pieces[a:b])
        if self.lattices.nodes > KEPT:
            self.lattices = Lattices(self.v)

    def decode(self, pieces: np.ndarray) -> str:
        """The text of piece numbers; the space mark before the first word is not part of it."""
        texts = self.v.texts
        return b"".join([texts[p] for p in pieces.tolist()])[1:].decode()


def _between_spaces(text: str) -> Iterator[list]:
    """What stands between the spaces of a text, in lists of about DRAWN characters or one run; runs
    longer than LONGEST are cut, all parts but the first in tuples."""
    start = 0
    while start <= len(text) and text:
        end = text.find(" ", start + DRAWN)
        end = len(text) if end < 0 else end
        words = text[start:end].split(" ")
        if max(map(len, words)) > LONGEST:
            words = [part for w in words for part in _cut(w)]
        yield words
        start = end + 1


def _cut(word: str) -> list:
    return [word[:LONGEST], *((word[k : k + LONGEST],) for k in range(LONGEST, len(word), LONGEST))]


# -- Spark --------------------------------------------------------------------------------


def pieces_of(
    spark, path: str, key: Column, text: Column, seed: int = 0, alpha: float = 1.0
) -> Column:
    """A struct of ``pieces`` (array<int>), ``n_pieces`` and ``lossless``: whether they decode to the text.

    NULL texts are empty and have no pieces. Rows with equal keys and texts get equal pieces; a NULL key
    is a key like any other.
    """
    model = spark.sparkContext.broadcast(read_file(path))

    @F.arrow_udf("struct<pieces: array<int>, n_pieces: bigint, lossless: boolean>")
    def drawn(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sampler = Sampler(model.value, seed, alpha)
        for keys, texts in batches:
            done = []
            for at in range(0, max(len(keys), 1), ROWS):
                names, own = [k.as_py() for k in keys.slice(at, ROWS)], list(strings(texts.slice(at, ROWS)))
                found = sampler.encode(names, own)
                same = [sampler.decode(p) == t for p, t in zip(found, own, strict=True)]
                columns = [
                    pa.array(found, pa.list_(pa.int32())), pa.array([len(p) for p in found], pa.int64()), pa.array(same, pa.bool_()),
                ]
                done.append(pa.StructArray.from_arrays(columns, names=["pieces", "n_pieces", "lossless"]))
            yield pa.concat_arrays(done)

    return drawn(key.cast("string"), filled(text))


def encode(docs: DataFrame, path: str, key: str, text: str = "text", seed: int = 0, alpha: float = 1.0) -> DataFrame:
    """``docs`` with ``pieces``, ``n_pieces`` and ``lossless``; columns of these names are replaced."""
    (drawn,) = unused(docs, "drawn")
    found = docs.withColumn(drawn, pieces_of(docs.sparkSession, path, F.col(key), F.col(text), seed, alpha))
    return found.withColumns({n: F.col(drawn)[n] for n in ("pieces", "n_pieces", "lossless")}).drop(drawn)


def decoded(spark, path: str, pieces: str | Column) -> Column:
    """The text of a column of piece numbers; NULL is the empty text."""
    model = spark.sparkContext.broadcast(read_file(path))

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sampler = Sampler(model.value, 0, 1.0)
        for rows in batches:
            yield pa.array([sampler.decode(np.asarray(r.as_py() or [], np.int64)) for r in rows], pa.string())

    return texts(pieces)
