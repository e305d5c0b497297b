"""LM scoring: a log-bilinear model trained with noise-contrastive estimation.

A word belongs to a class: one of its own if it is among the most frequent words, else one shared by
the words that hash alike by their last letters. The log-bilinear model predicts the class of a word
from the classes before it: each class has a vector as context and one as target, context vectors
are weighted by position and added, and the dot product with a target vector plus a bias is its
score. Within a class a word has its smoothed share of the training tokens. Both parts are normalised,
so every text has a probability, over known words and one unknown word per class.

All counts come from all training texts. Their class n-grams, at most classes ** (context + 1)
numbers whatever the size of the corpus, are what the model is trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import filled, stored, utf8, word_blocks

CONTEXT = 2  # words before the predicted one
OWN = 95  # most frequent words with a class of their own
SHARED = 32  # classes of all other words, by their ending
END = OWN + SHARED  # class of the end of a text, and of what stands before its first word
CLASSES = END + 1
WIDTH = 32  # of a class vector
NOISE = 16  # noise samples per observed n-gram, as an expectation
SENT = 200_000  # at most so many counts of frequent words are sent to the tasks; the others are joined
STEPS, RATE = 600, 0.1  # of the training, each step over all n-grams


def ending_class(word: bytes) -> int:
    """The shared class of a word, by its last two bytes."""
    return OWN + crc32(word[-2:]) % SHARED


class Classes(dict):
    """Classes of words; those not given are found by their endings."""

    KEPT = 1 << 18

    def __init__(self, own: list[bytes]):
        super().__init__({w: k for k, w in enumerate(own)})
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.KEPT:
            self.clear()
            self.update({w: k for k, w in enumerate(self.own)})
        self[word] = found = ending_class(word)
        return found


def class_sequence(data: bytes, classes: Classes) -> np.ndarray:
    """The classes of a lower-cased text's words, with the end before and after them."""
    parts = [np.full(CONTEXT, END, np.int64)]
    parts += [np.fromiter(map(classes.__getitem__, ws), np.int64, len(ws)) for ws in word_blocks(data.lower())]
    return np.concatenate([*parts, [END]])


def codes(sequence: np.ndarray) -> np.ndarray:
    """One number per predicted position: the classes before it and its own, in base CLASSES."""
    n = len(sequence) - CONTEXT
    found = np.zeros(n, np.int64)
    for k in range(CONTEXT + 1):
        found = found * CLASSES + sequence[k : k + n]
    return found


# -- the model ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    context: np.ndarray  # CLASSES x WIDTH
    target: np.ndarray  # CLASSES x WIDTH
    position: np.ndarray  # CONTEXT x WIDTH
    bias: np.ndarray  # CLASSES

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """Predicted vectors for rows of context classes."""
        return (self.context[before] * self.position).sum(axis=1)

    def log_probabilities(self, batch: int = 4096) -> np.ndarray:
        """Normalised log10 probabilities of every class after every context, by batched products."""
        every = np.arange(CLASSES**CONTEXT)
        before = np.stack([every // CLASSES ** (CONTEXT - 1 - k) % CLASSES for k in range(CONTEXT)], axis=1)
        table = np.empty((len(every), CLASSES), np.float32)
        for start in range(0, len(every), batch):
            scores = self.predicted(before[start : start + batch]) @ self.target.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            table[start : start + batch] = (scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))) / np.log(10)
        return table.reshape(-1)


def train(grams: np.ndarray, counts: np.ndarray, steps: int = STEPS, seed: int = 0) -> Model:
    """Fit to class n-gram counts by noise-contrastive estimation, with AdaGrad steps over all of them.

    Nothing is drawn but the vectors to start from: every step takes each n-gram with its count, and for
    each context the NOISE noise samples per observed n-gram as their expectation under the unigram
    distribution of classes. Scores count as log-probabilities, so the model learns to be nearly
    normalised by itself. The tables have a row per context met, CLASSES ** CONTEXT at most.
    """
    rng = np.random.default_rng(seed)
    unigram = np.bincount(grams % CLASSES, counts, CLASSES) + 1.0
    noise = unigram / unigram.sum()
    log_noise = np.log(NOISE * noise).astype(np.float32)
    shapes = [rng.normal(0, 0.1, (CLASSES, WIDTH)), rng.normal(0, 0.1, (CLASSES, WIDTH)), np.ones((CONTEXT, WIDTH)) / CONTEXT]
    params = [p.astype(np.float32) for p in (*shapes, np.log(noise))]
    squares = [np.full_like(p, 1e-20) for p in params]  # keeps apart from 0 only
    if not len(grams):
        return Model(*params)
    contexts, row = np.unique(grams // CLASSES, return_inverse=True)
    before = np.stack([contexts // CLASSES ** (CONTEXT - 1 - k) % CLASSES for k in range(CONTEXT)], axis=1)
    seen = np.zeros((len(contexts), CLASSES))
    np.add.at(seen, (row, grams % CLASSES), counts / counts.sum())
    both = (seen + seen.sum(axis=1, keepdims=True) * (NOISE * noise)).astype(np.float32)
    seen = seen.astype(np.float32)
    # sums by class are products with indicators
    holds = [(np.arange(CLASSES)[:, None] == before[:, k]).astype(np.float32) for k in range(CONTEXT)]
    for step in range(steps):
        context, target, position, bias = params
        inputs = context[before]
        predicted = (inputs * position).sum(axis=1)
        score = predicted @ target.T + bias
        error = both * (0.5 + 0.5 * np.tanh(0.5 * (score - log_noise))) - seen
        to_predicted = error @ target
        to_position = (to_predicted[:, None, :] * inputs).sum(axis=0)
        to_context = sum(holds[k] @ (to_predicted * position[k]) for k in range(CONTEXT))
        rate = RATE * (1 - step / steps)
        for p, s, g in zip(params, squares, (to_context, error.T @ predicted, to_position, error.sum(axis=0)), strict=True):
            s += g * g
            p -= rate * g / np.sqrt(s)
    return Model(*params)


# -- Spark --------------------------------------------------------------------------------


def held_out(key: Column, parts: int = 7, rest: int = 2) -> Column:
    """Whether a row is kept from training, by the CRC-32 of its key as text; a NULL key trains."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == rest, F.lit(False))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word`` (bytes) and ``c`` of all texts; words of one batch are counted before they are shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def rows() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "c"]
            )
            held.clear()
            return found

        for batch in batches:
            for data in utf8(batch.column(0)):
                for words in word_blocks(data.lower()):
                    for word in words:
                        held[word] = held.get(word, 0) + 1
                    if len(held) >= 1 << 18:
                        yield rows()
                held[b""] = held.get(b"", 0) + 1
            if len(held) >= 1 << 18:
                yield rows()
        yield rows()

    partial = docs.select(filled(text).alias("text")).mapInArrow(counted, "word binary, c bigint")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def _grams(own: list[bytes]):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = Classes(own), np.zeros(CLASSES ** (CONTEXT + 1), np.int64)
        for batch in batches:
            for data in utf8(batch.column(0)):
                found, n = np.unique(codes(class_sequence(data, classes)), return_counts=True)
                total[found] += n
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["gram", "c"])

    return counted


@dataclass(frozen=True)
class Fitted:
    """What scoring needs: ``words`` is the stored count table, the rest is bounded."""

    words: DataFrame
    tokens: int
    distinct: int
    frequent: list[tuple[bytes, int]]
    own: list[bytes]
    class_tokens: np.ndarray
    class_words: np.ndarray
    model: Model


def _frequent(words: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words above a count that at most ``most`` words have, with their counts, most frequent first.

    The bound is found among steps of a sixteenth of a doubling: no more than a thousand sums are
    collected for it, whatever the vocabulary.
    """
    named = words.filter(F.length("word") > 0).withColumn("step", F.floor(16 * F.log2("c")).cast("int"))
    sizes = sorted(((r.step, r.n) for r in named.groupBy("step").agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held = None, 0
    for step, n in sizes:
        if held + n > most:
            break
        least, held = step, held + n
    if least is None:
        return []
    top = named.filter(F.col("step") >= least).select("word", "c").toArrow()  # at most ``most`` rows
    pairs = zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True)
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def fit(docs: DataFrame, text: str = "text") -> Fitted:
    """Counts and model of all given texts."""
    spark = docs.sparkSession
    words = stored(word_counts(docs, text))
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = _frequent(words, SENT)
    own = [w for w, _ in frequent[:OWN]]
    sent = spark.sparkContext.broadcast(own)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = {w: k for k, w in enumerate(sent.value)}
        total, number = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            found = [END if not w else first.get(w, -1) for w in utf8(batch.column(0))]
            kinds = np.asarray([ending_class(w) if k < 0 else k for k, w in zip(found, utf8(batch.column(0)), strict=True)], np.int64)
            np.add.at(total, kinds, batch.column(1).to_numpy())
            number += np.bincount(kinds, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total), pa.array(number)], names=["k", "c", "n"])

    kinds = words.select("word", "c").mapInArrow(classed, "k bigint, c bigint, n bigint")
    class_tokens, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in kinds.groupBy("k").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():  # CLASSES rows
        class_tokens[r.k], class_words[r.k] = r.c, r.n
    texts = docs.select(filled(text).alias("text"))
    grams = texts.mapInArrow(_grams(own), "gram bigint, c bigint").groupBy("gram").agg(F.sum("c").alias("c"))
    found = grams.toArrow()  # at most CLASSES ** (CONTEXT + 1) rows
    numbers, n = found["gram"].to_numpy(), found["c"].to_numpy()
    order = np.argsort(numbers)
    model = train(numbers[order], n[order].astype(np.float64))
    return Fitted(words, tokens, distinct, frequent, own, class_tokens, class_words, model)


def _scored(sent):
    kind = "struct<n_tokens: bigint, n_known: bigint, smooth: double, model: double, rest: array<struct<word: binary, n: int>>>"

    @F.arrow_udf(kind)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        frequent, own, end, within, table = sent.value
        # counts of frequent words; others are 0 here and handed on
        number = {w: k + 1 for k, (w, _) in enumerate(frequent)}
        smooth = np.log10(np.asarray([0, *(c for _, c in frequent)], np.float64) + 1)
        classes = Classes(own)
        for texts in batches:
            rows = []
            for data in utf8(texts):
                lower, ids, rest = data.lower(), [], {}
                for words in word_blocks(lower):
                    found = [number.get(w, 0) for w in words]
                    ids.append(np.asarray(found, np.int64))
                    for word, k in zip(words, found, strict=True):
                        if not k:
                            rest[word] = rest.get(word, 0) + 1
                ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
                sequence = class_sequence(data, classes)
                model = table[codes(sequence)].sum(dtype=np.float64) - within[sequence[CONTEXT:]].sum()
                known = int(np.count_nonzero(ids)) + (end > 0)
                rows.append((len(ids) + 1, known, float(smooth[ids].sum() + np.log10(end + 1)), float(model), rest))
            n, known, smoothed, model, rests = zip(*rows, strict=True) if rows else ((),) * 5
            offsets = np.cumsum([0, *map(len, rests)], dtype=np.int32)
            words = pa.array([w for r in rests for w in r], pa.binary())
            counts = pa.array([c for r in rests for c in r.values()], pa.int32())
            pairs = pa.StructArray.from_arrays([words, counts], names=["word", "n"])
            columns = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(smoothed, pa.float64()), pa.array(model, pa.float64())]
            yield pa.StructArray.from_arrays(
                [*columns, pa.ListArray.from_arrays(pa.array(offsets), pairs)], names=["n_tokens", "n_known", "smooth", "model", "rest"]
            )

    return score


def score(docs: DataFrame, fitted: Fitted, key: str, text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Counts of the most frequent words are sent to the tasks; the other words of a row, each once, are
    joined with the whole count table, and the logarithms of their counts are added up per row. NULL
    and empty texts are scored as an end alone. Repeated rows, also of one key, each come back.
    """
    spark = docs.sparkSession
    end = fitted.class_tokens[END]
    within = np.log10(np.maximum(fitted.class_tokens + fitted.class_words, 0) + 1.0)
    sent = spark.sparkContext.broadcast((fitted.frequent, fitted.own, int(end), within, fitted.model.log_probabilities()))
    scored = docs.select(F.col(key).alias("key"), _scored(sent)(filled(text)).alias("s"))
    found = stored(scored.select(F.monotonically_increasing_id().alias("row"), "key", "s.*"))
    rest = found.select("row", F.inline("rest"))
    smooth = (F.col("n") * F.log10(F.col("c") + 1.0)).alias("smooth")
    met = rest.join(fitted.words, "word").select("row", "n", smooth)
    more = met.groupBy("row").agg(F.sum("n").alias("more_known"), F.sum("smooth").alias("more"))
    joined = found.drop("rest").join(more, "row", "left").fillna({"more_known": 0, "more": 0.0})
    counted = F.col("smooth") + F.col("more")
    base = counted - F.col("n_tokens") * F.lit(float(np.log10(fitted.tokens + fitted.distinct + 1)))
    return joined.select(
        F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"),
        F.lit(fitted.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("model") + counted).alias("score"),
    )
