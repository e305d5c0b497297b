"""Token counts, pieces, quality rules, substrings and language model against plain versions."""

import collections
import json
import math

import numpy as np
import pytest
import sentencepiece
from brute import BASE, TEXTS, frame, is_held, repeats, unigram, words
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import language_model, pieces, quality, substrings, token_counts

WORDS, PIECES = path("word_bpe_49k.json"), path("piece_bpe_32k.model")


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_token_counts_are_the_librarys(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    found = token_counts.count_tokens(frame(spark), WORDS, 20).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    expected = []
    for key, text in TEXTS:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((key, len((text or "").encode()), n, n > 20))
    assert order(map(tuple, found.collect())) == order(expected)


def test_files_that_split_otherwise_take_the_librarys_steps():
    spec = json.loads(Tokenizer.from_file(WORDS).to_str())
    texts = [t or "" for _, t in TEXTS] + ["In 2024 there were 1234567 of 12 THINGS", "McDonald's DON'T <|endoftext|> x"]
    digits, cased, bare = (json.loads(json.dumps(spec)) for _ in range(3))
    split = digits["pre_tokenizer"]["pretokenizers"][0]["pattern"]
    split["Regex"] = split["Regex"].replace(r"|[\p{N}]|", r"|[\p{N}]+|")
    cased["normalizer"] = {"type": "NFC"}
    bare["added_tokens"], bare["normalizer"] = [], None
    assert token_counts.splits_as_built_in(json.dumps(spec))
    for changed in (digits, cased, bare):
        made = json.dumps(changed)
        assert not token_counts.splits_as_built_in(made)
        tokenizer = Tokenizer.from_str(made)
        counter = token_counts.Counter(made, token_counts.whole_tokens(made))
        assert [counter.count(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_every_low_character_is_split_as_the_library_does():
    tokenizer = Tokenizer.from_file(WORDS)
    counter = token_counts.Counter(tokenizer.to_str(), token_counts.whole_tokens(tokenizer.to_str()))
    for code in [*range(0x250), 0x301, 0x660, 0x2028, 0x3000, 0xFB01, 0x1F600]:
        for text in (f"a{chr(code)}b", f"1{chr(code)}!", f"{chr(code)} x{chr(code)}́"):
            assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), hex(code)


def test_blocks_do_not_change_counts():
    tokenizer = Tokenizer.from_file(WORDS)
    counter = token_counts.Counter(tokenizer.to_str(), token_counts.whole_tokens(tokenizer.to_str()))
    text = (BASE + "\n") * 15000
    assert counter.count(text) == 15000 * counter.count(BASE)


def test_pieces_are_lossless_and_repeatable(spark):
    df = pieces.encode(frame(spark), PIECES, "doc_id", seed=3)
    rows = df.select("doc_id", "text", "pieces", "n_pieces", "lossless").collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert len(rows) == len(TEXTS) and all(r.lossless for r in rows)
    assert all(sp.decode(r.pieces) == (r.text or "") and r.n_pieces == len(r.pieces) for r in rows)
    again = pieces.encode(frame(spark).repartition(5), PIECES, "doc_id", seed=3)
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    assert sorted([(key(r), r.pieces) for r in rows]) == sorted([(key(r), r.pieces) for r in again.collect()])
    decoded = df.select("text", pieces.decoded(spark, PIECES, "pieces").alias("back")).collect()
    assert all(r.back == (r.text or "") for r in decoded)


def test_pieces_follow_the_lattice_distribution():
    sampler = pieces.Sampler(open(PIECES, "rb").read(), 1, 0.5)
    word, n = "then▁", 20000
    found = collections.Counter(tuple(p.tolist()) for p in sampler.encode(list(range(n)), [word[:-1]] * n))

    def ways(rest):
        if not rest:
            yield ()
        for k in range(1, len(rest) + 1):
            if rest[:k] in sampler.v.numbers:
                yield from ((sampler.v.numbers[rest[:k]], *more) for more in ways(rest[k:]))

    weights = {w: math.prod(sampler.v.weights[p] for p in w) for w in ways("▁" + word[:-1])}
    total = sum(weights.values())
    assert set(found) <= set(weights)
    assert max(abs(found[w] / n - x / total) for w, x in weights.items()) < 0.015
    mark = sampler.encode([0], [word])[0]
    assert sampler.decode(mark) == word  # the space mark within a text stays itself


def test_a_long_text_is_cut_without_effect():
    text = " ".join([BASE] * 20000) + " " + "y" * 9000
    sampler = pieces.Sampler(open(PIECES, "rb").read(), 1, 1.0)
    whole = sampler.encode([5], [text])[0]
    assert sampler.decode(whole) == text
    start = sampler.encode([5], [text[: 10 * len(BASE) + 9]])[0]
    assert np.array_equal(start, whole[: len(start)])


def test_statistics_against_definitions():
    for _, text in [*TEXTS, (0, "a\n a\na\nb c\n\n\n#*$%&|<>")]:
        counts, _ = quality.statistics(text or "")
        own = words(text)
        seen = collections.Counter(tuple(own[k : k + 8]) for k in range(len(own) - 7))
        inside = {j for k in range(len(own) - 7) if seen[tuple(own[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        assert counts == [len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(inside)]


def test_forest_is_monotonic_and_learns():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(4000) < 0.1)).astype(float)
    forest = quality.fit_forest(x[:2000], y[:2000], falling=(0,))
    assert ((forest.score(x[2000:]) >= 0) == y[2000:]).mean() > 0.85
    grid = np.linspace(0, 1, 200)
    for b, c in rng.random((20, 2)):
        rows = np.stack([grid, np.full(200, b), np.full(200, c)], axis=1)
        assert (np.diff(forest.score(rows)) <= 1e-12).all()


def test_quality_on_held_out_labels(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/labels.parquet")
    odd = F.col("doc_id") % 2 == 1
    judged = quality.judge(docs, quality.fit(docs, labels.filter(odd))).join(labels.filter(~odd).select("doc_id", F.col("quality").alias("y")), "doc_id")
    right = judged.select(F.avg(((F.col("quality.score") >= 0).cast("int") == F.col("y")).cast("double"))).first()[0]
    assert right > 0.95


def test_quality_without_labels_and_rows(spark):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    forest = quality.fit(frame(spark), labels)
    rows = quality.judge(frame(spark), forest).select("doc_id", "quality.*").collect()
    assert len(rows) == len(TEXTS)
    assert [r.kept for r in rows if r.doc_id == 2] == [True] and [r.base_failed for r in rows if r.doc_id == 4] == [True]
    assert quality.judge(frame(spark).limit(0), forest).count() == 0


def test_substrings_against_definition(spark):
    long = (12, " ".join(f"w{k % 97}" for k in range(3000)))
    rows = [*TEXTS, long, (13, "start " + long[1])]
    found = substrings.remove_repeats(frame(spark, rows), "doc_id").select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert order(map(tuple, found.collect())) == order(repeats(rows))


def test_a_run_of_just_the_window_is_found_at_any_offset(spark):
    run = " ".join(f"r{k}" for k in range(13))
    rows = [(k, " ".join(f"d{k}x{j}" for j in range(k)) + " " + run + f" end{k}") for k in range(1, 30)]
    found = {r.doc_id: r.n_removed for r in substrings.remove_repeats(frame(spark, rows), "doc_id").collect()}
    assert found == {k: 0 if k == 1 else 13 for k in range(1, 30)}


def test_substrings_of_an_empty_table(spark):
    assert substrings.remove_repeats(frame(spark).limit(0), "doc_id").count() == 0


def test_language_model_scores(spark):
    rows = [(k, t if k is None or k < 11 else BASE) for k, t in TEXTS] + [(k, BASE[k % 40 :]) for k in range(20, 60)]
    docs = frame(spark, rows)
    fitted = language_model.fit(docs.filter(~language_model.held_out(F.col("doc_id"))))
    found = language_model.score(docs, fitted, "doc_id").select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = order((r[0], *r[1:4], round(r[4], 6)) for r in found.collect())
    assert got == order((*e[:4], round(e[4], 6)) for e in unigram(rows, is_held))
    table = fitted.model.log_probabilities().reshape(-1, language_model.CLASSES)
    assert np.allclose((10.0**table).sum(axis=1), 1, atol=1e-4)
    better = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert better[0] > better[1]


def test_language_model_learns_from_every_ngram():
    """A gram met once in a billion still moves the vectors of its classes; nothing is left to a draw."""
    c = language_model.CLASSES
    grams, counts = np.asarray([(3 * c + 4) * c + 5, (6 * c + 7) * c + 8]), np.asarray([1e9, 1.0])
    start, moved = (language_model.train(grams, counts, steps=k) for k in (0, 20))
    for name, classes in {"context": [3, 4, 6, 7], "target": [5, 8]}.items():
        gone = np.abs(getattr(moved, name) - getattr(start, name)).max(axis=1)
        assert (gone[classes] > 1e-3).all()


def test_language_model_comes_near_the_counts():
    c, rng = language_model.CLASSES, np.random.default_rng(4)
    grams = np.unique(rng.integers(0, 4, (200, 3)) @ np.asarray([c * c, c, 1]))
    counts = rng.integers(1, 2000, len(grams)).astype(float)
    table = 10.0 ** language_model.train(grams, counts).log_probabilities().reshape(-1, c)
    total = np.bincount(grams // c, counts, c * c)
    assert np.average(np.abs(table[grams // c, grams % c] - counts / total[grams // c]), weights=counts) < 0.1


def test_language_model_without_texts(spark):
    fitted = language_model.fit(frame(spark).limit(0))
    assert language_model.score(frame(spark), fitted, "doc_id").count() == len(TEXTS)


@pytest.mark.parametrize("text", ["", "the cat", "THE  Cat\n"])
def test_class_sequences_end_and_begin_with_the_end(text):
    classes = language_model.Classes([b"the"])
    found = language_model.class_sequence(text.encode(), classes)
    assert len(found) == language_model.CONTEXT + len(text.split()) + 1
    assert found[0] == found[-1] == language_model.END
