"""Repeated byte strings against a plain version, and the index against all pairs of suffixes."""

import collections
import hashlib
import random

import numpy as np
import pytest
from brute import TEXTS, frame

from millrace.llm import run_index


def plain(rows, length):
    data = [(text or "").encode() for _, text in rows]
    counts = collections.Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    found = []
    for (key, _), t in zip(rows, data, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        found.append((key, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def documents(seed):
    rng = random.Random(seed)

    def noise(n, letters="abcdefgh é日"):
        return "".join(rng.choices(letters, k=n))

    passages = [noise(n) for n in (60, 75, 90, 140, 300)]
    rows = [(k, noise(rng.randrange(200)) + rng.choice(passages) + noise(rng.randrange(120))) for k in range(60)]
    rows += [(100 + k, noise(rng.randrange(1, 90)) + passages[3] + noise(rng.randrange(1, 90))) for k in range(80)]
    rows += [(300, "a" * 700), (301, "ab" * 150), (302, "a" * 90), (303, noise(40) * 6)]
    rows += [(305, passages[4]), (305, passages[4]), (None, passages[4][5:]), (306, noise(5000))]
    rows += [(307, rows[-1][1][1000:1400] + noise(3000, "xyz") + rows[-1][1][50:900])]
    return [*rows, *TEXTS]


@pytest.mark.parametrize(("hot", "chunk", "indexed"), [(1024, 1 << 20, 1 << 20), (3, 1 << 20, 4000), (1024, 333, 1 << 20)])
def test_against_definition(spark, monkeypatch, hot, chunk, indexed):
    monkeypatch.setattr(run_index, "HOT", hot)
    monkeypatch.setattr(run_index, "CHUNK", chunk)
    monkeypatch.setattr(run_index, "INDEXED", indexed)
    rows = documents(hot + chunk)
    for length in (64, 100):
        found = run_index.remove_repeats(frame(spark, rows).repartition(7), "doc_id", length=length)
        assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        found = found.collect()
        assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(plain(rows, length), key=repr)
        assert all(sum(e - a for a, e in r.spans) == r.n_removed and len(r.spans) == r.n_spans for r in found)


def test_nothing_and_short_lengths(spark):
    assert run_index.remove_repeats(frame(spark).limit(0), "doc_id").collect() == []
    with pytest.raises(ValueError, match="at least"):
        run_index.remove_repeats(frame(spark), "doc_id", length=50)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_matches_against_all_pairs(letters):
    rng = random.Random(len(letters))
    made = ["".join(rng.choices(letters, k=50)) for _ in range(4)]
    texts = [(rng.choice(made) + rng.choice(made) + "".join(rng.choices(letters, k=7))).encode() for _ in range(8)]
    texts += [b"a" * 40, b"a" * 35, bytes(range(256)), bytes(range(100, 256))]
    index = run_index.RunIndex(texts)
    joined = np.concatenate([[*(b + 1 for b in t), 0] for t in texts]).tolist()
    suffixes = sorted(range(len(joined)), key=lambda i: joined[i:])
    place = {i: r for r, i in enumerate(suffixes)}

    def common(a, b):
        n = 0
        while max(a, b) + n < len(joined) and joined[a + n] == joined[b + n]:
            n += 1
        return n

    best = [max(common(i, suffixes[r]) for r in (place[i] - 1, place[i] + 1) if 0 <= r < len(suffixes)) for i in range(len(joined))]
    assert index.matches().tolist() == best
    assert index.runs < len(joined)


def test_repetitive_texts_have_few_runs():
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefgh", k=300)).encode()
    few = run_index.RunIndex([text]).runs
    assert run_index.RunIndex([text[k % 5 :] for k in range(200)]).runs < 4 * few


def test_pieces_hold_every_window_once_and_agree_in_equal_texts():
    rng = random.Random(8)
    shared = bytes(rng.choices(b"abcdef", k=900))
    rolling = [run_index.Rolling(base) for base in run_index.BASES]
    seen = []
    for before in (b"", bytes(rng.choices(b"abcdef", k=321))):
        data = before + shared + bytes(rng.choices(b"abcdef", k=77))
        cut = run_index.cut_pieces(data, rolling, 200)
        windows = np.concatenate([np.arange(a, a + n) for a, n in zip(cut.start, cut.windows, strict=True)])
        assert windows.tolist() == list(range(len(data) - 199))
        names = {}
        for anchor, start, n, offset in zip(cut.anchor, cut.start, cut.windows, cut.offset, strict=True):
            for w in range(start, start + n):
                names[data[w : w + 200]] = (anchor, offset - (w - start))
        seen.append(names)
    common = seen[0].keys() & seen[1].keys()
    assert len(common) == 701 and all(seen[0][w] == seen[1][w] for w in common)
