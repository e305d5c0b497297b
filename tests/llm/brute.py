"""Plain versions of the operators, and texts with the awkward cases."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


BASE = "the quick brown fox jumps over the lazy dog while seven wizards brew a strong potion in the old tower by night"
TEXTS = [
    (1, BASE + "\nsecond line of the first text, which is not found anywhere else at all\n" + BASE),
    (2, BASE),
    (3, "other words stand here first " + BASE.replace("seven", "eight") + " and some follow"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "Été à l'école; naïve 日本語 テキスト 😀 \x1c x\xa0y Σας <|endoftext|> DON'T 123"),
    (8, "one"),
    (9, "a b " * 30),
    (10, "word " * 5 + BASE),
    (10, "word " * 5 + BASE),
    (11, "x" * 5000),
    (None, BASE),
]


def frame(spark, rows=TEXTS, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:  # columns that clash with what operators add
        names = ("key", "n_words", "fingerprint", "pieces", "quality", "row", "n_tokens", "line", "starts", "item", "_key")
        for name in names:
            df = df.selectExpr("*", f"'mine' AS {name}")
    return df


def repeats(rows, window=13):
    first = {}
    for key, text in rows:
        own = words(text)
        for k in range(len(own) - window + 1):
            if key is not None:
                run = tuple(own[k : k + window])
                first[run] = min(first.get(run, key), key)
    found = []
    for key, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if key is not None and first[tuple(own[k : k + window])] < key:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        found.append((key, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def unigram(rows, held):
    counts = collections.Counter()
    for key, text in rows:
        if not held(key):
            counts.update([*words(lower(text)), ""])
    n, v = sum(counts.values()), len(counts)
    found = []
    for key, text in rows:
        own = [*words(lower(text)), ""]
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        found.append((key, len(own), sum(counts[w] > 0 for w in own), n, score))
    return found


def is_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2
