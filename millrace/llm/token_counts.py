"""Token counts: whole-token shortcut.

A word vocabulary holds many strings that the tokenizer turns into exactly one token. Which they
are is proved once, on the driver: each vocabulary string goes through normalisation, splitting
and merging, and counts as whole if one token, itself, comes out. In the tasks a pre-token that is
whole counts as one; only the others run the merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.text import blocks, filled, read_file, strings

# Costs of merged pre-tokens kept by a task, and the longest pre-token that is kept.
KEPT = 1 << 18
KEPT_LENGTH = 64

# The splitting pattern of the word vocabulary for normalised text of characters below
# U+0180 (letters, numbers and white space by their Unicode classes).
LATIN = re.compile(
    r"[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0a-zªµºß-öø-ſ0-9²³¹¼-¾]+"
)
# Other words, and the one below whose lower case leaves the range, take the library's own steps.
OTHER = re.compile(r"[^\t-\r ]*[^\x00-\u012f\u0131-\u017f][^\t-\r ]*")
WORD = re.compile(r"[^\t-\r ]+")  # every word, for files that split otherwise


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else the next from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
LETTER_BYTES = {letter: b for b, letter in enumerate(BYTE_LETTERS)}


@lru_cache(maxsize=4)
def whole_tokens(spec: str) -> frozenset[str]:
    """Pre-tokens that encode alone as one token.

    A vocabulary string is proved whole by running the tokenizer on its text: it must come out of
    normalisation and splitting as one pre-token and of the merges as the token it names.
    """
    tokenizer = Tokenizer.from_str(spec)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    whole = set()
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        letters = entry[: len(entry) - len(suffix)]
        if not letters or not entry.endswith(suffix) or not all(c in LETTER_BYTES for c in letters):
            continue
        try:
            text = bytes(LETTER_BYTES[c] for c in letters).decode()
        except UnicodeDecodeError:
            continue
        normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        alone = [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)] == [letters]
        if alone and [x.id for x in tokenizer.model.tokenize(letters)] == [number]:
            whole.add(text)
    return frozenset(whole)


def _probes() -> Iterator[str]:
    """Texts without white space that show how a file splits: every character below U+0180 between
    letters, digits, marks and itself, and the endings that the pattern names."""
    kinds = ("", "a", "Z", "7", ".", "é")
    shown = [chr(c) for c in range(33, 0x180) if not chr(c).isspace() and not OTHER.fullmatch(chr(c))]
    for c in shown:
        yield from (f"{left}{c}{c}{right}" for left in kinds for right in kinds)
    yield from (f"a'{end}{more}" for end in ("s", "t", "re", "ve", "m", "ll", "d", "x", "S", "RE") for more in ("", "a", "7", "'s"))
    yield from ("12345", "a1b22", "''s", "...a", "CamelCase", "x" * 300, "1" * 300)


@lru_cache(maxsize=4)
def splits_as_built_in(spec: str) -> bool:
    """Whether the file normalises and splits the probes as ``LATIN`` and lower-casing do.

    Any file that does not is counted by the library's own steps, word by word.
    """
    tokenizer = Tokenizer.from_str(spec)
    for text in _probes():
        normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        pieces = [bytes(LETTER_BYTES.get(c, 0) for c in p).decode(errors="replace") for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        if pieces != LATIN.findall(text.lower()):
            return False
    return True


class PieceCosts(dict):
    """Tokens per pre-token: the whole ones from the start, the others as they are merged."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.whole = tokenizer, whole

    def __missing__(self, piece: str) -> int:
        cost = len(self.tokenizer.model.tokenize("".join([BYTE_LETTERS[b] for b in piece.encode()])))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = cost
        return cost


class Counter:
    """Counts the tokens of whole texts.

    Splitting drops white space, no pre-token holds any, and neither composition nor lower-casing
    looks beyond it; so the count of a text is the sum over its parts, however it is cut there.
    """

    def __init__(self, spec: str, whole: frozenset[str], built_in: bool | None = None):
        self.tokenizer = Tokenizer.from_str(spec)
        known = splits_as_built_in(spec) if built_in is None else built_in
        self.others = OTHER if known else WORD
        self.costs = PieceCosts(self.tokenizer, whole)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._count(b) for part in parts for b in blocks(part))

    def _count(self, text: str) -> int:
        total, others = 0, self.others.findall(text)
        if others:
            text = self.others.sub(" ", text)
            normalizer = self.tokenizer.normalizer
            for word in others:
                normal = normalizer.normalize_str(word) if normalizer else word
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                    total += self.costs[bytes(LETTER_BYTES[c] for c in piece).decode()]
        return total + sum(map(self.costs.__getitem__, LATIN.findall(text.lower())))


def token_count(spark, path: str, text: str | Column) -> Column:
    """The number of tokens of a text column, without begin or end tokens; NULL counts as empty.

    ``path`` names a ``tokenizers`` file whose splitting drops white space. The file (a few MB) and
    the whole tokens are sent to the tasks. Files that normalise or split otherwise than the word
    vocabulary take the library's own steps for every word. Strings of special tokens inside a text are those tokens.
    """
    spec = read_file(path).decode()
    if ["a"] != [p for p, _ in Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str(" a ")]:
        raise ValueError("the tokenizer keeps white space in its pre-tokens")
    sent = spark.sparkContext.broadcast((spec, whole_tokens(spec), splits_as_built_in(spec)))

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(*sent.value)
        for texts in batches:
            yield pa.array([counter.count(text) for text in strings(texts)], pa.int64())

    return count(filled(text))


def count_tokens(df: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Columns of these names are replaced. Every row comes back, repeated rows as often as they came;
    NULL and empty texts count 0 and 0.
    """
    counted = df.withColumns(
        {
            "n_bytes": F.octet_length(filled(text)).cast("long"),
            "n_tokens": token_count(df.sparkSession, path, text),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
