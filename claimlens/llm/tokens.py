"""Exact counts and ids of public tokenizers, memoised by pre-token.

A byte-pair tokenizer merges inside pre-tokens only, so a text's tokens are the tokens of its pre-tokens. Texts of a
plain alphabet are split here by the tokenizer's own pattern; for every other text the library does all the work.
Whatever the memo does not know the library encodes, so results are the library's at any memo size.

Texts longer than PIECE are taken a piece at a time, cut where a pre-token must end whatever stands on the other side:
before a blank or line feed after a character that no engine takes for white space, and after a full stop of the
Chinese and Japanese scripts before one of their letters. So one odd character costs the library one piece, not the
text. A run without such a place is one piece, as long as it is.

Defined results: null text is empty (zero tokens); special strings inside texts are what the library makes of them;
repeated rows are counted each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from claimlens.plans.session import small_batches

#: Entries of each of a worker's two memo generations.
MEMO = 180_000
#: Pre-tokens longer than this are encoded without being kept.
LONG = 64

#: Characters of a long text taken at once.
PIECE = 1 << 16
_BORDER = re.compile(r"(?<=[^\s\u180e\u200b])(?=[ \n])|(?<=[。！？])(?=[ぁ-ゖ一-鿿])")

#: Outside this alphabet the engines' character classes might differ.
_ODD = re.compile(r"[^\t\n\r -~¡«»¿À-ɏ]")
_BYTE_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ɏ0-9]+|\s+(?!\S)|\s+")


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def prove_whole_tokens(path: str) -> list[str]:
    """Offline proof: the vocabulary strings that are one pre-token and that the library encodes alone as one token."""
    tok, letters = load(path), byte_alphabet()
    strings = []
    for piece in tok.get_vocab(with_added_tokens=False):
        try:
            strings.append(bytes(letters[c] for c in piece).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue
    strings = sorted(s for s in strings if not _ODD.search(s) and _BYTE_LEVEL.findall(s) == [s])
    return [s for s, e in zip(strings, tok.encode_batch_fast(strings, add_special_tokens=False), strict=True) if len(e.ids) == 1]


def merger(path: str) -> Callable[[str], list]:
    """The library's merges of one pre-token that is already normalised: its bytes in the vocabulary's alphabet."""
    tokenize, letters = load(path).model.tokenize, {b: c for c, b in byte_alphabet().items()}
    return lambda piece: tokenize(piece.encode("utf-8").decode("latin-1").translate(letters))


class Memo(dict):
    """What `make` gives for each pre-token, in two generations: entries still in use move to the young one, and when
    that is full the old one is dropped."""

    def __init__(self, make: Callable, keep: dict):
        super().__init__(keep)
        self.make, self.keep, self.old = make, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONG:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > MEMO + len(self.keep):
            self.old = dict(self)
            self.clear()
            self.update(self.keep)

    def rest(self) -> None:
        """Give back the old generation between tasks, as a worker may lie idle with it."""
        self.old = {}


def odd(text: str, beyond: re.Pattern = _ODD) -> bool:
    """Whether the library must split a text: characters that engines class differently."""
    if text.isascii():
        return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
    return beyond.search(text) is not None


def pieces(text: str, size: int | None = None) -> Iterator[str]:
    """The text in parts of `size` characters or somewhat more, whose pre-tokens together are the text's."""
    size, at = size or PIECE, 0
    while len(text) - at > size and (m := _BORDER.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


class Counter:
    """Token counts of whole texts: proven pre-tokens count one, the library merges the rest."""

    def __init__(self, path: str, proven: list[str]):
        self.tok, merge = load(path), merger(path)
        self.memo = Memo(lambda piece: len(merge(piece)), dict.fromkeys(proven, 1))
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def count(self, text: str) -> int:
        return self._count(text) if len(text) <= PIECE else sum(map(self._count, pieces(text)))

    def _count(self, text: str) -> int:
        if odd(text) or any(s in text for s in self.special):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        self.memo.trim()
        return sum(map(self.memo.__getitem__, _BYTE_LEVEL.findall(text)))


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text; the proof is made once and sent to the workers.

    The proven strings are at most the vocabulary, so what is broadcast does not grow with the data.
    """
    spark = small_batches(docs.sparkSession)
    proven = spark.sparkContext.broadcast(prove_whole_tokens(path))

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, Counter(path, proven.value))
        for batch in batches:
            yield pd.Series([counter.count(t or "") for t in batch], dtype="int64")
        counter.memo.rest()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), count("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
