"""Benchmark decontamination by greedy string tiling.

Test items and documents are lower-cased word sequences. Karp-Rabin hashes of `seed` test words meet the running hashes
of a document (the join of shared-token seeds), and the longest non-overlapping match is marked again and again until
none of `seed` words is left. Tiles may lie in any order, so a passage whose sentences were moved about is covered like
one in place. A document leaks an item whose tiles cover `threshold` of it.

Places of seeds are never paired: a document's are kept once per distinct seed, and an item's longest match is found by
reading the stretches of the document that hold its seeds through a suffix automaton of what is unmarked of the item,
once per tile. So repetitive texts cost what their lengths sum to, not their product. Items whose seeds in the document
could not cover the threshold are passed over before that.

The test side goes to the tasks in blocks of about ITEM_BLOCK words, each against all documents, so nothing sent
grows with the data; a longer item is one block of its own. One long item bounds a tile search, not the corpus.

Defined results: null and wordless items match nothing; items shorter than the seed must match whole; null and empty
documents leak nothing; repeated document or item rows are each reported; ties between equally long matches go to the
first place in the item, then in the document; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

SEED, THRESHOLD, ITEM_BLOCK = 5, 0.6, 200_000
_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15  # odd, so multiplying by it loses nothing modulo 2^64


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes modulo 2^64 of every run of `width` ids."""
    n = len(ids) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out, x = np.zeros(n, np.uint64), ids.astype(np.uint64) + np.uint64(1)
    for i in range(width):
        out = out * np.uint64(_BASE) + x[i : i + n]
    return out


class Automaton:
    """Suffix automaton of a word sequence: where the longest suffix of what was read first stands in it."""

    def __init__(self, sequence: list[int]):
        self.step, self.link, self.size, self.first = [{}], [-1], [0], [-1]
        last = 0
        for at, c in enumerate(sequence):
            new = self._add(self.size[last] + 1, at, {}, -1)
            p = last
            while p >= 0 and c not in self.step[p]:
                self.step[p][c] = new
                p = self.link[p]
            if p < 0:
                self.link[new] = 0
            elif self.size[p] + 1 == self.size[q := self.step[p][c]]:
                self.link[new] = q
            else:
                twin = self._add(self.size[p] + 1, self.first[q], dict(self.step[q]), self.link[q])
                while p >= 0 and self.step[p].get(c) == q:
                    self.step[p][c] = twin
                    p = self.link[p]
                self.link[q] = self.link[new] = twin
            last = new

    def _add(self, size: int, first: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.first.append(first)
        return len(self.step) - 1

    def longest(self, stretches: list[tuple[int, list[int]]]) -> tuple[int, int, int]:
        """(length, place here, place there) of the longest match; of equals the first here, then the first there."""
        best, step, link, size, first = (0, 0, 0), self.step, self.link, self.size, self.first
        for start, sequence in stretches:
            state = n = 0
            for at, c in enumerate(sequence, start):
                while state and c not in step[state]:
                    state = link[state]
                    n = size[state]
                if c not in step[state]:
                    n = 0
                    continue
                state = step[state][c]
                n += 1
                if n > best[0] or (n == best[0] and first[state] - n + 1 < best[1]):
                    best = (n, first[state] - n + 1, at - n + 1)
        return best


def tiles(item: list[int], stretches: list[tuple[int, list[int]]], seed: int, whole: Automaton | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiling: (item start, document start, length) of the longest unmarked matches, longest first.

    stretches: (place, words) of the parts of the document that may match; `whole` is the item's own automaton.
    """
    out, item, at = [], list(item), whole or Automaton(item)
    while True:
        n, i, j = at.longest(stretches)
        if n < max(1, seed):
            return out
        out.append((i, j, n))
        item[i : i + n] = range(-2 - i, -2 - i - n, -1)  # each a word of its own, which no document holds
        cut = []
        for start, own in stretches:
            if start <= j < start + len(own):
                own, rest = own[: j - start], own[j - start + n :]
                cut += [(j + n, rest)] if len(rest) >= seed else []
            if len(own) >= seed:
                cut.append((start, own))
        stretches, at = sorted(cut), Automaton(item)


class Index:
    """The seeds of one block of test items."""

    def __init__(self, items: list[tuple[int, str]], seed: int):
        self.vocab: dict[str, int] = {}
        self.items = []
        self.seeds: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words(text)], np.int64)
            if not len(ids):
                continue
            width = min(seed, len(ids))
            for at, h in enumerate(rolling(ids, width).tolist()):
                self.seeds[width][h].append((len(self.items), at))
            self.items.append((item_id, ids.tolist(), width))
        self.sorted = {w: np.array(sorted(s), np.uint64) for w, s in self.seeds.items()}
        self.automata: dict[int, Automaton] = {}

    def leaks(self, text: str | None, threshold: float = 0.0) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(item_id, item words, covered words, tiles, first word, last word) of each item covered to the threshold, of those that meet the text."""
        get = self.vocab.get
        doc = np.array([get(w, -1) for w in words(text)], np.int64)
        inside = np.concatenate(([0], np.cumsum(doc < 0)))
        met: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for width, known in self.sorted.items():
            if len(doc) < width:
                continue
            full = np.nonzero(inside[width:] == inside[:-width])[0]
            if not len(full):
                continue
            hashes = rolling(doc, width)[full]
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            hit = known[at] == hashes
            if not hit.any():
                continue
            order = np.argsort(hashes[hit], kind="stable")
            places, (distinct, begins) = full[hit][order], np.unique(hashes[hit][order], return_index=True)
            for h, own in zip(distinct.tolist(), np.split(places, begins[1:]), strict=True):
                for item, i in self.seeds[width][h]:
                    met[item].append((i, own))
        for item, hits in sorted(met.items()):
            item_id, ids, width = self.items[item]
            spots = np.zeros(len(ids) + 1, np.int64)
            for i, _ in hits:
                spots[i] += 1
                spots[i + width] -= 1
            if np.count_nonzero(np.cumsum(spots)) < threshold * len(ids):
                continue  # no tiling covers more than its seeds do
            if item not in self.automata:
                self.automata[item] = Automaton(ids)
            found = tiles(ids, _stretches(doc, [own for _, own in hits], width), width, self.automata[item])
            covered = sum(n for _, _, n in found)
            if found and covered >= threshold * len(ids):
                yield item_id, len(ids), covered, len(found), min(j for _, j, _ in found), max(j + n for _, j, n in found)


def _stretches(doc: np.ndarray, places: list[np.ndarray], width: int) -> list[tuple[int, list[int]]]:
    """The parts of a document that seeds of `width` words at these places cover."""
    held = np.zeros(len(doc) + 1, np.int64)
    for own in {id(x): x for x in places}.values():
        held[own] += 1
        held[own + width] -= 1
    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(held[:-1]) > 0, [0]))))
    return [(a, doc[a:b].tolist()) for a, b in edge.reshape(-1, 2).tolist()]


def _blocks(items: DataFrame):
    """Broadcasts of the test side, block by block; each is one scan of the documents.

    The number of blocks goes by the length of all items, whatever files they come from, and items are dealt by hash: a
    small benchmark is one block, and no task or driver holds the whole of a large one.
    """
    staging = Staging(items.sparkSession, "benchmark")
    named = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = named.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = 1 if total <= 4 * ITEM_BLOCK else -(-5 * total // (16 * ITEM_BLOCK))  # a quarter more than fit, as hashes deal unevenly
    deal = F.xxhash64("item_id", "text", F.monotonically_increasing_id())  # equal rows part too
    blocked = staging.table(named.withColumn("block", F.pmod(deal, F.lit(blocks))), "items")
    for (block,) in blocked.select("block").distinct().orderBy("block").collect():
        held = blocked.where(F.col("block") == block).orderBy("item_id", "text").select("item_id", "text").collect()
        yield items.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in held])


_FOUND = "item_id long, item_words int, covered int, coverage double, tiles int, first_word int, last_word int"


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, seed: int = SEED) -> DataFrame:
    """doc_id, item_id, item_words, covered, coverage, tiles, first_word, last_word of every leaking pair."""
    spark = small_batches(docs.sparkSession)
    own, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for sent in _blocks(items):
        found = own.select("doc_id", _found(sent, threshold, seed)("text").alias("f")).select("doc_id", F.inline("f"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"doc_id long, {_FOUND}")


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, seed: int = SEED) -> DataFrame:
    """The rows of docs whose text leaks no item, with all their columns."""
    small_batches(docs.sparkSession)
    for sent in _blocks(items):
        docs = docs.where(~_leaky(sent, threshold, seed)(F.col("text")))
    return docs


def _leaky(sent, threshold: float, seed: int):
    @F.pandas_udf(T.BooleanType())
    def leaky(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(sent.value, seed)
        for batch in batches:
            yield pd.Series([next(index.leaks(text, threshold), None) is not None for text in batch], dtype=bool)

    return leaky


def _found(sent, threshold: float, seed: int):
    names = [field.split()[0] for field in _FOUND.split(", ")]

    @F.pandas_udf(f"array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(sent.value, seed)
        for batch in batches:
            rows = [[(i, size, n, n / size, k, lo, hi) for i, size, n, k, lo, hi in index.leaks(text, threshold)] for text in batch]
            yield pd.Series([[dict(zip(names, r, strict=True)) for r in own] for own in rows], dtype=object)

    return found


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item it leaks."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
