"""Substring dedup by content-defined chunks that a gear rolling hash cuts.

Every byte shifts a 16-bit gear hash left by one and adds its table value, so the hash at a byte depends on the last
16 bytes alone. Of every `w` successive words the one with the least gear hash at its end is a cut, and a chunk is what
stands between two cuts: one to `w` words, moved by no insertion elsewhere. Chunks are deduplicated by digest.

A window of `min_words` words has two stretches of `w` hashes that read nothing outside of it, so it holds two cuts at
least, and between its outermost ones the same chunks wherever it stands; the longest of these (of equals the one of the
largest digest) is the window's own. Where two texts hold that chunk, the window is digested; a window whose digest two
texts hold is repeated, and runs of successive repeated windows are the repeated passages, exact to the word at both
ends. Exact copies fold into one text before that and repeat whole.

Words are compared byte by byte, split at ASCII white space, the amount of which does not matter. Digests are sums of the words'
128-bit digests by powers of an odd base, of which 64 and 32 bits are kept for a window.

Defined results: texts of fewer than `min_words` words have no row, null and empty ones included; exact copies repeat whole; a
passage that repeats inside one document only counts where `within` is set; ties on the first place go to the smallest
(doc_id, place); repeated rows (same doc_id) are told apart by a row number; passages that overlap in part are reported
each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

#: Bytes that the gear hash at a byte depends on.
WINDOW = 16
#: Passages of over 50 words.
MIN_WORDS = 51
#: Words before a word's end that its hash may read, one more than fill WINDOW.
CONTEXT = WINDOW // 2 + 1
#: Words digested at once; base of the digests of spans and its inverse modulo 2^64.
BLOCK, BASE = 65_536, 0x9E3779B97F4A7C15
#: Bytes of the bitmap that spares texts a shuffle.
BITMAP = 1 << 18
INVERSE = pow(BASE, -1, 1 << 64)
#: A null doc_id goes through pandas as the lowest long, as its longs would turn to floats beside nulls.
_LOWEST = -(2**63)


def gear_table(seed: int = 7) -> np.ndarray:
    """256 pseudo-random 16-bit values, from one rule."""
    return np.array([xxhash.xxh64_intdigest(bytes([b]), seed) & 0xFFFF for b in range(256)], np.uint16)


_GEAR = gear_table()


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum of table values shifted by age, by doubling the window four times."""
    h, width = _GEAR[raw], 1
    while width < WINDOW:
        older = np.zeros_like(h)
        older[width:] = h[:-width]
        h = h + (older << np.uint16(width))
        width *= 2
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words of one text: where they begin and stop in its bytes, and digests of any span of them."""

    def __init__(self, text: str):
        data = text.encode("utf-8", "surrogatepass")
        self.raw = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_SPACE[self.raw]
        turns = np.diff(inside)
        self.begins, self.stops = np.nonzero(turns == 1)[0], np.nonzero(turns == -1)[0]
        self.data, self.n = data, len(self.begins)

    def digests(self) -> Words:
        """Prefix sums of the words' digests."""
        digest, n = xxhash.xxh3_128_digest, self.n
        parts = []
        for lo in range(0, n, BLOCK):
            parts.extend(map(digest, self.data[self.begins[lo] : self.stops[min(n, lo + BLOCK) - 1]].split()))
        own = np.frombuffer(b"".join(parts), "<u8").reshape(-1, 2)
        self.sums = np.zeros((n + 1, 2), np.uint64)
        np.cumsum(own * _powers(BASE, n)[:, None], axis=0, out=self.sums[1:])
        self.back = _powers(INVERSE, n)
        return self

    def spans(self, size: int, column: int) -> np.ndarray:
        """One half of the digest of the `size` words from each word on."""
        own = self.sums[:, column]
        return (own[size:] - own[:-size]) * self.back[: self.n - size + 1]

    def keys(self, context: int) -> np.ndarray:
        """What orders cuts, at the last word of every span of `context` words."""
        if context < CONTEXT:  # a window too short for gear hashes of its own
            order = np.zeros(self.n - context + 1, np.int64)
        else:
            blank = _SPACE[self.raw]
            keep = ~blank
            keep[1:] |= keep[:-1] & blank[1:]
            even = self.raw[keep]
            even[_SPACE[even]] = 32
            ends = np.cumsum(self.stops - self.begins + 1) - 2
            order = gear_hashes(even)[ends][context - 1 :].astype(np.int64)
        return order << 47 | (self.spans(context, 0) >> np.uint64(17)).astype(np.int64)

    def chunks(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cuts (words after which a chunk ends), the digest of the chunk from each cut to the next, and each window's own chunk."""
        context = max(1, min(CONTEXT, least // 3))
        m = least - context + 1  # hashes that a window holds
        order = np.argsort(self.keys(context), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        low = order[_sliding(np.minimum, rank, m // 2)]
        cuts, at = np.unique(low, return_inverse=True)
        first = cuts + context
        digest = (self.sums[first[1:], 0] - self.sums[first[:-1], 0]) * self.back[first[:-1]]
        score = np.minimum(np.diff(cuts), 63) << 57 | (digest >> np.uint64(7)).astype(np.int64)
        windows = self.n - least + 1
        lo, hi = at[:windows], at[m - m // 2 : m - m // 2 + windows]
        own = lo.copy()
        for more in range(1, int((hi - lo).max())):
            further = np.minimum(lo + more, len(score) - 1)
            own = np.where((lo + more < hi) & (score[further] > score[own]), further, own)
        return first - 1, digest, own

    def anchors(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and digests of the chunks that are some window's own."""
        _, digest, own = self.chunks(least)
        at = np.unique(own)
        return at, digest[at].view(np.int64)

    def around(self, ats: np.ndarray, least: int) -> np.ndarray:
        """First words of the windows whose own chunk is one of `ats`."""
        return np.nonzero(np.isin(self.chunks(least)[2], ats))[0]


def _sliding(pick: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every `size` successive values (or what `pick` picks), by doubling."""
    width = 1
    while 2 * width <= size:
        values = pick(values[:-width], values[width:])
        width *= 2
    return pick(values[: width - size], values[size - width :]) if width < size else values


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _anchor_rows(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, row, d, e, at, a: each text's chunks (number, digest) and, with `at` the number of its words below zero, its bytes' span."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, row, d, e, text in zip(batch.doc_id, batch.row, batch.d, batch.e, batch.text, strict=True):
                if text and (words := Words(text)).n >= least:
                    at, a = words.digests().anchors(least)
                    n, span = len(at) + 1, int(words.begins[0]) << 32 | int(words.stops[-1])
                    yield pd.DataFrame({"doc_id": np.full(n, doc_id), "row": np.full(n, row), "d": np.full(n, d), "e": np.full(n, e), "at": np.append(at, -words.n).astype(np.int32), "a": np.append(a, span)})

    rows = _texts(docs).withColumn("row", F.monotonically_increasing_id()).withColumn("doc_id", F.coalesce("doc_id", F.lit(_LOWEST)))
    return rows.mapInPandas(_gathered(found), "doc_id long, row long, d long, e long, at int, a long").withColumn("doc_id", F.nullif("doc_id", F.lit(_LOWEST)))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, d, e, text: whole texts with the two halves of their digest."""
    return docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("d"), F.xxhash64(F.lit(MIN_WORDS), "text").alias("e"), "text")


def _may_hold(keys: DataFrame, name: str):
    """A filter that holds for all of `keys` and for few others: a bitmap of fixed size, so that texts without a shared chunk stay where they are."""
    bit = F.col(name).bitwiseAND(F.lit(8 * BITMAP - 1))
    byte, mask = F.shiftright(bit, 3), F.pow(F.lit(2), bit.bitwiseAND(F.lit(7))).cast("int")
    bitmap = bytearray(BITMAP)
    for r in keys.groupBy(byte.alias("byte")).agg(F.bit_or(mask).alias("bits")).toLocalIterator():
        bitmap[r.byte] = r.bits
    held = F.conv(F.hex(F.substring(F.lit(bytes(bitmap)), byte.cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return held.bitwiseAND(mask) != 0


def _window_rows(hits: DataFrame, least: int) -> DataFrame:
    """doc_id, row, at, start, end, a, b: the windows of each text whose own chunk is one of the shared ones, `ats`."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, row, text, ats in zip(batch.doc_id, batch.row, batch.text, batch.ats, strict=True):
                words = Words(text).digests()
                at = words.around(np.asarray(ats), least)
                a, b = words.spans(least, 0)[at].view(np.int64), (words.spans(least, 1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                start, end = words.begins[at].astype(np.int32), words.stops[at + least - 1].astype(np.int32)
                yield pd.DataFrame({"doc_id": np.full(len(at), doc_id), "row": np.full(len(at), row), "at": at.astype(np.int32), "start": start, "end": end, "a": a, "b": b})

    return hits.withColumn("doc_id", F.coalesce("doc_id", F.lit(_LOWEST))).mapInPandas(_gathered(found), "doc_id long, row long, at int, start int, end int, a long, b int").withColumn("doc_id", F.nullif("doc_id", F.lit(_LOWEST)))


def _gathered(found):
    """Frames of one text each, handed on some 50,000 rows at a time."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for frame in found(batches):
            held.append(frame)
            rows += len(frame)
            if rows > 50_000:
                yield pd.concat(held, ignore_index=True)
                held, rows = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    return gather


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, within: bool = False, staging: Staging | None = None) -> DataFrame:
    """doc_id, row, start, end (UTF-8 bytes), words, first_doc_id, is_first for every maximal run of repeated windows.

    first_doc_id holds the earliest occurrence of the run's first window; is_first marks runs all of whose windows are
    first occurrences. Windows count as repeated when two rows hold them; with `within`, also when one row holds them twice.
    """
    if min_words < 2:
        raise ValueError("a passage of one word holds no chunk")
    staging = staging or Staging(docs.sparkSession, "chunks")
    small_batches(docs.sparkSession)
    own = staging.table(_anchor_rows(docs, min_words), "anchors")  # row numbers are drawn once
    every = own.where("at < 0").select("doc_id", "row", "d", "e", (-F.col("at")).alias("words"), F.shiftright("a", 32).cast("int").alias("start"), F.col("a").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("end"))
    texts = staging.table(every.groupBy("d", "e").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.count("*").alias("copies")), "texts")

    anchors = own.where("at >= 0").select("a", "d", "at")
    several = anchors.groupBy("a").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), *([F.count("*").alias("n")] if within else []))
    # written, so that the joins that follow have an exchange on both sides and adaptive execution splits a hot digest
    several = staging.table(several.where("n > 1" if within else "lo <> hi").select("a"), "shared")
    shared = anchors.join(several, "a")
    hits = texts.join(shared.groupBy("d").agg(F.collect_set("at").alias("ats")), "d")  # one text's own anchors
    hits = hits.select("d", "e", F.col("rep.doc_id").alias("rep_id"), F.col("rep.row").alias("row"), "ats")
    hits = staging.table(hits, "hits")
    read = _texts(docs).where(_may_hold(hits, "d")).join(hits, ["d", "e"]).where(F.col("doc_id").eqNullSafe(F.col("rep_id")))
    windows = staging.table(_window_rows(read.select("doc_id", "row", "text", "ats"), min_words), "windows")

    places = [F.min(F.struct("doc_id", "row", "at")).alias("first"), F.max(F.struct("doc_id", "row", "at")).alias("last")]
    twice = "first <> last" if within else "first.row <> last.row"
    seen = staging.table(windows.groupBy("a", "b").agg(*places).where(twice).select("a", "b", "first"), "seen")
    mine = (F.col("first.row") == F.col("row")) & (F.col("first.at") == F.col("at"))
    again = windows.join(seen, ["a", "b"]).select("doc_id", "row", "at", "start", "end", F.col("first.doc_id").alias("first_doc_id"), mine.alias("is_first"))
    run = F.col("at") - F.dense_rank().over(Window.partitionBy("row").orderBy("at"))  # a repeated row's windows come repeatedly
    head = F.min_by("first_doc_id", "at").alias("first_doc_id")
    words = (F.max("at") - F.min("at") + min_words).alias("words")
    runs = again.withColumn("run", run).groupBy("row", "doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), words, head, F.min("is_first").alias("is_first"), F.min("at").alias("at"))
    runs = staging.table(runs, "runs")

    copied = texts.where("copies > 1").select("d", "e", "rep")
    parts = runs.groupBy("row").agg(F.min("at").alias("at"), F.min_by("first_doc_id", "at").alias("first_doc_id"), F.min("is_first").alias("is_first")).withColumnRenamed("row", "rep_row")
    copied = copied.join(parts, F.col("rep.row") == F.col("rep_row"), "left")
    earliest = F.when(F.col("at") == 0, F.col("first_doc_id")).otherwise(F.col("rep.doc_id"))
    copied = copied.select("d", "e", F.col("rep.row").alias("rep_row"), earliest.alias("first_doc_id"), F.coalesce("is_first", F.lit(True)).alias("rep_first"))
    names = ["doc_id", "row", "start", "end", "words", "first_doc_id", "is_first"]
    whole = every.join(copied, ["d", "e"]).withColumn("is_first", F.col("rep_first") & (F.col("row") == F.col("rep_row"))).select(names)
    return whole.unionByName(runs.join(copied.select(F.col("rep_row").alias("row")), "row", "left_anti").select(names))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of every document, by shared chunks."""
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "start", "end", "words", "first_doc_id", "is_first")
