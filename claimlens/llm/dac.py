"""Token ids in directly addressable codes: chunk levels, continuation bitmaps and rank directories.

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of every id; a bit per entry says whether
the id goes on, and the entries that do make up the next level. Where entry i of a level goes on, its next chunk is
entry rank1(i) of the level below, and a directory of ones before every 512 bits gives that rank at once. So any
token is read from its index alone, without decoding a block.

File layout, little-endian: magic "DAC1"; uint32 number of documents and of levels; int64 doc_ids (null as the lowest
long); int64 bounds (documents + 1 token offsets); then for each level int64 n, n chunk bytes, ceil(n/8) bitmap bytes
padded to 64, and the uint32 directory.

Texts are encoded where they are read and never shuffled: each becomes its ids, two bytes an id where the vocabulary
allows, and these go straight to the shard whose range of documents they belong to, to be sorted and cut into files.

Files hold consecutive documents in ascending doc_id order (null first; ties by text hash, then ids), so the start of a
document is the sum of the ids before it. Defined results: null or empty text is the end id alone; repeated rows are
written each; an empty table gives no file and an empty result; other columns of the input are ignored. A very long
text is encoded in pieces, as claimlens.llm.tokens says.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.tokens import PIECE, Memo, load, merger, odd, pieces
from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

MAGIC, BLOCK_BITS, NULL_ID = b"DAC1", 512, -(2**63)
#: A file is closed at the first document end past so many tokens.
FILE_TOKENS = 200_000
#: Input aimed at in one shard, in bytes as stored; most shards; and bytes a reader of files holds at once.
TASK_BYTES, MAX_TASKS, ROW_GROUP = 8 << 20, 200_000, 8 << 20


# ---------------------------------------------------------------- the code


def _level(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    more = values > 255
    bits = np.packbits(more, bitorder="little")
    bits = np.concatenate((bits, np.zeros(-len(bits) % 64, np.uint8)))
    ones = np.bitwise_count(bits).reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint32)
    rank = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4") if len(ones) else np.zeros(0, "<u4")
    body = struct.pack("<q", len(values)) + (values & 255).astype(np.uint8).tobytes() + bits.tobytes() + rank.tobytes()
    return body, values[more] >> 8


def encode(ids: np.ndarray, doc_ids: np.ndarray, bounds: np.ndarray) -> bytes:
    """One file: all ids of some documents, their doc_ids and where each begins."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while len(rest):
        body, rest = _level(rest)
        levels.append(body)
    head = MAGIC + struct.pack("<II", len(doc_ids), len(levels))
    return b"".join((head, np.asarray(doc_ids, "<i8").tobytes(), np.asarray(bounds, "<i8").tobytes(), *levels))


class Reader:
    """Random access to a file's tokens."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a directly addressable code file")
        n_docs, n_levels = struct.unpack_from("<II", raw, 4)
        at = 12
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        at += 8 * n_docs
        self.bounds = np.frombuffer(raw, "<i8", n_docs + 1, at)
        at += 8 * (n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<q", raw, at)
            at += 8
            chunks = np.frombuffer(raw, np.uint8, n, at)
            at += n
            size = -(-n // BLOCK_BITS) * (BLOCK_BITS // 8)
            bits = np.frombuffer(raw, np.uint8, size, at)
            at += size
            rank = np.frombuffer(raw, "<u4", size // 64, at)
            at += 4 * len(rank)
            self.levels.append((chunks, bits, rank))

    def __len__(self) -> int:
        return len(self.levels[0][0]) if self.levels else 0

    def get(self, index: int) -> int:
        """One token by its index, through the rank directories alone."""
        if not 0 <= index < len(self):
            raise IndexError(index)
        out = shift = 0
        for chunks, bits, rank in self.levels:
            out |= int(chunks[index]) << shift
            if not bits[index >> 3] >> (index & 7) & 1:
                break
            block = index // BLOCK_BITS
            head = int.from_bytes(bits[block * 64 : (index >> 3) + 1].tobytes(), "little") & ((1 << index % BLOCK_BITS) - 1)
            index, shift = int(rank[block]) + head.bit_count(), shift + 8
        return out

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Tokens lo to hi: consecutive entries stay consecutive on every level, so one rank a level is enough."""
        out = np.zeros(hi - lo, np.uint32)
        where, shift = np.arange(hi - lo), 0
        for chunks, bits, rank in self.levels:
            out[where] |= chunks[lo:hi].astype(np.uint32) << shift
            more = np.unpackbits(bits[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 : (lo & 7) + hi - lo].astype(bool)
            if not more.any():
                break
            block = lo // BLOCK_BITS
            head = int.from_bytes(bits[block * 64 : (lo >> 3) + 1].tobytes(), "little") & ((1 << lo % BLOCK_BITS) - 1)
            lo = int(rank[block]) + head.bit_count()
            where, shift = where[more], shift + 8
            hi = lo + len(where)
        return out


# ---------------------------------------------------------------- ids of texts

#: The vocabulary's own split after white space is gone: endings, runs of letters, single digits, runs of the rest.
_WORDS = re.compile(r"[a-zß-öø-ɏ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-zß-öø-ɏ0-9]+")
#: Capitals from U+0180 on may lower to letters outside that alphabet.
_ODD = re.compile(r"[^\t\n\r -~¡«»¿À-ſ]")


class Encoder:
    """Ids of whole texts with the word-end vocabulary; words the library's model has merged are remembered as bytes."""

    def __init__(self, path: str, width: str = "<u4"):
        self.tok, merge = load(path), merger(path)
        self.code = {"<u2": "H", "<u4": "I"}[width]
        self.memo = Memo(lambda word: array(self.code, [t.id for t in merge(word)]).tobytes(), {})

    def ids(self, text: str) -> bytes:
        """Little-endian ids of a whole text, without an end id."""
        return self._ids(text) if len(text) <= PIECE else b"".join(map(self._ids, pieces(text)))

    def _ids(self, text: str) -> bytes:
        if odd(text, _ODD) or "<|" in text or "İ" in text:
            return array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        self.memo.trim()
        return b"".join(map(self.memo.__getitem__, _WORDS.findall(text.lower())))


_ENCODERS: dict[str, Encoder] = {}


# ---------------------------------------------------------------- writing and reading


def _width(tokenizer: str) -> str:
    """The narrowest unsigned integers that hold every id of a vocabulary."""
    return "<u2" if max(load(tokenizer).get_vocab().values(), default=0) < 1 << 16 else "<u4"


def _tasks(docs: DataFrame) -> int:
    """Shards to deal documents into, from the sizes of their files alone; a source of unknown size gets one a core."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return cores if size >= 2**60 else max(cores, min(MAX_TASKS, size // TASK_BYTES + 1))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id (null as the lowest long: pandas would turn longs beside nulls to floats), h (the text's hash), text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def _bounds(keyed: DataFrame, shards: int) -> list[tuple[int, int]]:
    """The last (doc_id, h) of every shard but the last one: MAX_TASKS pairs at most. Keys alone are shuffled for it."""
    dealt = keyed.select("doc_id", "h").repartitionByRange(shards, "doc_id", "h")
    lasts = dealt.groupBy(F.spark_partition_id().alias("shard")).agg(F.max(F.struct("doc_id", "h")).alias("last")).select("last.*").collect()
    return sorted((r.doc_id, r.h) for r in lasts)[:-1]


def _coded(keyed: DataFrame, tokenizer: str, bounds: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, h, shard, ids): each document's ids as bytes of the vocabulary's width, and the shard its key belongs to."""
    width, sent = _width(tokenizer), keyed.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("shard int, ids binary")
    def code(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, Encoder(tokenizer, width))
        for doc_ids, hashes, texts in batches:
            shards = [bisect_left(sent.value, key) for key in zip(doc_ids.tolist(), hashes.tolist(), strict=True)]
            yield pd.DataFrame({"shard": pd.Series(shards, dtype="int32"), "ids": pd.Series([encoder.ids(t or "") for t in texts], dtype=object)})
        encoder.memo.rest()

    return keyed.select("doc_id", "h", code("doc_id", "h", "text").alias("c")).select("doc_id", "h", "c.shard", "c.ids")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, file_tokens: int = FILE_TOKENS) -> None:
    """Write every document's ids, each closed by end_id, as files in ascending doc_id order.

    Files are rows (shard, file, tokens, body) of a Parquet folder, as executors reach shared stores through Spark alone.
    A shard is one task's range of documents, sorted and written a file at a time; ranges also cut by text hash, so that
    many rows without doc_id do not meet in one task.
    """
    small_batches(docs.sparkSession)
    keyed, width = _keyed(docs), _width(tokenizer)
    bounds = _bounds(keyed, _tasks(docs))
    coded = _coded(keyed, tokenizer, bounds).repartitionById(len(bounds) + 1, "shard")
    dealt = coded.sortWithinPartitions("doc_id", "h", "ids").select("shard", "doc_id", "ids")
    end = np.array([end_id], "<u4")

    def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, docs_, sizes, held, number, at = [], [], [], 0, 0, 0

        def close() -> pd.DataFrame:
            body = encode(np.concatenate(ids), np.array(docs_, np.int64), np.concatenate(([0], np.cumsum(sizes))))
            return pd.DataFrame({"shard": [at], "file": [number], "tokens": [held], "body": [body]})

        for batch in batches:
            for at, key, raw in zip(batch.shard.tolist(), batch.doc_id.tolist(), batch.ids, strict=True):
                own = np.frombuffer(raw, width)
                ids += [own, end]
                docs_.append(key)
                sizes.append(len(own) + 1)
                held += sizes[-1]
                if held >= file_tokens:
                    yield close()
                    ids, docs_, sizes, held, number = [], [], [], 0, number + 1
        if docs_:
            yield close()

    dealt.mapInPandas(files, "shard int, file int, tokens long, body binary").write.option("parquet.block.size", ROW_GROUP).parquet(path)


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    stored = spark.read.parquet(path)
    sums = stored.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = sums.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("base"))
    inside = Window.partitionBy("shard").orderBy("file")
    starts = stored.select("shard", "file", "tokens").withColumn("own", F.sum("tokens").over(inside) - F.col("tokens")).join(before, "shard").select("shard", "file", (F.col("own") + F.col("base")).alias("base"))

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, number, raw in zip(batch.shard, batch.file, batch.body, strict=True):
                file = Reader(raw)
                bounds = file.bounds.tolist()
                crc = [zlib.crc32(file.slice(lo, hi).astype("<u4").tobytes()) for lo, hi in zip(bounds, bounds[1:], strict=False)]
                ids = pd.array(file.doc_ids.copy(), dtype="Int64")
                ids[file.doc_ids == NULL_ID] = pd.NA
                yield pd.DataFrame({"shard": shard, "file": number, "doc_id": ids, "at": file.bounds[:-1], "n_tokens": np.diff(file.bounds), "ids_crc32": np.array(crc, np.int64)})

    small_batches(spark)
    own = stored.select("shard", "file", "body").mapInPandas(digests, "shard int, file int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return own.join(starts, ["shard", "file"]).select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_id_output(spark, sf_dir: str) -> DataFrame:
    """Encode every document, write the files to the shared folder, and report each document from the files."""
    path = Staging(spark, "dac").path("ids")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, path)
