"""Language identification by a byte convolutional network, trained in numpy.

A text's lower-cased UTF-8 bytes are cut into windows of WINDOW bytes that cover it whole (the last one is padded).
Filters of widths 2, 3, 4 and 5 slide over byte embeddings, each is max-pooled over the window, and a softmax layer
reads the pooled values. A document's probabilities are the mean of its windows', weighted by their letters.

Byte embeddings enter the filters linearly, so after training embedding and filter fold into one table a filter
position: a convolution is then a sum of table rows, and inference is lookups, adds and maxima in batches.

Training reads a bounded sample: the TRAIN_DOCS labelled documents of each language with the smallest seeded hash of
doc_id among those whose crc32(doc_id) mod 3 is not 1, and DOC_WINDOWS windows of each at even distances over the
whole text. Where that would be over SAMPLE_DOCS documents, every language gives fewer, SAMPLE_DOCS divided by the number of
languages and at least one: no language is left out. lang, source and doc_id are never inputs. Of rows that share a
doc_id the first lang and the first text in order are taught.

Defined results: null text or text without a letter is `und` with score 0; ties go to the first language in order;
repeated rows are predicted each; a table without labels predicts `und` everywhere with score 0, and with a single language that one;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.plans.session import small_batches

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4, 5), 8, 8
#: The bounds of the training sample.
TRAIN_DOCS, DOC_WINDOWS, SAMPLE_DOCS = 300, 4, 60_000
EPOCHS, BATCH, RATE, SEED = 12, 64, 0.01, 11


def held_out(doc_id):
    """Whether crc32 of doc_id as text leaves remainder 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def windows(raw: np.ndarray) -> np.ndarray:
    """All of a text's bytes as rows of WINDOW, padded with zero."""
    n = -(-len(raw) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(n, WINDOW)


def letters(win: np.ndarray) -> np.ndarray:
    """Letters of each window: ASCII letters, and lead bytes of longer characters."""
    return (((win >= 97) & (win <= 122)) | (win >= 192)).sum(axis=1)


class Net:
    """Byte embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.emb = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.conv = [rng.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = np.zeros((len(WIDTHS) * FILTERS, len(langs)), np.float32)
        self.bias = np.zeros(len(langs), np.float32)
        self.tables: list[list[np.ndarray]] | None = None

    def params(self) -> list[np.ndarray]:
        return [self.emb, *self.conv, self.out, self.bias]

    def gradients(self, win: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        n = len(win)
        x = self.emb[win]
        pooled, where = [], []
        for w, f in zip(WIDTHS, self.conv, strict=True):
            span = WINDOW - w + 1
            act = sum(x[:, i : i + span] @ f[i] for i in range(w))
            best = act.argmax(axis=1)
            where.append(best)
            pooled.append(np.take_along_axis(act, best[:, None], axis=1)[:, 0])
        h = np.concatenate(pooled, axis=1)
        z = h @ self.out + self.bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        loss = -float(np.log(p[np.arange(n), y] + 1e-9).mean())
        p[np.arange(n), y] -= 1
        p /= n
        g_out, g_bias, g_h = h.T @ p, p.sum(axis=0), p @ self.out.T
        g_emb, g_conv, rows = np.zeros_like(self.emb), [], np.arange(n)[:, None]
        for k, (w, f, best) in enumerate(zip(WIDTHS, self.conv, where, strict=True)):
            g = g_h[:, k * FILTERS : (k + 1) * FILTERS]
            g_f = np.empty_like(f)
            for i in range(w):
                seen = win[rows, best + i]
                e = self.emb[seen]
                g_f[i] = np.einsum("nfd,nf->df", e, g)
                np.add.at(g_emb, seen.ravel(), (g[:, :, None] * f[i].T[None]).reshape(-1, DIM))
            g_conv.append(g_f)
        return loss, [g_emb, *g_conv, g_out, g_bias]

    def fit(self, win: np.ndarray, y: np.ndarray, seed: int = SEED) -> Net:
        """Adam over shuffled batches."""
        rng, ps = np.random.default_rng(seed), self.params()
        m, v, t = [np.zeros_like(p) for p in ps], [np.zeros_like(p) for p in ps], 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            for at in range(0, len(y), BATCH):
                pick = order[at : at + BATCH]
                _, gs = self.gradients(win[pick], y[pick])
                t += 1
                for p, g, a, b in zip(ps, gs, m, v, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
        return self

    def fold(self) -> Net:
        """Tables of what each byte adds to each filter at each position."""
        self.tables = [[np.ascontiguousarray(self.emb @ f[i]) for i in range(f.shape[0])] for f in self.conv]
        return self

    def probabilities(self, win: np.ndarray) -> np.ndarray:
        if self.tables is None:
            self.fold()
        pooled = []
        # one gather for all positions of all widths: a byte's row holds every table's row
        wide = np.concatenate([t for own in self.tables for t in own], axis=1)
        for at in range(0, len(win), 128):
            part = win[at : at + 128]
            x = wide[part]
            col, got = 0, []
            for w in WIDTHS:
                span = WINDOW - w + 1
                act = x[:, :span, col : col + FILTERS].copy()
                for i in range(1, w):
                    act += x[:, i : i + span, col + i * FILTERS : col + (i + 1) * FILTERS]
                col += w * FILTERS
                got.append(act.max(axis=1))
            pooled.append(np.concatenate(got, axis=1))
        z = np.concatenate(pooled) @ self.out + self.bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)


def train(docs: DataFrame) -> Net:
    """Fit on the documented sample of labelled documents."""
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
    # of rows that share a doc_id one is taught, its language with its own text: the least language, of equal ones the least hash
    usable = usable.withColumn("row", F.struct("lang", F.xxhash64("text").alias("h")))
    ids = usable.groupBy("doc_id").agg(F.min("row").alias("row")).select("doc_id", "row.lang", "row")
    # a bounded head per language before the window, so that one frequent language is not ranked in one task
    share = ids.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    near = share.withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id"))).where(F.col("r") <= TRAIN_DOCS)
    ranked = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= TRAIN_DOCS).select("doc_id", "lang", "row", "r")
    chosen = ranked.limit(SAMPLE_DOCS + 1).collect()
    if len(chosen) > SAMPLE_DOCS:
        each = max(1, SAMPLE_DOCS // ranked.where("r = 1").count())
        chosen = ranked.where(F.col("r") <= each).collect()
    if not chosen:
        return Net([])
    langs = sorted({r.lang for r in chosen})
    at = {lang: i for i, lang in enumerate(langs)}
    number = {r.doc_id: at[r.lang] for r in chosen}

    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def sampled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                win = windows(as_bytes(text))
                win = win[letters(win) > 0]
                pick = np.unique(np.linspace(0, len(win) - 1, DOC_WINDOWS).astype(int)) if len(win) else []
                out.append([win[i].tobytes() for i in pick])
            yield pd.Series(out, dtype=object)

    taught = docs.sparkSession.createDataFrame([(r.doc_id, r.row) for r in chosen], usable.select("doc_id", "row").schema)
    texts = usable.join(F.broadcast(taught), ["doc_id", "row"]).groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", sampled("text").alias("w")).collect()
    rows = sorted(((r.doc_id, bytes(w)) for r in rows for w in r.w))
    if not rows:
        return Net(langs)
    win = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    return Net(langs).fit(win, np.array([number[i] for i, _ in rows]))


def predict(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""
    spark = small_batches(docs.sparkSession)
    sent = spark.sparkContext.broadcast(net)  # a few thousand numbers
    shape = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(shape)
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            langs, scores = ["und"] * len(batch), np.zeros(len(batch))
            held = [(i, windows(as_bytes(t))) for i, t in enumerate(batch) if t] if model.langs else []
            if held:
                sizes = [len(w) for _, w in held]
                win = np.concatenate([w for _, w in held])
                weight = letters(win).astype(np.float64)
                sums = np.add.reduceat(model.probabilities(win) * weight[:, None], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
                total = sums.sum(axis=1)
                for (i, _), row, all_ in zip(held, sums, total, strict=True):
                    if all_ > 0 and any(map(str.isalpha, batch.iloc[i])):
                        k = int(row.argmax())
                        langs[i], scores[i] = model.langs[k], min(1.0, row[k] / all_)
            yield pd.DataFrame({"lang": langs, "score": scores})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), best("text").alias("b")).select("doc_id", "held_out", F.col("b.lang").alias("lang_pred"), F.col("b.score").alias("score"))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predict(docs, train(docs))
