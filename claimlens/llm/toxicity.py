"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text's lower-cased words (runs of letters, long ones cut at 24) are read in windows of WINDOW words every STRIDE, so
each word stands in two windows and the windows cover the whole text. A word enters as its word embedding (zero for
words outside the vocabulary) beside its character embedding, the mean over its hashed character 4-grams. Two gated
recurrent networks run over a window, attention pools their states, a logistic unit scores the window, and a document
scores its highest window.

Words enter the recurrent cells linearly, so what a word adds to them is one row, kept in a bounded memo.

Training reads a bounded sample: of the rows of labels whose crc32(doc_id) mod 3 is not 1, of those whose texts
have MAX_CHARS at most, the TRAIN_DOCS of each class with the smallest seeded hash. A labelled document teaches its highest
window; embeddings start with the smoothed log-odds of words and 4-grams in one dimension, which also picks the first
windows. labels, lang, source and doc_id are never inputs of a score.

Defined results: null, empty and wordless texts score as an empty window; without labels of both classes every score
is 0; repeated rows are scored each; null labels teach nothing; of labels that contradict one another over a doc_id the
toxic one counts, and of texts that share a doc_id the first in order is taught; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import logging
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.llm.langid import held_out
from claimlens.plans.session import small_batches

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN, BUCKETS, GRAM = 6, 6, 8, 1 << 14, 4
#: The bounds of the training sample and of the vocabulary.
TRAIN_DOCS, MAX_CHARS, MAX_WORDS, MIN_DOCS = 2000, 20_000, 20_000, 3
#: Passes over the sample; small samples take more, up to STEPS updates.
EPOCHS, STEPS, BATCH, RATE, SEED = 8, 300, 64, 0.01, 5
#: Embeddings move slower than the cells: their first values carry what labels say of single words.
SLOW = 0.02
#: Words whose rows a worker keeps; the memo starts again when full.
MEMO = 120_000
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]{1,24}")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams(word: str) -> list[int]:
    raw = f"<{word}>".encode("utf-8", "surrogatepass")
    return [zlib.crc32(raw[i : i + GRAM]) % BUCKETS for i in range(max(1, len(raw) - GRAM + 1))]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def starts(n: int) -> range:
    """Window starts that cover n words, each word twice but for the ends; one window where there is none."""
    return range(0, max(1, n - STRIDE) if n > WINDOW else 1, STRIDE)


class Net:
    def __init__(self, vocab: dict[str, int], seed: int = SEED):
        rng, h, d = np.random.default_rng(seed), HIDDEN, WORD_DIM + CHAR_DIM
        init = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        self.vocab = vocab
        self.word = (0.02 * rng.normal(size=(len(vocab) + 1, WORD_DIM))).astype(np.float32)
        self.word[-1] = 0
        self.char = (0.02 * rng.normal(size=(BUCKETS, CHAR_DIM))).astype(np.float32)
        self.wx, self.bx = init(d, 6 * h), np.zeros(6 * h, np.float32)
        self.wh = [init(h, 3 * h), init(h, 3 * h)]
        self.att, self.out, self.bias = init(2 * h), init(2 * h), np.zeros(1, np.float32)
        self.fitted = False

    # ------------------------------------------------------------ inputs

    def inputs(self, names: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Embeddings of words, with what they are made of."""
        ids = np.array([self.vocab.get(w, len(self.vocab)) for w in names], np.int64)
        own = [grams(w) for w in names]
        sizes = np.array([len(g) for g in own])
        flat = np.fromiter((g for x in own for g in x), np.int64, sizes.sum())
        char = np.add.reduceat(self.char[flat], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0) / sizes[:, None]
        return np.concatenate((self.word[ids], char.astype(np.float32)), axis=1), ids, own

    def rows(self, names: list[str]) -> np.ndarray:
        """What words add to the gates of both directions."""
        return self.inputs(names)[0] @ self.wx + self.bx

    # ------------------------------------------------------------ the network

    def _run(self, gx: np.ndarray, wh: np.ndarray, keep: list | None) -> np.ndarray:
        """States (steps, windows, HIDDEN) of one direction; gx is (steps, windows, 3 HIDDEN)."""
        h_, (steps, n, _) = HIDDEN, gx.shape
        h, out = np.zeros((n, h_), np.float32), np.empty((steps, n, h_), np.float32)
        for t in range(steps):
            gh, x = h @ wh, gx[t]
            zr = 1 / (1 + np.exp(-(x[:, : 2 * h_] + gh[:, : 2 * h_])))
            z, r = zr[:, :h_], zr[:, h_:]
            new = np.tanh(x[:, 2 * h_ :] + r * gh[:, 2 * h_ :])
            if keep is not None:
                keep.append((h, z, r, new, gh[:, 2 * h_ :]))
            h = new + z * (h - new)
            out[t] = h
        return out

    def forward(self, gx: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Window scores; gx (steps, windows, 6 HIDDEN), mask (steps, windows) of real words."""
        h3 = 3 * HIDDEN
        kf, kb = ([], []) if keep is not None else (None, None)
        ahead = self._run(gx[:, :, :h3], self.wh[0], kf)
        back = self._run(gx[::-1, :, h3:], self.wh[1], kb)[::-1]
        s = np.concatenate((ahead, back), axis=2)
        e = np.where(mask, np.exp(np.clip(s @ self.att, -20, 20)), 0)
        a = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", a, s)
        if keep is not None:
            keep.update(s=s, a=a, pooled=pooled, kf=kf, kb=kb)
        return _sigmoid(pooled @ self.out + self.bias[0])

    def _back(self, g_out: np.ndarray, kept: list, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients to gx and wh from those to the states of one direction."""
        h_, steps = HIDDEN, len(kept)
        g_x, g_w, g_h = np.empty((*g_out.shape[:2], 3 * h_), np.float32), np.zeros_like(wh), np.zeros(g_out.shape[1:], np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, new, ghn = kept[t]
            g = g_out[t] + g_h
            d_new = g * (1 - z) * (1 - new * new)
            d_z, d_r = g * (h - new) * z * (1 - z), d_new * ghn * r * (1 - r)
            g_x[t] = np.concatenate((d_z, d_r, d_new), axis=1)
            d_gh = np.concatenate((d_z, d_r, d_new * r), axis=1)
            g_w += h.T @ d_gh
            g_h = g * z + d_gh @ wh.T
        return g_x, g_w

    def step(self, names: list[str], at: np.ndarray, mask: np.ndarray, y: np.ndarray, adam) -> float:
        """One update on windows: at (steps, windows) indexes names, the last of which is the pad."""
        x, ids, own = self.inputs(names)
        x[-1] = 0
        gx = (x @ self.wx + self.bx)[at]
        keep: dict = {}
        p = self.forward(gx, mask, keep)
        d = ((p - y) / len(y)).astype(np.float32)
        s, a, pooled = keep["s"], keep["a"], keep["pooled"]
        g_pool = d[:, None] * self.out
        g_a = np.einsum("nh,tnh->tn", g_pool, s)
        g_e = a * (g_a - (a * g_a).sum(axis=0))
        g_s = a[:, :, None] * g_pool + g_e[:, :, None] * self.att
        h = HIDDEN
        gf, wf = self._back(g_s[:, :, :h], keep["kf"], self.wh[0])
        gb, wb = self._back(g_s[::-1, :, h:], keep["kb"], self.wh[1])
        g_gx = np.concatenate((gf, gb[::-1]), axis=2)
        g_rows = np.zeros((len(names), 6 * h), np.float32)
        np.add.at(g_rows, at, g_gx)
        g_x = g_rows @ self.wx.T
        g_x[-1] = 0
        g_word, g_char = np.zeros_like(self.word), np.zeros_like(self.char)
        np.add.at(g_word, ids[:-1], g_x[:-1, :WORD_DIM])
        g_word[-1] = 0
        sizes = np.array([len(q) for q in own])
        np.add.at(g_char, np.fromiter((q for z in own for q in z), np.int64, sizes.sum()), np.repeat(g_x[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
        adam([self.word, self.char, self.wx, self.bx, *self.wh, self.att, self.out, self.bias], [g_word, g_char, x.T @ g_rows, g_rows.sum(axis=0), wf, wb, np.einsum("tn,tnh->h", g_e, s), pooled.T @ d, d.sum(keepdims=True)])
        return -float(np.mean(np.where(y == 1, np.log(p + 1e-9), np.log(1 - p + 1e-9))))


class Adam:
    def __init__(self):
        self.t, self.m, self.v, self.rate = 0, None, None, RATE

    def __call__(self, ps: list[np.ndarray], gs: list[np.ndarray]) -> None:
        if self.m is None:
            self.m, self.v = [np.zeros_like(p) for p in ps], [np.zeros_like(p) for p in ps]
        self.t += 1
        for k, (p, g, a, b) in enumerate(zip(ps, gs, self.m, self.v, strict=True)):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= self.rate * (SLOW if k < 2 else 1) * (a / (1 - 0.9**self.t)) / (np.sqrt(b / (1 - 0.999**self.t)) + 1e-8)


class Scorer:
    """Scores of whole texts, in batches of windows over all documents of a batch."""

    def __init__(self, net: Net, memo: int = MEMO, block: int = 1024):
        self.net, self.memo, self.block = net, memo, block
        self._clear()

    def _clear(self) -> None:
        self.at, self.n = {}, 1
        self.rows = np.zeros((1024, 6 * HIDDEN), np.float32)
        self.rows[0] = self.net.bx  # the pad: no embedding

    def indexes(self, texts: list[str | None]) -> list[np.ndarray]:
        """Row numbers of every text's words; new words get rows."""
        if self.n > self.memo:
            self._clear()
        split = [words(t) for t in texts]
        at = self.at
        new = [w for w in set().union(*split) if w not in at]
        for lo in range(0, len(new), 8192):
            part = new[lo : lo + 8192]
            while self.n + len(part) > len(self.rows):
                self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
            self.rows[self.n : self.n + len(part)] = self.net.rows(part)
            at.update(zip(part, range(self.n, self.n + len(part)), strict=True))
            self.n += len(part)
        return [np.fromiter(map(at.__getitem__, own), np.int32, len(own)) for own in split]

    def windows(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All windows of some texts as (windows, WINDOW) rows, zero where padded, and windows of each text."""
        parts, counts = [], []
        for own in ids:
            at = np.arange(0, len(starts(len(own)))) * STRIDE
            padded = np.zeros(at[-1] + WINDOW, np.int32)
            padded[: len(own)] = own[: len(padded)]
            parts.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[at])
            counts.append(len(at))
        return np.concatenate(parts), np.array(counts)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's highest window score, and all windows with their counts and scores' places."""
        if not texts:
            return np.zeros(0), np.zeros((0, WINDOW), np.int32), np.zeros(0, np.int64)
        win, counts = self.windows(self.indexes(texts))
        out = np.empty(len(win))
        for lo in range(0, len(win), self.block):
            part = win[lo : lo + self.block].T
            out[lo : lo + self.block] = self.net.forward(self.rows[part], part > 0)
        return out, win, counts


def fit(texts: list[str], y: np.ndarray, seed: int = SEED) -> Net:
    """Multiple-instance training: each document's highest window, chosen anew each epoch, teaches its label."""
    one: dict[str, str] = {}  # equal words share one string
    split = [[one.setdefault(w, w) for w in words(t)] for t in texts]
    sides = [Counter(), Counter()], [Counter(), Counter()]
    for own, label in zip(split, y, strict=True):
        names = set(own)
        sides[0][label].update(names)
        sides[1][label].update({g for w in names for g in grams(w)})
    total = [max(1, int((y == k).sum())) for k in (0, 1)]

    def odds(key, side) -> float:
        neg, pos = side[0][key], side[1][key]
        n = neg + pos
        lo = math.log((pos + 0.5) / (total[1] + 1)) - math.log((neg + 0.5) / (total[0] + 1))
        return lo * n / (n + 3)

    known = [w for w, n in (sides[0][0] + sides[0][1]).most_common(MAX_WORDS) if n >= MIN_DOCS]
    net = Net({w: i for i, w in enumerate(sorted(known))}, seed)
    net.word[:-1, 0] = [odds(w, sides[0]) / 2 for w in sorted(known)]
    for g in set(sides[1][0]) | set(sides[1][1]):
        net.char[g, 0] = odds(g, sides[1]) / 2
    # the first windows: highest sums of log-odds; afterwards the network chooses
    names = sorted(one) + [""]
    place = {w: i for i, w in enumerate(names[:-1])}

    def by_part(f, width: int) -> np.ndarray:
        """f of all names, a part at a time."""
        out = np.empty((len(names), width), np.float32)
        for lo in range(0, len(names), 8192):
            out[lo : lo + 8192] = f(names[lo : lo + 8192])
        return out

    value = by_part(lambda part: net.inputs(part)[0][:, [0, WORD_DIM]], 2).sum(axis=1)
    value[-1] = 0
    pad = len(names) - 1
    every = []
    for own in split:
        at = [[place[w] for w in own[s : s + WINDOW]] for s in starts(len(own))]
        every.append(np.array([x + [pad] * (WINDOW - len(x)) for x in at], np.int32))
    del split, one, sides
    flat = np.concatenate(every)
    cut = np.cumsum([0, *map(len, every)])
    every = [flat[a:b] for a, b in zip(cut, cut[1:], strict=False)]
    rng, adam = np.random.default_rng(seed), Adam()
    weight = [i for k in (0, 1) for i in np.nonzero(y == k)[0].tolist() * max(1, round(total[1 - k] / total[k]) if total[k] < total[1 - k] else 1)]
    epochs = max(EPOCHS, -(-STEPS // -(-len(weight) // BATCH)))
    for epoch in range(epochs):
        adam.rate = RATE * (1 - 0.9 * epoch / epochs)
        if epoch:
            rows = by_part(net.rows, 6 * HIDDEN)
            rows[-1] = net.bx
            got = np.concatenate([net.forward(rows[flat[lo : lo + 2048].T], flat[lo : lo + 2048].T != pad) for lo in range(0, len(flat), 2048)])
        else:
            got = np.concatenate([value[w].sum(axis=1) for w in every])
        top = [int(got[a:b].argmax()) for a, b in zip(cut, cut[1:], strict=False)]
        order = rng.permutation(weight)
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            # negatives also teach a window at random, so that no part of a clean text goes unseen
            more = [i for i in pick if y[i] == 0]
            win = np.stack([every[i][top[i]] for i in pick] + [every[i][rng.integers(len(every[i]))] for i in more])
            label = np.concatenate((y[pick], np.zeros(len(more))))
            used, at = np.unique(np.append(win.ravel(), pad), return_inverse=True)
            at = at[:-1].reshape(win.shape).T
            net.step([names[i] for i in used], at, win.T != pad, label, adam)
    net.fitted = True
    return net


def train(docs: DataFrame, labels: DataFrame) -> Net:
    """Fit on the documented sample of labelled documents."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.where(F.length("text") <= MAX_CHARS)
    # labels without a text to learn from take no place in the sample
    one = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = {}
    for k in (0, 1):
        for r in one.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(TRAIN_DOCS).collect():
            chosen[r.doc_id] = k
    rows = texts.where(F.col("doc_id").isin(sorted(chosen))).groupBy("doc_id").agg(F.min("text").alias("text")).collect() if chosen else []
    rows = sorted((r.doc_id, r.text) for r in rows)
    y = np.array([chosen[i] for i, _ in rows], np.int64)
    if len(set(y.tolist())) < 2:
        logging.getLogger(__name__).warning("no labelled texts of both classes: every score is 0")
        return Net({})
    return fit([t for _, t in rows], y)


def _scorer(docs: DataFrame, labels: DataFrame):
    spark = small_batches(docs.sparkSession)
    sent = spark.sparkContext.broadcast(train(docs, labels))  # bounded by MAX_WORDS and BUCKETS

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = sent.value
        scorer = Scorer(net)
        for batch in batches:
            if not net.fitted or not len(batch):
                yield pd.Series(np.zeros(len(batch)))
                continue
            out, _, counts = scorer.scores(list(batch))
            yield pd.Series(np.maximum.reduceat(out, np.concatenate(([0], np.cumsum(counts)[:-1]))))

    return score


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), _scorer(docs, labels)("text").alias("score"))
    return own.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score under the threshold, with all their columns."""
    return docs.where(_scorer(docs, labels)(F.col("text")) < THRESHOLD)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
