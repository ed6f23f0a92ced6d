"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's path is the counts of its letters in successive groups. One edit changes the counts by a surplus of one, a
deficit of one, or both, so a depth-first search spends a budget of one each and meets every near word, and few others; the
words of its leaves are verified letter by letter. A pair is sought from one side only: from the shorter word, or between
words of one length from the one whose first differing group grows, so that surplus is spent before deficit.

The trie is dealt over the cluster by its upper levels: a word lives in the subtree of its first counts and is sent as a
query to the subtrees that the budget reaches. A subtree of more than MEMBERS words is split by further levels, and words
of one path beyond that number in parts that every query visits. A task builds one subtree at a time and streams queries.

Defined results: null, empty and wordless texts have no words; a null doc_id is written as an empty text; repeated rows
count each; very long runs are words like any other; ties go to the smallest word in code-point order; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.crc import crc32_sql
from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, FACTOR, SLIP = 6, 5, 5, 199
#: The levels of the trie, frequent letters first; the last level holds every letter beyond a-z.
GROUPS = ("e", "a", "i", "o", "n", "r", "t", "s", "l", "u", "d", "cm", "hg", "pbfv", "wykjxqz", None)
#: Levels after which the trie is cut, words a subtree may hold, words that a leaf may hold before it is split.
DEPTHS, MEMBERS, LEAF = (4, 9, len(GROUPS)), 20_000, 32
#: Letters of a word that are compared as rows of an array; longer words are compared one by one.
WIDE = 32


def words_of(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of letters of at least the least length, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).where(F.length("run") >= LEAST_LENGTH)


def vocabulary(runs: DataFrame, slip: int | None = SLIP, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least the least length and count. Where `slip` divides the checksum of a document's run, one letter is lost."""
    word = F.col("run")
    if slip:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
        at = (h % F.length(word)).cast("int")
        word = F.when(h % slip == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def counts(word: Column) -> Column:
    """The path of a word: how many of its letters fall into each group."""
    size = F.length(word)
    named = [size - F.length(F.translate(word, g, "")) for g in GROUPS if g]
    return F.array(*named, size - sum(named[1:], named[0]))


def _ball(depth: int) -> list[list[int]]:
    """What the budget adds to the first `depth` counts: nothing, one, or one and later minus one."""
    out = [[0] * depth]
    for i in range(depth):
        out.append([int(k == i) for k in range(depth)])
    for i, j in combinations(range(depth), 2):
        out.append([int(k == i) - int(k == j) for k in range(depth)])
    return out


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _letters(words: list[str]) -> np.ndarray:
    """The first WIDE letters of words as rows of bytes; every letter of a run has one byte in Latin-1."""
    return np.array([w.encode("latin-1") for w in words], f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)


class Words:
    """Words of one task with their paths and their letters from both ends."""

    def __init__(self, words: np.ndarray, paths: np.ndarray):
        held = words.tolist()
        self.words, self.paths = words, paths
        self.sizes = np.fromiter(map(len, held), np.int64, len(held))
        self.heads, self.tails = _letters(held), _letters([w[::-1] for w in held])


def verified(asked: Words, i: np.ndarray, held: Words, w: np.ndarray) -> np.ndarray:
    """Whether held[w] is one edit from asked[i], of its size or one more: equal ends then leave one letter of it at most."""
    size, longer = asked.sizes[i], held.sizes[w]
    head = (asked.heads[i] != held.heads[w]).argmax(axis=1)
    tail = (asked.tails[i] != held.tails[w]).argmax(axis=1)
    ok = (np.minimum(head, size) + np.minimum(tail, size) >= longer - 1) & (asked.words[i] != held.words[w])
    for k in np.flatnonzero(longer > WIDE).tolist():
        ok[k] = one_edit(asked.words[i[k]], held.words[w[k]])
    return ok


class Trie:
    """The words of a subtree by size and path; a node is a stretch of rows of one size that share their first counts."""

    def __init__(self, words: np.ndarray, n: np.ndarray, paths: np.ndarray):
        order = np.lexsort([*paths.T[::-1], np.fromiter(map(len, words.tolist()), np.int64, len(words))])
        self.held, self.n = Words(words[order], paths[order]), n[order]

    def near(self, asked: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, words) one edit apart, depth first: all queries that reach a node descend together."""
        paths, width = self.held.paths, self.held.paths.shape[1]
        stack = []
        for size, lo, m in zip(*np.unique(self.held.sizes, return_index=True, return_counts=True), strict=True):
            q = np.flatnonzero((asked.sizes == size) | (asked.sizes == size - 1))
            stack.append((lo, lo + m, 0, q, np.zeros(len(q), np.int8)))
        while stack:
            lo, hi, level, q, spent = stack.pop()
            if not len(q):
                continue
            if hi - lo <= LEAF or level == width:
                for at in range(lo, hi, LEAF):
                    yield self._leaf(at, min(hi, at + LEAF), asked, level, q, spent)
                continue
            values, starts = np.unique(paths[lo:hi, level], return_index=True)
            own = asked.paths[q, level]
            for value, start, end in zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), hi - lo], strict=True):
                more = value - own  # the words of this child beyond the query
                now = spent + (more != 0)  # a surplus is spent first, then a deficit
                alive = (more == 0) | ((more == 1) & (spent == 0)) | ((more == -1) & (spent == 1))
                if alive.any():
                    stack.append((lo + start, lo + end, level + 1, q[alive], now[alive]))

    def _leaf(self, lo: int, hi: int, asked: Words, level: int, q: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        more = self.held.paths[lo:hi, None, level:] - asked.paths[None, q, level:]
        plus, minus = (more == 1).sum(axis=2, dtype=np.int8), (more == -1).sum(axis=2, dtype=np.int8)
        ok = (np.abs(more).sum(axis=2, dtype=np.int32) == plus + minus) & (plus <= (spent == 0)) & (minus <= spent + plus - (spent == 2) * 2) & (minus <= 1)
        w, i = np.nonzero(ok)
        both = (plus[w, i] == 1) & (minus[w, i] == 1)
        keep = np.ones(len(w), bool)
        if both.any():
            late = (more[w[both], i[both]] == 1).argmax(axis=1) > (more[w[both], i[both]] == -1).argmax(axis=1)
            keep[np.flatnonzero(both)[late]] = False
        equal = (spent[i] == 0) & (plus[w, i] == 0) & (minus[w, i] == 0)
        w, i, equal = w[keep] + lo, q[i[keep]], equal[keep]
        good = verified(asked, i, self.held, w)
        w, i, equal = w[good], i[good], equal[good]
        equal &= asked.sizes[i] == self.held.sizes[w]
        once = ~equal | (asked.words[i] < self.held.words[w])  # equal paths are met from both sides
        return i[once], w[once]


def _paths(column: pd.Series) -> np.ndarray:
    paths = np.stack(column.to_numpy())
    return paths.astype(np.int16) if paths.max() < 10_000 else paths.astype(np.int64)  # differences fit


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, a_n, b, b_n) from rows ordered by subtree, its words before the queries that visit it."""
    key, members, trie = None, [], None
    arrays = lambda rows: (rows["word"].to_numpy(), rows["n"].to_numpy(), _paths(rows["path"]))
    for batch in batches:
        out = []
        for (shard, part, asks), rows in batch.groupby(["shard", "part", "asks"], sort=False):
            if (shard, part) != key:
                key, members, trie = (shard, part), [], None
            if not asks:
                members.append(rows)
                continue
            if not members:
                continue
            trie = trie or Trie(*arrays(pd.concat(members)))
            words, n, paths = arrays(rows)
            asked = Words(words, paths)
            out += [pd.DataFrame({"a": words[i], "a_n": n[i], "b": trie.held.words[w], "b_n": trie.n[w]}) for i, w in trie.near(asked) if len(i)]
        if out:
            yield pd.concat(out, ignore_index=True)


def near_words(vocabulary: DataFrame, staging: Staging, members: int = MEMBERS) -> DataFrame:
    """(a, a_n, b, b_n): each pair of near words once. vocabulary: word, n, without repeats."""
    small_batches(vocabulary.sparkSession, 4096)
    everyone = staging.table(vocabulary.select("word", "n", counts(F.col("word")).alias("path")), "paths")
    homes, asking, dealt = everyone, everyone, None
    for depth in DEPTHS:
        key = lambda path, d=depth: F.array_join(F.slice(path, 1, d), ",")
        ball = F.array(*[F.array(*map(F.lit, add)) for add in _ball(depth)])
        home = homes.withColumn("shard", key("path"))
        sizes = home.groupBy("shard").agg(F.count("*").alias("m"))
        last = depth == DEPTHS[-1]
        sizes = staging.table(sizes.withColumn("parts", F.ceil(F.col("m") / members).cast("int") if last else F.lit(1)), "sizes")
        reach = asking.select("word", "n", "path", F.explode(ball).alias("add")).withColumn("shard", key(F.zip_with(F.slice("path", 1, depth), "add", lambda x, y: x + y))).drop("add")
        fit = sizes if last else sizes.where(F.col("m") <= members)
        own = home.join(fit, "shard").select("shard", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("asks"), "word", "n", "path")
        visit = reach.join(fit, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "word", "n", "path")
        rows = own.unionByName(visit)
        dealt = rows if dealt is None else dealt.unionByName(rows)
        wide = sizes.where(F.col("m") > members).select("shard")
        if last or wide.isEmpty():
            break
        homes = staging.table(home.join(wide, "shard", "left_semi").select("word", "n", "path"), "homes")
        asking = staging.table(reach.join(wide, "shard", "left_semi").select("word", "n", "path").distinct(), "asking")
    ordered = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part", "asks")
    return staging.table(ordered.mapInPandas(_pairs, "a string, a_n long, b string, b_n long"), "near")


def forms(vocabulary: DataFrame, pairs: DataFrame, staging: Staging, factor: int = FACTOR) -> DataFrame:
    """(word, n, form, form_n, n_near, root): the most frequent near word, if it is so many times as frequent, and where forms lead."""
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("m")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("top"))
    taken = -F.col("top.less") >= F.col("n") * factor
    best = staging.table(best.select("word", "n_near", F.when(taken, F.col("top.near")).alias("form"), F.when(taken, -F.col("top.less")).alias("form_n")), "best")
    led = staging.table(best.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # each step at least doubles what a word has followed; a form is several times as frequent, so there are no circles
        ahead = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = staging.table(led.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            break
        led = now.drop("moved")
    out = vocabulary.join(best, "word", "left").join(led, "word", "left")
    return out.select("word", "n", "form", "form_n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    staging = Staging(spark, "variants")
    words = staging.table(vocabulary(words_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))), "words")
    return forms(words, near_words(words, staging), staging).select("word", "form", "root", "n", "n_near", "form_n")


OP11_SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
  own AS (SELECT coalesce(doc_id::varchar, '') || ':' || run AS t, run, count(*) AS c FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
  hashed AS (SELECT run, c, {crc32_sql("t")} AS h FROM own),
  lost AS (SELECT CASE WHEN h % {SLIP} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
  w AS (SELECT word, sum(c)::bigint AS n FROM lost WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
  k AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
  gone AS (SELECT DISTINCT k.word AS a, k.n AS a_n, w.word AS b, w.n AS b_n FROM k JOIN w ON w.word = k.rest),
  near AS (SELECT a AS word, a_n AS n, b AS near, b_n AS m FROM gone UNION ALL SELECT b, b_n, a, a_n FROM gone
    UNION ALL SELECT DISTINCT x.word, x.n, y.word, y.n FROM k x JOIN k y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
  best AS (SELECT word, n, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM near GROUP BY word, n),
  f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {FACTOR} * w.n THEN near END AS form, CASE WHEN m >= {FACTOR} * w.n THEN m END AS form_n FROM w LEFT JOIN best USING (word)),
  led AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT led.word, led.next, f.form FROM led JOIN f ON f.word = led.next)
SELECT f.word, form, led.at AS root, f.n, n_near, form_n FROM f JOIN led ON led.word = f.word AND led.next IS NULL
"""
