"""SimHash near-duplicates by covering locality-sensitive hashing.

Seven structured bit masks cover radius 2: bit i belongs to class 1 + i mod 7, read as a 3-bit vector, and mask v
keeps the bits whose class has odd inner product with v. Two fingerprints that differ in at most two bits span at
most two classes, some v is orthogonal to both, and under that mask they are equal. So every linked pair meets in
some table, without false negatives. A pair of one bucket is a link if its distance is within the radius.

Buckets of more than GROUP fingerprints are never listed in pairs: their members differ in the 27 or 28 bits that the
mask drops, and a second family of seven masks covers these in the same way, then a third one. What a third mask drops
is six bits at most, so its buckets hold GROUP fingerprints at most, whatever the data.

Defined results: null or wordless text has fingerprint zero and links like any other; repeated rows share their
component; wordless texts have no near copies beyond the radius; an empty table gives an empty result; other columns of the input are ignored; a null doc_id stays as a
row and never becomes a component id unless its whole component has none (then null).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.graph import connected_components
from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

SEED, SHINGLE, BITS, RADIUS = 42, 3, 64, 2
#: Fingerprints of a bucket that are held against each other; families of masks after which no bucket holds more.
GROUP, FAMILIES = 64, 3
#: Rounds in which texts meet one other text of a key; texts of a key whose pairs are listed; texts and shingles of a block.
ROUNDS, LISTED, BLOCK, CELLS = 2, 16, 512, 1 << 20
#: Near copies beyond the radius: Jaccard similarity over sets of WIDTH words, met in BANDS keys of ROWS minima each. A
#: pair at 0.8 shares no key with probability (1 - 0.8^4)^20 = 0.00003.
WIDTH, SIMILARITY, BANDS, ROWS = 5, 0.8, 20, 4


def _as_signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering(places: list[int], radius: int = RADIUS) -> list[int]:
    """The 2^(radius+1) - 1 masks over some bits, one of which leaves out any `radius` of them."""
    top = 1 << (radius + 1)
    return [sum(1 << p for i, p in enumerate(places) if (v & (1 + i % (top - 1))).bit_count() & 1) for v in range(1, top)]


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks of all bits."""
    return covering(list(range(BITS)), radius)


def narrower(family: list[int], radius: int = RADIUS) -> list[list[int]]:
    """For each mask of a family, that mask with each of those that cover what it drops."""
    return [[m | c for c in covering([i for i in range(BITS) if not m >> i & 1], radius)] for m in family]


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of `width` words, or of the whole of a shorter text; words are split at ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, "<u8")
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - width + 1
    if n < 1:
        return np.array([digest(joined, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)), "<u8", n)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one whole text."""
    hashes = shingles(text, width)
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([_as_signed(fingerprint(t)) for t in batch], dtype="int64")


_FACTORS = np.random.default_rng(SEED).integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)


def bands(text: str | None, width: int = WIDTH) -> list[int] | None:
    """The keys of one whole text; None if it has no words."""
    hashes = shingles(text, width)
    if not len(hashes):
        return None
    low = np.min([(hashes[at : at + 4096, None] * _FACTORS).min(axis=0) for at in range(0, len(hashes), 4096)], axis=0)
    return [_as_signed(xxhash.xxh64_intdigest(x.tobytes(), SEED)) for x in low.reshape(BANDS, ROWS)]


def jaccard(a: str, b: str, width: int = WIDTH) -> float:
    """Exact similarity of two texts' sets of shingles."""
    x, y = set(shingles(a, width).tolist()), set(shingles(b, width).tolist())
    return len(x & y) / max(1, len(x | y))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _bands(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([bands(t) for t in batch], dtype=object)


def row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row; columns that hold maps, which hash functions refuse, enter as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(f.name)) if '"type":"map"' in f.dataType.json() else F.col(f.name) for f in docs.schema])


def fingerprints(docs: DataFrame, keyed: bool = False) -> DataFrame:
    """(doc_id, fp, h): the SimHash of every whole text as a signed long, and a hash of the row; keyed: d and its bands too."""
    small_batches(docs.sparkSession)
    more = [F.xxhash64("text").alias("d"), _bands("text").alias("bands")] if keyed else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _fingerprints("text").alias("fp"), row_hash(docs).alias("h"), *more)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([np.unique(shingles(t, WIDTH)).view("<i8") for t in batch], dtype=object)


def similar_links(docs: DataFrame, own: DataFrame, staging: Staging, similarity: float) -> DataFrame:
    """(src, dst): fingerprints of texts that share a key and whose similarity is at least the one asked for.

    Every pair of texts that share a key is either verified or already joined by others, whatever the keys hold. Texts
    first meet one other text a round, so that copies join by a pair a text. Then the pairs of small keys that are not
    joined yet are listed. The texts of larger keys form clusters, which are cut into blocks of near sizes, and every
    two blocks that can hold a link meet in one task, which counts all overlaps at once and lists no pair that is none.
    Sets of shingles are built once, for texts that share a key.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp", "bands"))
    texts = staging.table(own.where("bands is not null").groupBy("d").agg(first.alias("r")), "texts")
    keyed = texts.select("d", F.posexplode("r.bands").alias("t", "k"))
    shared = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1").select("t", "k")
    keyed = staging.table(keyed.join(shared, ["t", "k"]), "keyed")
    wanted = keyed.select("d").distinct().join(texts, "d").select("d", F.coalesce("r.doc_id", F.lit(0)).alias("id"), "r.nameless")
    named = F.col("doc_id").cast("long")
    read = docs.select(F.coalesce(named, F.lit(0)).alias("id"), named.isNull().alias("nameless"), F.xxhash64("text").alias("d"), "text").join(wanted, ["d", "id", "nameless"])
    sets = staging.table(read.groupBy("d").agg(F.min("text").alias("text")).select("d", _sets("text").alias("s")), "sets")
    met = found = staging.table(docs.sparkSession.createDataFrame([], "x long, y long"), "met")
    members = keyed.withColumn("c", F.col("d"))
    for _ in range(ROUNDS):
        pairs = staging.table(_with_first(members, ["t", "k"], met), "pairs")
        if pairs.isEmpty():
            break
        found, met = found.unionByName(staging.table(_verified(sets, pairs, similarity), "similar")), met.unionByName(pairs)
        members = _joined(keyed, found, staging)
    keys = members.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"), F.min("d").alias("first")).where("low < high")
    unsettled = staging.table(members.join(keys.select("t", "k", "n", "first"), ["t", "k"]), "unsettled")
    few, many = unsettled.where(F.col("n") <= LISTED), unsettled.where(F.col("n") > LISTED)
    clusters = connected_components(many.select(F.col("d").alias("src"), F.col("first").alias("dst")), staging)
    placed = staging.table(clusters.select(F.col("node").alias("d"), F.col("component").alias("cluster")).join(many.select("d", "c").distinct(), "d"), "clusters")
    other = few.select("t", "k", F.col("d").alias("e"), F.col("c").alias("ec"))
    listed = few.join(other, ["t", "k"]).where("d < e and c <> ec").select(F.col("d").alias("x"), F.col("e").alias("y")).distinct().join(met, ["x", "y"], "left_anti")
    found = found.unionByName(staging.table(_verified(sets, listed, similarity), "listed"))
    found = found.unionByName(staging.table(_block_links(placed, sets, staging, similarity), "blocks"))
    names = texts.select("d", F.col("r.fp").alias("fp"))
    left = found.join(names.select(F.col("d").alias("x"), F.col("fp").alias("src")), "x")
    out = staging.table(left.join(names.select(F.col("d").alias("y"), F.col("fp").alias("dst")), "y").where("src <> dst").select("src", "dst").distinct(), "links")
    for over in (keyed, sets, unsettled, placed, texts):
        staging.drop(over)
    return out


def _joined(keyed: DataFrame, found: DataFrame, staging: Staging) -> DataFrame:
    """keyed with the component c of every d under the links found so far."""
    joined = connected_components(found, staging, "x", "y").select(F.col("node").alias("d"), F.col("component").alias("c"))
    return staging.table(keyed.join(joined, "d", "left").withColumn("c", F.coalesce("c", "d")), "members")


def _with_first(members: DataFrame, by: list[str], met: DataFrame) -> DataFrame:
    """(x, y): each d with the smallest other d that is the first of one of its keys, of another component, and not met."""
    firsts = members.groupBy(*by).agg(F.min(F.struct("d", "c")).alias("f"))
    near = members.join(firsts, by).where("c <> f.c").select("d", F.col("f.d").alias("other")).distinct()
    new = near.select("d", F.least("d", "other").alias("x"), F.greatest("d", "other").alias("y")).join(met, ["x", "y"], "left_anti")
    return new.groupBy("d").agg(F.min(F.struct("x", "y")).alias("p")).select("p.x", "p.y").distinct()


def _verified(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those (x, y) whose sets are similar enough."""
    both = pairs.join(sets.select(F.col("d").alias("x"), F.col("s").alias("a")), "x").join(sets.select(F.col("d").alias("y"), F.col("s").alias("b")), "y")
    common = both.select("x", "y", F.size(F.array_intersect("a", "b")).alias("i"), (F.size("a") + F.size("b")).alias("n"))
    return common.where(F.col("i") / (F.col("n") - F.col("i")) >= similarity).select("x", "y")


def _block_links(placed: DataFrame, sets: DataFrame, staging: Staging, similarity: float) -> DataFrame:
    """(x, y): links that join the components of each cluster's texts as all their links do. placed: d, cluster, c.

    Texts whose sizes are too far apart to be similar are never compared: a step of sizes meets itself and the next one.
    A component that fills blocks has blocks of its own, and two blocks of one component do not meet.
    """
    block, cells, step = BLOCK, CELLS, math.log(1 / similarity) * 1.001
    sized = placed.join(sets.select("d", F.size("s").alias("n")), "d").withColumn("step", F.floor(F.log("n") / step))
    whole = sized.groupBy("cluster", "step", "c").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    whole = whole.withColumn("pure", F.when((F.col("m") >= block) | (F.col("w") >= cells), F.col("c")))
    parts = whole.groupBy("cluster", "step", "pure").agg(F.ceil(F.greatest(F.sum("m") / block, F.sum("w") / cells)).alias("parts"))
    same = F.col("pure").eqNullSafe(F.col("p2"))
    whole = whole.join(parts.withColumnRenamed("pure", "p2").withColumnsRenamed({"cluster": "k2", "step": "s2"}), (F.col("cluster") == F.col("k2")) & (F.col("step") == F.col("s2")) & same)
    dealt = sized.select("d", "cluster", "c", "step").join(whole.select("cluster", "step", "c", "pure", "parts"), ["cluster", "step", "c"])
    dealt = staging.table(dealt.select("d", "c", "cluster", "step", F.xxhash64("cluster", "step", "pure", F.pmod(F.xxhash64("d"), F.col("parts"))).alias("id")), "dealt")
    blocks = dealt.groupBy("cluster", "step", "id").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    right = blocks.select("cluster", F.col("step").alias("at"), F.col("id").alias("id2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    meet = blocks.withColumn("at", F.explode(F.array("step", F.col("step") + 1))).join(right, ["cluster", "at"])
    meet = meet.where("(at > step or id <= id2) and not (low = high and low2 = high2 and low = low2)").select("id", "id2")
    sides = meet.select(F.col("id").alias("p"), F.col("id2").alias("q"), F.explode(F.array_distinct(F.array("id", "id2"))).alias("id"))
    whole = dealt.select("id", "d", "c").join(sets, "d").join(sides, "id").select("p", "q", (F.col("id") != F.col("p")).alias("second"), "d", "c", "s")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, {False: [], True: []}

        def settle() -> pd.DataFrame:
            left = pd.concat(held[False])
            return joining_links(left, left if at[0] == at[1] else pd.concat(held[True]), similarity)

        for rows in batches:
            for (p, q, second), some in rows.groupby(["p", "q", "second"], sort=False):
                if (p, q) != at:
                    if at is not None:
                        yield settle()
                    at, held = (p, q), {False: [], True: []}
                held[second].append(some)
        if at is not None:
            yield settle()

    ordered = whole.repartition("p", "q").sortWithinPartitions("p", "q", "second")
    return ordered.mapInPandas(run, "x long, y long")


def joining_links(left: pd.DataFrame, right: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """(x, y) of d: links between rows of two blocks (d, c, s: their sets) that join their components as all links would."""
    n1, n2 = left["s"].map(len).to_numpy(), right["s"].map(len).to_numpy()
    common = overlaps(left["s"], right["s"])
    near = common / (n1[:, None] + n2 - common) >= similarity
    c1, c2, d1, d2 = (f[k].tolist() for k in "cd" for f in (left, right))
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = c = root.get(root[c], root[c])
        return c

    out = []
    for i, j in np.argwhere(near).tolist():
        if (a := find(c1[i])) != (b := find(c2[j])):
            root[a] = b
            out.append((d1[i], d2[j]))
    return pd.DataFrame(out, columns=["x", "y"], dtype="int64")


def overlaps(left: pd.Series, right: pd.Series, dense: int = 4096, room: int = 1 << 22) -> np.ndarray:
    """The sizes of the intersections of all sets of one list with all of another."""
    l, r = (np.concatenate(x.to_list()) for x in (left, right))
    li, ri = (np.repeat(np.arange(len(x)), x.map(len)) for x in (left, right))
    shared = np.intersect1d(l, r)
    (lk, li), (rk, ri) = ((np.searchsorted(shared, v[ok]), i[ok]) for v, i in ((l, li), (r, ri)) for ok in [np.isin(v, shared)])
    n1, n2 = np.bincount(lk, minlength=len(shared)), np.bincount(rk, minlength=len(shared))
    out = np.zeros((len(left), len(right)), np.int64)
    frequent = n1 * n2 >= dense
    at = np.cumsum(frequent) - 1  # frequent shingles by products of incidence matrices
    for lo in range(0, int(frequent.sum()), 1024):
        a, b = (np.zeros((len(x), 1024), np.float32) for x in (left, right))
        for m, k, i in ((a, lk, li), (b, rk, ri)):
            ok = frequent[k] & (at[k] >= lo) & (at[k] < lo + 1024)
            m[i[ok], at[k[ok]] - lo] = 1
        out += (a @ b.T).astype(np.int64)
    ok = ~frequent[lk]  # the others by the rows that hold them
    order = np.argsort(lk[ok], kind="stable")
    rows, starts = li[ok][order], np.cumsum(np.where(frequent, 0, n1)) - np.where(frequent, 0, n1)
    ok = ~frequent[rk]
    rk, ri = rk[ok], ri[ok]
    edges = np.searchsorted(np.cumsum(n1[rk]), np.arange(room, n1[rk].sum() + room, room), side="right")
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(rk)], strict=True):
        size = n1[rk[lo:hi]]
        if size.sum():
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            flat = rows[np.repeat(starts[rk[lo:hi]], size) + inner] * len(right) + np.repeat(ri[lo:hi], size)
            out += np.bincount(flat, minlength=out.size).reshape(out.shape)
    return out


def links(distinct: DataFrame, staging: Staging, group: int = GROUP) -> DataFrame:
    """(src, dst): the pairs of distinct fingerprints at Hamming distance 2 or less, as buckets of masks give them.

    distinct: one column fp without repeats. A bucket's pairs are listed where it holds `group` fingerprints at most;
    larger ones are split by the next family of masks.
    """
    signed = lambda family: [F.lit(_as_signed(m)) for m in family]
    family, out = masks(), None
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(m) for m in signed(family)])).alias("t", "k"))
    for depth in range(FAMILIES):
        sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
        met = staging.table(keyed.join(sizes, ["t", "k"]), "met")
        few = met.where(F.col("n") <= group) if depth + 1 < FAMILIES else met  # the last family's buckets are all small
        held = few.groupBy("t", "k").agg(F.collect_list("fp").alias("xs")).select(F.explode("xs").alias("src"), "xs")
        near = held.select("src", F.explode(F.filter("xs", lambda x: (x > F.col("src")) & (F.bit_count(x.bitwiseXOR(F.col("src"))) <= RADIUS))).alias("dst"))
        out = near if out is None else out.unionByName(near)
        many = met.where(F.col("n") > group)
        if depth + 1 == FAMILIES or many.isEmpty():
            break
        below = narrower(family)
        table = F.array(*[F.array(*signed(own)) for own in below])
        split = many.select("fp", "t", F.posexplode(F.element_at(table, F.col("t") + 1)).alias("s", "m"))
        keyed = split.select("fp", (F.col("t") * len(below[0]) + F.col("s")).alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("k"))
        family = [m for own in below for m in own]
    return out.distinct()


def _labelled(docs: DataFrame, staging: Staging | None, similarity: float | None) -> DataFrame:
    """doc_id, fp, h, root, component_id of every row; root names a component even where no row of it has a doc_id."""
    staging = staging or Staging(docs.sparkSession, "simhash")
    own = staging.table(fingerprints(docs, similarity is not None), "fingerprints")
    first = staging.table(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    edges = links(first.select("fp"), staging)
    if similarity is not None:
        edges = edges.select("src", "dst").unionByName(similar_links(docs, own, staging, similarity))
    found = connected_components(edges, staging)
    rooted = first.join(found, first.fp == found.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    label = rooted.join(least, "root").select("fp", "root", "component_id")
    return own.join(label, "fp").select("doc_id", "fp", "h", "root", "component_id")


def near_duplicates(docs: DataFrame, staging: Staging | None = None, similarity: float | None = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable over links).

    Links are fingerprints within the radius and, unless `similarity` is None, texts at least so similar.
    """
    return _labelled(docs, staging, similarity).select("doc_id", "fp", "component_id")


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, similarity=None).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, similarity: float | None = SIMILARITY) -> DataFrame:
    """One row of each near-duplicate group, with the columns of docs: smallest doc_id, then smallest row hash.

    Rows without doc_id are held against each other alone: of those of a group one stays beside the one with a doc_id.
    """
    ids = F.col("doc_id").isNull().alias("nameless")
    best = _labelled(docs, None, similarity).groupBy("root", ids).agg(F.min(F.struct("doc_id", "h")).alias("b"))
    kept = best.select("nameless", F.coalesce("b.doc_id", F.lit(0)).alias("id"), F.col("b.h").alias("h"))
    named = F.col("doc_id").cast("long")
    whole = docs.select(named.isNull().alias("nameless"), F.coalesce(named, F.lit(0)).alias("id"), row_hash(docs).alias("h"), F.struct(*docs.columns).alias("row"))  # no name of ours meets theirs
    once = whole.join(kept, ["nameless", "id", "h"], "left_semi").withColumn("n", F.row_number().over(Window.partitionBy("nameless", "id", "h").orderBy("h")))
    return once.where("n = 1").select("row.*")
