"""Merkle manifest of a dataset: a tree of digests a group, a tree over the groups' roots, and a proof for every row.

Rows of a group are numbered in order. Every level then is an equi-join of nodes with their computed siblings: a node of
slot zero names the indices of its run (XOR with one in a binary tree, slot offsets otherwise), meets them, and emits the
run's parent. Proofs come down from the root: a run and the siblings above it give those of its members, so that long
proofs travel once a run and not once a row. Folding goes up again, from any leaf and the original siblings.

No group is ever gathered: rows are numbered by a range sort and the sums of what stands before each of its parts, and
all joins are on (tree, index). Each level is a sixteenth of the one below.

Defined results: null columns are written `-`; rows of one doc_id are ordered by their leaves; rows without doc_id come
first, and are never tampered with; a null group is a group of its own and comes first; repeated rows are leaves of their
own; columns beyond those named do not count; no rows give no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.crc import crc32_sql
from claimlens.plans.staging import Staging

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of the decimal doc_id's checksum: what divides it marks the rows that the query tampers with.
TAMPERED = 5


def field(value: Column | str) -> Column:
    """A value in a leaf: UTF-8 byte count, colon, value; a minus sign if null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column | str) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def numbered(rows: DataFrame, key: list[str], order: list[str], staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(rows with part and at, parts with lo and start): idx of a row in its key is at - lo + start.

    One range sort; parts hold one row for each key of each partition, and their running sums are all that is ordered by key.
    """
    at = rows.withColumn("tie", F.monotonically_increasing_id())  # so that equal rows, however many, fall into several partitions
    held = at.repartitionByRange(*key, *order, "tie").sortWithinPartitions(*key, *order, "tie").drop("tie")
    held = staging.table(held.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sorted")
    parts = held.groupBy(*key, "part").agg(F.min("at").alias("lo"), F.count("*").alias("m"))
    before = Window.partitionBy(*key).orderBy("part")
    return held, parts.select(*key, "part", "lo", "m", (F.sum("m").over(before) - F.col("m")).alias("start"))


def _levels(most: int, arity: int) -> int:
    n = 0
    while most > 1:
        most, n = -(-most // arity), n + 1
    return n


def _parents(nodes: DataFrame, arity: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(runs: tree, idx of the parent, n of the level, run of digests; nodes of the next level) of trees with several nodes."""
    many = nodes.where("n > 1")
    heads = many.where(F.col("idx") % arity == 0)
    shifts = F.array(F.col("idx").bitwiseXOR(F.lit(1))) if arity == 2 else F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda o: F.col("idx") + o)
    named = heads.select("tree", "n", F.col("idx").alias("head"), F.explode(F.concat(F.array("idx"), shifts)).alias("idx"))
    met = named.join(many.select("tree", "idx", "digest"), ["tree", "idx"])
    runs = met.groupBy("tree", "n", "head").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda s: s["digest"]).alias("run"))
    runs = staging.table(runs.select("tree", (F.col("head") / arity).cast("long").alias("idx"), "n", "run"), "runs")
    return runs, runs.select("tree", F.ceil(F.col("n") / arity).alias("n"), "idx", F.sha2(F.array_join("run", ""), 256).alias("digest"))


def _descend(runs: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """(tree, idx, proof, subroot) of every member of the runs, from those of their parents."""
    met = runs.select("tree", "idx", "run").join(above, ["tree", "idx"]).select("tree", "idx", "run", "proof", "subroot", F.explode(F.sequence(F.lit(0), F.size("run") - 1)).alias("slot"))
    others = F.concat(F.slice("run", 1, F.col("slot")), F.slice("run", F.col("slot") + 2, arity))
    return met.select("tree", (F.col("idx") * arity + F.col("slot")).alias("idx"), F.concat(F.array_join(others, ""), "proof").alias("proof"), "subroot")


def _ascend(rows: DataFrame, runs: DataFrame, arity: int) -> DataFrame:
    """rows (tree, at, digest, ...) one level up: the digest takes its place among its siblings; trees that are complete stay."""
    slot = F.col("at") % arity
    up = rows.withColumn("idx", F.floor(F.col("at") / arity)).join(runs.select("tree", "idx", "run"), ["tree", "idx"], "left")
    filled = F.concat(F.slice("run", 1, slot.cast("int")), F.array("digest"), F.slice("run", slot.cast("int") + 2, arity))
    folded = F.when(F.col("run").isNull(), F.col("digest")).otherwise(F.sha2(F.array_join(filled, ""), 256))
    return up.withColumn("digest", folded).withColumn("at", F.col("idx")).drop("idx", "run")


@dataclass
class Manifest:
    """leaves: tree, n, idx, leaf and the columns kept; runs and top: the runs of every level, of the groups and above them."""

    leaves: DataFrame
    runs: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None
    arity: int

    def proofs(self) -> DataFrame:
        """(tree, idx, proof, subroot): the hex digests of all siblings of a leaf, level by level up to the root, left to right."""
        spark = self.leaves.sparkSession
        above = spark.createDataFrame([(0, 0, "", "")], "tree long, idx long, proof string, subroot string")
        for runs in reversed(self.top):
            above = _descend(runs, above, self.arity)
        done = self.subroots.join(above.select(F.col("idx").alias("tree"), "proof"), "tree").select("tree", F.lit(0).cast("long").alias("idx"), "proof", F.col("digest").alias("subroot"), "depth")
        below = done.where(F.col("depth") == len(self.runs)).drop("depth")
        for level in reversed(range(len(self.runs))):
            below = _descend(self.runs[level], below, self.arity).unionByName(done.where(F.col("depth") == level).drop("depth"))
        return below

    def fold(self, rows: DataFrame, digest: str) -> DataFrame:
        """(tree, idx, folded): the root that a digest in the place of leaf (tree, idx) leads to with the original siblings."""
        up = rows.select("tree", F.col("idx").alias("own"), F.col("idx").alias("at"), F.col(digest).alias("digest"))
        for runs in self.runs:
            up = _ascend(up, runs, self.arity)
        up = up.select(F.col("tree").alias("group"), "own", F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), "digest")
        for runs in self.top:
            up = _ascend(up, runs, self.arity)
        return up.select(F.col("group").alias("tree"), F.col("own").alias("idx"), F.col("digest").alias("folded"))

    def write(self, path: str) -> None:
        """The manifest as files: leaves with their places, and every inner node beside its children."""
        self.leaves.write.parquet(f"{path}/leaves")
        for name, levels in (("runs", self.runs), ("top", self.top)):
            for level, runs in enumerate(levels):
                runs.write.parquet(f"{path}/{name}-{level}")


def build(leaves: DataFrame, group: str, order: str, staging: Staging, arity: int = ARITY) -> Manifest:
    """The tree of rows that hold a digest `leaf`: a tree a group, ordered by `order`, and one over the groups in order."""
    known = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null sorts first, and bytes order the rest
    held, parts = numbered(leaves.withColumn("group_", known), ["group_"], [order, "leaf"], staging)
    parts = staging.table(parts, "parts")
    sizes = parts.groupBy("group_").agg(F.sum("m").alias("n")).withColumn("all_", F.lit(0).cast("long"))
    names, bounds = numbered(sizes, ["all_"], ["group_"], staging)
    trees = names.join(bounds, ["all_", "part"]).select("group_", "n", (F.col("at") - F.col("lo") + F.col("start")).alias("tree"))
    trees = staging.table(trees, "trees")
    placed = held.join(parts.join(trees, "group_").select("group_", "part", "lo", "start", "tree", "n"), ["group_", "part"])
    leaves = staging.table(placed.select("tree", "n", (F.col("at") - F.col("lo") + F.col("start")).alias("idx"), *[c for c in held.columns if c not in ("group_", "part", "at")]), "leaves")
    most = trees.agg(F.max("n").alias("n"), F.count("*").alias("trees")).first()
    nodes, runs, done = leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), [], []
    for level in range(_levels(most.n or 0, arity) + 1):
        done.append(nodes.where("n = 1").select("tree", "digest", F.lit(level).alias("depth")))
        if level < _levels(most.n or 0, arity):
            own, nodes = _parents(nodes, arity, staging)
            runs.append(own)
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    subroots = staging.table(subroots, "subroots")
    nodes, top = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(most.trees).alias("n"), F.col("tree").alias("idx"), "digest"), []
    for _ in range(_levels(most.trees, arity)):
        own, nodes = _parents(nodes, arity, staging)
        top.append(own)
    last = nodes.first()
    return Manifest(leaves, runs, subroots, top, last and last.digest, arity)


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    staging = Staging(spark, "merkle")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    bent = F.when(hit, leaf(*COLUMNS[:-1], lowered))
    tree = build(docs.select("doc_id", "source", leaf(*COLUMNS).alias("leaf"), bent.alias("bent")), "source", "doc_id", staging)
    folded = tree.fold(tree.leaves.withColumn("bent", F.coalesce("bent", "leaf")), "bent")
    proofs = tree.proofs().select("tree", "idx", F.sha2("proof", 256).alias("proof_sha256"), "subroot")
    out = tree.leaves.join(proofs, ["tree", "idx"]).join(folded, ["tree", "idx"])
    root = F.lit(tree.root)
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", F.col("folded").alias("folded_root"), F.coalesce(F.col("folded") == root, F.lit(False)).alias("verified"))


def _op13_sql(levels: int = 5, top: int = 3) -> str:
    """The trees level by level; a complete tree goes up unchanged. Enough for 16^levels rows a source, 16^top sources."""
    h = lambda *values: "sha256(" + " || ".join(f"coalesce(strlen({v})::varchar || ':' || {v}, '-')" for v in values) + ")"
    names = ["doc_id::varchar", "source", "lang", "n_chars::varchar"]
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    ctes = [
        f"raw AS (SELECT doc_id, source, {h(*names, 'text')} AS leaf, CASE WHEN {crc32_sql('doc_id::varchar')} % {TAMPERED} = 0 THEN {h(*names, f"translate(text, '{upper}', '{lower}')")} END AS bent FROM documents)",
        "l AS (SELECT *, dense_rank() OVER (ORDER BY coalesce('=' || source, '')) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM raw)",
        "a0 AS (SELECT tree, n, idx, leaf AS d FROM l)",
    ]

    def climb(name: str, count: int) -> None:
        for i in range(count):
            ctes.append(f"{name}r{i} AS (SELECT tree, max(n) AS n, idx // 16 AS idx, list(d ORDER BY idx) AS run FROM {name}{i} GROUP BY tree, idx // 16)")
            ctes.append(f"{name}{i + 1} AS (SELECT tree, (n + 15) // 16 AS n, idx, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS d FROM {name}r{i})")

    def walk(name: str, first: str, at: str, count: int, out: str) -> None:
        ctes.append(f"{out}0 AS ({first})")
        for i in range(count):
            s = f"(w.{at} // {16**i} % 16)"
            ctes.append(
                f"{out}{i + 1} AS (SELECT w.* REPLACE (w.proof || CASE WHEN r.n > 1 THEN array_to_string(r.run[1:{s}] || r.run[{s} + 2:], '') ELSE '' END AS proof, "
                f"CASE WHEN r.n > 1 THEN sha256(array_to_string(r.run[1:{s}] || [w.f] || r.run[{s} + 2:], '')) ELSE w.f END AS f) "
                f"FROM {out}{i} w JOIN {name}r{i} r ON r.tree = {'0' if at == 'tree' else 'w.tree'} AND r.idx = w.{at} // {16 ** (i + 1)})"
            )

    climb("a", levels)
    ctes.append(f"b0 AS (SELECT 0 AS tree, count(*) OVER () AS n, tree AS idx, d FROM a{levels})")
    climb("b", top)
    walk("a", "SELECT doc_id, leaf, tree, idx, '' AS proof, coalesce(bent, leaf) AS f FROM l", "idx", levels, "w")
    walk("b", f"SELECT * FROM w{levels}", "tree", top, "v")
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT v.doc_id, v.leaf, s.d AS subroot, t.d AS root, sha256(v.proof) AS proof_sha256, v.f AS folded_root, v.f = t.d AS verified FROM v{top} v JOIN a{levels} s ON s.tree = v.tree CROSS JOIN b{top} t"
    )


OP13_SQL = _op13_sql()
