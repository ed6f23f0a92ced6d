"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Source token shares p are raised to an exponent a in [0, 1] and normalised: 1 keeps the shares, 0 makes them equal.
Entropy falls and the largest number of passes over a source falls as a grows, so both limits are met by bisection:
the largest a whose entropy reaches `entropy` (as a part of the largest possible), and the smallest whose busiest
source is read at most `max_repeat` times; the larger of the two, as the repetition limit is the hard one.

A budget then becomes rows: each source's documents fall by hash into blocks of about `block_tokens`; a source with
r passes is read floor(r) times whole, and for the remaining fraction its blocks, in a permutation by seeded hash, are
taken while they fit, the block at the edge up to a hash bound that fits. Per-epoch block order and the order within
a block are hashes too, so sorting by (mix_epoch, mix_block_order, mix_order) replays the mixture anywhere.

budget None means the smallest budget that reads every source once at least, so no document is lost; a number of
tokens reads large sources in part. Tokens are words between white space.

Defined results: null text has zero tokens and a document without tokens goes with its block; null source is a
source of its own; repeated rows are mixed each; ties of hash stay together; documents of a source without
tokens come back once; an empty table gives an empty result; columns that clash with the mix_ names are kept untouched under theirs
and the mix_ columns take a trailing underscore.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.plans.staging import Staging

ENTROPY, MAX_REPEAT, BLOCK_TOKENS, SEED = 0.98, 2.0, 1 << 17, 17
#: Sources whose shares the driver weighs; a table with more is refused, not cut.
MAX_SOURCES = 1_000_000


def weights(tokens: list[int], a: float) -> list[float]:
    """Normalised shares to the power a; sources without tokens weigh nothing."""
    total = sum(tokens) or 1
    raised = [(t / total) ** a if t else 0.0 for t in tokens]
    norm = math.fsum(raised) or 1.0
    return [x / norm for x in raised]


def entropy(w: list[float]) -> float:
    return -math.fsum(x * math.log(x) for x in w if x > 0)


def passes(tokens: list[int], w: list[float], budget: float | None) -> list[float]:
    """How often each source is read; without a budget the least read source is read once."""
    per = [x / t if t else 0.0 for x, t in zip(w, tokens, strict=True)]
    if budget is None:
        budget = 1 / min((x for x in per if x), default=1.0)
    return [x * budget for x in per]


def bisect_exponent(tokens: list[int], target: float | None, max_repeat: float | None, budget: float | None = None, steps: int = 60) -> float:
    """The exponent that meets the entropy target, raised as far as the repetition limit asks."""
    most = math.log(max(1, sum(t > 0 for t in tokens)))

    def bisect(ok, high_side: bool) -> float:
        lo, hi = 0.0, 1.0
        if ok(hi if high_side else lo):
            return hi if high_side else lo
        for _ in range(steps):
            mid = (lo + hi) / 2
            if ok(mid):
                lo, hi = (mid, hi) if high_side else (lo, mid)
            else:
                lo, hi = (lo, mid) if high_side else (mid, hi)
        return lo if high_side else hi

    a = bisect(lambda x: entropy(weights(tokens, x)) >= target * most, True) if target is not None else 1.0
    if max_repeat is not None:
        a = max(a, bisect(lambda x: max(passes(tokens, weights(tokens, x), budget), default=0) <= max_repeat * (1 + 1e-12), False))
    return a


def _tokens(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, target: float | None = ENTROPY, max_repeat: float | None = MAX_REPEAT, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED, keep_text: bool = True, staging: Staging | None = None) -> DataFrame:
    """docs, each row as often as its source's passes ask, with mix_tokens, mix_epoch, mix_block, mix_block_order, mix_order.

    Only per-source totals reach the driver. Block totals combine before the shuffle; the running sums over them hold
    one row per block. Documents join block rows and are never sorted or gathered.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark, "mixing")
    names = [c for c in docs.columns if keep_text or c != "text"]
    add = {n: n + "_" * (n in names) for n in ("mix_tokens", "mix_epoch", "mix_block", "mix_block_order", "mix_order")}
    key = F.struct("doc_id", "source")
    # a row travels as one struct, so no name of ours meets theirs; sums are formed over a slim table, and texts are
    # read once, where the mixture is dealt
    own = [F.to_json(F.struct("source")).alias("label"), F.xxhash64(F.lit(seed), key).alias("deal"), F.xxhash64(F.lit(seed + 1), key).alias("h"), F.xxhash64(F.lit(seed + 4), key).alias("at"), _tokens().alias("tokens")]
    row = F.struct(*names).alias("row")
    slim = staging.table(docs.select(*own, *([] if keep_text else [row])), "tokens")
    sized = docs.select(*own, row) if keep_text else slim
    total = slim.groupBy("label").agg(F.sum("tokens").alias("t")).limit(MAX_SOURCES + 1).collect()
    if len(total) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    total.sort(key=lambda r: r.label)
    tokens = [r.t for r in total]
    reads = passes(tokens, weights(tokens, bisect_exponent(tokens, target, max_repeat, budget)), budget) if any(tokens) else [1.0] * len(tokens)
    table = spark.createDataFrame(
        [(r.label, max(1, math.ceil(r.t / block_tokens)), int(x + 1e-9) if r.t else 1, max(0.0, x - int(x + 1e-9)) * r.t) for r, x in zip(total, reads, strict=True)],
        "label string, blocks long, whole long, rest double",
    )
    place = lambda df: df.join(F.broadcast(table), "label").withColumn("block", F.pmod("deal", F.col("blocks")))  # noqa: E731 MAX_SOURCES bounds the table
    sums = place(slim).where("rest > 0").groupBy("label", "block", "rest").agg(F.sum("tokens").alias("b"))
    sums = staging.table(sums.withColumn("o", F.xxhash64(F.lit(seed + 2), "label", "block")).withColumn("slot", F.shiftright("o", 54)), "sums")
    # the permutation's running sums: over the at most 1,024 slots of a source, then inside each slot, so that no task ranks all blocks of a source
    slots = sums.groupBy("label", "slot").agg(F.sum("b").alias("s"))
    before = slots.select("label", "slot", (F.sum("s").over(Window.partitionBy("label").orderBy("slot")) - F.col("s")).alias("before"))
    inner = Window.partitionBy("label", "slot").orderBy("o", "block")
    marked = sums.join(before, ["label", "slot"]).select("label", "block", "b", (F.col("rest") - F.col("before") - F.sum("b").over(inner) + F.col("b")).alias("room"))
    full = marked.where("b <= room").select("label", "block", F.lit(2**63 - 1).alias("bound"))
    # one block a source at most straddles the edge; its documents are bounded by block_tokens, but for empty ones
    edge = marked.where("b > room and room > 0").select("label", "block", "room")
    inside = place(slim).join(F.broadcast(edge), ["label", "block"]).groupBy("label", "block", "room", "h").agg(F.sum("tokens").alias("d"))
    within = Window.partitionBy("label", "block").orderBy("h")
    part = inside.withColumn("run", F.sum("d").over(within)).where("run <= room").groupBy("label", "block").agg(F.max("h").alias("bound"))
    taken = staging.table(full.unionByName(part), "blocks")
    out = place(sized).join(taken, ["label", "block"], "left")
    copies = F.col("whole") + F.when(F.col("bound").isNotNull() & (F.col("h") <= F.col("bound")), 1).otherwise(0)
    out = out.withColumn("copies", copies).where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    return out.select(
        "row.*",
        F.col("tokens").alias(add["mix_tokens"]),
        F.col("epoch").alias(add["mix_epoch"]),
        F.col("block").alias(add["mix_block"]),
        F.xxhash64(F.lit(seed + 3), "epoch", "label", "block").alias(add["mix_block_order"]),
        F.xxhash64("at", "epoch").alias(add["mix_order"]),
    )


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The mixture's rows: each document as often as the target weights ask, with its place in the block permutation."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs, keep_text=False)
