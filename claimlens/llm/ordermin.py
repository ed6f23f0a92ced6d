"""Fingerprints by Order MinHash, in Spark's own functions alone.

A text's tokens are its runs of non-blanks in pieces of at most PIECE characters, and its k-mers are K tokens in a row.
Each k-mer is numbered by its occurrence in the text and hashed with that number. Of SIZE orders of these hashes each
selects the ORDER least; their k-mers, put back into the order of the text, are hashed to one component. So a component
survives an edit if neither its k-mers nor their order change, and moving a passage costs likeness where a set of k-mers
would not notice.

The orders are turns of one circle: the j-th begins at j / SIZE of the hashes' range. So a text is hashed and sorted
twice, not SIZE times: once to number occurrences and once to read all orders off, beside marks at their beginnings. A
k-mer and its place share one long, so sorts move longs. Every step is a function of one row's arrays and no column is
evaluated again for each element, as `let` binds it first.

Defined results: a null text is empty; texts without a non-blank are all alike; a text of fewer than K tokens is one
k-mer; with fewer k-mers than ORDER a component takes all of them. Likeness is the share of equal components. Extra
columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.plans.staging import Staging

PIECE, K, ORDER, SIZE = 8, 3, 2, 64
#: Bytes of text a part of the ordered documents holds, parts at most, and parts between two of the coarse bounds.
PART_BYTES, PARTS, WIDTH = 16 << 20, 65_536, 256
#: Bits of a long that hold a k-mer's place, from one; a text holds fewer tokens than 2^27.
PLACE = 28
_LOW, _HIGH = (1 << PLACE) - 1, -(1 << PLACE)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0))


def _kmers(words: Column, k: int) -> Column:
    """Longs of a k-mer's hash and its place."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + d) for d in range(k)]).bitwiseAND(F.lit(_HIGH)).bitwiseOR(i + F.lit(1).cast("long")))


def _numbered(kmers: Column) -> Column:
    """The same with hashes of (k-mer, occurrence): equal k-mers are neighbours among the sorted longs, in the order of the text."""
    fresh = lambda held: lambda v, i: F.shiftrightunsigned(v.bitwiseXOR(F.coalesce(F.get(held, i - 1), F.bitwise_not(v))), PLACE) != 0
    hashed = lambda v, n: F.xxhash64(v.bitwiseAND(F.lit(_HIGH)), n).bitwiseAND(F.lit(_HIGH)).bitwiseOR(v.bitwiseAND(F.lit(_LOW)))

    def later(again: Column) -> Column:
        """Of second and further occurrences, a stretch of equal ones at a time."""
        starts = F.filter(F.sequence(F.lit(0), F.size(again) - 1), lambda i: fresh(again)(F.get(again, i), i))
        of = lambda s: F.transform(s, lambda at, r: F.transform(F.slice(again, at + 1, F.coalesce(F.get(s, r + 1), F.size(again)) - at), lambda v, o: hashed(v, o + 1)))
        return F.when(F.size(again) > 0, let(starts, lambda s: F.flatten(of(s)))).otherwise(F.array().cast("array<bigint>"))

    def both(held: Column) -> Column:
        first = F.transform(F.filter(held, fresh(held)), lambda v: hashed(v, F.lit(0)))
        return F.concat(first, let(F.filter(held, lambda v, i: ~fresh(held)(v, i)), later))

    return let(F.sort_array(kmers), both)


def _components(numbered: Column, order: int, size: int) -> Column:
    """The component of each turn of the circle: the hash of its least k-mers in the order of the text."""
    marks = F.array(*[F.lit(-(1 << 63) + j * ((1 << 64) // size)) for j in range(size)])  # their places are zero
    turned = lambda v: F.shiftleft(v, 64 - PLACE).bitwiseOR(F.shiftrightunsigned(v, PLACE))  # noqa: E731 place first, then hash

    def read(circle: Column) -> Column:
        real = F.filter(circle, lambda v: v.bitwiseAND(F.lit(_LOW)) != 0)
        at = F.filter(F.sequence(F.lit(0), F.size(circle) - 1), lambda i: F.get(circle, i).bitwiseAND(F.lit(_LOW)) == 0)

        def one(least: Column, mark: Column, j: Column) -> Column:
            steps = F.sequence(F.lit(0), F.least(F.lit(order), F.size(least)) - 1)
            chosen = F.transform(steps, lambda d: turned(F.get(least, (mark - j + d) % F.size(least))))
            return F.shiftright(F.xxhash64(F.transform(F.sort_array(chosen), lambda v: v.bitwiseAND(F.lit((1 << (64 - PLACE)) - 1)))), 32).cast("int")

        return let(real, lambda least: F.transform(at, lambda mark, j: one(least, mark, j)))

    return let(F.sort_array(F.concat(numbered, marks)), read)


def signature(text: Column, k: int = K, order: int = ORDER, size: int = SIZE) -> Column:
    """The `size` components of a whole text, as ints; null is empty."""
    return let(tokens(F.coalesce(text, F.lit(""))), lambda words: _components(_numbered(_kmers(words, k)), order, size))


def written(components: Column) -> Column:
    """A signature as text: eight hex digits a component."""
    return F.array_join(F.transform(components, lambda x: F.lower(F.right(F.lpad(F.hex(x), 16, "0"), F.lit(8)))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal components."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.size(a)


def _bounds(keys: DataFrame, parts: int) -> DataFrame:
    """One row: the first keys of about equal parts of all keys, ascending, and every WIDTH-th of them."""
    dealt = keys.repartitionByRange(parts, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
    one = dealt.agg(F.array_sort(F.collect_list("key")).alias("bounds"))
    return one.select("bounds", F.transform(F.sequence(F.lit(1), F.greatest(F.size("bounds"), F.lit(1)), F.lit(WIDTH)), lambda i: F.get("bounds", i - 1)).alias("coarse"))


def with_next(docs: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, text, components, and next_text, next_components of the following document; after the last comes the first.

    Documents are ordered by doc_id, those without one first; rows of one doc_id by a hash of their texts. A range sort of
    these keys alone finds where parts begin. A text is then dealt once, to its part; a part's first document is sent to
    the part before as well, so that every part looks one row ahead. Equal rows of one doc_id are one another's next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.struct(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h")))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = min(PARTS, max(1, -(-size // PART_BYTES)))
    bounds = staging.table(_bounds(rows.select("key"), parts), "bounds")  # one row of PARTS keys at most
    upto = lambda keys: F.size(F.filter(keys, lambda b: b <= F.col("key")))
    dealt = rows.join(F.broadcast(bounds)).withColumn("c", (upto("coarse") - 1) * WIDTH)
    dealt = dealt.withColumn("part", F.col("c") + upto(F.slice("bounds", F.col("c") + 1, WIDTH)) - 1)
    head = F.get("bounds", F.col("part")) == F.col("key")
    before = F.pmod(F.col("part") - 1, F.size("bounds"))
    placed = F.when(head, F.array(F.struct("part", F.lit(False).alias("after")), F.struct(before.alias("part"), F.lit(True).alias("after")))).otherwise(F.array(F.struct("part", F.lit(False).alias("after"))))
    dealt = dealt.select("doc_id", "text", "key", F.explode(placed).alias("p")).select("doc_id", "text", "key", "p.part", "p.after", signature(F.col("text")).alias("components"))
    ahead = F.lead(F.struct("text", "components")).over(Window.partitionBy("part").orderBy("after", "key"))
    return dealt.withColumn("next", ahead).where("not after").select("doc_id", "text", "components", F.col("next.text").alias("next_text"), F.col("next.components").alias("next_components"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many first code points of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def op12_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = with_next(docs, Staging(spark, "ordermin")).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("e", let(signature(F.col("edited")), lambda e: F.struct(written(e).alias("edited_fingerprint"), likeness(F.col("components"), e).alias("near_edited"))))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("components")).alias("fingerprint"),
        "e.edited_fingerprint",
        "e.near_edited",
        likeness(F.col("components"), F.col("next_components")).alias("near_next"),
    )
