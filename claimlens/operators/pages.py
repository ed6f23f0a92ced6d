"""Pages as tables: tokens with the bytes they stand at, elements as intervals of tokens, visible spans proved by their bytes.

One pattern tiles the whole source, so a token's offset is the sum of what stands before it and no parser runs beside
Spark. Elements are matched name by name: an opening tag meets the next closing one of its name at its own level. An
element holds what lies in its interval, so tests of ancestors are comparisons of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Comments, scripts and styles as a whole, declarations and tags, text, and a stray less-than sign.
TOKENS = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|</?[a-z!?][^>]*(?:>|\z)|[^<]+|<"
#: Elements without content (fixed values of HTML).
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def tokens(pages: DataFrame) -> DataFrame:
    """(page_id, n, kind, name, token, start, end) of pages (page_id, html): open, close, void, text or hidden; bytes of UTF-8."""
    found = F.regexp_extract_all("html", F.lit(TOKENS), F.lit(0))
    rows = pages.where("html is not null and html <> ''").select("page_id", F.posexplode(found).alias("n", "token"))
    name = F.lower(F.regexp_extract("token", r"^</?([A-Za-z][^\s/>]*)", 1))
    kind = (
        F.when(~F.col("token").startswith("<") | (F.col("token") == "<"), "text")
        .when(F.col("token").rlike(r"(?i)^<(!|\?|script\b|style\b)"), "hidden")
        .when(F.col("token").startswith("</"), "close")
        .when(F.col("name").isin(*VOID) | F.col("token").endswith("/>"), "void")
        .otherwise("open")
    )
    here = Window.partitionBy("page_id").orderBy("n")
    sized = rows.withColumn("name", name).withColumn("kind", kind).withColumn("end", F.sum(F.octet_length("token")).over(here))
    return sized.select("page_id", "n", "kind", F.when(F.col("kind") != "text", F.col("name")).alias("name"), "token", (F.col("end") - F.octet_length("token")).alias("start"), "end")


def elements(tokens: DataFrame) -> DataFrame:
    """(page_id, name, n, until, level) of every element: its opening token, the closing one (null if it never closes), and how many of its name hold it."""
    tags = tokens.where("kind in ('open', 'close')").select("page_id", "name", "n", "kind")
    order = Window.partitionBy("page_id", "name").orderBy("n")
    turned = tags.withColumn("depth", F.sum(F.when(F.col("kind") == "open", 1).otherwise(-1)).over(order))
    level = turned.withColumn("level", F.when(F.col("kind") == "open", F.col("depth")).otherwise(F.col("depth") + 1))
    after = Window.partitionBy("page_id", "name", "level").orderBy("n")
    met = level.withColumns({"after": F.lead("kind").over(after), "at": F.lead("n").over(after)}).where("kind = 'open'")
    return met.select("page_id", "name", "n", F.when(F.col("after") == "close", F.col("at")).alias("until"), "level")


def decoded(text: Column) -> Column:
    """Text with its five named references resolved, the ampersand last, and non-breaking spaces as such."""
    for name, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(value))
    return text


def spans(tokens: DataFrame) -> DataFrame:
    """(page_id, n, start, end, raw, text) of every visible span that is not blank: its bytes, and what a reader sees."""
    shown = tokens.where("kind = 'text'").where(F.col("token").rlike(r"[^\s]"))
    plain = F.trim(F.regexp_replace(decoded(F.col("token")), r"[ \t\r\n\f]+", " "))
    return shown.select("page_id", "n", "start", "end", F.col("token").alias("raw"), plain.alias("text"))


def within(spans: DataFrame, elements: DataFrame, names: list[str]) -> DataFrame:
    """(page_id, name, n, text): the text of every element of these names, its spans in their order."""
    own = elements.where(F.col("name").isin(*names)).select("page_id", "name", F.col("n").alias("open"), "until")
    met = own.join(spans.select("page_id", "n", "text"), "page_id").where("n > open and n < until")
    return met.groupBy("page_id", "name", F.col("open").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda s: s["text"]), " ").alias("text"))


def proved(claimed: DataFrame, pages: DataFrame) -> DataFrame:
    """claimed (page_id, start, end, sha256) with `holds`: whether the page's bytes there have that digest."""
    read = claimed.join(pages.select("page_id", F.encode("html", "UTF-8").alias("bytes")), "page_id", "left")
    piece = F.substring(F.col("bytes"), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    inside = (F.col("start") >= 0) & (F.col("end") <= F.octet_length("bytes")) & (F.col("start") < F.col("end"))
    return read.withColumn("holds", F.coalesce(inside & (F.sha2(piece, 256) == F.col("sha256")), F.lit(False))).drop("bytes")
