"""Text expressions: safe cells, tokens, amounts, capabilities, folded search and visible HTML text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_cell(text: Column) -> Column:
    """A cell that a spreadsheet cannot read as a formula: an apostrophe goes before risky beginnings."""
    risky = F.ltrim(text).rlike(r"^[=+\-@]") | text.rlike(r"^[\t\r\n]")
    return F.when(risky, F.concat(F.lit("'"), text)).otherwise(text)


def tokens(text: Column, separator: str = r"\s+") -> Column:
    """Sorted distinct tokens without blanks."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.trim(text), separator), lambda x: x != "")))


def amounts(text: Column) -> Column:
    """Dollar amounts as decimals, with million and billion multiplied out."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)\$\s?(\d+(?:\.\d+)?(?:\s(?:million|billion))?)"), 1)

    def value(x: Column) -> Column:
        number = F.regexp_extract(x, r"^(\d+(?:\.\d+)?)", 1).cast("decimal(20,6)")
        unit = F.lower(F.regexp_extract(x, r"\s(\w+)$", 1))
        return (number * F.when(unit == "million", 1_000_000).when(unit == "billion", 1_000_000_000).otherwise(1)).cast("double")

    return F.transform(found, value)


def measures(text: Column, unit: str) -> Column:
    """Sorted distinct whole numbers written before a unit."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(rf"(?i)\b(\d+)\s?{unit}\b"), 1), lambda x: x.cast("int"))))


def _udf(one, kind):
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: None if x is None else one(x))

    return run


def fold(text: str) -> str:
    """Case-folded normal form: equal for what readers take as the same letters."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())


def folded():
    """Column form of fold; collations are no substitute (sharp s differs)."""
    return _udf(fold, T.StringType())


def name_key():
    """Compatibility-normal, white-space-free key of names."""
    return _udf(lambda x: "".join(unicodedata.normalize("NFKC", x).split()), T.StringType())


def name_words(text: str) -> str:
    """Words of a name for whole-word comparison: compatibility-normal, case-folded, all but letters and digits as blanks."""
    kept = (c if c.isalnum() else " " for c in unicodedata.normalize("NFKC", text).casefold())
    return " ".join("".join(kept).split())


def worded():
    """Column form of name_words."""
    return _udf(name_words, T.StringType())


class _Visible(HTMLParser):
    HIDDEN = frozenset(("script", "style", "noscript", "template"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.HIDDEN

    def handle_endtag(self, tag):
        self.depth -= tag in self.HIDDEN and self.depth > 0

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def visible(html: str) -> str:
    """Text a reader sees, with white space collapsed; script and style contents are left out."""
    parser = _Visible()
    parser.feed(html)
    parser.close()
    return " ".join(" ".join(parser.parts).split())


def visible_text():
    return _udf(visible, T.StringType())


def segments_in_order(segments: Column, text: Column) -> Column:
    """Whether all segments occur in the text, each after the one before."""
    start = F.struct(F.lit(1).alias("at"), F.lit(True).alias("ok"))

    def step(acc, s):
        place = F.call_function("locate", s, text, acc["at"])
        return F.struct(F.when(place > 0, place + F.length(s)).otherwise(acc["at"]).alias("at"), (acc["ok"] & (place > 0)).alias("ok"))

    return F.aggregate(segments, start, step)["ok"]


def links(html: Column) -> Column:
    """array of (href, text) of a page's anchors in their order; inner tags are dropped and white space is collapsed."""
    rule = r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a\s*>"
    found = F.regexp_extract_all(html, F.lit(rule), 0)
    plain = lambda a: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(a, rule, 2), "<[^>]*>", " "), r"\s+", " "))
    return F.transform(found, lambda a: F.struct(F.regexp_extract(a, rule, 1).alias("href"), plain(a).alias("text")))


def page_number(url: Column) -> Column:
    """The page that a listing's url asks for; 1 where it names none."""
    return F.coalesce(F.regexp_extract(url, r"[?&]page=(\d+)(?:&|#|\z)", 1).try_cast("int"), F.lit(1))
