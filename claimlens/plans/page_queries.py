"""Registered queries over raw pages: elements, visible spans and fields, from one tiling of the source."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import pages
from claimlens.plans.queries import query
from claimlens.sources import projection as P

_VOID = ", ".join(f"'{v}'" for v in pages.VOID)
_TOKENS = rf"""
raw AS (SELECT page_id, regexp_extract_all(html, '{pages.TOKENS}') AS a FROM pages WHERE html <> ''),
cut AS (SELECT page_id, generate_subscripts(a, 1) - 1 AS n, unnest(a) AS token FROM raw),
named AS (SELECT *, lower(regexp_extract(token, '^</?([A-Za-z][^\s/>]*)', 1)) AS name, sum(strlen(token)) OVER (PARTITION BY page_id ORDER BY n)::BIGINT AS "end" FROM cut),
tokens AS (SELECT page_id, n, token, name, "end" - strlen(token) AS start, "end", CASE WHEN token[1] <> '<' OR token = '<' THEN 'text' WHEN regexp_matches(token, '(?i)^<(!|\?|script\b|style\b)') THEN 'hidden'
  WHEN starts_with(token, '</') THEN 'close' WHEN name IN ({_VOID}) OR ends_with(token, '/>') THEN 'void' ELSE 'open' END AS kind FROM named),
turned AS (SELECT page_id, name, n, kind, sum(CASE WHEN kind = 'open' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id, name ORDER BY n) AS depth FROM tokens WHERE kind IN ('open', 'close')),
levels AS (SELECT *, CASE WHEN kind = 'open' THEN depth ELSE depth + 1 END AS level FROM turned),
elements AS (SELECT page_id, name, n, CASE WHEN after = 'close' THEN spot END AS until, level FROM (SELECT *, lead(kind) OVER w AS after, lead(n) OVER w AS spot FROM levels WINDOW w AS (PARTITION BY page_id, name, level ORDER BY n)) u WHERE kind = 'open'),
spans AS (SELECT page_id, n, start, "end", token AS raw, trim(regexp_replace(replace(replace(replace(replace(replace(replace(token, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g')) AS text
  FROM tokens WHERE kind = 'text' AND regexp_matches(token, '[^\s]'))"""


def _tokens(spark, sf_dir):
    return pages.tokens(P.table(spark, sf_dir, "pages"))


@query(f"WITH {_TOKENS} SELECT page_id, name, n::INTEGER AS n, until::INTEGER AS until, level::BIGINT AS level FROM elements")
def page_elements(spark, sf_dir):
    """Every element of every page as an interval of tokens."""
    return pages.elements(_tokens(spark, sf_dir))


@query(f'WITH {_TOKENS} SELECT page_id, start, "end", sha256(raw) AS sha256, text FROM spans')
def page_spans(spark, sf_dir):
    """Every visible span of every page: where its bytes stand, their digest, and what a reader sees."""
    s = pages.spans(_tokens(spark, sf_dir))
    return s.select("page_id", "start", "end", F.sha2("raw", 256).alias("sha256"), "text")


@query(f"WITH {_TOKENS} SELECT e.page_id, e.name, e.n::INTEGER AS n, string_agg(s.text, ' ' ORDER BY s.n) AS text FROM elements e JOIN spans s ON s.page_id = e.page_id AND s.n > e.n AND s.n < e.until WHERE e.name IN ('title', 'h1', 'li', 'article') GROUP BY ALL")
def page_fields(spark, sf_dir):
    """Titles, headings, list items and articles of every page, by the intervals that hold their spans."""
    t = _tokens(spark, sf_dir)
    return pages.within(pages.spans(t), pages.elements(t), ["title", "h1", "li", "article"])


@query(f"""WITH {_TOKENS} SELECT page_id, count(*) AS n, count(*) FILTER (start % 5 <> 3) AS n_proved FROM spans GROUP BY 1""")
def page_proofs(spark, sf_dir):
    """Spans held against the pages' bytes: those whose claim was shifted by a byte are not proved."""
    p = P.table(spark, sf_dir, "pages")
    s = pages.spans(pages.tokens(p))
    shift = F.when(F.col("start") % 5 == 3, 1).otherwise(0)
    claimed = s.select("page_id", (F.col("start") + shift).alias("start"), (F.col("end") + shift).alias("end"), F.sha2("raw", 256).alias("sha256"))
    return pages.proved(claimed, p).groupBy("page_id").agg(F.count("*").alias("n"), F.count_if("holds").alias("n_proved"))
