"""Curated nested records and capture ledgers: child tables, headline picks, tallies, checks and inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.clocks import partial_date


def child(records: DataFrame, column: str, ident: str = "id") -> DataFrame:
    """One row per element of an array of structs, with the record's id and the element's place."""
    rows = records.select(F.col(ident).alias("record_id"), F.posexplode(column).alias("place", "x"))
    return rows.select("record_id", "place", "x.*")


def source_urls(records: DataFrame) -> DataFrame:
    """Records with a map from source id to url."""
    return records.withColumn("urls", F.map_from_entries(F.transform("sources", lambda s: F.struct(s["id"], s["url"]))))


def headline_investment(metrics: DataFrame) -> DataFrame:
    """The latest whole-facility investment of each record; dollars preferred; null when figures still differ."""
    start = partial_date(F.col("as_of"))[0]
    own = metrics.where((F.col("metric") == "investment") & F.col("applies_to").isin("facility", "project")).withColumn("start", start)
    top = Window.partitionBy("record_id")
    latest = own.withColumn("r", F.rank().over(top.orderBy(F.col("start").desc()))).where("r = 1")
    usd = latest.withColumn("any_usd", F.max((F.col("unit") == "USD").cast("int")).over(top)).where((F.col("unit") == "USD") | (F.col("any_usd") == 0))
    figure = F.struct("unit", "value", "value_max", "qualifier")
    return usd.groupBy("record_id").agg(F.when(F.size(F.collect_set(figure)) == 1, F.min(figure)).alias("f")).select("record_id", "f.*")


def production_target(milestones: DataFrame, sources: DataFrame, events: list[str]) -> DataFrame:
    """Planned production date by the newest source that states one; several of one source: the earliest."""
    planned = milestones.where(F.col("event").isin(*events) & F.col("planned"))
    cited = planned.select("record_id", "date", F.explode_outer("source_ids").alias("source_id"))
    dated = cited.join(sources.select("record_id", F.col("id").alias("source_id"), partial_date(F.col("published"))[1].alias("published")), ["record_id", "source_id"], "left")
    newest = dated.groupBy("record_id", "date").agg(F.coalesce(F.max("published"), F.lit("0001-01-01").cast("date")).alias("newest"))
    order = Window.partitionBy("record_id").orderBy(F.col("newest").desc(), partial_date(F.col("date"))[0], "date")
    return newest.withColumn("r", F.row_number().over(order)).where("r = 1").select("record_id", F.col("date").alias("target"))


def tallies(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, label, n) ordered by descending count, then label."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("label")) for c in columns]))
    return rows.select(pairs.alias("p")).groupBy("p.field", "p.label").agg(F.count("*").alias("n")).orderBy("field", F.col("n").desc(), "label")


def broken_links(records: DataFrame, inverse: dict[str, str]) -> DataFrame:
    """Related links without their inverse, or to an unknown record. records: id, related array<struct<id, relation>>."""
    links = records.select("id", F.inline("related").alias("other", "relation"))
    turned = F.coalesce(*[F.when(F.col("relation") == k, F.lit(v)) for k, v in inverse.items()])
    back = links.select(F.col("other").alias("id"), F.col("id").alias("other"), F.col("relation").alias("wanted"))
    known = records.select(F.col("id").alias("other"), F.lit(True).alias("known"))
    out = links.withColumn("wanted", turned).join(known, "other", "left").join(back.withColumn("back", F.lit(True)), ["id", "other", "wanted"], "left")
    return out.where("known is null or back is null").select("id", "other", "relation", F.when(F.col("known").isNull(), "unknown").otherwise("no_inverse").alias("problem"))


def document_change(current: Column, prior: Column, current_text: Column, prior_text: Column) -> Column:
    """first, unchanged, raw_bytes_only or visible_text_changed, from the digests of bytes and of visible text."""
    return F.when(prior.isNull(), "first").when(current == prior, "unchanged").when(current_text.eqNullSafe(prior_text), "raw_bytes_only").otherwise("visible_text_changed")


def check_health(observations: DataFrame, eligible: list[str], now: int, seconds: int) -> DataFrame:
    """Freshness and health of each document. observations: document_id, us, status, text_sha256; ties on the latest clock count."""
    good = F.col("status").isin(*eligible)
    last = observations.groupBy("document_id").agg(F.max("us").alias("last_us"), F.max(F.when(good, F.col("us"))).alias("good_us"), F.count("*").alias("checks"))
    both = observations.join(last, "document_id")
    got = both.groupBy("document_id", "last_us", "good_us", "checks").agg(F.count_if((F.col("us") == F.col("last_us")) & ~good).alias("bad"), F.countDistinct(F.when(good & (F.col("us") == F.col("good_us")), F.col("text_sha256"))).alias("versions"))
    age = (F.lit(now) - F.col("good_us")) / 1e6
    fresh = F.when(F.col("good_us").isNull(), "never_observed").when(age >= seconds, "stale").otherwise("fresh")
    health = F.when(F.col("bad") > 0, "requires_attention").when(F.col("versions") > 1, "conflicting_observations").otherwise("ok")
    return got.select("document_id", "checks", fresh.alias("freshness"), health.alias("health"))


def inventory(captures: DataFrame) -> DataFrame:
    """First and last observation of each url with the sorted union of what it matched."""
    return captures.groupBy("url").agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("matches")))).alias("matches"))


def vintages(before: DataFrame, after: DataFrame, key: str = "url") -> DataFrame:
    """(key, presence): in both vintages, or only in one."""
    a, b = before.select(key, F.lit(True).alias("a")).distinct(), after.select(key, F.lit(True).alias("b")).distinct()
    return a.join(b, key, "full_outer").select(key, F.when(F.col("a").isNull(), "only_after").when(F.col("b").isNull(), "only_before").otherwise("both").alias("presence"))


def journal(deadlines: DataFrame, records: DataFrame) -> DataFrame:
    """Each case's recording: on_time, late or missing. deadlines: case_id, due_us; records: case_id, recorded_us."""
    first = records.groupBy("case_id").agg(F.min("recorded_us").alias("first_us"))
    both = deadlines.join(first, "case_id", "left")
    return both.select("case_id", "first_us", F.when(F.col("first_us").isNull(), "missing").when(F.col("first_us") <= F.col("due_us"), "on_time").otherwise("late").alias("recording"))


def repeats(rows: DataFrame, group: str, statement: str) -> DataFrame:
    """Statements of each group: all, distinct, and repeated beyond the first."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.countDistinct(statement).alias("distinct")).withColumn("repeated", F.col("n") - F.col("distinct"))


def roster_score(rows: DataFrame) -> DataFrame:
    """Denominators of a roster by disposition. rows: project, disposition, classification, target_met."""
    met = F.col("target_met")
    return rows.groupBy("disposition").agg(F.count("*").alias("cases"), F.countDistinct("project").alias("projects"), F.count_if(met).alias("met"), F.count_if(~met).alias("missed"), F.count_if(met.isNull()).alias("unresolved"))


def replace_outcomes(base: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """Base rows with the outcome of an overlay where it has one."""
    new = overlay.select(key, F.col("outcome").alias("__new"), F.lit(True).alias("__has"))
    return base.join(new, key, "left").withColumn("outcome", F.when(F.col("__has"), F.col("__new")).otherwise(F.col("outcome"))).drop("__new", "__has")


def contract_errors(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the names of the rules they break; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]))
    return rows.withColumn("errors", broken).where(F.size("errors") > 0)
