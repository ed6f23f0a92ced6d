"""Readers with exact schemas: CSV and JSON, zipped or plain, nested API responses, map elements, pages and snapshots."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.facilities import wkt_point, whole
from claimlens.functions.ids import canonical, strict_decoder
from claimlens.sources.exports import name_below


def csv_exact(spark: SparkSession, path: str, header: list[str], null: str | None = None) -> DataFrame:
    """CSV whose header must be exactly `header`; all columns text, broken rows fail."""
    first = spark.read.text(path).where("length(value) > 0").first()
    got = next(csv.reader([first.value.lstrip("\ufeff")])) if first else []
    if got != list(header):
        raise ValueError(f"header is {got!r}, not {list(header)!r}")
    schema = ", ".join(f"`{c}` string" for c in header)
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"')
    return (reader.option("nullValue", null) if null is not None else reader).csv(path)


def zip_rows(spark: SparkSession, path: str, member: str, header: list[str], skip: int = 0, batch: int = 5000) -> DataFrame:
    """Rows of a CSV inside zip archives, decoded as a stream inside the task; a wrong header or checksum fails.

    skip drops rows after the header (a publisher's date row). One archive is one task's, as zip cannot be split.
    """
    names = list(header)

    def rows(archives: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in archives:
            for content in frame.content:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(member) as raw:
                    reader = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                    if next(reader, None) != names:
                        raise ValueError(f"{member} does not have the expected header")
                    for _ in range(skip):
                        next(reader, None)
                    held = []
                    for number, row in enumerate(reader, 1):
                        if len(row) != len(names):
                            raise ValueError(f"row {number} has {len(row)} cells")
                        held.append([number, *row])
                        if len(held) == batch:
                            yield pd.DataFrame(held, columns=["row_number", *names], dtype=object)
                            held = []
                    yield pd.DataFrame(held, columns=["row_number", *names], dtype=object)

    schema = "row_number long, " + ", ".join(f"`{c}` string" for c in names)
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, schema)


def zip_json_array(spark: SparkSession, path: str, member: str, schema: str, batch: int = 5000) -> DataFrame:
    """Objects of a JSON array inside zip archives, decoded one at a time; a cut or malformed array, a repeated key and anything after the array fail."""

    def rows(archives: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in archives:
            for content in frame.content:
                with zipfile.ZipFile(io.BytesIO(content)) as z, io.TextIOWrapper(z.open(member), "utf-8-sig") as raw:
                    held = []
                    for value in array_objects(raw):
                        held.append(canonical(value))
                        if len(held) == batch:
                            yield pd.DataFrame({"value": pd.Series(held, dtype=object)})
                            held = []
                    yield pd.DataFrame({"value": pd.Series(held, dtype=object)})

    text = spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "value string")
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


#: Characters of one object of a streamed array.
LONGEST_OBJECT = 1 << 28


def array_objects(raw: io.TextIOBase, size: int = 1 << 20) -> Iterator[dict]:
    """The objects of one JSON array, read from a stream a part at a time."""
    decoder, blank = strict_decoder(), re.compile(r"[ \t\r\n]*")
    text, at, wanted, more = "", 0, "[", True
    while True:
        at = blank.match(text, at).end()
        if at == len(text) and more:
            text, at = raw.read(size), 0
            more = bool(text)
            continue
        mark = text[at : at + 1]
        if wanted == "end":
            if mark:
                raise ValueError("text after the array")
            return
        if not mark:
            raise ValueError("the array is cut off")
        if wanted == "[" or (wanted == "," and mark == ","):
            if mark != wanted:
                raise ValueError("not an array")
            at, wanted = at + 1, "first" if wanted == "[" else "object"
        elif mark == "]" and wanted in ("first", ","):
            at, wanted = at + 1, "end"
        elif mark == "{" and wanted != ",":
            try:
                value, at = decoder.raw_decode(text, at)
            except json.JSONDecodeError:
                part = raw.read(size) if more and len(text) - at < LONGEST_OBJECT else ""
                if not part:
                    raise
                text, at = text[at:] + part, 0  # an object goes on in the next part
                continue
            yield value
            wanted = ","
        else:
            raise ValueError(f"{mark!r} inside an array of objects")


def jsonl_strict(spark: SparkSession, path: str, schema: str, key: str, batch: int = 5000) -> DataFrame:
    """JSON lines that must be canonical, one object a line, with the key strictly rising within each file; anything else fails.

    A file is one task's, as order is checked over all of it.
    """

    def rows(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = strict_decoder()
        for frame in files:
            for content in frame.content:
                last, held = None, []
                for number, line in enumerate(io.TextIOWrapper(io.BytesIO(content), "utf-8", newline="\n"), 1):
                    line = line.removesuffix("\n")
                    value = decoder.decode(line)
                    if not isinstance(value, dict) or canonical(value) != line:
                        raise ValueError(f"line {number} is no canonical object")
                    if last is not None and not last < value[key]:
                        raise ValueError(f"line {number}: {key} does not rise")
                    last = value[key]
                    held.append(line)
                    if len(held) == batch:
                        yield pd.DataFrame({"value": pd.Series(held, dtype=object)})
                        held = []
                yield pd.DataFrame({"value": pd.Series(held, dtype=object)})

    text = spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "value string")
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def has_code(cell: Column, codes: list[str], separator: str = ",") -> Column:
    """Whether a cell of separated codes holds one of them exactly."""
    return F.arrays_overlap(F.transform(F.split(cell, separator), lambda x: F.trim(x)), F.array(*[F.lit(c) for c in codes]))


def variants(rows: DataFrame, key: str) -> DataFrame:
    """Distinct rows grouped by key: every variant kept, repeats dropped."""
    rest = [c for c in rows.columns if c != key]
    return rows.distinct().groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("variants"))


def allowlisted(rows: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """Rows whose key is allowed; a key that repeats anywhere in the source is an error."""
    twice = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{key} {twice[0][0]!r} repeats")
    return rows.join(allowed.select(key).distinct(), key, "left_semi")


LEI = """data array<struct<type:string,id:string,attributes:struct<lei:string,
  entity:struct<legalName:struct<name:string,language:string>,jurisdiction:string,category:string,status:string,registeredAs:string,
    legalAddress:struct<country:string,city:string,postalCode:string>,headquartersAddress:struct<country:string,city:string,postalCode:string>>,
  registration:struct<status:string,initialRegistrationDate:string,lastUpdateDate:string>>>>"""


def lei_records(responses: DataFrame, column: str = "value") -> DataFrame:
    """Entities of JSON:API responses; resource id and attribute must agree."""
    r = responses.select(F.from_json(column, LEI, {"mode": "FAILFAST"}).alias("r")).select(F.explode("r.data").alias("d"))
    rows = r.select(F.col("d.id").alias("lei"), F.col("d.attributes.lei").alias("own"), "d.type", F.col("d.attributes.entity").alias("entity"), F.col("d.attributes.registration").alias("registration"))
    sound = (F.col("lei") == F.col("own")) & (F.col("type") == "lei-records") & whole(F.col("lei"), "[A-Z0-9]{18}[0-9]{2}")
    return rows.withColumn("lei", F.when(sound, F.col("lei")).otherwise(F.raise_error(F.lit("identifier and resource disagree")))).drop("own", "type")


ELEMENTS = "elements array<struct<type:string,id:long,lat:double,lon:double,timestamp:string,center:struct<lat:double,lon:double>,geometry:array<struct<lat:double,lon:double>>,tags:map<string,string>>>"


def map_elements(responses: DataFrame, column: str = "value") -> DataFrame:
    """Nodes, ways and relations with a point: a node's own, else the centre, else the middle of its bounds."""
    e = responses.select(F.from_json(column, ELEMENTS, {"mode": "FAILFAST"}).alias("r")).select(F.explode("r.elements").alias("e"))
    mid = lambda f: (F.array_min(F.transform("e.geometry", lambda g: g[f])) + F.array_max(F.transform("e.geometry", lambda g: g[f]))) / 2
    lat = F.coalesce(F.when(F.col("e.type") == "node", F.col("e.lat")), F.col("e.center.lat"), mid("lat"))
    lon = F.coalesce(F.when(F.col("e.type") == "node", F.col("e.lon")), F.col("e.center.lon"), mid("lon"))
    closed = (F.size("e.geometry") >= 4) & (F.col("e.geometry")[0] == F.element_at("e.geometry", -1))
    kind = F.when(F.col("e.type") == "node", "Point").when(closed, "Polygon").when(F.size("e.geometry") > 0, "LineString")
    sound = F.col("e.type").isin("node", "way", "relation") & F.col("e.id").isNotNull()
    return e.where(sound).select(F.col("e.type").alias("element_type"), F.col("e.id").alias("element_id"), lat.alias("lat"), lon.alias("lon"), kind.alias("geometry_type"), F.coalesce("e.tags", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("tags"), F.col("e.timestamp").alias("published"))


BINDINGS = "results struct<bindings:array<map<string,struct<value:string>>>>"


def sparql_points(responses: DataFrame, column: str = "value") -> DataFrame:
    """Rows of SPARQL JSON with a WKT point."""
    b = responses.select(F.from_json(column, BINDINGS, {"mode": "FAILFAST"}).alias("r")).select(F.explode("r.results.bindings").alias("b"))
    cell = lambda k: F.try_element_at(F.col("b"), F.lit(k))["value"]
    lon, lat = wkt_point(cell("coord"))
    item = F.substring_index(cell("item"), "/", -1)
    return b.select(item.alias("item"), F.coalesce(cell("label"), item).alias("name"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"), cell("country").alias("country"), F.substring(cell("inception"), 1, 10).alias("inception")).where("lon is not null")


def curated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record a file; its id must be the file's name."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path).withColumn("stem", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    return rows.withColumn("id", F.when(F.col("id") == F.col("stem"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("file name and id differ: "), "stem")))).drop("stem")


def verify_snapshot(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """(name, problem): files of a snapshot that a manifest (name, bytes, sha256) lacks or contradicts; empty when sound."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(name_below(root).alias("name"), F.col("length").alias("got_bytes"), F.sha2("content", 256).alias("got"))
    both = manifest.join(files, "name", "full_outer")
    problem = F.when(F.col("got").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(F.col("bytes") != F.col("got_bytes"), "size").when(F.col("sha256") != F.col("got"), "digest")
    return both.select("name", problem.alias("problem")).where("problem is not null")


def claim_index(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Claims of a JSON-lines release that are asked for, one row an id, with the number of rows it had."""
    rows = spark.read.schema("id string, subject_entity_id string, predicate string, value string").json(path)
    return rows.join(wanted.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min(F.struct("subject_entity_id", "predicate", "value")).alias("claim"), F.count("*").alias("copies"))


def industrial_candidates(facilities: DataFrame, sites: DataFrame, prefix: str, terms: list[str]) -> DataFrame:
    """Facilities by activity-code prefix, by a name term, or by their parent site's name term, with the reasons; confidential names are withheld."""
    named = lambda c: F.exists(F.array(*[F.lit(f" {t} ") for t in terms]), lambda t: F.concat(F.lit(" "), F.lower(c), F.lit(" ")).contains(t))
    joined = facilities.join(sites.select(F.col("site_id"), F.col("site_name")), "site_id", "left")
    reasons = F.array_compact(F.array(F.when(F.col("code").startswith(prefix), "activity_code"), F.when(named(F.col("name")), "facility_name"), F.when(named(F.col("site_name")), "site_name")))
    secret = F.coalesce("confidential", F.lit(False))
    return joined.withColumn("reasons", reasons).where(F.size("reasons") > 0).withColumn("name", F.when(~secret, F.col("name"))).withColumn("redacted", secret)
