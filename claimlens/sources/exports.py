"""Sinks: escaped CSV, canonical JSON lines, GeoJSON, Parquet, release folders with manifests, data descriptors."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.ids import canonical_json, tree_digest
from claimlens.functions.text import safe_cell
from claimlens.plans.staging import Staging


def write_csv(df: DataFrame, path: str) -> None:
    """CSV whose text cells no spreadsheet reads as formulas; lists are joined by '; '."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "; ")
        elif isinstance(f.dataType, T.StructType | T.MapType):
            c = F.to_json(c)
        cols.append((safe_cell(c) if isinstance(f.dataType, T.StringType | T.ArrayType | T.StructType | T.MapType) else c).alias(f.name))
    df.select(*cols).write.mode("errorifexists").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


def json_lines(df: DataFrame) -> DataFrame:
    """One canonical JSON text a row: sorted keys, nulls kept."""
    return df.select(canonical_json()(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("value"))


def write_jsonl(df: DataFrame, path: str) -> None:
    json_lines(df).write.mode("errorifexists").text(path)


def features(df: DataFrame, ident: str, lon: str, lat: str) -> DataFrame:
    """GeoJSON features, one a row; rows without a point have null geometry."""
    point = F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, 6), F.round(lat, 6)).alias("coordinates")))
    rest = [c for c in df.columns if c not in (lon, lat)]
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.col(ident).alias("id"), point.alias("geometry"), F.struct(*rest).alias("properties")), {"ignoreNullFields": "false"}).alias("value"))


def write_geojson(df: DataFrame, path: str, ident: str, lon: str, lat: str) -> None:
    """Newline-delimited features, so that a collection of any size needs no gathering."""
    features(df, ident, lon, lat).write.mode("errorifexists").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def descriptor(tables: dict[str, DataFrame]) -> str:
    """A data package descriptor derived from schemas."""
    kind = {"bigint": "integer", "int": "integer", "double": "number", "boolean": "boolean", "date": "date", "timestamp": "datetime"}
    resources = [{"name": n, "schema": {"fields": [{"name": c, "type": kind.get(t, "string")} for c, t in df.dtypes]}} for n, df in sorted(tables.items())]
    return json.dumps({"profile": "tabular-data-package", "resources": resources}, sort_keys=True)


def name_below(root: str) -> Column:
    """The name of a file below a folder, with the folders between them, so that equal names in two folders stay apart."""
    plain = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return F.when(plain.startswith(base + "/"), F.substring(plain, F.lit(len(base) + 2), F.length(plain))).otherwise(F.substring_index("path", "/", -1))


def resources(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha256) of every file below a folder, as a data package and verify_snapshot name them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(name_below(path).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_checked_release(tables: dict[str, DataFrame], rules: dict[str, Callable], views: dict[str, Callable], path: str, meta: dict[str, str], staging: Staging) -> DataFrame:
    """A release all of whose views are of one state of the store, written only if that state breaks no rule.

    tables are pinned first: each is written once to the shared folder, so later writers and lost executors change
    nothing. rules and views are functions of the pinned tables; a rule gives the rows that break it, and may ask for
    views too, by name, as they are pinned before it is tested. Every broken rule is told with its count and an example,
    and nothing is installed. The manifest holds the digests of the tables' rows beside those of the views.
    """
    pinned = {name: staging.table(df, name) for name, df in sorted(tables.items())}
    for name, view in views.items():  # a view may read those before it
        pinned[name] = staging.table(view(pinned), name)
    broken = []
    for name, rule in sorted(rules.items()):
        rows = staging.table(rule(pinned), "broken")
        if n := rows.count():
            broken.append(f"{name}: {n} rows, such as {rows.orderBy(*rows.columns).first().asDict()}")
        staging.drop(rows)
    if broken:
        raise ValueError("no release: " + "; ".join(broken))
    digests = {f"table {name}": tree_digest(pinned[name].select(F.to_json(F.struct("*")).alias("value")), F.col("value")).first().digest for name in sorted(tables)}
    return write_release({name: pinned[name] for name in views}, path, meta | digests)


def write_release(views: dict[str, DataFrame], path: str, meta: dict[str, str]) -> DataFrame:
    """Write each view as canonical JSON lines under a staging name, then the manifest; install by one rename.

    The manifest (view, rows, digest) holds a tree of SHA-256 digests of the rows, whatever their order, so equal views
    give equal manifests; verify_release computes it again.
    """
    spark = next(iter(views.values())).sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(path)
    stage = path.rstrip("/") + ".staging"
    fs.delete(jvm.org.apache.hadoop.fs.Path(stage), True)
    rows = []
    for name, df in sorted(views.items()):
        write_jsonl(df, f"{stage}/{name}")
        got = tree_digest(spark.read.text(f"{stage}/{name}"), F.col("value")).first()
        rows.append((name, got.rows, got.digest))
    manifest = spark.createDataFrame(rows, "view string, rows long, digest string")
    for k, v in sorted(meta.items()):
        manifest = manifest.withColumn(k, F.lit(v))
    write_jsonl(manifest.coalesce(1), f"{stage}/manifest")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(stage), target):
        raise OSError(f"could not install {path}")
    return manifest


def verify_release(spark: SparkSession, path: str) -> DataFrame:
    """(view, problem): views of a written release whose rows or digest are not what its manifest says; empty when sound."""
    told = spark.read.schema("view string, rows long, digest string").json(f"{path}/manifest").collect()  # one row a view
    wrong = []
    for r in told:
        got = tree_digest(spark.read.text(f"{path}/{r.view}"), F.col("value")).first()
        if (got.rows, got.digest) != (r["rows"], r.digest):
            wrong.append((r.view, "rows" if got.rows != r["rows"] else "digest"))
    return spark.createDataFrame(wrong, "view string, problem string")
