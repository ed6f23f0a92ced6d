"""Readers, sinks, expressions and streams."""

import hashlib
import io
import json
import unicodedata
import uuid
import zipfile

import pytest
from claimlens.functions import clocks, facilities, ids, text
from claimlens.plans.staging import Staging
from claimlens.sources import exports, readers
from claimlens.streaming import queues
from pyspark.sql import functions as F


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_clocks(spark):
    assert one(spark, clocks.clock_us(F.lit("2026-09-08T12:35:20.817388-07:00"))) == 1788896120817388
    assert one(spark, clocks.clock_us(F.lit("2026-09-08T12:35:20"))) is None and one(spark, clocks.clock_us(F.lit("junkZ"))) is None
    assert one(spark, clocks.iso_utc(F.lit(1000000))) == "1970-01-01T00:00:01Z" and one(spark, clocks.iso_utc(F.lit(1000001))) == "1970-01-01T00:00:01.000001Z"
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, clocks.is_calendar_quarter(d("2024-04-01"), d("2024-07-01"))) and not one(spark, clocks.is_calendar_quarter(d("2024-04-02"), d("2024-07-01")))
    assert one(spark, clocks.partial_date(F.lit("2024-02-30"))[2]) is None
    assert str(one(spark, clocks.partial_date(F.lit("2024-H2"))[1])) == "2024-12-31"
    assert one(spark, clocks.published_by(F.lit("2024-01-02"), F.lit("2024-01-02 23:00:00").cast("timestamp")))


def test_ids(spark):
    ns = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    for name in ["plain", 'quote" back\\slash', "tab\t中"]:
        assert one(spark, ids.uuid5(ns, F.lit(name))) == str(uuid.uuid5(uuid.UUID(ns), name))
    c = ids.canonical_json()
    rows = spark.createDataFrame([('{"b":1,"a":null}',), ('{"a":1,"a":2}',), ("NaN",), ("[1,",), (None,)], "t string").select(c("t").alias("c")).collect()
    assert [r.c for r in rows] == ['{"a":null,"b":1}', None, None, None, None]


def test_text(spark):
    cells = spark.createDataFrame([(x,) for x in ["=1", " +1", "\tx", "a=b", "", None, "@x"]], "t string").select(text.safe_cell(F.col("t")).alias("c")).collect()
    assert [r.c for r in cells] == ["'=1", "' +1", "'\tx", "a=b", "", None, "'@x"]
    assert text.fold("STRASSE") == text.fold("Straße") and text.fold(unicodedata.normalize("NFD", "É")) == text.fold("é")
    assert text.visible("<p>a<script>b</script> <b>c</b>&amp;d</p><style>x</style>") == "a c &d"
    assert one(spark, text.segments_in_order(F.array(F.lit("ab"), F.lit("ab")), F.lit("xab abz"))) and not one(spark, text.segments_in_order(F.array(F.lit("z"), F.lit("a")), F.lit("az")))
    assert one(spark, text.amounts(F.lit("paid $1.5 billion and $20"))) == [1.5e9, 20.0]
    assert one(spark, facilities.wafer_sizes(F.lit("200-mm and 300mm and 200 mm"))) == [200, 300]
    assert one(spark, facilities.cleanroom_sqft(F.lit("with 12,500 square feet of cleanroom"))) == 12500


def archive(path, member, raw):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, raw)


def test_zipped_sources(spark, tmp_path):
    archive(tmp_path / "a.zip", "m.csv", "﻿id,name\n01-JAN-24,\n1,\"x, y\"\n2,\"line\nbreak\"\n".encode())
    rows = readers.zip_rows(spark, str(tmp_path / "a.zip"), "m.csv", ["id", "name"], skip=1, batch=1).collect()
    assert [(r.row_number, r.id, r.name) for r in rows] == [(1, "1", "x, y"), (2, "2", "line\nbreak")]
    with pytest.raises(Exception, match="expected header"):
        readers.zip_rows(spark, str(tmp_path / "a.zip"), "m.csv", ["id"]).collect()
    archive(tmp_path / "b.zip", "m.json", json.dumps([{"k": str(i), "v": "é" * 40} for i in range(30_000)]))
    assert readers.zip_json_array(spark, str(tmp_path / "b.zip"), "m.json", "k string, v string").agg(F.countDistinct("k")).first()[0] == 30_000


def test_csv_and_curated(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n')
    assert readers.csv_exact(spark, str(tmp_path / "t.csv"), ["a", "b"]).collect()[0].b == "x\ny"
    with pytest.raises(ValueError):
        readers.csv_exact(spark, str(tmp_path / "t.csv"), ["a", "c"])
    (tmp_path / "rec").mkdir()
    (tmp_path / "rec" / "one.json").write_text('{"id":"one","v":1}')
    assert readers.curated(spark, str(tmp_path / "rec"), "id string, v int").collect()[0].v == 1
    (tmp_path / "rec" / "two.json").write_text('{"id":"other","v":1}')
    with pytest.raises(Exception, match="differ"):
        readers.curated(spark, str(tmp_path / "rec"), "id string, v int").collect()


def test_nested_responses(spark):
    lei = "5493001KJTIIGC8Y1R12"
    body = {"data": [{"type": "lei-records", "id": lei, "attributes": {"lei": lei, "entity": {"legalName": {"name": "N"}}}}]}
    assert readers.lei_records(spark.createDataFrame([(json.dumps(body),)], "value string")).first().entity.legalName.name == "N"
    body["data"][0]["attributes"]["lei"] = "x"
    with pytest.raises(Exception, match="disagree"):
        readers.lei_records(spark.createDataFrame([(json.dumps(body),)], "value string")).collect()
    osm = {"elements": [{"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"a": "b"}}, {"type": "way", "id": 2, "geometry": [{"lat": 0.0, "lon": 0.0}, {"lat": 4.0, "lon": 2.0}]}, {"type": "area", "id": 3}]}
    rows = readers.map_elements(spark.createDataFrame([(json.dumps(osm),)], "value string")).collect()
    assert [(r.element_id, r.lat, r.lon, r.geometry_type) for r in rows] == [(1, 1.0, 2.0, "Point"), (2, 2.0, 1.0, "LineString")]
    sparql = {"results": {"bindings": [{"item": {"value": "http://x/Q7"}, "coord": {"value": "Point(1.5 -2.25)"}}, {"item": {"value": "http://x/Q8"}}]}}
    rows = readers.sparql_points(spark.createDataFrame([(json.dumps(sparql),)], "value string")).collect()
    assert [(r.item, r.name, r.lon, r.lat) for r in rows] == [("Q7", "Q7", 1.5, -2.25)]


def test_snapshots_and_allowlists(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a").write_bytes(b"abc")
    (tmp_path / "s" / "b").write_bytes(b"abc")
    sha = hashlib.sha256(b"abc").hexdigest()
    m = spark.createDataFrame([("a", 3, sha), ("c", 1, sha)], "name string, bytes long, sha256 string")
    assert {(r.name, r.problem) for r in readers.verify_snapshot(spark, str(tmp_path / "s"), m).collect()} == {("b", "unlisted"), ("c", "missing")}
    rows, allowed = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2,)], "k int")
    assert [r.v for r in readers.allowlisted(rows, "k", allowed).collect()] == ["y"]
    with pytest.raises(ValueError):
        readers.allowlisted(rows.unionByName(rows), "k", allowed)
    f = spark.createDataFrame([(1, 1, "26.11", "Acme", False), (2, 1, "10", "Chip Works", True), (3, 2, "10", "Bakery", None)], "id int, site_id int, code string, name string, confidential boolean")
    s = spark.createDataFrame([(1, "Park"), (2, "Chip Park")], "site_id int, site_name string")
    got = {r.id: (r.name, r.reasons) for r in readers.industrial_candidates(f, s, "26.1", ["chip"]).collect()}
    assert got == {1: ("Acme", ["activity_code"]), 2: (None, ["facility_name"]), 3: ("Bakery", ["site_name"])}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("=x", ["b", "a"], None)], "t string, l array<string>, n int")
    exports.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().t == "'=x"
    m = exports.write_release({"one": df, "two": df.where("false")}, str(tmp_path / "r"), {"as_of": "2024-01-15"})
    assert {(r["view"], r["rows"]) for r in m.collect()} == {("one", 1), ("two", 0)}
    assert json.loads(spark.read.text(str(tmp_path / "r" / "one")).first().value) == {"t": "=x", "l": ["b", "a"], "n": None}
    with pytest.raises(FileExistsError):
        exports.write_release({"one": df}, str(tmp_path / "r"), {})
    exports.write_parquet(df, str(tmp_path / "p"))
    exports.write_geojson(spark.createDataFrame([(1, None, 2.0)], "id int, lon double, lat double"), str(tmp_path / "g"), "id", "lon", "lat")
    assert json.loads(spark.read.text(str(tmp_path / "g")).first().value)["geometry"] is None
    assert json.loads(exports.descriptor({"t": df}))["resources"][0]["schema"]["fields"][2]["type"] == "integer"
    assert readers.verify_snapshot and exports.verify_release(spark, str(tmp_path / "r")).count() == 0
    part = next(p for p in (tmp_path / "r" / "one").glob("part-*") if p.stat().st_size)
    part.with_name(f".{part.name}.crc").unlink()
    part.write_text('{"t":"=y","l":["b","a"],"n":null}\n')
    assert [tuple(r) for r in exports.verify_release(spark, str(tmp_path / "r")).collect()] == [("one", "digest")]


@pytest.mark.parametrize(
    ("text", "problem"),
    [('[{"a":1},{"a":2}', "cut off"), ('[{"a":1,"a":2}]', "repeated"), ('[{"a":1}] x', "after the array"), ('{"a":1}', "not an array"), ('[{"a":1} {"a":2}]', "inside an array"), ('[{"a":1},]', "inside an array"), ("[1]", "inside an array"), ('[{"a":NaN}]', "no JSON number"), ('[{"a":', ""), ("", "cut off")],
)
def test_malformed_arrays_are_refused(text, problem):
    for size in (1, 3, 1 << 20):
        with pytest.raises(ValueError, match=problem):
            list(readers.array_objects(io.StringIO(text), size))


def test_arrays_in_parts():
    rows = [{"k": i, "v": "é}]" * (i % 5)} for i in range(40)]
    for text in (json.dumps(rows), json.dumps(rows, indent=2) + "\n", "[]", " [ ] "):
        for size in (1, 7, 1 << 20):
            assert list(readers.array_objects(io.StringIO(text), size)) == json.loads(text)


def test_malformed_responses_fail(spark):
    for read in (readers.map_elements, readers.sparql_points):
        with pytest.raises(Exception, match="(?i)malformed"):
            read(spark.createDataFrame([("{broken",)], "value string")).collect()


def test_strict_lines_and_resources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"a","n":1}\n{"id":"b","n":2}\n')
    assert [r.id for r in readers.jsonl_strict(spark, str(tmp_path / "a.jsonl"), "id string, n int", "id").collect()] == ["a", "b"]
    for n, (bad, problem) in enumerate([('{"id":"b"}\n{"id":"a"}\n', "does not rise"), ('{"id":"a"}\n{"id":"a"}\n', "does not rise"), ('{"n":1, "id":"a"}\n', "no canonical"), ('{"id":"a","id":"b"}\n', "repeated"), ("[1]\n", "no canonical")]):
        (tmp_path / f"{n}.bad").write_text(bad)
        with pytest.raises(Exception, match=problem):
            readers.jsonl_strict(spark, str(tmp_path / f"{n}.bad"), "id string", "id").collect()
    listed = exports.resources(spark, str(tmp_path / "a.jsonl"))
    assert readers.verify_snapshot(spark, str(tmp_path / "a.jsonl"), listed).count() == 0 and listed.first()["bytes"] == 34


def test_equal_names_in_two_folders_stay_apart(spark, tmp_path):
    for folder, content in (("x", b"one"), ("y", b"two")):
        (tmp_path / "s" / folder).mkdir(parents=True)
        (tmp_path / "s" / folder / "same").write_bytes(content)
    listed = exports.resources(spark, str(tmp_path / "s"))
    assert {r.name: r.sha256 for r in listed.collect()} == {"x/same": hashlib.sha256(b"one").hexdigest(), "y/same": hashlib.sha256(b"two").hexdigest()}
    manifest = spark.createDataFrame([tuple(r) for r in listed.collect()], listed.schema)
    assert readers.verify_snapshot(spark, str(tmp_path / "s"), manifest).count() == 0
    (tmp_path / "s" / "y" / "same").write_bytes(b"six")
    assert [tuple(r) for r in readers.verify_snapshot(spark, f"file:{tmp_path}/s", manifest).collect()] == [("y/same", "digest")]


def test_a_release_is_of_one_sound_state(spark, tmp_path):
    source = str(tmp_path / "claims")
    spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, 9, "c")], "id long, us long, v string").write.parquet(source)
    links = spark.createDataFrame([(1, "d"), (2, "e"), (7, "f")], "id long, doc string")
    tables = lambda: {"claims": spark.read.parquet(source), "links": links.where("id < 5")}

    def current(t):
        spark.createDataFrame([(4, 4, "late")], "id long, us long, v string").write.mode("append").parquet(source)  # a writer in between
        return t["claims"].where("us <= 6")

    views = {"current": current, "evidence": lambda t: t["links"].join(t["current"], "id", "left_semi"), "history": lambda t: t["claims"]}
    rules = {"evidence without a claim": lambda t: t["links"].join(t["claims"], "id", "left_anti"), "a current claim lacks evidence": lambda t: t["current"].join(t["evidence"], "id", "left_anti")}
    out = str(tmp_path / "r")
    m = exports.write_checked_release(tables(), rules, views, out, {"as_of": "x"}, Staging(spark, "release"))
    assert {(r["view"], r["rows"]) for r in m.collect()} == {("current", 2), ("evidence", 2), ("history", 3)} and "table claims" in m.columns
    assert exports.verify_release(spark, out).count() == 0
    with pytest.raises(ValueError, match="evidence without a claim: 1 rows, such as {'id': 7, 'doc': 'f'}"):
        exports.write_checked_release(tables() | {"links": links}, rules, {"history": lambda t: t["claims"], "current": lambda t: t["claims"], "evidence": lambda t: t["links"]}, str(tmp_path / "no"), {}, Staging(spark, "release"))
    assert not (tmp_path / "no").exists() and not (tmp_path / "no.staging").exists()


def test_explicit_semiconductor(spark):
    tags = lambda **t: F.create_map(*[F.lit(x) for kv in {"name": "n", **{k.replace("__", ":"): v for k, v in t.items()}}.items() for x in kv])
    yes = [tags(industrial="Semiconductor"), tags(factory="x;semiconductor"), tags(proposed__industrial="integrated circuit"), tags(product="Silicon-Wafer", landuse="industrial"), tags(product="microchips", factory="yes"), tags(product="photomask", building="factory")]
    no = [tags(industrial="semiconductor", amenity="parking"), tags(product="microchip"), tags(product="bread", man_made="works"), tags(factory="semiconductors"), tags(landuse="industrial")]
    assert all(one(spark, facilities.explicit_semiconductor(t)) for t in yes) and not any(one(spark, facilities.explicit_semiconductor(t)) for t in no)
    assert one(spark, facilities.any_flag(F.lit(""), F.lit(None), F.lit("1"))) and not one(spark, facilities.any_flag(F.lit("0"), F.lit(None)))


def test_line_ends_and_small_clocks(spark):
    assert one(spark, clocks.partial_date(F.lit("2024\n"))[2]) is None and one(spark, clocks.clock_us(F.lit("2024-01-01T00:00:00Z\n"))) is None
    assert one(spark, facilities.registration_number(F.lit("ABCD1234\n"))) is None
    assert str(one(spark, clocks.publisher_date(F.lit("05-MAR-24")))) == "2024-03-05"
    assert [one(spark, clocks.publisher_date(F.lit(x))) for x in ("31-FEB-24", "05-Mar-24", "5-MAR-24", "05-MAR-24\n")] == [None] * 4
    assert str(one(spark, clocks.local_day(F.lit(1704067199000000), 8))) == "2024-01-01"
    got = [tuple(map(str, spark.range(1).select(*clocks.literal_period(F.lit(x))).first())) for x in ("2027", "first half of 2027", "second half of 2027", "third half of 2027")]
    assert got == [("2027-01-01", "2027-12-31"), ("2027-01-01", "2027-06-30"), ("2027-07-01", "2027-12-31"), ("None", "None")]
    assert text.name_words("Ａcme–Chip, GmbH") == "acme chip gmbh"


def test_capacity_units_and_past_rates(spark):
    relative = lambda u, m: one(spark, facilities.relative_capacity(F.lit(u), F.lit(m)))
    assert all(relative(u, "output") for u in ("pct", "fraction", "index", "Percentage  Point", "x")) and all(relative("wafers", m) for m in ("a fold", "relative yield"))
    assert not relative("wafers", "output") and not relative(None, None) and relative("", "increase of output") and not relative("wafers", "increase of output")
    assert one(spark, facilities.throughput(F.lit("In 2019 it made 20,000 wafers per week and 5 panels per day. It made 7 wafers per month."))) == []
    got = one(spark, facilities.throughput(F.lit("A fab is expected to produce up to 20,000 wafers per month\nIt would offer a capacity of 1.5 million chips every year")))
    assert [tuple(r) for r in got] == [(20000.0, "wafers", "month"), (1500000.0, "chips", "year")]


def events(spark):
    rows = [(q, s, s * 10, "decided" if s % 3 == 2 else "observed", json.dumps({"version": str((q + s) % 2), "action": "resolved"})) for q in range(5) for s in range(9)]
    return spark.createDataFrame(rows, queues.EVENT)


def test_appends_are_guarded(spark):
    log = queues.chain(events(spark))
    assert queues.violations(log).count() == 0
    head = {r.queue: r.event_id for r in log.where("sequence = 8").collect()}
    new = spark.createDataFrame([(0, 90, "observed", "{}", head[0]), (1, 90, "observed", "{}", "stale"), (2, 1, "observed", "{}", head[2]), (77, 0, "observed", "{}", None)], "queue long, recorded_us long, kind string, payload string, expected_event_id string")
    taken, refused = queues.append(log, new)
    assert sorted(r.queue for r in taken.collect()) == [0, 77] and sorted(r.queue for r in refused.collect()) == [1, 2]
    assert queues.violations(log.unionByName(taken.select(log.columns))).count() == 0
    rivals = spark.createDataFrame([(0, 95, "observed", '{"b":1}', head[0]), (0, 90, "observed", '{"a":1}', head[0]), (0, 95, "observed", '{"a":1}', head[0]), (78, 5, "observed", "{}", None), (78, 5, "observed", "{}", None)], new.schema)
    taken, refused = queues.append(log, rivals)
    assert [(r.queue, r.sequence, r.recorded_us) for r in taken.orderBy("queue").collect()] == [(0, 9, 90), (78, queues.FIRST, 5)] and refused.count() == 3
    assert queues.violations(log.unionByName(taken.select(log.columns))).count() == 0


def test_appended_queues_fold_as_streams(spark, tmp_path):
    log, at = spark.createDataFrame([], queues.CHAINED), {}
    for n in range(3):
        new = spark.createDataFrame([(5, n * 10, "observed", json.dumps({"version": "v"}), at.get(5))], "queue long, recorded_us long, kind string, payload string, expected_event_id string")
        taken, _ = queues.append(log, new)
        rows = taken.select(log.columns).collect()
        at[5] = rows[0].event_id
        log = log.unionByName(spark.createDataFrame(rows, queues.CHAINED))
    log.select("queue", "sequence", "recorded_us", "kind", "payload").coalesce(1).write.parquet(str(tmp_path / "in"))
    q = queues.fold_stream(spark.readStream.schema(queues.EVENT).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("f").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("f").collect())) == sorted(map(tuple, queues.fold(log).collect())) != []


def test_stream_equals_batch_whatever_the_order(spark, tmp_path):
    all_ = events(spark)
    for n in range(3):  # late and early events: sequences arrive in three shuffled files
        all_.where(f"pmod(sequence * 7 + queue, 3) = {n}").coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    stream = spark.readStream.schema(queues.EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    seen = {}

    def keep(df, _):
        for r in df.collect():
            seen[r.queue, r.version] = tuple(r)

    q = queues.fold_stream(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(seen.values()) == sorted(map(tuple, queues.fold(all_).collect()))


def test_windows_stream(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.write.parquet(str(tmp_path / "e"))
    out = queues.windowed_counts(spark.readStream.schema(e.schema).parquet(str(tmp_path / "e")))
    q = out.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("n")).first()[0] == e.count() == queues.windowed_counts(e).agg(F.sum("n")).first()[0]


def test_canonical_json_of_lone_surrogates(spark):
    rows = spark.createDataFrame([(1, '{"b":"\\ud800","a":1}'), (2, '{"a":1,"a":2}'), (3, "\"\U0001f600\"")], "k int, t string")
    got = [r.c for r in rows.select("k", ids.canonical_json()("t").alias("c")).orderBy("k").collect()]
    assert got == ['{"a":1,"b":"\\ud800"}', None, '"\U0001f600"']
