"""Polling: due instants in batch and as a stream that is restarted, and signals of reports."""

import random
from datetime import datetime, timedelta, timezone

from claimlens.operators import polling
from claimlens.streaming.polls import due_stream
from pyspark.sql import functions as F

HOUR = 3_600_000_000
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_due_times_equal_a_walk(spark):
    rng = random.Random(1)
    rows = [(t, rng.randrange(0, 200)) for t in range(5) for _ in range(20)]
    want = set()
    for t in range(5):
        seen = sorted({us for x, us in rows if x == t and us <= 150})
        want |= {(t, us + 10) for us in seen if us + 10 <= 150 and not any(us < v <= us + 10 for v in seen)}
    got = polling.due_times(spark.createDataFrame(rows, "target_id long, us long"), 10, 150).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_the_stream_equals_the_plan_after_restarts(spark, tmp_path):
    rng = random.Random(2)
    attempts = sorted((rng.uniform(0, 300), t) for t in range(4) for _ in range(15))
    runs = [attempts[i : i + 12] for i in range(0, len(attempts), 12)]
    for a, b in zip(runs, runs[1:], strict=False):  # some come late, though not behind the watermark
        a[-1], b[0] = b[0], a[-1]
    runs += [[(400.0, 99)], [(500.0, 99)], [(501.0, 99)]]  # clocks that move the watermark on
    shape = "target_id long, ts timestamp"
    source, sink, mark = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    for n, run in enumerate(runs):
        spark.createDataFrame([(t, START + timedelta(hours=h)) for h, t in run], shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)  # a new query on the old checkpoint each time
        due_stream(stream, 6 * HOUR, "40 hours").writeStream.option("checkpointLocation", mark).trigger(availableNow=True).outputMode("append").start(sink, format="parquet").awaitTermination(120)
    every = spark.createDataFrame([(t, START + timedelta(hours=h)) for run in runs for h, t in run], shape)
    upto = int((START + timedelta(hours=460)).timestamp() * 1e6)  # the watermark that the last batch saw
    want = {tuple(r) for r in polling.due_times(every.select("target_id", F.unix_micros("ts").alias("us")), 6 * HOUR, upto).collect()}
    rows = [tuple(r) for r in spark.read.parquet(sink).collect()]
    assert len(rows) == len(set(rows)) and {r for r in rows if r[0] != 99} == {r for r in want if r[0] != 99} and len(want) > 20


def test_signals_change_with_what_they_tell(spark):
    rows = [(1, "doc/a", "fresh"), (1, "doc/b", "stale"), (2, "doc/b", "stale"), (2, "doc/a", "fresh"), (3, "doc/a", "fresh"), (3, "doc/b", "fresh"), (4, "doc/a", "fresh"), (4, "doc/b", "fresh"), (4, "doc/b", "fresh"), (5, "doc/a", None)]
    got = polling.report_signals(spark.createDataFrame(rows, "tick long, part string, text string")).orderBy("tick").collect()
    assert [r.changed for r in got] == [True, False, True, False, True] and got[0].signal == got[1].signal
    assert polling.report_signals(spark.createDataFrame(rows, "tick long, part string, text string"), changed_only=True).count() == 3
