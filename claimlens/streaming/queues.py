"""Event-sourced queues: hash-chained logs, their validation, and folds in batch and in Structured Streaming.

An event is (queue, sequence, recorded_us, kind, payload); its id hashes the id before it. A queue's state folds in
sequence order: an observation opens a candidate per version, a decision changes the one it names, an observation of a
decided version asks for reopening. Late events are never dropped: state keeps what it needs to fold by sequence.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = "queue long, sequence long, recorded_us long, kind string, payload string"
CHAINED = EVENT + ", previous_event_id string, event_id string"
OPEN = ("pending", "acknowledged")
#: The sequence of a queue's first event.
FIRST = 0


def event_id(previous: str | None, sequence: int, payload: str | None) -> str:
    return hashlib.sha256("|".join((previous or "", str(sequence), payload or "")).encode()).hexdigest()


def chain(events: DataFrame) -> DataFrame:
    """Give each event of a queue its id and its predecessor's; a queue is folded in sequence order, in bounded batches."""

    ordered = events.select("queue", "sequence", "recorded_us", "kind", "payload").repartition("queue").sortWithinPartitions("queue", "sequence")

    def by_queue(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None
        for f in batches:
            before, own = [], []
            for q, s, p in zip(f["queue"], f["sequence"], f["payload"], strict=True):
                previous = last[1] if last and last[0] == q else None
                last = (q, event_id(previous, int(s), p))
                before.append(previous)
                own.append(last[1])
            yield f.assign(previous_event_id=before, event_id=own)

    return ordered.mapInPandas(by_queue, CHAINED)


def violations(events: DataFrame) -> DataFrame:
    """(queue, sequence, problem): a wrong id, a wrong predecessor, a gap, or a clock that went backwards."""
    order = Window.partitionBy("queue").orderBy("sequence")
    seen = events.withColumns({"before": F.lag("event_id").over(order), "last_us": F.lag("recorded_us").over(order), "last": F.lag("sequence").over(order)})
    own = F.sha2(F.concat_ws("|", F.coalesce("previous_event_id", F.lit("")), F.col("sequence").cast("string"), F.coalesce("payload", F.lit(""))), 256)
    problem = (
        F.when(~F.col("previous_event_id").eqNullSafe(F.col("before")), "predecessor")
        .when(own != F.col("event_id"), "id")
        .when(F.col("last") + 1 != F.col("sequence"), "gap")
        .when(F.col("recorded_us") < F.col("last_us"), "clock")
    )
    return seen.select("queue", "sequence", problem.alias("problem")).where("problem is not null")


def append(events: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused) of new events that carry expected_event_id: it must be their queue's head, and clocks must not fall.

    Of new events that name one head the first by (recorded_us, kind, payload) is accepted; to the others it is stale. A
    queue begins with sequence FIRST.
    """
    head = events.groupBy("queue").agg(F.max_by(F.struct("event_id", "sequence", "recorded_us"), "sequence").alias("head"))
    both = new.join(head, "queue", "left")
    good = F.col("expected_event_id").eqNullSafe(F.col("head.event_id")) & (F.col("head").isNull() | (F.col("recorded_us") >= F.col("head.recorded_us")))
    turn = F.row_number().over(Window.partitionBy("queue", "good").orderBy("recorded_us", "kind", "payload"))
    both = both.withColumn("good", F.coalesce(good, F.lit(False))).withColumn("good", F.col("good") & (turn == 1))
    sequence = F.coalesce(F.col("head.sequence") + 1, F.lit(FIRST))
    own = F.sha2(F.concat_ws("|", F.coalesce("head.event_id", F.lit("")), sequence.cast("string"), F.coalesce("payload", F.lit(""))), 256)
    taken = both.where("good").select("queue", sequence.alias("sequence"), "recorded_us", "kind", "payload", F.col("head.event_id").alias("previous_event_id"), own.alias("event_id"))
    return taken, both.where("not good").select(new.columns)


class Fold:
    """The state of one queue."""

    def __init__(self, state: dict | None = None):
        self.candidates = state or {}

    def apply(self, kind: str, payload: dict, recorded_us: int) -> None:
        key = payload.get("version")
        if kind == "observed":
            c = self.candidates.setdefault(key, {"status": "pending", "first": recorded_us, "last": recorded_us, "seen": 0, "reopen": False})
            c["reopen"] |= c["status"] not in OPEN
            c["seen"] += 1
            c["first"], c["last"] = min(c["first"], recorded_us), max(c["last"], recorded_us)
        elif kind == "decided" and key in self.candidates:
            self.candidates[key] |= {"status": payload["action"], "reopen": False}

    def rows(self, queue: int) -> list[tuple]:
        return [(queue, k, c["status"], c["first"], c["last"], c["seen"], c["reopen"]) for k, c in sorted(self.candidates.items())]


STATE = "queue long, version string, status string, first_us long, last_us long, seen long, reopen boolean"
_COLUMNS = [c.split()[0] for c in STATE.split(", ")]


def fold(events: DataFrame, at: int | None = None) -> DataFrame:
    """State of every queue at an instant: one sorted pass over each partition, state only of the queue at hand."""
    rows = events if at is None else events.where(F.col("recorded_us") <= at)
    ordered = rows.select("queue", "sequence", "recorded_us", "kind", "payload").repartition("queue").sortWithinPartitions("queue", "sequence")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue, state = None, Fold()
        for f in batches:
            out: list[tuple] = []
            for q, us, kind, payload in zip(f["queue"], f["recorded_us"], f["kind"], f["payload"], strict=True):
                if queue is not None and q != queue:
                    out += state.rows(int(queue))
                    state = Fold()
                queue = q
                state.apply(kind, json.loads(payload), int(us))
            yield pd.DataFrame(out, columns=_COLUMNS)
        if queue is not None:
            yield pd.DataFrame(state.rows(int(queue)), columns=_COLUMNS)

    return ordered.mapInPandas(run, STATE)


def fold_stream(events: DataFrame) -> DataFrame:
    """The same fold over a stream: keyed state holds events that came early until their predecessors arrive.

    Emits (update mode) the whole state of each queue that a batch touched; the last rows per queue equal fold().
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"next": FIRST, "early": {}, "candidates": {}}
        for f in frames:
            for s, us, kind, payload in zip(f["sequence"], f["recorded_us"], f["kind"], f["payload"], strict=True):
                held["early"][str(s)] = [int(us), kind, payload]
        folded = Fold(held["candidates"])
        while (e := held["early"].pop(str(held["next"]), None)) is not None:
            folded.apply(e[1], json.loads(e[2]), e[0])
            held["next"] += 1
        held["candidates"] = folded.candidates
        state.update((json.dumps(held),))
        yield pd.DataFrame(folded.rows(int(key[0])), columns=_COLUMNS)

    return events.groupBy("queue").applyInPandasWithState(update, STATE, "held string", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Our extension: counts and sums per tumbling window and type under a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def recurrences(observations: DataFrame) -> DataFrame:
    """(key, version, us): a version seen again after a clock at which another one stood. observations: key, version, us."""
    clock = observations.groupBy("key", "us").agg(F.collect_set("version").alias("versions"))
    before = clock.withColumn("before", F.lag("versions").over(Window.partitionBy("key").orderBy("us")))
    rows = before.select("key", "us", "before", F.explode("versions").alias("version"))
    return rows.where(F.col("before").isNotNull() & (F.size(F.array_remove("before", F.col("version"))) > 0)).select("key", "version", "us")
