"""Streams that each have a spec of their own, and specs that change while the stream runs.

Changes arrive as a stream of their own, ``(stream_id, effective_ms, spec)``, next to the
events. The first stage keeps, for each stream, the spec in force, the number of its changes and
those still to come; it hands every event on with its epoch and settings, and a marker row for
each change. All work on payloads is then done by the JVM, with the settings as columns, and the
ordered stages read theirs from the row. State that belongs to an earlier epoch counts for
nothing: dedup and threshold begin afresh, and the open batch of the epoch before closes
with the time of its last event. So state does not grow with the number of changes.

A change takes effect before the first event of its time or later, or, where such events have
been through already, when it arrives. Late events are taken under the spec in force. A spec
that cannot be read changes nothing; a NULL or empty one has no stages.

With ``keep_dropped`` every event comes out once, unbatched, with the stage that dropped it.
"""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import COLUMNS, ENVELOPE
from millrace.operators.slices import LOWEST
from millrace.plans.many import SETTINGS, accepted_types, settings_of, settings_text, with_prepared
from millrace.plans.pipeline import payload_bytes
from millrace.plans.spec import PipelineSpec
from millrace.streaming.packets import Packets, stateful_stage
from millrace.streaming.pipeline import configure_state
from millrace.streaming.stages import GRACE_MS, MEMBER, MEMBER_NAMES, Cut, batch_of, envelope_table, payload_id, with_members

ASSIGNED = [*ENVELOPE.fields, T.StructField("epoch", T.IntegerType()), T.StructField("_set", T.StringType()), T.StructField("_control", T.BooleanType())]
WITH_EPOCH = [*ENVELOPE.fields, T.StructField("epoch", T.IntegerType())]
CHANGE = pa.struct([("effective", pa.int64()), ("told", pa.string())])


class _Assign(Packets):
    """Holds the spec in force, its epoch, the latest event time, and changes still to come."""

    name = "now"
    fields = pa.schema([("epoch", pa.int32()), ("latest", pa.int64()), ("told", pa.string()), ("coming", pa.list_(CHANGE))])
    # The changes of a micro-batch are known before its events.
    order = (("_control", "descending"), ("timestamp", "ascending"), ("seq", "ascending"))

    def settled(self, rows, ids, held, clock):
        out, changes = [], {}
        names = [*COLUMNS, "_control"]
        lines = zip(ids, zip(*(rows[name].to_pylist() for name in names)))
        for id_, own in groupby(lines, key=itemgetter(0)):
            epoch, latest, told, coming = held.get(id_, (0, LOWEST, None, []))
            waiting = [(entry["effective"], entry["told"]) for entry in coming]
            events = []
            for _, line in own:
                if not line[-1]:
                    events.append(line[:-1])
                elif (settings := settings_text(line[COLUMNS.index("payload")])) is not None:
                    waiting.append((line[COLUMNS.index("timestamp")], settings))
            waiting.sort()
            at = 0
            for time, event in [(latest, None), *((event[COLUMNS.index("timestamp")], event) for event in events)]:
                while at < len(waiting) and waiting[at][0] <= time:
                    start, told = waiting[at]
                    at, epoch = at + 1, epoch + 1
                    out.append((id_, "", id_, "", start, None, -1, epoch, told, True))
                if event is not None:
                    latest = max(latest, time)
                    out.append((*event, epoch, told, False))
            changes[id_] = (epoch, latest, told, [{"effective": start, "told": settings} for start, settings in waiting[at:]])
        return self.handed(out), changes

    def handed(self, rows):
        table = envelope_table([row[:8] for row in rows], [*COLUMNS, "epoch"])
        table = table.append_column("_set", pa.array([row[8] for row in rows], pa.string()))
        return table.append_column("_control", pa.array([row[9] for row in rows], pa.bool_()))


class _Held(Packets):
    """What the ordered stages share: rows that pass untouched, and the fate of those that are dropped."""

    order = (("epoch", "ascending"), ("_control", "descending"), ("timestamp", "ascending"), ("seq", "ascending"))
    stage: str
    used: tuple[str, ...] = ()

    def untouched(self, rows: pa.Table, setting: str) -> pa.ChunkedArray:
        """Whether a row has no part in the stage."""
        free = pc.or_(rows["_control"], pc.is_null(rows[setting]))
        return pc.or_(free, pc.is_valid(rows["dropped_by"])) if "dropped_by" in rows.column_names else free

    def passed(self, rows: pa.Table, kept: list[bool]) -> pa.Table:
        """The rows that are kept; where fates are told, all rows, with the stage that dropped them."""
        verdict, rows = pa.array(kept, pa.bool_()), rows.drop_columns(list(self.used))
        if "dropped_by" not in rows.column_names:
            return rows.filter(verdict)
        told = pc.if_else(verdict, rows["dropped_by"], pa.scalar(self.stage, pa.string()))
        return rows.set_column(rows.column_names.index("dropped_by"), "dropped_by", told)


class _Dedup(_Held):
    """Holds the time at which a payload was last kept, and the epoch it belongs to."""

    name = stage = "dedup"
    fields = pa.schema([("epoch", pa.int32()), ("kept", pa.int64()), ("timer", pa.int64())])

    def __init__(self, live: bool):
        self.live = live

    def settled(self, rows, ids, held, clock):
        passed, changes, before = [], {}, object()
        epoch = last = None
        columns = (rows[name].to_pylist() for name in ("epoch", "timestamp", "_set_ttl"))
        for id_, free, now, time, ttl in zip(ids, self.untouched(rows, "_set_ttl").to_pylist(), *columns):
            if free or ttl < 0:
                passed.append(True)
                continue
            if id_ != before:
                before, (epoch, last, _) = id_, held.get(id_, (None, None, None))
            if now != epoch:
                epoch, last = now, None
            kept = last is None or time - last > ttl
            if kept:
                last = time
                changes[id_] = (epoch, time, clock + ttl + GRACE_MS if self.live else None)
            passed.append(kept)
        return self.passed(rows, passed), changes


class _Threshold(_Held):
    """Holds the number that was last let through, and the epoch it belongs to."""

    name, stage, used = "passed", "threshold", ("_number",)
    fields = pa.schema([("epoch", pa.int32()), ("passed", pa.float64())])

    def settled(self, rows, ids, held, clock):
        passed, changes, before = [], {}, object()
        epoch = last = None
        columns = (rows[name].to_pylist() for name in ("epoch", "_number", "_set_delta"))
        for id_, free, now, value, delta in zip(ids, self.untouched(rows, "_set_delta").to_pylist(), *columns):
            if free or value is None:
                passed.append(True)
                continue
            if id_ != before:
                before, (epoch, last) = id_, held.get(id_, (None, None))
            if now != epoch:
                epoch, last = now, None
            kept = last is None or abs(value - last) >= delta
            if kept:
                last = value
                changes[id_] = (epoch, value)
            passed.append(kept)
        return self.passed(rows, passed), changes


class _Batch(_Held):
    """Holds the epoch, the open tick, the time of the last event, and the members of the open batch."""

    name = "open"
    fields = pa.schema(
        [("epoch", pa.int32()), ("due", pa.int64()), ("last", pa.int64()), ("interval", pa.int64()), ("timer", pa.int64()), ("open", pa.list_(MEMBER))]
    )

    def __init__(self, live: bool):
        self.live = live

    def settled(self, rows, ids, held, clock):
        rows, places = with_members(rows, ids, held)
        cut, alone, changes = Cut(), [], {}
        names = ("timestamp", "epoch", "_control", "_whole", "_set_size", "_set_interval")
        times, epochs, controls, wholes, sizes, intervals = (rows[name].to_pylist() for name in names)
        for id_, (start, fresh, end) in places.items():
            epoch, due, last, interval, _, _ = held.get(id_, (None,) * 6)
            members = list(range(start, fresh))
            for i in range(fresh, end):
                if epochs[i] != epoch:
                    if members:
                        cut.close(members, last, epoch)
                        members = []
                    epoch, due = epochs[i], None
                if controls[i]:
                    continue
                size, interval, time = sizes[i], intervals[i], times[i]
                if size is None or not wholes[i]:
                    alone.append(i)
                    continue
                due = time + interval if due is None else due
                if time >= due:
                    if members:
                        cut.close(members, due, epoch)
                        members = []
                    due += interval * ((time - due) // interval + 1)
                members.append(i)
                last = time
                if len(members) >= size:
                    cut.close(members, time, epoch)
                    members, due = [], time + interval
            timer = clock + interval if self.live and members else None
            left = rows.take(pa.array(members, pa.int64())).select(MEMBER_NAMES).to_pylist() if members else []
            changes[id_] = (epoch, due, last, interval, timer, left)
        names = [*COLUMNS, "epoch"]
        return pa.concat_tables([cut.envelopes(rows, names), rows.take(pa.array(alone, pa.int64())).select(names)]), changes

    def handed(self, rows):
        return envelope_table(rows, [*COLUMNS, "epoch"])

    def expired(self, id_, values):
        epoch, due, last, interval, _, members = values
        closing = [(*batch_of(id_, members, due), epoch)] if members else []
        return closing, (epoch, due + interval if members else due, last, interval, None, [])


def run_stream_specs(events: DataFrame, specs: DataFrame, live: bool = False, keep_dropped: bool = False) -> DataFrame:
    """Apply to each event of a stream the spec in force, as ``specs`` (stream_id, effective_ms, spec) has it.

    ``specs`` is a stream too; a NULL time is the beginning of time. The result has ``epoch`` next
    to the envelope, the number of changes so far. Streams without a spec pass unchanged.
    """
    configure_state(events.sparkSession)
    stream = F.col("stream_id")
    controls = specs.select(
        stream,
        F.lit("").alias("topic"),
        stream.alias("source"),
        F.lit("").alias("type"),
        F.coalesce(F.col("effective_ms").cast("long"), F.lit(LOWEST)).alias("timestamp"),
        F.col("spec").cast("string").alias("payload"),
        F.lit(-1).cast("long").alias("seq"),
        F.lit(True).alias("_control"),
    )
    both = events.select(COLUMNS).withColumn("_control", F.lit(False)).unionByName(controls)
    assigned = stateful_stage(both, stream, _Assign(), ASSIGNED)
    return _conditioned(assigned.withColumn("_set", F.from_json("_set", SETTINGS)), live, keep_dropped)


def stream_fate(events: DataFrame, spec: PipelineSpec, live: bool = False) -> DataFrame:
    """Every event of a stream once, unbatched, with ``dropped_by`` and ``ingested_bytes``, as ``run(keep_dropped=True)`` has it."""
    configure_state(events.sparkSession)
    told = F.from_json(F.lit(settings_of(spec)), SETTINGS)
    rows = events.select(COLUMNS).withColumns({"epoch": F.lit(0), "_set": told, "_control": F.lit(False)})
    used = (spec.ttl_ms is not None, spec.threshold is not None)
    return _conditioned(rows, live, True, *used).drop("epoch")


def _conditioned(rows: DataFrame, live: bool, keep_dropped: bool, ttl: bool = True, delta: bool = True) -> DataFrame:
    control = F.col("_control")
    accepted = accepted_types() | control
    if keep_dropped:
        rows = rows.withColumn("ingested_bytes", payload_bytes()).withColumn("dropped_by", F.when(~accepted, "filter"))
    else:
        rows = rows.filter(accepted)
    rows = with_prepared(rows)
    if ttl:
        # A marker meets no payload; it goes with its stream.
        id_ = F.when(control, F.unhex(F.sha2(F.coalesce("stream_id", F.lit("")), 256))).otherwise(payload_id())
        rows = stateful_stage(rows, id_, _Dedup(live), [field for field in rows.schema if field.name != "_key"], "_key")
    if delta:
        rows = stateful_stage(rows, F.col("stream_id"), _Threshold(), [field for field in rows.schema if field.name != "_number"])
    if keep_dropped:
        return rows.filter(~F.col("_control")).select(*COLUMNS, "epoch", "ingested_bytes", "dropped_by")
    return stateful_stage(rows, F.col("stream_id"), _Batch(live), WITH_EPOCH)
