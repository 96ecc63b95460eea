"""The ordered stages on streams, with their state in Spark's state store.

Each stage keeps as little state as its rule allows: dedup one time per payload
until its time-to-live is over, the threshold one number per stream, a batch its
open members. Rows of one micro-batch are taken in ``(timestamp, seq)`` order, and
micro-batches as they come. No row is too late: there is no watermark, a late row
is taken in the micro-batch it arrives in. For dedup only a payload that was
already kept at a later time is then a duplicate. On a live stream, what a stage no
longer needs goes by the clock: dedup forgets a payload that has not been kept for
its time-to-live and ``GRACE_MS`` on top. A replay, which runs through a finished
input, has no clock: it forgets nothing, and batches that are still open at its end
are read from the state with ``open_batches``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import COLUMNS, ENVELOPE
from millrace.functions import json_text as J
from millrace.operators.stateful import payload_key
from millrace.streaming.packets import Packets, last_of, opened, stateful_stage

#: How long, by the clock, a payload is remembered beyond its time-to-live.
GRACE_MS = 24 * 3_600_000


def payload_id(stream: str = "stream_id", key: str = "_key") -> Column:
    """Identity of a payload in its stream, a 256-bit digest."""
    own = F.when(F.col(stream).isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col(stream)))
    return F.unhex(F.sha2(F.concat(F.hex(key), own), 256))


class _Dedup(Packets):
    """Holds the time at which a payload was last kept."""

    name = "kept"
    fields = pa.schema([("kept", pa.int64()), ("timer", pa.int64())])

    def __init__(self, ttl: int, live: bool):
        self.ttl, self.live = ttl, live

    def settled(self, rows, ids, held, clock):
        passed, changes, before = [], {}, object()
        timer = clock + self.ttl + GRACE_MS if self.live else None
        last = None
        for id_, time in zip(ids, rows["timestamp"].to_pylist()):
            if id_ != before:
                before, last = id_, held[id_][0] if id_ in held else None
            kept = last is None or time - last > self.ttl
            if kept:
                last = time
                changes[id_] = (time, timer)
            passed.append(kept)
        return rows.filter(pa.array(passed, pa.bool_())), changes


class _Threshold(Packets):
    """Holds the number that was last let through."""

    name = "passed"
    fields = pa.schema([("passed", pa.float64())])

    def __init__(self, delta: float):
        self.delta = delta

    def settled(self, rows, ids, held, clock):
        passed, changes, before = [], {}, object()
        last = None
        for id_, value in zip(ids, rows["_number"].to_pylist()):
            if id_ != before:
                before, last = id_, held[id_][0] if id_ in held else None
            kept = value is None or last is None or abs(value - last) >= self.delta
            if kept and value is not None:
                last = value
                changes[id_] = (value,)
            passed.append(kept)
        return rows.drop_columns(["_number"]).filter(pa.array(passed, pa.bool_())), changes


MEMBER = pa.struct([("topic", pa.string()), ("source", pa.string()), ("type", pa.string()), ("payload", pa.string()), ("seq", pa.int64())])


def batch_of(stream: str | None, members: list[dict], time: int) -> tuple:
    """The envelope of a batch."""
    first = members[0]
    payload = "[" + ",".join("null" if m["payload"] is None else m["payload"] for m in members) + "]"
    return stream, members[-1]["topic"], first["source"], first["type"] + "_batch", time, payload, first["seq"]


def envelope_table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows) if rows else ([] for _ in names)
    types = {"timestamp": pa.int64(), "seq": pa.int64(), "epoch": pa.int32()}
    return pa.table({name: pa.array(list(column), types.get(name, pa.string())) for name, column in zip(names, columns)})


MEMBER_NAMES = [field.name for field in MEMBER]


def with_members(rows: pa.Table, ids: list, held: dict) -> tuple[pa.Table, dict]:
    """``rows`` with the open members of each id ahead of its own, and by id where those, its rows and what follows begin."""
    parts, places, at = [], {}, 0
    edges = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
    for start, end in zip(edges, [*edges[1:], len(ids)]):
        id_ = ids[start]
        members = [member | {"stream_id": id_} for member in held[id_][-1]] if id_ in held else []
        places[id_] = (at, at + len(members), at + len(members) + end - start)
        at = places[id_][2]
        parts.append((start, end, members))
    carried = [member for _, _, members in parts for member in members]
    if not carried:
        return rows, places
    order, ahead = [], rows.num_rows
    for start, end, members in parts:
        order += range(ahead, ahead + len(members))
        order += range(start, end)
        ahead += len(members)
    older = pa.table({field.name: pa.array([member.get(field.name) for member in carried], field.type) for field in rows.schema})
    return pa.concat_tables([rows, older.cast(rows.schema)]).take(pa.array(order)), places


class Cut:
    """Batches as numbers of rows, and the envelopes they make."""

    def __init__(self):
        self.members, self.edges, self.times, self.epochs = [], [0], [], []

    def close(self, members, time: int, epoch: int | None = None) -> None:
        self.members += members
        self.epochs.append(epoch)
        self.edges.append(len(self.members))
        self.times.append(time)

    def envelopes(self, rows: pa.Table, names: list[str]) -> pa.Table:
        members, edges = rows.take(pa.array(self.members, pa.int64())), np.array(self.edges)
        first, last = members.take(edges[:-1]), members.take(edges[1:] - 1)
        texts = pc.fill_null(members["payload"], "null").combine_chunks()
        # A list of texts per batch, joined in one go.
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), texts), ",")
        made = {
            "type": pc.binary_join_element_wise(first["type"], "_batch", ""),
            "topic": last["topic"],
            "timestamp": pa.array(self.times, pa.int64()),
            "epoch": pa.array(self.epochs, pa.int32()),
            "payload": pc.binary_join_element_wise("[", joined, "]", ""),
        }
        return pa.table({name: made.get(name, first[name]) for name in names})


class _Batch(Packets):
    """Holds the open tick and the members of the open batch."""

    name = "open"
    fields = pa.schema([("due", pa.int64()), ("timer", pa.int64()), ("open", pa.list_(MEMBER))])

    def __init__(self, size: int, interval: int, live: bool):
        self.size, self.interval, self.live = size, interval, live

    def settled(self, rows, ids, held, clock):
        whole = rows["_whole"]
        bare, rows = rows.filter(pc.invert(whole)).select(COLUMNS), rows.filter(whole)
        rows, places = with_members(rows, [id_ for id_, fits in zip(ids, whole.to_pylist()) if fits], held)
        cut, changes = Cut(), {}
        size, interval = self.size, self.interval
        times = rows["timestamp"].to_pylist()
        for id_, (start, fresh, end) in places.items():
            due = held[id_][0] if id_ in held else times[fresh] + interval
            for i in range(fresh, end):
                time = times[i]
                if time >= due:
                    if i > start:
                        cut.close(range(start, i), due)
                        start = i
                    due += interval * ((time - due) // interval + 1)
                if i + 1 - start == size:
                    cut.close(range(start, i + 1), time)
                    start, due = i + 1, time + interval
            timer = clock + interval if self.live and start < end else None
            changes[id_] = (due, timer, rows.slice(start, end - start).select(MEMBER_NAMES).to_pylist())
        return pa.concat_tables([cut.envelopes(rows, COLUMNS), bare]), changes

    def handed(self, rows):
        return envelope_table(rows, COLUMNS)

    def expired(self, id_, values):
        due, _, members = values
        closing = [batch_of(id_, members, due)] if members else []
        return closing, (due + self.interval if members else due, None, [])


def dedup(df: DataFrame, ttl_ms: int, live: bool = False) -> DataFrame:
    """Dedup of a stream; ``_key`` is used where it is there."""
    if ttl_ms < 0:
        return df
    keyed = df if "_key" in df.columns else df.withColumn("_key", payload_key(F.col("payload")))
    fields = [field for field in df.schema if field.name != "_key"]
    return stateful_stage(keyed, payload_id(), _Dedup(ttl_ms, live), fields, "_key")


def threshold(df: DataFrame, path: str, delta: float) -> DataFrame:
    """Threshold of a stream; ``_number`` is used where it is there."""
    valued = df
    if "_number" not in df.columns:
        valued = J.with_document(df).withColumn("_found", J.extract(F.col("_doc"), path))
        valued = valued.withColumn("_number", J.number(F.col("_found"))).drop("_doc", "_found")
    fields = [field for field in valued.schema if field.name != "_number"]
    return stateful_stage(valued, F.col("stream_id"), _Threshold(float(delta)), fields)


def batch(df: DataFrame, max_size: int, interval_ms: int, live: bool = False) -> DataFrame:
    """Batches of a stream; ``_whole`` is used where it is there.

    A batch closes by time when an event at or after its tick arrives; on a ``live`` stream also
    when no event has come for its interval by the clock.
    """
    if interval_ms <= 0 or max_size <= 0:
        raise ValueError("batch size and interval must be positive")
    checked = df
    if "_whole" not in df.columns:
        whole = F.col("payload").isNull() | J.is_json(F.col("_doc"))
        checked = J.with_document(df).withColumn("_whole", whole).drop("_doc")
    return stateful_stage(checked, F.col("stream_id"), _Batch(max_size, interval_ms, live), ENVELOPE.fields)


def open_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Batches that were open when the query of ``checkpoint`` ended, with the time of their last event's tick.

    Those of streams with changing specs have their ``epoch``. They stand in the state, so a restarted query goes on with them; one that is over hands them out here.
    """
    operators = spark.read.format("state-metadata").load(checkpoint).filter(F.col("operatorProperties").contains('"open"'))
    number = operators.select("operatorId").first()
    if number is None:
        return spark.createDataFrame([], ENVELOPE)
    state = spark.read.format("statestore").option("operatorId", number[0]).option("stateVarName", "open")
    packets = state.option("flattenCollectionTypes", "false").load(checkpoint).select(F.col("list_value.packet").alias("packets"))
    held = packets.limit(1).select(F.element_at("packets", 1)).first()
    epoch = [T.StructField("epoch", T.IntegerType())] if held and "epoch" in opened(held[0]).column_names else []
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in ENVELOPE), *epoch])
    names = schema.fieldNames()

    def left_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket in batch.column(0).to_pylist():
                states = last_of([opened(packet) for packet in bucket]).to_pylist()
                ends = [state | dict(zip(COLUMNS, batch_of(state["_id"], state["open"], state["due"]))) for state in states if state["open"]]
                yield from envelope_table([tuple(end[name] for name in names) for end in ends], names).to_batches()

    return packets.mapInArrow(left_open, schema)
