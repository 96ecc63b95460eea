"""Rows with state, a bucket of keys at a time.

Python's state interface costs about a millisecond per key and some tens of microseconds per row. So
keys are hashed to ``BUCKETS`` buckets, the rows of a bucket travel in packets (Arrow tables, one
binary cell each), and a processor sees all keys of a bucket at once. The state of a bucket is a list
of such packets, one appended for each micro-batch that changes something; later ones win. They
are put together once as much has been appended as was there, so writes stay in proportion to changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Buckets that keys are dealt to, part of every checkpoint.
BUCKETS = 256

#: Rows and bytes that are dealt out together, and appended packets that a bucket's state may have.
PACK_ROWS, PACK_BYTES = 65_536, 64 << 20
PACKETS = 64


def closed(table: pa.Table) -> bytes:
    """A table as one binary cell."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def opened(packet: bytes) -> pa.Table:
    return pa.ipc.open_stream(packet).read_all()


def stateful_stage(df: DataFrame, id_: Column, processor: Packets, output: list[T.StructField], *used: str) -> DataFrame:
    """``processor`` over the rows of a streaming frame, with ``id_``, made of the columns ``used``, as the key of its state."""
    keyed = df.withColumn("_id", id_).drop(*used)
    bucket = F.pmod(F.xxhash64("_id"), F.lit(BUCKETS)).cast("int")
    packets = keyed.withColumn("_bucket", bucket).mapInArrow(_dealt, "_bucket int, _packet binary")
    settled = packets.groupBy("_bucket").transformWithState(
        statefulProcessor=processor,
        outputStructType=T.StructType([T.StructField("_packet", T.BinaryType())]),
        outputMode="Append",
        timeMode="ProcessingTime" if processor.live else "None",
    )
    return settled.select("_packet").mapInArrow(_rows, T.StructType([T.StructField(f.name, f.dataType) for f in output]))


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        waiting.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= PACK_ROWS or size >= PACK_BYTES:
            yield from _by_bucket(waiting)
            waiting, rows, size = [], 0, 0
    if rows:
        yield from _by_bucket(waiting)


def _by_bucket(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches)
    buckets = table["_bucket"].to_numpy()
    order = np.argsort(buckets, kind="stable")
    table, buckets = table.drop_columns(["_bucket"]).take(pa.array(order)).combine_chunks(), buckets[order]
    edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
    for start, end in zip(edges, edges[1:]):
        packet = closed(table.slice(start, end - start))
        bucket = pa.array([buckets[start]], pa.int32())
        yield pa.RecordBatch.from_arrays([bucket, pa.array([packet], pa.binary())], ["_bucket", "_packet"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packet in batch.column(0):
            yield from opened(packet.as_py()).to_batches()


class Held:
    """The state of a bucket: for each id the values last saved; None forgets it."""

    def __init__(self, parts, fields: pa.Schema):
        self.parts, self.fields = parts, fields
        self.tables = [opened(part[0]) for part in parts.get()]

    def of(self, ids: list) -> dict[Any, tuple]:
        """What is held of ``ids``."""
        if not self.tables:
            return {}
        wanted = pa.array(ids, self.tables[0].schema.field("_id").type)
        return _latest([table.filter(pc.is_in(table["_id"], value_set=wanted)) for table in self.tables])

    def everything(self) -> dict[Any, tuple]:
        return _latest(self.tables)

    def save(self, changes: dict[Any, tuple | None], id_type: pa.DataType) -> None:
        """Append ``changes``, or put all together anew."""
        if not changes:
            return
        none = (None,) * len(self.fields)
        columns = list(zip(*(none if values is None else values for values in changes.values())))
        arrays = [pa.array(column, field.type) for column, field in zip(columns, self.fields)]
        gone = pa.array([values is None for values in changes.values()])
        schema = pa.schema([pa.field("_id", id_type), pa.field("_gone", pa.bool_()), *self.fields])
        new = pa.Table.from_arrays([pa.array(list(changes), id_type), gone, *arrays], schema=schema)
        appended = sum(table.num_rows for table in self.tables[1:]) + new.num_rows
        self.tables.append(new)
        if 1 < len(self.tables) <= PACKETS and appended < self.tables[0].num_rows:
            self.parts.appendList([(closed(new),)])
            return
        merged = last_of(self.tables)
        if merged.num_rows:
            self.parts.put([(closed(merged),)])
        else:
            self.parts.clear()
        self.tables = [merged]


def last_of(tables: list[pa.Table]) -> pa.Table:
    """The last row of each id that is not gone."""
    table = pa.concat_tables(tables)
    numbered = pa.table({"_id": table["_id"], "n": np.arange(table.num_rows)})
    last = numbered.group_by("_id").aggregate([("n", "max")])["n_max"]
    table = table.take(last)
    return table.filter(pc.invert(table["_gone"]))


def _latest(tables: list[pa.Table]) -> dict[Any, tuple]:
    found = {}
    for table in tables:
        names = [name for name in table.column_names if name not in ("_id", "_gone")]
        values = zip(*(table[name].to_pylist() for name in names))
        for id_, gone, held in zip(table["_id"].to_pylist(), table["_gone"].to_pylist(), values):
            if gone:
                found.pop(id_, None)
            else:
                found[id_] = held
    return found


class Packets(StatefulProcessor):
    """Takes the rows of a bucket through ``settled``, which sees them sorted by id and ``order``.

    ``name`` is that of the state and ``fields`` are the columns of an id's; ``timer``, where there is
    one, is the time by the clock at which ``expired`` is asked about the id on a live stream.
    """

    name: str
    fields: pa.Schema
    order: tuple[tuple[str, str], ...] = (("timestamp", "ascending"), ("seq", "ascending"))
    live = False

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getListState(self.name, "packet binary")

    def settled(self, rows: pa.Table, ids: list, held: dict[Any, tuple], clock: int | None) -> tuple[pa.Table, dict[Any, tuple | None]]:
        """The rows that go on, and the states that changed; ``ids`` are those of ``rows``."""
        raise NotImplementedError

    def expired(self, id_: Any, values: tuple) -> tuple[list[tuple], tuple | None]:
        """Rows that go on once the timer of an id is over, and its state from then on."""
        return [], None

    def handed(self, rows: list[tuple]) -> pa.Table:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        table = pa.concat_tables([opened(row["_packet"]) for row in rows]).combine_chunks()
        # All columns may be null, so that tables can be put together.
        table = pa.table(table.columns, names=table.column_names)
        table = table.take(pc.sort_indices(table, [("_id", "ascending"), *self.order]))
        clock = timerValues.getCurrentProcessingTimeInMs() if self.live else None
        held = Held(self.parts, self.fields)
        ids = table["_id"].to_pylist()
        out, changes = self.settled(table.drop_columns(["_id"]), ids, held.of(list(dict.fromkeys(ids))), clock)
        held.save(changes, table.schema.field("_id").type)
        if self.live and changes:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self._wait(held)
        if out.num_rows:
            yield Row(_packet=closed(out))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        clock, rows, changes = timerValues.getCurrentProcessingTimeInMs(), [], {}
        held = Held(self.parts, self.fields)
        at = self.fields.get_field_index("timer")
        for id_, values in held.everything().items():
            if values[at] is not None and values[at] <= clock:
                left, changes[id_] = self.expired(id_, values)
                rows += left
        if changes:
            held.save(changes, held.tables[0].schema.field("_id").type)
        self._wait(held)
        if rows:
            yield Row(_packet=closed(self.handed(rows)))

    def _wait(self, held: Held) -> None:
        """One timer for the bucket, that of the id that is due first."""
        at = self.fields.get_field_index("timer")
        timers = [values[at] for values in held.everything().values() if values[at] is not None]
        if timers:
            self.handle.registerTimer(min(timers))
