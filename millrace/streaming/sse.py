"""Server-sent-event lines to envelopes on streams.

A connection's open block, its data lines so far and the event name that is pending are state, so a
block may arrive over any number of micro-batches. Lines of a connection are taken in
``seq`` order within a micro-batch, and micro-batches as they come. Lines after the last blank
one stay in the state; a finished input never makes them an event, as on batch frames. The JVM
tells lines apart and checks what blocks hold; Python only puts the lines of a block together.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.sources.sse import CONNECTION, as_envelopes, told_lines
from millrace.streaming.pipeline import configure_state

_EVENT = "stream_id string, topic string, conn_id string, seq long, recv_ms long, _text string, _type string"


class _Blocks(StatefulProcessor):
    """Holds the pending event name, and the data lines of the open block."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.name = handle.getValueState("name", "name string")
        self.data = handle.getListState("data", "line string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.name.get()
        name = held[0] if held else None
        data = [entry[0] for entry in self.data.get()]
        carried, begun = len(data), False
        for row in sorted(rows, key=lambda row: row.seq):
            if row["_blank"]:
                if text := "\n".join(data).lstrip("\n"):
                    yield Row(
                        stream_id=key[0], topic=row.topic, conn_id=key[1], seq=row.seq, recv_ms=row.recv_ms, _text=text, _type=name
                    )
                    name = None
                data, begun = [], True
            elif row["_name"] is not None:
                name = row["_name"]
            elif row["_data"] is not None:
                data.append(row["_data"])
        self.name.update((name,))
        if begun and not data:
            self.data.clear()
        elif begun:
            self.data.put([(line,) for line in data])
        elif len(data) > carried:
            # A long block only has its new lines written.
            self.data.appendList([(line,) for line in data[carried:]])


def stream_sse_events(lines: DataFrame) -> DataFrame:
    """Events of a stream of lines ``(stream_id, topic, conn_id, seq, recv_ms, line)``."""
    configure_state(lines.sparkSession)
    told = told_lines(lines)
    blocks = told.groupBy(*CONNECTION).transformWithState(
        statefulProcessor=_Blocks(), outputStructType=_EVENT, outputMode="Append", timeMode="None"
    )
    return as_envelopes(blocks)
