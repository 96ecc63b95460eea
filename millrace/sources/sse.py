"""Server-sent-event lines to envelopes.

The lines of a connection form blocks that end with a blank line. A block with
data becomes an event; an event name stays pending until one does. Connections
live long, so one may hold a large share of all lines: everything that runs
along a connection runs inside slices of about ``SLICE`` counted lines, which
begin behind blank lines so that blocks stay whole, and only one row per slice is
looked at across slices. Lines travel in packets (``lines``), shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.envelope import envelopes
from millrace.functions import json_text as J
from millrace.operators.slices import MAX_SLICES, sorted_by
from millrace.session import checkpointed
from millrace.sources import lines as L
from millrace.sources.lines import CONNECTION

# What a line and an event without a name look like.
DEFAULT_TYPE = "sse_message"
NAME_PREFIX = "event:"
DATA_PREFIX = "data:"

SLICE = 1_000_000


def sse_events(lines: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """Events of lines ``(stream_id, topic, conn_id, seq, recv_ms, line)``.

    An event takes the sequence number and time of the blank line that ends it.
    """
    # Packets are looked at for slices first; lines must not be read and told apart again for that.
    packets = checkpointed(_packets(lines, slice_rows), drop_shuffles=True)
    cuts, named = _cuts(packets, slice_rows)
    slices = sorted_by(_sliced(packets, cuts), [*CONNECTION, "_slice"], ["_from"])
    blocks = slices.mapInArrow(L.finished, L.EVENTS)
    return as_envelopes(_with_pending_name(blocks, slices, cuts) if cuts and named else blocks)


def told_lines(lines: DataFrame) -> DataFrame:
    """Add what each line is: ``_blank`` is 1 for a blank one, ``_name`` and ``_data`` are what follows a prefix."""
    line = F.col("line")
    text = F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    data = F.when(text.startswith(DATA_PREFIX + " "), F.substr(text, F.lit(7))).otherwise(F.substr(text, F.lit(6)))
    return lines.withColumns(
        {
            "_blank": (text == "").cast("long"),
            "_name": F.when(text.startswith(NAME_PREFIX), _trimmed(F.substr(text, F.lit(7)))),
            "_data": F.when(text.startswith(DATA_PREFIX), data),
        }
    )


def as_envelopes(blocks: DataFrame) -> DataFrame:
    """Envelopes of blocks with their text ``_text`` and the name ``_type`` that is due."""
    parsed = J.with_document(blocks, "_text", "_doc")
    as_it_stands = J.is_json(F.col("_doc")) | J.unjudged(F.col("_doc"), "_text")
    payload = F.when(as_it_stands, F.col("_text")).otherwise(J.as_data_object(F.col("_text")))
    type_ = F.when(F.col("_type") == "", DEFAULT_TYPE).otherwise(F.coalesce("_type", F.lit(DEFAULT_TYPE)))
    return envelopes(parsed, type_, payload)


def _packets(lines: DataFrame, slice_rows: int) -> DataFrame:
    """Lines, packed where they are."""
    told = told_lines(lines)
    closing, data, name = F.col("_blank") == 1, F.col("_data"), F.col("_name")
    kind = F.when(closing, L.BLANK).when(data.isNotNull(), L.DATA).when(name.isNotNull(), L.NAME).otherwise(L.OTHER)
    narrow = told.select(
        *CONNECTION,
        F.col("seq").cast("long"),
        kind.cast("byte").alias("kind"),
        # Only the line that ends a block carries its time and topic along.
        F.when(closing, F.col("topic")).otherwise(F.coalesce(data, name)).alias("text"),
        F.when(closing, F.col("recv_ms").cast("long")).alias("recv_ms"),
    )
    return narrow.mapInArrow(L.packed(slice_rows), L.PACKETS)


def _cuts(packets: DataFrame, slice_rows: int) -> tuple[DataFrame | None, bool]:
    """Where connections of more than ``slice_rows`` lines are cut, if any are, and whether any line is a name.

    A cut is a blank line that ends a slice. There are ``MAX_SLICES`` of them at most, so they are broadcast.
    """
    sizes = packets.groupBy(*CONNECTION).agg(F.sum("_n").alias("_n"), F.max("_named").alias("_named"))
    total, largest, named = sizes.agg(F.sum("_n"), F.max("_n"), F.max("_named")).first()
    if not total or largest <= slice_rows:
        return None, bool(named)
    rows = max(slice_rows, total // MAX_SLICES)
    heavy = sizes.filter(F.col("_n") > rows).select(*CONNECTION)
    marks = packets.select(*CONNECTION, F.inline("_marks")).join(F.broadcast(heavy), CONNECTION)
    along = Window.partitionBy(*CONNECTION).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    cuts = marks.withColumn("_slice", F.floor(F.sum("n").over(along) / rows)).filter("cut and _slice > 0")
    cuts = cuts.groupBy(*CONNECTION, "_slice").agg(F.min("at").alias("_at"))
    return checkpointed(cuts.groupBy(*CONNECTION).agg(F.array_sort(F.collect_list("_at")).alias("_cuts"))), bool(named)


def _sliced(packets: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """Packets of one slice each, with ``_slice``, increasing along a connection."""
    if cuts is None:
        return packets.select(*CONNECTION, F.lit(0).cast("long").alias("_slice"), "_from", "_lines", "_texts")
    joined = packets.join(F.broadcast(cuts), CONNECTION, "left")
    passed = F.size(F.filter("_cuts", lambda at: at < F.col("_from")))
    inner = F.filter("_cuts", lambda at: (at >= F.col("_from")) & (at < F.col("_to")))
    slice_ = F.when(F.col("_cuts").isNull(), 0).otherwise(passed).cast("long")
    return joined.select(
        *CONNECTION, slice_.alias("_slice"), "_from", inner.alias("_inner"), "_lines", "_texts"
    ).mapInArrow(L.cut, L.SLICED)


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def running_total(df: DataFrame, keys: list[str], slice_: str, order: str, value: str, output: str) -> DataFrame:
    """Add the sum of ``value`` over all rows of ``keys`` before this one.

    The sum runs inside each slice and starts from the total of the slices
    before, which is computed on one row per slice.
    """
    group = [*keys, slice_]
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group).agg(F.sum(value).alias("_sum"))
    totals = totals.select(*group, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = df.withColumn(output, F.coalesce(F.sum(value).over(before), F.lit(0)))
    joined = inside.join(totals, group)
    return joined.withColumn(output, F.col(output) + F.col("_ahead")).drop("_ahead")


def _with_pending_name(blocks: DataFrame, slices: DataFrame, cuts: DataFrame) -> DataFrame:
    """Complete ``_type``, the last name since the event before, by what the slices before have left."""
    left = slices.mapInArrow(L.left, L.LEFT).join(F.broadcast(cuts), CONNECTION, "left_semi")
    along = Window.partitionBy(*CONNECTION).orderBy("_slice")
    # Slices up to the next with an event form one stretch.
    left = left.withColumn("_stretch", F.sum(F.col("_seen").cast("long")).over(along))
    stretch = Window.partitionBy(*CONNECTION, "_stretch").orderBy("_slice")
    left = left.withColumn("_pending", F.last("_tail", ignorenulls=True).over(stretch))
    pending = left.select(*CONNECTION, "_slice", F.lag("_pending").over(along).alias("_pending"))
    pending = pending.filter("_pending is not null")
    joined = blocks.join(F.broadcast(pending), [*CONNECTION, "_slice"], "left")
    return joined.withColumn("_type", F.coalesce("_type", F.when(F.col("_first"), F.col("_pending"))))
