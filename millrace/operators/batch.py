"""Group the events of a stream into arrays, by size and by time.

A batch closes with its ``max_size``-th event, or at the first tick after it
opened. Ticks lie ``interval`` apart, counted from the first event of the
stream or from the last batch that closed by size. An event exactly on a tick
belongs to the next batch.

A heavy stream is cut into slices. What can happen in a slice depends on the
open tick and on the number of events pending when it begins. Every such entry
leads either to a batch that is full within the first tick, at one of the first
``max_size`` events, or to a tick between two events. From there on the course
of the slice is fixed, so the slice is described by the states it ends in for
these few cases. With the descriptions followed in order, the slice borders are
moved to where a batch begins, and each batch is built whole by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import ENVELOPE, ORDER
from millrace.functions import json_text as J
from millrace.operators.slices import (
    HIGHEST,
    LOWEST,
    MAX_ROWS,
    SlicePlan,
    bounded_join,
    group_starts,
    plan_slices,
    sliced_only,
    sorted_scan,
    with_slices,
)
from millrace.session import checkpointed

LONGS = T.ArrayType(T.LongType())


def batch(df: DataFrame, max_size: int, interval_ms: int, max_rows: int = MAX_ROWS) -> DataFrame:
    """Replace events by batch events.

    A batch has the first event's source, the first one's type plus ``_batch``,
    the last one's topic and the payloads in order. Its time is that of the
    event that filled it, else of the tick that closed it, else, at the end of
    the input, of its last event. Payloads that are not JSON cannot go into an
    array: their events stay as they are.
    """
    if interval_ms <= 0 or max_size <= 0:
        raise ValueError("batch size and interval must be positive")
    plan = plan_slices(df, max_rows)
    whole = F.col("payload").isNull() | J.is_json(F.col("_doc"))
    checked = J.with_document(df).withColumn("_whole", whole).drop("_doc")
    return into_batches(
        checked, F.lit(max_size), F.lit(interval_ms), plan, subject=F.col("_whole")
    )


def into_batches(
    df: DataFrame,
    max_size: Column,
    interval_ms: Column,
    plan: SlicePlan | None,
    scope=("stream_id",),
    subject: Column | None = None,
) -> DataFrame:
    """Batches per ``scope``; rows that are not ``subject`` come out as they are."""
    rows = with_slices(df, plan).withColumns(
        {
            "_joins": F.lit(True) if subject is None else subject,
            "_size": max_size.cast("long"),
            "_interval": interval_ms.cast("long"),
            "_due": F.lit(None).cast("long"),
            "_more": F.lit(False),
            "_seed": F.lit(False),
        }
    )
    if plan is not None:
        rows = _aligned(rows, list(scope))
    extra = [name for name in scope if name not in ENVELOPE.fieldNames()]
    output = T.StructType([T.StructField(f.name, f.dataType) for f in ENVELOPE])
    for name in extra:
        output = output.add(name, df.schema[name].dataType)
    kernel = _builder([*scope, "_slice"], extra)
    return sorted_scan(rows, [*scope, "_slice"], ORDER, kernel, output)


def _aligned(rows: DataFrame, scope: list[str]) -> DataFrame:
    """Move slice borders to where a batch begins; add a row with each slice's open tick."""
    slim = sliced_only(rows).filter("_joins").select(
        *scope, "_slice", *ORDER, "_size", "_interval"
    )
    key_fields = [T.StructField(f.name, f.dataType) for f in slim.select(*scope, "_slice").schema]
    described = T.StructType(
        [
            *key_fields,
            *(T.StructField(name, T.LongType()) for name in _WHOLE),
            *(T.StructField(name, LONGS) for name in _FULL + _TICK),
        ]
    )
    borders = T.StructType(
        [
            *key_fields,
            T.StructField("_cut_time", T.LongType()),
            T.StructField("_cut_seq", T.LongType()),
            T.StructField("_home", T.LongType()),
            T.StructField("_due", T.LongType()),
            T.StructField("_more", T.BooleanType()),
        ]
    )
    group = [*scope, "_slice"]
    courses = sorted_scan(slim, group, ORDER, _describer(group), described)
    followed = sorted_scan(courses, scope, ["_slice"], _follower(scope), borders)
    followed = checkpointed(followed)
    cuts = followed.filter("_home is not null").select(*group, "_cut_time", "_cut_seq", "_home")
    time, cut = F.col("timestamp"), F.col("_cut_time")
    carried = (time < cut) | ((time == cut) & (F.col("seq") <= F.col("_cut_seq")))
    moved = bounded_join(rows, cuts, group, cuts.count())
    moved = moved.withColumn("_slice", F.when(carried, F.col("_home")).otherwise(F.col("_slice")))
    seeds = followed.filter("_due is not null").select(
        *group,
        "_due",
        "_more",
        F.lit(True).alias("_seed"),
        F.lit(True).alias("_joins"),
        *(F.lit(LOWEST).alias(name) for name in ORDER),
    )
    return moved.drop("_cut_time", "_cut_seq", "_home").unionByName(seeds, allowMissingColumns=True)


# Columns of a slice's description: the slice itself, cases that fill a batch
# within the first tick, and cases that reach a tick first.
_WHOLE = ["size", "interval", "first", "rows"]
_FULL = ["full_time", "full_seq", "full_due", "full_pending"]
_TICK = ["tick_after", "tick_rows", "tick_due", "tick_pending", "tick_moved"]


def _courses(times: np.ndarray, seqs: np.ndarray, size: int, interval: int) -> dict:
    """Describe one slice: the state at its end for every case it may begin with."""
    n, first = len(times), int(times[0])
    filled = np.arange(min(size, n))
    offsets = np.unique((times - first) % interval)
    after = np.append(offsets[offsets > 0], interval)  # ticks between two events are alike
    before = np.searchsorted(times, first + after, "left")
    alike = (before < size) & (before < n)
    after, before = after[alike], before[alike]

    at = np.concatenate([filled + 1, before])
    due = np.concatenate([times[filled] + interval, first + after])
    due, pending, moved = _play(times, at, due, size, interval)
    k = len(filled)
    return {
        "size": size,
        "interval": interval,
        "first": first,
        "rows": n,
        "full_time": times[filled].tolist(),
        "full_seq": seqs[filled].tolist(),
        "full_due": due[:k].tolist(),
        "full_pending": pending[:k].tolist(),
        "tick_after": after.tolist(),
        "tick_rows": before.tolist(),
        "tick_due": due[k:].tolist(),
        "tick_pending": pending[k:].tolist(),
        "tick_moved": moved[k:].astype(np.int64).tolist(),
    }


def _play(times, at, due, size, interval):
    """Run all cases to the end of the slice, each from row ``at`` with nothing pending."""
    n = len(times)
    pending = np.zeros(len(at), dtype=np.int64)
    moved = np.zeros(len(at), dtype=bool)
    live = np.flatnonzero(at < n)
    while len(live):
        row, tick, held = at[live], due[live], pending[live]
        now = times[row]
        late = now >= tick
        held = np.where(late, 0, held)
        tick = np.where(late, tick + interval * ((now - tick) // interval + 1), tick)
        end = np.searchsorted(times, tick, "left")
        full = held + end - row >= size
        last = np.where(full, row + size - held - 1, 0)
        at[live] = np.where(full, last + 1, end)
        due[live] = np.where(full, times[last] + interval, tick)
        pending[live] = np.where(full, 0, held + end - row)
        moved[live] |= full
        live = live[at[live] < n]
    return due, pending, moved


def _describer(group: list[str]):
    def kernel(batches):
        key = None
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = interval = fields = None

        def describe(owner):
            times, seqs = (np.concatenate(column) for column in zip(*parts))
            course = _courses(times, seqs, size, interval)
            arrays = [pa.array([value], kind) for value, kind in zip(owner, fields)]
            arrays += [
                pa.array([value], pa.list_(pa.int64()) if isinstance(value, list) else pa.int64())
                for value in course.values()
            ]
            return pa.RecordBatch.from_arrays(arrays, names=[*group, *course])

        for batch_ in batches:
            if not batch_.num_rows:
                continue
            fields = fields or [batch_.schema.field(name).type for name in group]
            before = key
            starts, key = group_starts(batch_, group, key)
            times = batch_.column("timestamp").to_numpy()
            seqs = batch_.column("seq").to_numpy()
            borders = [0, *np.flatnonzero(starts).tolist(), len(times)]
            for begin, end in zip(borders, borders[1:]):
                if starts[begin : begin + 1].any() and parts:
                    owner = before if begin == 0 else tuple(batch_.column(g)[begin - 1].as_py() for g in group)
                    yield describe(owner)
                    parts = []
                if end > begin:
                    size = batch_.column("_size")[begin].as_py()
                    interval = batch_.column("_interval")[begin].as_py()
                    parts.append((times[begin:end], seqs[begin:end]))
        if parts:
            yield describe(key)

    return kernel


def _follower(scope: list[str]):
    def kernel(batches):
        key = due = None
        pending, home = 0, None
        waiting: list[list] = []  # borders up to the last slice in which batches begin
        for batch_ in batches:
            if not batch_.num_rows:
                continue
            starts, key = group_starts(batch_, scope, key)
            types = [batch_.schema.field(name).type for name in scope]
            done: list[list] = []
            for start, course in zip(starts.tolist(), batch_.to_pylist()):
                if start:
                    done += waiting
                    waiting, due, pending, home = [], None, 0, None
                owner = [course[name] for name in scope]
                slice_, first, rows = course["_slice"], course["first"], course["rows"]
                size, interval = course["size"], course["interval"]
                due = first + interval if due is None else due
                if first >= due:
                    pending, due = 0, due + interval * ((first - due) // interval + 1)

                carried, opening = pending > 0, due
                case = int(np.searchsorted(course["tick_after"], due - first, "left"))
                ticks = case < len(course["tick_after"])
                in_tick = course["tick_rows"][case] if ticks else min(rows, size)
                if pending + in_tick >= size:
                    full = size - pending - 1
                    cut = (course["full_time"][full], course["full_seq"][full])
                    opens = not carried or full < rows - 1
                    opening = cut[0] + interval if carried else due
                    due, pending = course["full_due"][full], course["full_pending"][full]
                elif ticks:
                    cut, opens = (due - 1, HIGHEST), True
                    shift = 0 if course["tick_moved"][case] else course["tick_after"][case] - (due - first)
                    due, pending = course["tick_due"][case] - shift, course["tick_pending"][case]
                else:
                    cut, opens = (HIGHEST, HIGHEST), not carried
                    pending += rows

                border = [*owner, slice_]
                border += [*cut, home] if carried else [None, None, None]
                if opens:
                    if waiting:
                        waiting[0][-1] = True
                    done += waiting
                    waiting, home = [], slice_
                    waiting.append([*border, opening, False])
                else:
                    (waiting or done).append([*border, None, None])
            if done:
                yield _borders(done, scope, types)
        if waiting:
            yield _borders(waiting, scope, types)

    def _borders(lines, scope, types):
        kinds = [*types, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        names = [*scope, "_slice", "_cut_time", "_cut_seq", "_home", "_due", "_more"]
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*lines), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return kernel


def _builder(group: list[str], extra: list[str]):
    names = [*ENVELOPE.fieldNames(), *extra]
    flags = ["_seed", "_joins", "_size", "_interval", "_due", "_more"]
    time_at, text_at, topic_at = (names.index(name) for name in ("timestamp", "payload", "topic"))

    def kernel(batches):
        key = due = None
        more = False
        payloads: list[str] = []
        head = topic = time = types = None
        out: list[tuple] = []

        def close(at):
            line = dict(zip(names, head))
            line |= {"topic": topic, "type": line["type"] + "_batch", "timestamp": at}
            line["payload"] = "[" + ",".join(payloads) + "]"
            out.append(tuple(line.values()))
            payloads.clear()

        def shipped():
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch_ in batches:
            if not batch_.num_rows:
                continue
            types = types or [batch_.schema.field(name).type for name in names]
            starts, key = group_starts(batch_, group, key)
            rows = zip(*(batch_.column(name).to_pylist() for name in names))
            told = (batch_.column(name).to_pylist() for name in flags)
            for start, row, seed, joins, size, interval, opening, goes_on in zip(starts.tolist(), rows, *told):
                if start:
                    if payloads:
                        close(due if more else time)
                    due, more = None, False
                if seed:
                    due, more = opening, goes_on
                    continue
                if not joins:
                    out.append(row)
                    continue
                time = row[time_at]
                if due is None:
                    due = time + interval
                if time >= due:
                    if payloads:
                        close(due)
                    due += interval * ((time - due) // interval + 1)
                if not payloads:
                    head = row
                payloads.append("null" if row[text_at] is None else row[text_at])
                topic = row[topic_at]
                if len(payloads) == size:
                    close(time)
                    due = time + interval
            if out:
                yield shipped()
        if payloads:
            close(due if more else time)
        if out:
            yield shipped()

    return kernel
