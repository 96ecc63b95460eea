"""Keep an event only when its value has moved far enough from the last one kept.

Both stateful filters are this one rule. The threshold filter holds a number
back until it differs by ``delta`` from the last number let through. Dropping
duplicates for a fixed time is the same rule on the event time of each payload:
an event is kept when more than the time-to-live, that is at least one
millisecond more, lies between it and the last kept one.

The rule is sequential, yet it can be cut. Whatever value a slice is entered
with, the first event kept in it sets a new highest or lowest value of the
slice so far, and from then on the entry no longer matters. So a slice is
described by the few events that can come first and by the value it ends with
after each of them: a map, in pieces, from the value at its start to that at its end.
Maps of neighbours compose into one of the same form, so they are combined, some at a
time, level by level, and then the values are handed down the levels again. No task follows
a whole stream, and none holds more than two maps. All slices are then marked in parallel.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import ORDER
from millrace.operators.slices import (
    LOWEST,
    SlicePlan,
    group_starts,
    sliced_only,
    sorted_scan,
    with_slices,
)
from millrace.session import checkpointed

#: Pieces of maps that one task composes or follows, about, and maps at the least.
PIECES, FAN = 1_000_000, 16
#: Pairs of pieces up to which two maps are composed one by one.
SMALL = 256


def hold(df: DataFrame, keys: list[str], plan: SlicePlan | None, mark: str | None = None) -> DataFrame:
    """Apply the rule per ``keys`` to the columns ``_value`` and ``_delta``.

    Rows whose ``_value`` is NULL pass and leave the state alone. Held rows are
    removed; with ``mark`` they stay and that column says whether a row passed.
    Where there is a column ``_hot``, only keys it marks are cut into slices.
    """
    names = [name for name in df.columns if name != "_hot"]
    output = T.StructType([T.StructField(name, df.schema[name].dataType) for name in names])
    rows = with_slices(df, plan).withColumn("_seed", F.lit(False))
    if "_hot" in df.columns:
        whole = F.lit(LOWEST)
        rows = rows.withColumn("_slice", F.when(F.col("_hot"), F.col("_slice")).otherwise(whole)).drop("_hot")
    group = [*keys, "_slice"]
    if plan is not None:
        rows = rows.unionByName(_entries(rows, keys), allowMissingColumns=True)
    if mark:
        output = output.add(mark, T.BooleanType())
    return sorted_scan(rows, group, ORDER, _marker(group, names, mark), output)


def hold_sorted(df: DataFrame, keys: list[str]) -> DataFrame:
    """``hold`` on a frame whose rows of a key already lie together and in order, as a window leaves them."""
    rows = df.withColumn("_seed", F.lit(False))
    return rows.mapInArrow(_marker(keys, df.columns, None), df.schema)


def _entries(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per slice of a cut stream, holding the value the slice is entered with."""
    slim = sliced_only(rows).select(*keys, "_slice", *ORDER, "_value", "_delta")
    key_fields = [T.StructField(f.name, f.dataType) for f in slim.select(*keys, "_slice").schema]
    classes = T.StructType(
        [
            *key_fields,
            T.StructField("_delta", T.DoubleType()),
            T.StructField("_rank", T.LongType()),
            T.StructField("_value", T.DoubleType()),
            T.StructField("_exit", T.DoubleType()),
        ]
    )
    group = [*keys, "_slice"]
    nodes = checkpointed(sorted_scan(slim, group, ORDER, _describer(group), classes))
    size = nodes.agg(F.count("*").alias("pieces"), F.count_if(F.col("_rank") == 0).alias("maps")).first()
    entered = _handed_down(nodes, keys, max(FAN, PIECES * size.maps // max(1, size.pieces)))
    return entered.select(
        *keys, "_slice", "_delta", "_value", F.lit(True).alias("_seed"), *(F.lit(LOWEST).alias(name) for name in ORDER)
    )


def _handed_down(nodes: DataFrame, keys: list[str], fan: int) -> DataFrame:
    """The value with which each slice is entered, ``_value``, from the maps ``(_slice, _delta, _rank, _value, _exit)``.

    A stream is entered without a value; what its first slices are entered with is then left out.
    """
    fields = {field.name: field for field in nodes.schema}
    above = T.StructType([*(fields[name] for name in keys), T.StructField("_slice", T.LongType()), *(fields[n] for n in ("_delta", "_rank", "_value", "_exit"))])
    entered = T.StructType([*(fields[name] for name in [*keys, "_slice", "_delta", "_value"])])
    group = [*keys, "_parent"]
    last = nodes.agg(F.max("_slice")).first()[0]
    levels = []
    while last is not None:
        levels.append(nodes.withColumn("_parent", F.floor(F.col("_slice") / fan)))
        last //= fan
        if not last:
            break
        nodes = checkpointed(sorted_scan(levels[-1], group, ["_slice", "_rank"], _composer(group), above))
    found = nodes.select(*entered.names).limit(0) if not levels else None
    for level in reversed(levels):
        rows = level
        if found is not None:
            seeds = found.withColumnRenamed("_slice", "_parent").withColumns({"_slice": F.lit(LOWEST), "_rank": F.lit(-1).cast("long")})
            rows = level.unionByName(seeds, allowMissingColumns=True)
        found = sorted_scan(rows, group, ["_slice", "_rank"], _follower(group, keys), entered)
    return found


def _lists(batch: pa.RecordBatch, *names: str):
    return (batch.column(name).to_pylist() for name in names)


def _marker(group: list[str], names: list[str], mark: str | None):
    def kernel(batches):
        key = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, key = group_starts(batch, group, key)
            passed = []
            for start, value, delta, seed in zip(
                starts.tolist(), *_lists(batch, "_value", "_delta", "_seed")
            ):
                if start:
                    last = None
                if value is None:
                    passed.append(True)
                elif last is None or seed or abs(value - last) >= delta:
                    last = value
                    passed.append(not seed)
                else:
                    passed.append(False)
            verdict = pa.array(passed, pa.bool_())
            rows = batch.select(names)
            if mark:
                rows = rows.append_column(mark, verdict).filter(pa.compute.invert(batch.column("_seed")))
            else:
                rows = rows.filter(verdict)
            yield rows

    return kernel


class _Slice:
    """What becomes of a slice for every value it may be entered with."""

    def __init__(self, delta: float):
        self.delta = delta
        self.firsts: list[float] = []  # events that can be the first one kept
        self.lanes: list[float] = []  # values held at this point, ascending
        self.members: dict[float, list[int]] = {}  # lane -> indexes into firsts
        self.stuck: list[int] = []  # first kept is NaN: nothing is kept after it
        self.low = self.high = None
        self.open = True

    def take(self, value: float) -> None:
        lanes, delta = self.lanes, self.delta
        moved: list[int] = []
        # Lanes far enough away let this event through and go on as one lane.
        while lanes and abs(value - lanes[0]) >= delta:
            moved += self.members.pop(lanes.pop(0))
        while lanes and abs(value - lanes[-1]) >= delta:
            moved += self.members.pop(lanes.pop())
        if self.open and self._may_come_first(value):
            if value != value:
                self.stuck.append(len(self.firsts))
            else:
                moved.append(len(self.firsts))
            self.firsts.append(value)
        if moved:
            if value not in self.members:
                insort(lanes, value)
            self.members.setdefault(value, []).extend(moved)

    def _may_come_first(self, value: float) -> bool:
        if value != value:
            # A NaN is kept only where nothing at all was kept before it.
            return not self.firsts
        if self.low is None:
            self.low = self.high = value
            return True
        if self.low <= value <= self.high:
            return False
        self.low, self.high = min(self.low, value), max(self.high, value)
        # Every entry value is now farther than delta from one of the extremes.
        self.open = not (self.high - self.low >= 2.5 * self.delta)
        return True

    def exits(self) -> list[float]:
        result = [float("nan")] * len(self.firsts)
        for lane, indexes in self.members.items():
            for index in indexes:
                result[index] = lane
        return result


def _describer(group: list[str]):
    def kernel(batches):
        key = state = types = None
        columns = [*group, "_delta", "_rank", "_value", "_exit"]
        done: list[tuple] = []

        def flush():
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*done), types)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=columns)

        def finish(owner, slice_):
            for rank, (first, exit_) in enumerate(zip(slice_.firsts, slice_.exits())):
                done.append((*owner, slice_.delta, rank, first, exit_))

        for batch in batches:
            if not batch.num_rows:
                continue
            if types is None:
                types = [batch.schema.field(name).type for name in group]
                types += [pa.float64(), pa.int64(), pa.float64(), pa.float64()]
            before = key
            starts, key = group_starts(batch, group, key)
            owners = list(zip(*_lists(batch, *group)))
            for row, (start, value, delta) in enumerate(
                zip(starts.tolist(), *_lists(batch, "_value", "_delta"))
            ):
                if start:
                    if state is not None:
                        finish(owners[row - 1] if row else before, state)
                    state = _Slice(delta)
                if value is not None:
                    state.take(value)
            if len(done) >= 10_000:
                yield flush()
        if state is not None:
            finish(key, state)
        if done:
            yield flush()

    return kernel


def composed(f: tuple[np.ndarray, np.ndarray], g: tuple[np.ndarray, np.ndarray], delta: float):
    """The map ``f`` and then ``g``, each as (first events, values at the end)."""
    if not len(f[0]):
        return g
    if len(f[0]) * len(g[0]) <= SMALL:
        return _composed_one_by_one(f, g, delta)
    g = tuple(np.asarray(part) for part in g)
    firsts, exits = (np.asarray(part) for part in f)
    exits = _followed(g, exits, delta)
    with np.errstate(invalid="ignore"):
        low, high = np.fmin.reduce(firsts), np.fmax.reduce(firsts)
        if not high - low >= 2.5 * delta:
            # What the second map can still decide: a new highest or lowest value.
            tops = np.concatenate([[high], np.fmax.accumulate(np.fmax(g[0], high))[:-1]]) if len(g[0]) else g[0]
            bottoms = np.concatenate([[low], np.fmin.accumulate(np.fmin(g[0], low))[:-1]]) if len(g[0]) else g[0]
            new = (g[0] > tops) | (g[0] < bottoms) | (np.isnan(tops) & ~np.isnan(g[0]))
            # Once its ends lie so far apart, every value has been decided upon.
            new &= ~(tops - bottoms >= 2.5 * delta)
            firsts, exits = np.concatenate([firsts, g[0][new]]), np.concatenate([exits, g[1][new]])
    return merged(firsts, exits)


def _composed_one_by_one(f, g, delta: float) -> tuple[list[float], list[float]]:
    """``composed`` for short maps, which arrays are too slow for."""
    later = list(zip(*g))
    firsts, exits = list(f[0]), [next((end for first, end in later if abs(first - value) >= delta), value) for value in f[1]]
    seen = [first for first in firsts if first == first]
    low, high = (min(seen), max(seen)) if seen else (None, None)
    for first, end in later:
        if first != first:
            continue
        if low is None:
            low = high = first
        elif high - low >= 2.5 * delta:
            break
        elif low <= first <= high:
            continue
        low, high = min(low, first), max(high, first)
        firsts.append(first)
        exits.append(end)
    return firsts, exits


def merged(firsts: np.ndarray, exits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same map without events that the next one outdoes to the same end."""
    if len(firsts) < 3:
        return firsts, exits
    rising = firsts[1:] > np.fmax.accumulate(firsts)[:-1]
    alike = (exits[1:-1] == exits[2:]) & (rising[:-1] == rising[1:])
    kept = np.concatenate([[True], ~alike, [True]])
    return firsts[kept], exits[kept]


def _followed(g: tuple[np.ndarray, np.ndarray], values: np.ndarray, delta: float) -> np.ndarray:
    """What ``g`` makes of each value; where it decides nothing the value stays."""
    firsts, exits = g
    if not len(firsts) or not len(values):
        return values
    tops, bottoms = np.fmax.accumulate(firsts), np.fmin.accumulate(firsts)
    with np.errstate(invalid="ignore"):
        up = _first_true(lambda at: tops[at] - values >= delta, np.searchsorted(tops, values + delta), len(firsts))
        down = _first_true(lambda at: values - bottoms[at] >= delta, np.searchsorted(-bottoms, delta - values), len(firsts))
    at = np.minimum(up, down)
    return np.where(at < len(firsts), exits[np.minimum(at, len(firsts) - 1)], values)


def _first_true(holds, guess: np.ndarray, n: int) -> np.ndarray:
    """The first place at which a condition that stays true holds, from a guess that rounding may have moved."""
    at = guess.copy()
    while True:
        back = (at > 0) & holds(np.maximum(at - 1, 0))
        if not back.any():
            break
        at[back] -= 1
    while True:
        on = (at < n) & ~holds(np.minimum(at, n - 1))
        if not on.any():
            return at
        at[on] += 1


def _composer(group: list[str]):
    names = [*group[:-1], "_slice", "_delta", "_rank", "_value", "_exit"]

    def kernel(batches):
        key = types = None
        done = own = None  # the map of the children so far, and of the one at hand
        child = delta = None
        made: list[tuple] = []

        def joined():
            mine = own[0] if len(own) == 1 else tuple(np.concatenate(part) for part in zip(*own))
            return mine if done is None else composed(done, mine, delta)

        def finish(owner):
            firsts, exits = merged(*(np.asarray(part, dtype=np.float64) for part in joined()))
            made.append(([*owner, delta], firsts, exits))

        def shipped():
            sizes = [len(firsts) for _, firsts, _ in made]
            arrays = [pa.array(np.repeat(np.array(values, dtype=object), sizes), kind) for values, kind in zip(zip(*(o for o, _, _ in made)), types)]
            arrays.append(pa.array(np.concatenate([np.arange(n) for n in sizes])))
            arrays += [pa.array(np.concatenate([part[i] for part in made])) for i in (1, 2)]
            made.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            types = types or [batch.schema.field(name).type for name in [*group, "_delta"]]
            before = key
            starts, key = group_starts(batch, group, key)
            slices, deltas = batch.column("_slice").to_numpy(), batch.column("_delta").to_numpy()
            cuts = np.flatnonzero(starts | np.concatenate([[True], slices[1:] != slices[:-1]]))
            firsts, exits = (batch.column(name).to_numpy() for name in ("_value", "_exit"))
            for begin, end in zip(cuts, [*cuts[1:], batch.num_rows]):
                if starts[begin]:
                    if own:
                        finish(before if begin == 0 else tuple(batch.column(g)[int(begin) - 1].as_py() for g in group))
                    done, own, child = None, [], None
                elif slices[begin] != child and own:
                    done, own = joined(), []
                child, delta = slices[begin], float(deltas[begin])
                own.append((firsts[begin:end].tolist(), exits[begin:end].tolist()) if end - begin <= SMALL else (firsts[begin:end], exits[begin:end]))
            if sum(len(firsts) for _, firsts, _ in made) >= 10_000:
                yield shipped()
        if own:
            finish(key)
        if made:
            yield shipped()

    return kernel


def _follower(group: list[str], keys: list[str]):
    """Hands the value that a node is entered with on through its children; a seed row holds it."""

    def kernel(batches):
        key = held = entry = current = None
        decided = False
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, key = group_starts(batch, group, key)
            rows, values = [], []
            for row, (start, slice_, first, exit_, delta) in enumerate(
                zip(starts.tolist(), *_lists(batch, "_slice", "_value", "_exit", "_delta"))
            ):
                if start:
                    held = current = None
                if slice_ == LOWEST:
                    held = first
                    continue
                if slice_ != current:
                    current, entry, decided = slice_, held, False
                    if held is not None:
                        rows.append(row)
                        values.append(held)
                if not decided and (entry is None or abs(first - entry) >= delta):
                    held, decided = exit_, True
            if rows:
                chosen = batch.take(pa.array(rows, pa.int64())).select([*keys, "_slice", "_delta"])
                yield chosen.append_column("_value", pa.array(values, pa.float64()))

    return kernel
