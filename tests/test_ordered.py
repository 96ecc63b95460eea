"""The ordered stages against plain folds, with streams whole and cut into slices."""

import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import hold
from millrace.operators.batch import batch
from millrace.operators.runs import unsettled, with_runs, without_repeated_numbers
from millrace.operators.slices import plan_slices, with_slices
from millrace.operators.stateful import dedup, payload_key, threshold
import tests_folds as folds

WHOLE = 1_000_000


def seqs(df):
    return sorted((row.stream_id, row.seq) for row in df.select("stream_id", "seq").collect())


def test_dedup_cases(events):
    rows = [(0, '{"id": 1}'), (1, '{"id": 1}'), (2, '{"id": 2}'), (102, '{"id": 1}')]
    assert [s for _, s in seqs(dedup(events(rows), 50))] == [0, 2, 3]


def test_duplicate_does_not_prolong(events):
    rows = [(t, "a") for t in (0, 30, 60, 61, 100, 121, 122, 140)]
    assert [s for _, s in seqs(dedup(events(rows), 60))] == [0, 3, 6]


def test_negative_ttl_keeps_all(events):
    assert len(seqs(dedup(events([(0, "a"), (0, "a")]), -1))) == 2


def test_threshold_case(events):
    rows = [(i, json.dumps({"data": {"val": v}})) for i, v in enumerate([10.0, 10.2, 10.6, 10.6, 11.2])]
    assert [s for _, s in seqs(threshold(events(rows), "data.val", 0.5))] == [0, 2, 4]


def test_threshold_values(events):
    payloads = [
        '{"v":1}', '{"v":"1.4"}', '{"v":" 9 "}', '{"v":"9d"}', '{"v":true}', '{"v":null}', '{"v":[9]}',
        "{}", "x", "", '{"v":"1e400"}', '{"v":1.2}', '{"v":"0x9"}', '{"v":"2"}', '{"v":"NaN"}', '{"v":"-inf"}',
        '{"v":"-Infinity"}', '{"v":2}', '[{"v":7}]', '{"v":2.4} x',
    ]
    df = events([(i, p) for i, p in enumerate(payloads)])
    numbers = [1, 1.4, *[None] * 9, 1.2, None, 2, math.nan, -math.inf, -math.inf, 2, None, None]
    assert [s for _, s in seqs(threshold(df, "v", 0.5))] == folds.threshold(numbers, 0.5)


def test_first_nan_blocks(events):
    df = events([(i, json.dumps({"v": v})) for i, v in enumerate(["nan", "1", "nan", "9", "x"])])
    assert [s for _, s in seqs(threshold(df, "v", 0.5))] == [0, 4]


def streams(seed, n, span, count):
    """Events of a few streams, one of them holding most."""
    rng = random.Random(seed)
    out = []
    for stream in range(count):
        size = n if stream == 0 else n // 20
        times = sorted(rng.randrange(span) for _ in range(size))
        out.append((f"s{stream}", times, rng))
    return out


@pytest.mark.parametrize("max_rows", [WHOLE, 13])
@pytest.mark.parametrize("seed,span,ttl", [(1, 4000, 50), (2, 40_000_000, 3_000_000), (3, 300, 20), (4, 100_000, 90_000)])
def test_dedup_equals_fold(events, seed, span, ttl, max_rows):
    rows, want = [], []
    for name, times, rng in streams(seed, 600, span, 3):
        own = [(t, rng.choice(["a", "a", "a", "b", "c"])) for t in times]
        rows += [
            {"stream_id": name, "timestamp": t, "payload": p, "seq": i} for i, (t, p) in enumerate(own)
        ]
        want += [(name, i) for i in folds.dedup(own, ttl)]
    assert seqs(dedup(events(rows), ttl, max_rows)) == sorted(want)


def test_slices_follow_time_and_stay_small(events):
    rows = []
    for name, times, _ in streams(9, 800, 600_000, 2):
        times += [299_000] * 3 + [301_000 + i for i in range(300)]
        rows += [{"stream_id": name, "timestamp": t, "seq": i} for i, t in enumerate(sorted(times))]
    df = events(rows)
    assert plan_slices(df, WHOLE) is None
    sliced = with_slices(df, plan_slices(df, 50)).orderBy("stream_id", "timestamp", "seq").collect()
    assert len(sliced) == len(rows)
    slices = [(row.stream_id, row._slice) for row in sliced]
    assert slices == sorted(slices)
    sizes = Counter(slices)
    assert len(sizes) > 20 and max(sizes.values()) <= 100


def walk(rng, n, kind):
    if kind == "steps":
        return [rng.randrange(12) / 10 for _ in range(n)]
    if kind == "ramp":
        return [i * 0.01 for i in range(n)]
    if kind == "odd":
        return [rng.choice([1.0, 2.0, math.inf, -math.inf, math.nan, None, 1.5]) for _ in range(n)]
    values, at = [], 0.0
    for _ in range(n):
        at += rng.gauss(0, 0.2)
        values.append(round(at, 3))
    return values


@pytest.mark.parametrize("max_rows", [WHOLE, 13])
@pytest.mark.parametrize("kind,delta", [("steps", 0.5), ("ramp", 0.35), ("odd", 0.5), ("drift", 0.7), ("drift", 0.0), ("odd", -1.0)])
def test_threshold_equals_fold(events, kind, delta, max_rows):
    rows, want = [], []
    for name, times, rng in streams(5, 500, 8_000_000, 3):
        values = walk(rng, len(times), kind)
        for i, (t, v) in enumerate(zip(times, values)):
            text = "no" if v is None else str(v) if math.isfinite(v) else str(v)
            rows.append({"stream_id": name, "timestamp": t, "payload": json.dumps({"v": text}), "seq": i})
        want += [(name, i) for i in folds.threshold(values, delta)]
    assert seqs(threshold(events(rows), "v", delta, max_rows)) == sorted(want)


@pytest.mark.parametrize("max_rows", [WHOLE, 13])
@pytest.mark.parametrize(
    "seed,span,size,interval",
    [
        (1, 20_000, 10, 300),
        (2, 20_000, 3, 50),
        (3, 20_000_000, 5, 100_000),
        (4, 2000, 7, 1_000_000),
        (5, 500, 4, 20),
        (6, 20_000, 100_000, 700),
        (7, 9_000_000, 60, 3_000_000),
        (8, 5000, 1, 10),
    ],
)
def test_batches_equal_fold(events, seed, span, size, interval, max_rows):
    rows, want = [], []
    for name, times, _ in streams(seed, 500, span, 3):
        for i, t in enumerate(times):
            rows.append({"stream_id": name, "timestamp": t, "payload": f'{{"i":{i}}}', "seq": i})
        want += [(name, at, tuple(members)) for at, members in folds.batches(times, size, interval)]
    got = [
        (row.stream_id, row.timestamp, tuple(entry["i"] for entry in json.loads(row.payload)))
        for row in batch(events(rows), size, interval, max_rows).collect()
    ]
    assert sorted(got) == sorted(want)


def test_batch_fields(events):
    df = events(
        [
            {"type": "a", "topic": "t.1", "payload": '{"id":1}'},
            {"type": "b", "topic": "t.2", "payload": None},
            {"type": "c", "topic": "t.3", "payload": '"x"'},
        ]
    )
    rows = sorted(batch(df, 2, 3_600_000).collect(), key=lambda row: row.seq)
    assert [(r.type, r.topic, r.source, r.payload) for r in rows] == [
        ("a_batch", "t.2", "s", '[{"id":1},null]'),
        ("c_batch", "t.3", "s", '["x"]'),
    ]


def test_event_on_a_tick_opens_the_next_batch(events):
    df = events([(0, "1"), (49, "2"), (50, "3"), (120, "4")])
    rows = sorted(batch(df, 10, 50).collect(), key=lambda row: row.seq)
    assert [(r.timestamp, r.payload) for r in rows] == [(50, "[1,2]"), (100, "[3]"), (120, "[4]")]


def applied(cells, value, delta):
    """What a map makes of a value, event by event."""
    for first, exit_ in zip(*cells):
        if value is None or abs(first - value) >= delta:
            return exit_
    return value


def described(values, delta):
    slice_ = hold._Slice(delta)
    for value in values:
        slice_.take(value)
    return np.array(slice_.firsts), np.array(slice_.exits())


@pytest.mark.parametrize("seed", range(60))
def test_maps_of_slices_compose(seed):
    rng = random.Random(seed)
    delta = rng.choice([1.0, 3.0, 7.0, 0.1])
    odd = [float("nan"), float("inf"), -float("inf")] if seed % 3 == 0 else []

    def drawn():
        n = rng.randrange(1, 12)
        if seed % 2:
            return sorted(rng.sample(range(40), n))
        return [rng.choice([*odd, rng.uniform(-10, 10), float(rng.randrange(-5, 5))]) for _ in range(n)]

    parts = [drawn() for _ in range(rng.randrange(2, 6))]
    maps = [described(map(float, part), delta) for part in parts]
    whole = maps[0]
    for one in maps[1:]:
        whole = hold.composed(whole, one, delta)
    with np.errstate(invalid="ignore"):
        for value in [None, *[rng.uniform(-30, 60) for _ in range(50)], *map(float, range(-20, 60)), *odd]:
            want = value
            for one in maps:
                want = applied(one, want, delta)
            got = applied(whole, value, delta)
            assert got == want or got != got and want != want


def test_merging_keeps_a_map_and_shortens_it():
    times = described([float(t) for t in range(1000)], 400.0)
    short = hold.composed(times, described([5000.0], 400.0), 400.0)
    assert len(short[0]) < 5
    for value in (-1000.0, -400.0, 0.0, 599.0, 600.0, 4600.0, 4601.0):
        assert applied(short, value, 400.0) == applied(described([5000.0], 400.0), applied(times, value, 400.0), 400.0)


@pytest.mark.parametrize("fan", [2, 3])
def test_a_payload_in_every_millisecond_over_many_levels(events, monkeypatch, fan):
    """A time-to-live longer than a slice, and a stream of 50 slices."""
    monkeypatch.setattr(hold, "FAN", fan)
    monkeypatch.setattr(hold, "PIECES", 1)
    rows = [(t, "p" if t % 7 else "q") for t in range(300)]
    got = dedup(events(rows), 11, 6)
    assert [s for _, s in seqs(got)] == sorted(folds.dedup(rows, 11))


def test_only_runs_longer_than_the_time_to_live_reach_python(events):
    """Three payloads: apart, within one time-to-live, and every 5 ms."""
    rows = sorted([(t * 1000, "a") for t in range(20)] + [(t, "b") for t in range(50)] + [(t * 5, "c") for t in range(100)])
    df = events(rows).withColumn("_key", payload_key(F.col("payload")))
    timed = with_runs(df, ["stream_id", "_key"], F.lit(100), F.lit(True))
    sent = timed.filter(unsettled(F.lit(100)))
    assert {r.payload for r in sent.select("payload").distinct().collect()} == {"c"}
    assert sent.count() == 79
    assert [s for _, s in seqs(dedup(events(rows), 100))] == sorted(folds.dedup(rows, 100))


def test_equal_neighbours_do_not_reach_the_threshold(events):
    values = [1, 1, 1, 5, 5, 1, None, 1, float("nan"), float("nan"), float("inf"), float("inf")]
    df = events([(i, "{}") for i in range(len(values))])
    told = df.sparkSession.createDataFrame([(i, v if v is None else float(v)) for i, v in enumerate(values)], "seq long, _value double")
    rows = df.join(told, "seq").withColumn("_delta", F.lit(0.5))
    assert [s for _, s in seqs(without_repeated_numbers(rows, ["stream_id"]))] == [0, 3, 5, 6, 8, 9, 10, 11]
    assert without_repeated_numbers(rows.withColumn("_delta", F.lit(0.0)), ["stream_id"]).count() == len(values)
