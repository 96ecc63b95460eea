"""Stateless stages, spec reading, and whole chains."""

import json
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace import PipelineSpec, chain, run
from millrace.functions import json_text as J
from millrace.functions.durations import parse_duration
from millrace.operators.stateless import enrich, filter_types, transform
from millrace.plans.many import run_epochs, run_streams
from millrace.plans.pipeline import stages
from millrace.plans.spec import Batch, Threshold


def payloads(df):
    return [row.payload for row in df.orderBy("stream_id", "seq").collect()]


def lines(df):
    names = [name for name in df.columns if name != "epoch"]
    return sorted(map(tuple, df.select(names).collect()), key=repr)


def test_filter(events):
    df = events([{"type": t} for t in ("trade", "ticker", "unknown", "Trade")])
    kept = filter_types(df, ["trade", "ticker"])
    assert [row.seq for row in kept.orderBy("seq").collect()] == [0, 1]
    assert filter_types(df, []).count() == 4


def test_transform(events):
    df = events(
        [
            (0, '{"symbol":"BTCUSDT","data":{"kline":{"c":"45000"}},"ignored":"field"}'),
            (1, '{"symbol":"ETHUSDT"}'),
            (2, '{"other":1}'),
            (3, "not-json"),
            (4, "[1]"),
            (5, ""),
            (6, "null"),
            (7, '{"symbol":null,"data":{"kline":[{"c":1}]}}'),
            (8, '{"symbol":{"b":[1,{"x":null}]},"data":7}'),
            (9, '{"symbol":1} x'),
            (10, None),
            (11, '{"data.kline.c":1,"symbol":1.50}'),
        ]
    )
    assert payloads(transform(df, {"price": "data.kline.c", "symbol": "symbol"})) == [
        '{"price":"45000","symbol":"BTCUSDT"}',
        '{"symbol":"ETHUSDT"}',
        "{}",
        "not-json",
        "[1]",
        "",
        "{}",
        '{"symbol":null}',
        '{"symbol":{"b":[1,{"x":null}]}}',
        '{"symbol":1} x',
        None,
        '{"symbol":1.5}',
    ]


def test_transform_odd_keys(events):
    df = events([(0, json.dumps({"it's": {'a"b': 1}, "q?": 2, "": {"": 3}, 'x\'"': 4}))])
    mapping = {"a": "it's.a\"b", "b": "q?", "c": ".", "d": 'x\'"', "e'": "q?"}
    assert json.loads(payloads(transform(df, mapping))[0]) == {"a": 1, "b": 2, "c": 3, "d": 4, "e'": 2}


def test_enrich(events):
    df = events([(0, '{"price": 100, "env": 1}'), (1, "not-json"), (2, "[1]"), (3, "{}"), (4, "null"), (5, "")])
    assert payloads(enrich(df, {"env": "prod", "version": "1.0"})) == [
        '{"env":"prod","price":100,"version":"1.0"}',
        "not-json",
        "[1]",
        '{"env":"prod","version":"1.0"}',
        "null",
        "",
    ]


@pytest.mark.parametrize(
    "text,millis",
    [
        ("50ms", 50), ("1m", 60_000), ("1h30m", 5_400_000), ("1.5s", 1500), ("0", 0), ("-2s", -2000),
        ("100us", Fraction(1, 10)), ("+1ms", 1), (".5s", 500), ("1.s", 1000), ("3ns", Fraction(3, 10**6)),
    ],
)
def test_duration(text, millis):
    assert parse_duration(text) == millis


@pytest.mark.parametrize("text", ["", "5", "abc", "1 s", "s", "1d", "--1s", ".s", "1m x"])
def test_bad_duration(text):
    with pytest.raises(ValueError):
        parse_duration(text)


def test_spec_defaults():
    assert PipelineSpec.from_json(None) == PipelineSpec() == PipelineSpec.from_json("{}")
    spec = PipelineSpec.from_dict(
        {
            "filter": {"match_types": ["a"]},
            "transform": {"mapping": {"x": "y.z"}},
            "dedup": {"enabled": True, "ttl": "nonsense", "cache_size": 5},
            "enrich": {"tags": {"k": "v"}},
            "threshold": {"enabled": True, "path": "x"},
            "batch": {"enabled": True, "max_batch_size": -1},
        }
    )
    assert spec == PipelineSpec(("a",), {"x": "y.z"}, 60_000, {"k": "v"}, Threshold("x", 0.0), Batch(100, 1000))
    off = {"dedup": {"ttl": "1s"}, "threshold": {"enabled": True, "path": ""}, "batch": {"enabled": False}}
    assert PipelineSpec.from_dict(off) == PipelineSpec()
    with pytest.raises(ValueError):
        PipelineSpec.from_dict({"batch": {"enabled": True, "flush_interval": "0s"}})


FULL = {
    "filter": {"match_types": ["a", "b"]},
    "transform": {"mapping": {"v": "d.v", "k": "k"}},
    "dedup": {"enabled": True, "ttl": "400ms"},
    "enrich": {"tags": {"env": "prod"}},
    "threshold": {"enabled": True, "path": "v", "delta": 2},
}
BATCH = {"batch": {"enabled": True, "max_batch_size": 3, "flush_interval": "60ms"}}


def mixed(events, n=160):
    rows = []
    for i in range(n):
        payload = json.dumps({"d": {"v": i * 7 % 11}, "k": i % 3, "noise": i})
        rows.append(
            {
                "stream_id": f"s{i % 5 % 3}",
                "timestamp": i * 5,
                "type": "abc"[i % 7 % 3],
                "payload": "oops" if i % 13 == 0 else payload,
            }
        )
    return events(rows)


def test_reference_chain(events):
    spec = PipelineSpec.from_dict(
        {
            "filter": {"match_types": ["allowed"]},
            "enrich": {"tags": {"foo": "bar"}},
            "dedup": {"enabled": True, "ttl": "1m"},
        }
    )
    df = events([{"type": t, "payload": '{"val": 1}'} for t in ("blocked", "allowed", "allowed")])
    assert [(r.seq, r.payload) for r in run(df, spec).collect()] == [(1, '{"foo":"bar","val":1}')]
    fate = run(df, spec, keep_dropped=True).orderBy("seq").collect()
    assert [r.dropped_by for r in fate] == ["filter", None, "dedup"]


def test_empty_spec_passes_all(events):
    df = mixed(events)
    assert lines(run(df, PipelineSpec())) == lines(df)


@pytest.mark.parametrize("max_rows", [1_000_000, 15])
@pytest.mark.parametrize("config", [FULL, FULL | BATCH])
def test_run_equals_stage_by_stage(events, config, max_rows):
    df, spec = mixed(events), PipelineSpec.from_dict(config)
    assert lines(run(df, spec, max_rows=max_rows)) == lines(chain(*stages(spec))(df))


@pytest.mark.parametrize("max_rows", [1_000_000, 15])
def test_every_event_has_one_fate(events, max_rows):
    df, spec = mixed(events), PipelineSpec.from_dict(FULL)
    fate = run(df, spec, keep_dropped=True, max_rows=max_rows)
    assert fate.count() == df.count() == fate.select("stream_id", "seq").distinct().count()
    alive = fate.filter("dropped_by is null").drop("dropped_by", "ingested_bytes")
    assert lines(alive) == lines(run(df, spec))
    dead = {row[0] for row in fate.select("dropped_by").distinct().collect()}
    assert dead == {None, "filter", "dedup", "threshold"}


def test_stages_run_in_the_given_order(events):
    def append(text):
        return lambda df: df.withColumn("source", F.concat("source", F.lit(text)))

    df = events([{"source": "x"}])
    assert [row.source for row in chain(append("_a"), append("_b"))(df).collect()] == ["x_a_b"]
    assert chain(lambda df: df.filter("false"), append("_b"))(df).count() == 0
    assert lines(chain()(df)) == lines(df)


def test_many_streams_each_with_its_spec(events):
    df = mixed(events)
    specs = {
        "s0": PipelineSpec.from_dict(FULL | BATCH),
        "s1": PipelineSpec.from_dict({"dedup": {"enabled": True, "ttl": "1s"}, "enrich": FULL["enrich"]}),
    }
    want = lines(df.filter("stream_id = 's2'"))
    for stream, spec in specs.items():
        want += lines(run(df.filter(F.col("stream_id") == stream), spec))
    for max_rows in (1_000_000, 15):
        assert lines(run_streams(df, specs, max_rows=max_rows)) == sorted(want, key=repr)


def test_threshold_without_other_stages_in_many(events):
    df = mixed(events)
    spec = PipelineSpec(threshold=Threshold("d.v", 3.0))
    assert lines(run_streams(df, {s: spec for s in ("s0", "s1", "s2")})) == lines(run(df, spec))


def test_a_new_spec_starts_afresh(events):
    df = mixed(events)
    first, second = PipelineSpec.from_dict(FULL), PipelineSpec.from_dict(FULL | BATCH)
    history = [("s0", 400, second), ("s0", 100, first), ("s1", None, first), ("s1", 300, PipelineSpec())]
    time, stream = F.col("timestamp"), F.col("stream_id")
    parts = [
        (df.filter((stream == "s0") & (time < 100)), PipelineSpec()),
        (df.filter((stream == "s0") & time.between(100, 399)), first),
        (df.filter((stream == "s0") & (time >= 400)), second),
        (df.filter((stream == "s1") & (time < 300)), first),
        (df.filter((stream == "s1") & (time >= 300)), PipelineSpec()),
        (df.filter(stream == "s2"), PipelineSpec()),
    ]
    want = sorted((line for part, spec in parts for line in lines(run(part, spec))), key=repr)
    for max_rows in (1_000_000, 15):
        assert lines(run_epochs(df, history, max_rows=max_rows)) == want
    fate = run_epochs(df, history, keep_dropped=True)
    assert fate.count() == df.count()


def test_json_check(spark):
    texts = {
        '{"a":1}': True, " [1, 2] ": True, "null": True, '"s"': True, "1.5e3": True, '{"a":1,"a":2}': True,
        '{"a":1} x': False, "1 // c": False, "": False, "1,2": False, "1] x": False, "01": False, "NaN": False,
        '{"a":1}}': False, "[1": False, "'a'": False, "[1,]": False, '"\t"': False, "true false": False,
    }
    df = J.with_document(spark.createDataFrame([(text,) for text in texts], "payload string"))
    found = {row.payload: row.ok for row in df.select("payload", F.col("_doc").isNotNull().alias("ok")).collect()}
    assert found == texts
