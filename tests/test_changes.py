"""Specs that change, as a list, a table and a control stream; SSE, fates and custom stages on streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace import ENVELOPE, PipelineSpec, run
from millrace.metrics import reduction
from millrace.plans.many import run_epochs, run_history, run_streams, unreadable
from millrace.plans.pipeline import chain, stages
from millrace.sinks.publish import start_fates
from millrace.sources.sse import sse_events
from millrace.sources.stored import stream_parquet
from millrace.streaming.custom import stateful, stream_chain, stream_stages
from millrace.streaming.epochs import run_stream_specs, stream_fate
from millrace.streaming.sse import stream_sse_events
from millrace.streaming.stages import open_batches

NAMES = [*ENVELOPE.fieldNames(), "epoch"]
HISTORY = "stream_id string, effective_ms long, spec string"
DEDUP = {"transform": {"mapping": {"v": "v"}}, "dedup": {"enabled": True, "ttl": "90ms"}}
LIMIT = {"threshold": {"enabled": True, "path": "v", "delta": 2}, "enrich": {"tags": {"k": "t"}}}
BATCH = {"batch": {"enabled": True, "max_batch_size": 4, "flush_interval": "150ms"}}
ONLY_X = {"filter": {"match_types": ["x"]}}


def arrivals(seed, n=300, ids="aabc"):
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += rng.choice([0, 1, 3, 10, 40])
        payload = "oops" if i % 41 == 7 else json.dumps({"v": rng.randrange(6), "n": i})
        rows.append({"stream_id": rng.choice(ids), "timestamp": at, "type": rng.choice("xxy"), "topic": f"t.{i % 3}", "payload": payload})
    return rows


def changes(end):
    """Changes of three streams: from the start, in the middle, twice at one moment, and unreadable ones."""
    thirds = [end // 3, 2 * end // 3]
    return [
        ("a", None, json.dumps(DEDUP)),
        ("a", thirds[0], json.dumps(DEDUP | BATCH)),
        ("a", thirds[1], "{}"),
        ("b", thirds[0], json.dumps(LIMIT)),
        ("b", thirds[0], json.dumps(ONLY_X)),
        ("b", thirds[1], None),
        ("b", thirds[1] + 1, "{not json"),
        ("b", thirds[1] + 2, json.dumps({"batch": {"enabled": True, "flush_interval": "-1s"}})),
        ("d", 5, json.dumps(LIMIT)),
    ]


def readable(history):
    kept = [(s, at, text) for s, at, text in history if text is None or text.startswith("{") and "not" not in text and "-1s" not in text]
    kept.sort(key=lambda c: (c[0], -1 if c[1] is None else c[1], c[2] or ""))
    return [(s, at, PipelineSpec.from_json(text)) for s, at, text in kept]


def lines(df, names=NAMES):
    return sorted(map(tuple, df.select(names).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "max_rows": 20}])
@pytest.mark.parametrize("keep_dropped", [False, True])
def test_a_table_of_changes_is_what_a_list_is(events, spark, how, keep_dropped):
    rows = arrivals(1)
    df, history = events(rows), changes(rows[-1]["timestamp"])
    table = spark.createDataFrame(history, HISTORY).repartition(3)
    got = run_history(df, table, keep_dropped, **how)
    want = run_epochs(df, readable(history), keep_dropped)
    names = [*NAMES, "dropped_by", "ingested_bytes"] if keep_dropped else NAMES
    assert lines(got, names) == lines(want, names)
    assert unreadable(table).count() == 2


def test_no_changes_at_all(events, spark):
    df = events(arrivals(2, 20))
    empty = spark.createDataFrame([], HISTORY)
    for how in ({}, {"broadcast_rows": -1}):
        assert lines(run_history(df, empty, **how)) == lines(df.withColumn("epoch", F.lit(0)))
    assert run_history(df.limit(0), spark.createDataFrame(changes(9), HISTORY)).count() == 0


def test_keys_with_quotes_in_specs_of_many_streams(events):
    payloads = [{"it's": {"a?b": n}, "q\\": n % 2} for n in (1, 2, 4)]
    df = events([(i, json.dumps(p)) for i, p in enumerate(payloads)])
    spec = PipelineSpec.from_dict(
        {"transform": {"mapping": {"x": "it's.a?b", "y": "q\\"}}, "threshold": {"enabled": True, "path": "x", "delta": 2}}
    )
    got = run_streams(df, {"s": spec})
    assert lines(got, ENVELOPE.fieldNames()) == lines(run(df, spec), ENVELOPE.fieldNames())
    assert [json.loads(r.payload) for r in got.orderBy("seq").collect()] == [{"x": 1, "y": 1}, {"x": 4, "y": 0}]


def land(df, folder, parts):
    """Write ``df`` as one file per part, in the order of arrival."""
    rows = df.orderBy("seq").collect()
    size = -(-len(rows) // parts)
    for part in range(parts):
        chunk = df.sparkSession.createDataFrame(rows[part * size : (part + 1) * size], df.schema)
        chunk.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        yield part


def follow(stream, folder):
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    assert query.awaitTermination(300)


def reader(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("restart", [False, True])
def test_changes_on_streams_are_what_they_are_on_batch_frames(events, spark, tmp_path, restart):
    rows, folder = arrivals(3), str(tmp_path)
    df, history = events(rows), changes(rows[-1]["timestamp"])
    table = spark.createDataFrame(history, HISTORY).coalesce(1)
    table.write.parquet(f"{folder}/specs")

    def once():
        specs = reader(spark, f"{folder}/specs", table.schema)
        follow(run_stream_specs(stream_parquet(spark, f"{folder}/in", maxFilesPerTrigger=1), specs), folder)

    for _ in land(df, folder, 3):
        if restart:
            once()
    once()
    got = spark.read.parquet(f"{folder}/out").unionByName(open_batches(spark, f"{folder}/checkpoint"))
    assert lines(got) == lines(run_history(df, table))


def test_changes_that_come_late_count_from_then_on(events, spark, tmp_path):
    """A change arrives after events of its time: those keep the spec they had, later ones have the new."""
    folder = str(tmp_path)
    first = events([{"timestamp": t, "payload": json.dumps({"v": 1}), "seq": t} for t in range(0, 100, 10)])
    later = events([{"timestamp": t, "payload": json.dumps({"v": 1}), "seq": t} for t in range(100, 200, 10)])
    dedup = json.dumps({"dedup": {"enabled": True, "ttl": "1h"}})
    for chunk, change in ((first, ("s", None, "{}")), (later, ("s", 50, dedup))):
        chunk.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        spark.createDataFrame([change], HISTORY).coalesce(1).write.mode("append").parquet(f"{folder}/specs")
        specs = reader(spark, f"{folder}/specs", HISTORY)
        follow(run_stream_specs(stream_parquet(spark, f"{folder}/in", maxFilesPerTrigger=1), specs), folder)
    got = {(r.seq, r.epoch) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {(t, 1) for t in range(0, 100, 10)} | {(100, 2)}


def told(rng, n):
    """Lines of a connection, and the events (seq, type, text) that they make."""
    made, out, name, data = [], [], None, []
    for seq in range(n):
        kind = rng.choice(["data", "data", "blank", "name", "empty", "comment"])
        line = {"data": f"data: {seq}", "blank": rng.choice(["", "\r"]), "name": f"event: e{seq} ", "empty": "data:", "comment": ": c"}[kind]
        made.append(line)
        if kind == "blank":
            text = "\n".join(data).lstrip("\n")
            if text:
                out.append((seq, name or "sse_message", text))
                name = None
            data = []
        elif kind == "name":
            name = f"e{seq}"
        elif kind in ("data", "empty"):
            data.append("" if kind == "empty" else str(seq))
    return made, out


@pytest.mark.parametrize("restart", [False, True])
def test_sse_blocks_cut_between_micro_batches(spark, tmp_path, restart):
    rng, rows, want, folder = random.Random(5), [], [], str(tmp_path)
    for conn in range(6):
        made, out = told(rng, 80)
        rows += [("s", "t", f"c{conn}", seq, seq, line) for seq, line in enumerate(made)]
        want += [(seq, type_, text) for seq, type_, text in out]
    schema = "stream_id string, topic string, conn_id string, seq long, recv_ms long, line string"
    lines_ = spark.createDataFrame(rows, schema)

    def once():
        follow(stream_sse_events(reader(spark, f"{folder}/in", schema)), folder)

    for _ in land(lines_, folder, 4):
        if restart:
            once()
    once()

    def events_of(df):
        found = df.select("seq", "type", F.get_json_object("payload", "$.data").alias("wrapped"), "payload").collect()
        return sorted((r.seq, r.type, r.payload if r.wrapped is None else r.wrapped) for r in found)

    out = spark.read.schema(ENVELOPE).parquet(f"{folder}/out")
    assert events_of(out) == sorted(want)
    assert lines(out, ENVELOPE.fieldNames()) == lines(sse_events(lines_), ENVELOPE.fieldNames())


def test_fates_on_streams_add_up(events, spark, tmp_path):
    df, folder = events(arrivals(6)), str(tmp_path)
    for _ in land(df, folder, 3):
        pass
    spec = PipelineSpec.from_dict(ONLY_X | DEDUP | LIMIT)
    stream = stream_fate(stream_parquet(spark, f"{folder}/in", maxFilesPerTrigger=1), spec)
    assert start_fates(stream, f"{folder}/fate", f"{folder}/checkpoint", availableNow=True).awaitTermination(300)
    fate = spark.read.parquet(f"{folder}/fate")
    names = [*ENVELOPE.fieldNames(), "dropped_by", "ingested_bytes"]
    want = run(df, spec, keep_dropped=True)
    assert lines(fate, names) == lines(want, names)
    for row in reduction(fate).collect():
        assert row.events_ingested == row.dropped_filter + row.dropped_dedup + row.dropped_threshold + row.events_published
        assert min(row.dropped_filter, row.dropped_dedup, row.dropped_threshold, row.events_published) > 0
    assert {r.fate for r in fate.select("fate").distinct().collect()} == {"published", "filter", "dedup", "threshold"}


def largest():
    """A fold that lets an event through when its number is the largest of its stream so far, and forgets on 'oops'."""

    def fold(state, event):
        if event["payload"] == "oops":
            return None, [event]
        value = json.loads(event["payload"])["n"] % 17
        if state is None or value > state[0]:
            return (value,), [event | {"source": str(value)}]
        return state, []

    return fold


@pytest.mark.parametrize("restart", [False, True])
def test_custom_stages_keep_their_state(events, spark, tmp_path, restart):
    rows, folder = arrivals(7), str(tmp_path)
    df = events(rows)
    spec = PipelineSpec.from_dict({"filter": {"match_types": ["x"]}, "enrich": {"tags": {"k": "t"}}})

    def once():
        built = stream_chain(*stream_stages(spec), stateful("largest", "value bigint", largest()))
        follow(built(stream_parquet(spark, f"{folder}/in", maxFilesPerTrigger=1)), folder)

    for _ in land(df, folder, 3):
        if restart:
            once()
    once()
    state, want = {}, []
    for row in chain(*stages(spec))(df).orderBy("timestamp", "seq").collect():
        state[row.stream_id], out = largest()(state.get(row.stream_id), row.asDict())
        want += [tuple(event.values()) for event in out]
    assert lines(spark.read.parquet(f"{folder}/out"), ENVELOPE.fieldNames()) == sorted(want, key=repr)


def test_stages_of_a_spec_on_streams(events, spark, tmp_path):
    df, folder = events(arrivals(8)), str(tmp_path)
    for _ in land(df, folder, 2):
        pass
    spec = PipelineSpec.from_dict(ONLY_X | DEDUP | LIMIT)
    follow(stream_chain(*stream_stages(spec))(stream_parquet(spark, f"{folder}/in", maxFilesPerTrigger=1)), folder)
    assert lines(spark.read.parquet(f"{folder}/out"), ENVELOPE.fieldNames()) == lines(run(df, spec), ENVELOPE.fieldNames())
