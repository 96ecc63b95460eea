"""Streams give what batch frames give, in one or several micro-batches."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tests_folds as folds
from millrace import ENVELOPE, PipelineSpec, run
from millrace.metrics import observed
from millrace.plans.spec import Batch, Threshold
from millrace.sinks.publish import publishable, start_append
from millrace.sources.stored import stream_parquet
from millrace.streaming.pipeline import run_stream
from millrace.streaming.stages import open_batches


def arrivals(seed, n=240):
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += rng.choice([1, 3, 10, 40, 200])
        rows.append(
            {
                "stream_id": rng.choice("aab"),
                "timestamp": at,
                "type": rng.choice(["x", "x", "y"]),
                "topic": f"t.{i % 3}",
                "payload": "oops" if i % 31 == 7 else json.dumps({"v": rng.randrange(6), "n": i}),
            }
        )
    return rows


def land(df, folder, parts):
    """Write ``df`` as one file per part, in the order of arrival."""
    rows = df.orderBy("seq").collect()
    size = -(-len(rows) // parts)
    for part in range(parts):
        chunk = df.sparkSession.createDataFrame(rows[part * size : (part + 1) * size], ENVELOPE)
        chunk.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        yield part


def follow(spark, folder, spec, once=True):
    stream = run_stream(stream_parquet(spark, f"{folder}/in", maxFilesPerTrigger=1), spec)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    assert query.awaitTermination(240)
    return query


def lines(df):
    return sorted(map(tuple, df.select(ENVELOPE.fieldNames()).collect()), key=repr)


SPECS = {
    "dedup": PipelineSpec(mapping={"v": "v"}, ttl_ms=90),
    "threshold": PipelineSpec(threshold=Threshold("v", 2.0)),
    "both": PipelineSpec(match_types=("x",), mapping={"v": "v"}, ttl_ms=90, tags={"k": "t"}, threshold=Threshold("v", 2.0)),
}


@pytest.mark.parametrize("name", SPECS)
@pytest.mark.parametrize("restart", [False, True])
def test_stream_equals_batch(events, spark, tmp_path, name, restart):
    df, spec = events(arrivals(3)), SPECS[name]
    for _ in land(df, str(tmp_path), 3):
        if restart:
            query = follow(spark, str(tmp_path), spec)
    if not restart:
        query = follow(spark, str(tmp_path), spec)
    assert lines(spark.read.parquet(f"{tmp_path}/out")) == lines(run(df, spec))


def test_no_row_is_too_late(events, spark, tmp_path):
    """Five files in reversed time: unique payloads all come out, in batches of one too."""
    rows = [(100_000_000 - i * 60_000, json.dumps(i)) for i in range(200)]
    for _ in land(events(rows), str(tmp_path), 5):
        pass
    follow(spark, str(tmp_path), PipelineSpec(ttl_ms=0, batch=Batch(1, 1000)))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200


def closed(rows, size, interval):
    """Batches of each stream; the last one is stamped with its tick."""
    out = []
    for stream in "ab":
        own = [r for r in rows if r["stream_id"] == stream and r["payload"] != "oops"]
        times = [r["timestamp"] for r in own]
        for at, members in folds.batches(times, size, interval):
            out.append((stream, at, [own[m]["payload"] for m in members]))
        if len(out[-1][2]) < size:
            out.append((stream, open_tick(times, size, interval), out.pop()[2]))
    return sorted(out)


def open_tick(times, size, interval):
    due, pending = times[0] + interval, 0
    for now in times:
        if now >= due:
            pending, due = 0, due + interval * ((now - due) // interval + 1)
        pending += 1
        if pending == size:
            pending, due = 0, now + interval
    return due


@pytest.mark.parametrize("restart", [False, True])
def test_stream_batches(events, spark, tmp_path, restart):
    rows = arrivals(8)
    spec = PipelineSpec(batch=Batch(4, 150))
    for _ in land(events(rows), str(tmp_path), 3):
        if restart:
            follow(spark, str(tmp_path), spec)
    follow(spark, str(tmp_path), spec)
    out = spark.read.parquet(f"{tmp_path}/out").unionByName(open_batches(spark, f"{tmp_path}/checkpoint"))
    got = sorted(
        (r.stream_id, r.timestamp, [json.dumps(m) for m in json.loads(r.payload)])
        for r in out.filter("type like '%_batch'").collect()
    )
    assert got == closed(rows, 4, 150)
    assert out.filter("payload = 'oops'").count() == sum(r["payload"] == "oops" for r in rows)


def test_whole_chain_to_the_log(events, spark, tmp_path):
    rows = arrivals(5)
    df = events(rows)
    for _ in land(df, str(tmp_path), 2):
        pass
    config = SPECS["both"]
    spec = PipelineSpec(**{**config.__dict__, "batch": Batch(3, 10_000_000)})
    arriving = observed(stream_parquet(spark, f"{tmp_path}/in", maxFilesPerTrigger=1), "arrived")
    good, _ = publishable(run_stream(arriving, spec))
    query = start_append(good, f"{tmp_path}/log", f"{tmp_path}/checkpoint", availableNow=True)
    assert query.awaitTermination(240)
    seen = [p["observedMetrics"]["arrived"]["events"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(seen) == len(rows)
    want = run(df, spec).filter(F.size(F.from_json("payload", "array<string>")) == 3)
    stored = spark.read.parquet(f"{tmp_path}/log")
    assert lines(stored) == lines(want) and stored.count() > 5
    assert Path(f"{tmp_path}/log/day=1970-01-01/topic_root=t").is_dir()
