"""Lines in packets, and the blocks they form."""

import hashlib
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.session import DROP_SHUFFLES
from millrace.sources import lines as L
from millrace.sources.sse import sse_events
from test_sources import follow, told

KINDS = ["", "", ": c", "data:{n}", "data:", "data:ä{n}", "data:" + "x" * 700, "event:e{n}", "event:"]


def line(seq, text):
    kinds = {"data": L.DATA, "event": L.NAME}
    kind = L.BLANK if text == "" else kinds.get(text.split(":")[0], L.OTHER)
    said = {L.BLANK: "t", L.OTHER: None}.get(kind, text.partition(":")[2])
    return ("s", "c", seq, kind, said, seq if kind == L.BLANK else None)


@pytest.mark.parametrize("seed", range(40))
def test_packets_equal_fold(monkeypatch, seed):
    """Whatever the order of lines, the size of packets, the slices and the stretches that are opened together."""
    rng = random.Random(seed)
    for name, most in (("PACK_ROWS", 40), ("OPEN_ROWS", 30), ("SMALL", 900), ("LINE_BYTES", 64)):
        monkeypatch.setattr(L, name, rng.randrange(1, most))
    texts = [rng.choice(KINDS).format(n=rng.randrange(50)) for _ in range(rng.choice([1, 30, 400]))]
    rows = [line(i * 3, text) for i, text in enumerate(texts)]
    types = {"seq": pa.int64(), "kind": pa.int8(), "text": pa.string(), "recv_ms": pa.int64()}
    schema = pa.schema([*((name, pa.string()) for name in L.CONNECTION), *types.items()])
    shuffled = rows if seed % 3 == 0 else rng.sample(rows, len(rows))
    arrived = pa.Table.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*shuffled), schema)], schema=schema)
    step = rng.randrange(1, 50)
    packets = list(L.packed(step)(arrived.to_batches(rng.randrange(1, 40))))
    packets = pa.Table.from_batches(packets, packets[0].schema if packets else schema)
    said = [row[2] for row in rows if row[3] != L.OTHER]
    if not said:
        assert not packets.num_rows
        return
    assert max(packets["_to"].to_pylist()) == said[-1] and sum(packets["_n"].to_pylist()) >= len(said)
    marks = [mark for part in packets["_marks"].to_pylist() for mark in part]
    assert sum(mark["n"] for mark in marks) == sum(packets["_n"].to_pylist())
    blanks = {row[2] for row in rows if row[3] == L.BLANK}
    cuts = sorted({mark["at"] for mark in marks if mark["cut"]})
    assert blanks.issuperset(cuts)
    cuts = cuts[:: rng.randrange(1, 4)]
    begin, end = packets["_from"].to_pylist(), packets["_to"].to_pylist()
    slices = [sum(at < b for at in cuts) for b in begin]
    inner = [[at for at in cuts if b <= at < e] for b, e in zip(begin, end)]
    given = [packets[n].combine_chunks() for n in L.CONNECTION]
    given += [pa.array(slices, pa.int64()), packets["_from"].combine_chunks(), pa.array(inner, pa.list_(pa.int64()))]
    given += [packets[n].combine_chunks() for n in ("_lines", "_texts")]
    batch = pa.RecordBatch.from_arrays(given, [*L.CONNECTION, "_slice", "_from", "_inner", "_lines", "_texts"])
    sliced = pa.Table.from_batches(L.cut([batch])).sort_by([("_slice", "ascending"), ("_from", "ascending")])
    batches = sliced.to_batches(rng.randrange(1, 10))
    tails = {row["_slice"]: row for each in L.left(iter(batches)) for row in each.to_pylist()}
    assert sorted(tails) == sorted(set(sliced["_slice"].to_pylist()))
    events, pending = [], {}
    name = None
    for number, row in sorted(tails.items()):
        pending[number] = name
        name = row["_tail"] if row["_seen"] or row["_tail"] is not None else name
    for each in L.finished(iter(batches)):
        for row in each.to_pylist():
            type_ = row["_type"] if row["_type"] is not None else pending[row["_slice"]] if row["_first"] else None
            assert row["seq"] == row["recv_ms"] and row["topic"] == "t"
            events.append((row["seq"], type_ or "sse_message", row["_text"]))
    assert [event[1:] for event in sorted(events)] == list(follow(texts))
    assert len({event[0] for event in events}) == len(events) and {event[0] for event in events} <= blanks


def test_lines_that_arrive_out_of_order(spark):
    """Packets of several partitions overlap in every slice."""
    rng = random.Random(7)
    kinds = ["", "data: {n}", "data: ä{n}", "data:", "event: e{n}", ": c"]
    lines = {f"c{c}": [rng.choice(kinds).format(n=rng.randrange(50)) for _ in range(300 if c < 3 else 9)] for c in range(9)}
    rows = [(c, "t", c, i, i, text) for c, texts in lines.items() for i, text in enumerate(texts)]
    rng.shuffle(rows)
    schema = "stream_id string, topic string, conn_id string, seq long, recv_ms long, line string"
    df = spark.createDataFrame(rows, schema).repartition(7)
    for slice_rows in (1, 40, 1000):
        events = sse_events(df, slice_rows)
        for c, texts in lines.items():
            got = [(t, json.loads(p)["data"] if p.startswith("{") else p) for t, _, p in told(events.filter(F.col("stream_id") == c))]
            assert got == list(follow(texts))


def written(spark):
    """Files of shuffles, and of checkpoints, with their sizes."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [blocks.apply(i).getPath() for i in range(blocks.size())]
    top = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    files += [os.path.join(folder, name) for folder, _, names in os.walk(top.removeprefix("file:")) for name in names]
    return {path: os.path.getsize(path) for path in files if os.path.exists(path)}


def test_lines_take_little_disk(spark):
    """What is shuffled and kept of short lines is less than one and a half times their text, and not a row for each."""
    blocks, each = 100, 4_000
    texts = [[hashlib.md5(f"{b}-{n}".encode()).hexdigest()[:5] for n in range(each)] for b in range(blocks)]
    word = F.substring(F.md5(F.concat_ws("-", "block", "n").cast("binary")), 1, 5)
    numbered = spark.range(blocks, numPartitions=4).select(F.col("id").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(each))).alias("n"))
    lines = numbered.select(
        F.lit("s").alias("stream_id"), F.lit("t").alias("topic"), F.lit("c").alias("conn_id"),
        (F.col("block") * 5_000 + F.col("n")).alias("seq"), F.col("block").alias("recv_ms"),
        F.when(F.col("n") < each, F.concat(F.lit("data: "), word)).otherwise("").alias("line"),
    )
    before = written(spark)
    rows = sse_events(lines, 30_000).select("timestamp", "payload").collect()
    used = sum(size for path, size in written(spark).items() if path not in before)
    assert {row.timestamp: json.loads(row.payload)["data"].split("\n") for row in rows} == dict(enumerate(texts))
    assert used < 1.5 * blocks * each * 6, f"{used / (blocks * each * 6):.2f} bytes a byte of text"


def test_texts_are_not_shuffled_while_their_lines_are(spark):
    """What was shuffled to make the lines is gone once the lines are packed."""
    word = F.substring(F.md5(F.concat_ws("-", "block", "n").cast("binary")), 1, 5)
    numbered = spark.range(50, numPartitions=4).select(F.col("id").alias("block"), F.explode(F.sequence(F.lit(1), F.lit(4_000))).alias("n"))
    blocks = numbered.select("block", F.struct("n", F.concat(F.lit("data: "), word).alias("w")).alias("_w")).repartition(4, "block")
    lines = blocks.groupBy("block").agg(F.sort_array(F.collect_list("_w"))["w"].alias("_lines")).select(
        F.col("block").alias("recv_ms"), F.posexplode(F.concat("_lines", F.array(F.lit("")))).alias("n", "line")
    )
    lines = lines.select(
        F.lit("s").alias("stream_id"), F.lit("t").alias("topic"), F.lit("c").alias("conn_id"),
        (F.col("recv_ms") * 5_000 + F.col("n")).alias("seq"), "recv_ms", "line",
    )
    before = written(spark)
    assert sse_events(lines, 30_000).count() == 50
    left = {path: size for path, size in written(spark).items() if path not in before}
    assert sum(left.values()) < 1.5 * 50 * 4_000 * 6
    assert spark.conf.get(DROP_SHUFFLES) == "false"
