"""Captures to envelopes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import json_text as J
from millrace.sources.captures import (
    grpc_events,
    grpc_processed,
    rest_events,
    webhook_events,
    webhook_outcomes,
    websocket_events,
)
from millrace.sources.dispatch import collect_events, normaliser
from millrace.sinks.publish import BEYOND_LIMITS, refusals, serialised
from millrace.sources.sse import sse_events
from millrace.sources.stored import from_json_lines

BASE = "stream_id string, topic string, seq long, recv_ms long, "


def capture(spark, columns, rows):
    return spark.createDataFrame([("s", "t.x", i, 1000 + i, *row) for i, row in enumerate(rows)], BASE + columns)


def told(df):
    return [(r.type, r.timestamp, r.payload) for r in df.orderBy("seq").collect()]


def test_websocket(spark):
    df = capture(spark, "conn_id string, frame string", [("c", '{"price":100}'), ("c", "junk")])
    assert told(websocket_events(df)) == [
        ("websocket_message", 1000, '{"price":100}'),
        ("websocket_message", 1001, "junk"),
    ]
    assert websocket_events(df).first().source == "s"


def test_rest(spark):
    rows = [(200, '{"a":1}'), (299, "plain \"text\"\n"), (500, "{}"), (204, ""), (300, "{}"), (201, "[1,2]"), (200, None)]
    got = told(rest_events(capture(spark, "status int, body string", rows)))
    assert got == [
        ("rest_poller_response", 1000, '{"a":1}'),
        ("rest_poller_response", 1001, json.dumps("plain \"text\"\n")),
        ("rest_poller_response", 1005, "[1,2]"),
    ]


def nested(depth, closed=None):
    return "[" * depth + "]" * (depth if closed is None else closed)


def test_texts_the_parser_refuses(spark):
    """What is beyond its limits is set aside as it stands, and counted; other texts that are no JSON are wrapped."""
    key = "k" * 60_000
    beyond, no_json, whole = BEYOND_LIMITS, "wrapped", None
    texts = {
        nested(999): whole, nested(1000): beyond, nested(1100, 1099): beyond, nested(10_001): beyond,
        '{"a":' * 1100 + '"]\\""' + "}" * 1100: beyond, '{"a" : [ 1,' * 400 + "null" + "] }" * 400: whole,
        "7" * 1000: whole, "7" * 1500: beyond, "-1." + "7" * 1500 + "e-5": beyond, "0" + "7" * 800: no_json,
        f'{{"{key[:40_000]}":[true]}}': whole, f'{{"{key[:40_000]}":[true,]}}': no_json, "[plain text": no_json, "[" * 300: no_json,
        "see " + "[" * 2000: no_json,
    }
    events = serialised(rest_events(capture(spark, "status int, body string", [(200, text) for text in texts])))
    rows = events.orderBy("seq").collect()
    assert [r.refused for r in rows] == [None if why in (whole, no_json) else why for why in texts.values()]
    assert [r.payload for r in rows] == [json.dumps(t) if why == no_json else t for t, why in texts.items()]
    assert [r.message is None for r in rows] == [why == beyond for why in texts.values()]
    assert [tuple(r) for r in refusals(events.filter("message is null")).collect()] == [("s", BEYOND_LIMITS, 6)]


def test_sse_with_sparse_numbers(spark):
    """Slices hold counted lines, however far apart their numbers are."""
    lines = ["event: a", "data: 1", "", "data: 2", "", "", "event: b", "", "data: 3", "", "data: open"]
    rows = [("s", "t.x", i**9, i, "c", line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, BASE + "conn_id string, line string")
    for slice_rows in (1, 3, 100):
        assert [(t, p) for t, _, p in told(sse_events(df, slice_rows))] == [("a", "1"), ("sse_message", "2"), ("b", "3")]


def test_webhook(spark):
    good = "Bearer k7-open-door"
    big = "x" * (5 * 1024 * 1024)
    rows = [
        ("POST", good, '{"a":1}'),
        ("POST", None, "{}"),
        ("POST", "Bearer wrong", "{}"),
        ("GET", good, "{}"),
        ("POST", good, ""),
        ("POST", good, "text"),
        ("POST", "bearer k7-open-door", "{}"),
        ("POST", good, big),
        ("POST", good, big + "x"),
        ("GET", None, ""),
        ("POST", good, None),
    ]
    df = capture(spark, "method string, authorization string, body string", rows)
    outcome = [r.status for r in webhook_outcomes(df, "k7-open-door").orderBy("seq").collect()]
    assert outcome == [202, 401, 401, 405, 400, 202, 401, 202, 400, 405, 400]
    events = told(webhook_events(df, "k7-open-door"))
    assert [t for _, t, _ in events] == [1000, 1005, 1007]
    assert events[1] == ("webhook_recv", 1005, '"text"')
    open_ = [r.status for r in webhook_outcomes(df).orderBy("seq").collect()]
    assert open_ == [202, 202, 202, 405, 400, 202, 202, 202, 400, 405, 400]


def test_grpc(spark):
    rows = [("c1", "type1", b'{"key":"value1"}'), ("c1", "type2", b'{"key":"value2"}'), ("c2", "", b"raw")]
    df = capture(spark, "call_id string, type string, payload binary", rows)
    assert [(t, p) for t, _, p in told(grpc_events(df))] == [
        ("type1", '{"key":"value1"}'),
        ("type2", '{"key":"value2"}'),
        ("", "raw"),
    ]
    assert {(r.call_id, r.processed_count) for r in grpc_processed(df).collect()} == {("c1", 2), ("c2", 1)}


def test_dispatch(spark):
    frames = capture(spark, "conn_id string, frame string", [("c", "1")])
    responses = capture(spark, "status int, body string", [(200, "{}")])
    both = collect_events({"websocket": frames, "rest_poller": responses})
    assert {r.type for r in both.collect()} == {"websocket_message", "rest_poller_response"}
    with pytest.raises(ValueError):
        normaliser("carrier_pigeon")


def test_json_lines(spark):
    lines = [
        '{"source":"s","type":"e","timestamp":1700000000000,"payload":{"price":"42000.50"}}',
        '{"source":"s","type":"e","timestamp":1,"payload":null}',
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [tuple(r) for r in from_json_lines(df).collect()] == [
        ("s", "e", 1700000000000, '{"price":"42000.50"}'),
        ("s", "e", 1, "null"),
    ]


def sse(spark, lines, slice_rows=1_000_000):
    rows = [(conn, line) for conn, text in lines.items() for line in text]
    df = capture(spark, "conn_id string, line string", rows)
    return [(t, p) for t, _, p in told(sse_events(df, slice_rows))]


def test_sse_cases(spark):
    lines = [
        "event: custom_event", 'data: {"foo":"bar"}', "",
        'data: {"msg":"hello"}', "",
        "data: {", 'data: "multi":"line"}', "",
        ": comment", "id: 7", "retry: 10", "",
        "event:  kept \t", "", "data: plain", "data:  two", "",
        "data:", "data:x", "", "data:", "",
        "event: a", "event: b", "data: 1", "",
        "event: a", "event:", "data: 2", "\r",
        "event: lost", "data: unfinished",
    ]
    assert sse(spark, {"c": lines}) == [
        ("custom_event", '{"foo":"bar"}'),
        ("sse_message", '{"msg":"hello"}'),
        ("sse_message", '{\n"multi":"line"}'),
        ("kept", '{"data":"plain\\n two"}'),
        ("sse_message", '{"data":"x"}'),
        ("b", "1"),
        ("sse_message", "2"),
    ]


def follow(lines):
    """Line by line, what a connection yields."""
    name, data = "", ""
    for line in lines:
        if line == "":
            if data:
                yield name or "sse_message", data
                name, data = "", ""
        elif line.startswith("event:"):
            name = line[6:].strip()
        elif line.startswith("data:"):
            text = line[5:]
            text = text[1:] if text.startswith(" ") else text
            data = data + "\n" + text if data else text


@pytest.mark.parametrize("slice_rows", [1_000_000, 7, 1])
def test_sse_equals_fold(spark, slice_rows):
    rng = random.Random(4)
    kinds = ["", "", "data: {n}", "data:", "data:{n}", "event: e{n}", "event:", ": c", "id: 3"]
    lines = {
        f"c{c}": [rng.choice(kinds).format(n=rng.randrange(50)) for _ in range(rng.choice([5, 60, 300]))]
        for c in range(12)
    }
    want = [pair for text in lines.values() for pair in follow(text)]
    got = [
        (t, json.loads(p)["data"] if p.startswith("{") else p) for t, p in sse(spark, lines, slice_rows)
    ]
    assert got == want


def test_lines_are_shuffled_once(spark):
    """Blocks are put together where their slices are, and what they become reads no line again."""
    schema = "stream_id string, topic string, conn_id string, seq long, recv_ms long, line string"
    rows = [("s", "t", "c", i, i, "" if i % 5 == 4 else f"data: {i}") for i in range(60)]
    events = sse_events(spark.createDataFrame(rows, schema), slice_rows=7)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert "_data" not in plan and events.count() == 12
    assert sorted(row.seq for row in events.collect()) == list(range(4, 60, 5))


def test_judged_down_to_a_depth(spark):
    """With a depth no text is set aside: JSON stays as it is, however long its numbers, all else is wrapped."""
    texts = {
        nested(1000): True, nested(1100, 1099): False, nested(1100, 1101): False, nested(10_000): True, nested(10_001): False,
        '{"a":' * 1100 + '"]\\""' + "}" * 1100: True, '{"a":' * 1100 + '"\\q"' + "}" * 1100: False,
        '{"a" : [ 1,' * 600 + "null" + "] }" * 600: True, '{"a" : [ 1,' * 600 + "nul" + "] }" * 600: False,
        "7" * 1500: True, "0" + "7" * 1500: False, "-1." + "7" * 1500 + "e-5": True, "1." + "7" * 1500 + ".5": False,
        '{"a":1}': True, " [1, 2]\r\n": True, '{"a":1,"a":2}': True, '{"a":1} x': False, "1 // c": False, "1,2": False, "1] x": False,
        "01": False, "NaN": False, "[NaN]": False, "['a']": False, '{"a":1}}': False, "[1": False, "[1,]": False, '"\t"': False,
        '1,"x":2': False, '1},"x":{"y":2': False, '1],"x":[2': False, '1}},"h":1}': False, '1,"h":5}': False, '"x': False,
        '"x\\': False, "1}": False, '{"a":1},{"b":2}': False, '{},"b":[{}': False, "true": True, "truefalse": False, "-": False,
    }
    events = rest_events(capture(spark, "status int, body string", [(200, text) for text in texts]), 10_000)
    got = [payload for _, _, payload in told(events)]
    assert got == [text if whole else json.dumps(text) for text, whole in texts.items()]


def test_strings_are_quoted_alike(spark):
    """Single values are told by their spelling, and a wrapped text reads back as itself, control characters and all."""
    singles = {
        '"ä \U0001f600"': True, '"a\\u0041"': True, '"\\x"': False, '"a\\': False, '"a"b"': False, '"\\""': True, '"\x01"': False,
        "-0": True, "0.5e+10": True, "1.": False, ".5": False, "+1": False, "-01": False, "1e": False, "\tnull\n": True, "nul": False,
    }
    df = spark.createDataFrame([(text,) for text in [*singles, None, "", "\\", '"', "\x00\x1f\x7f\t\r\n/< "]], "text string")
    rows = J.with_verdict(df, "text").select("*", J.as_json_string(F.col("text")).alias("as_string")).collect()
    assert {r.text: r._whole for r in rows if r.text in singles} == singles
    for r in rows:
        assert (None if r.as_string is None else json.loads(r.as_string)) == r.text
