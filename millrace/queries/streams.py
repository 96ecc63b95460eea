"""Queries that run as streams: all files there are, then the result is read back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from millrace import metrics
from millrace.plans.many import run_history
from millrace.plans.spec import Batch, PipelineSpec, Threshold
from millrace.queries.feeds import SSE_SQL, sse_lines, turns
from millrace.queries.registry import query
from millrace.queries.stages import (
    DAY,
    FIRST_CHANGE,
    FLAT_SQL,
    REDUCTION_SQL,
    SECOND_CHANGE,
    SIX_HOURS,
    SORTED_SQL,
    SPEC,
    chain_sql,
)
from millrace.queries.tables import (
    WIDE_SQL,
    batches_sql,
    env_sql,
    event_envelopes,
    held_sql,
    ordered_sql,
    table,
    type_streams,
    user_events,
    wide_payload,
)
from millrace.session import shared_folder
from millrace.sinks.publish import publishable, start_append, start_fates, with_partitions
from millrace.streaming.custom import stateful, stream_chain, stream_stages
from millrace.streaming.epochs import run_stream_specs, stream_fate
from millrace.streaming.pipeline import run_stream
from millrace.streaming.sse import stream_sse_events
from millrace.streaming.stages import open_batches


#: Files that the events land in, and the rows from which on there are more of them.
FILES, FILE_ROWS = 5, 2_000_000

#: Tasks that work on the rows of a file, which one task reads.
SHARES = 16


def _arriving(spark, sf_dir, backwards=False, **columns):
    """The events as a stream: files of successive times, each of which is a micro-batch."""
    events = table(spark, sf_dir, "events")
    parts = max(FILES, events.count() // FILE_ROWS)
    edges = events.select(F.percentile_approx("event_id", [i / parts for i in range(1, parts)])).first()[0] or []
    part = F.size(F.filter(F.lit(edges) if edges else F.array().cast("array<bigint>"), lambda edge: F.col("event_id") > edge))
    staged, landed = (f"{shared_folder(spark)}/events-{uuid.uuid4().hex}" for _ in range(2))
    # One pass deals the events out; each file is then copied from its own part alone.
    events.withColumn("_part", part).write.partitionBy("_part").parquet(staged)
    order = range(parts - 1, -1, -1) if backwards else range(parts)
    for place, number in enumerate(order):
        own = spark.read.parquet(staged).filter(F.col("_part") == number).drop("_part")
        own.coalesce(1).write.parquet(f"{landed}/{place}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{landed}/*")
    return event_envelopes(stream.repartition(SHARES, "event_id"), **columns)


def _drained(spark, stream):
    """What the stream has appended to its log once all files are through, and batches left open."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    messages, _ = publishable(stream)
    query = start_append(messages, f"{folder}/log", f"{folder}/checkpoint", availableNow=True)
    query.awaitTermination()
    log = spark.read.parquet(f"{folder}/log")
    tail, _ = publishable(open_batches(spark, f"{folder}/checkpoint"))
    return log.unionByName(with_partitions(tail), allowMissingColumns=True)


@query(
    f"""with recursive {env_sql("'all'")}, {ordered_sql("env", "payload")},
    {held_sql("timestamp", SIX_HOURS + 1, "payload")}
    select e.seq, e.payload from e join kept using (payload, rn)"""
)
def stream_dedup(spark, sf_dir):
    stream = run_stream(_arriving(spark, sf_dir, stream=F.lit("all")), PipelineSpec(ttl_ms=SIX_HOURS))
    return _drained(spark, stream).select("seq", "payload")


@query(
    f"""with recursive {env_sql()}, {ordered_sql("env")}, {held_sql("cents", 5000)}
    select e.stream_id, e.seq from e join kept using (stream_id, rn)"""
)
def stream_threshold(spark, sf_dir):
    spec = PipelineSpec(threshold=Threshold("data.cents", 5000))
    stream = run_stream(_arriving(spark, sf_dir, payload=wide_payload()), spec)
    return _drained(spark, stream).select("stream_id", "seq")


@query(
    f"""with recursive {env_sql()}, {ordered_sql("env")}, {batches_sql(4, DAY)}
    select stream_id, topic, type, payload, seq,
           case when events = 4 then timestamp else due end as timestamp
    from batches"""
)
def stream_batch(spark, sf_dir):
    """All batches, also those that are still open when the files end."""
    stream = run_stream(_arriving(spark, sf_dir), PipelineSpec(batch=Batch(4, DAY)))
    return _drained(spark, stream).select("stream_id", "topic", "type", "payload", "seq", "timestamp")


@query(
    f"""with recursive {chain_sql(FLAT_SQL, 3000)}
    select stream_id, seq, type, timestamp, {SORTED_SQL} as payload from passed"""
)
def stream_full_chain(spark, sf_dir):
    stream = run_stream(_arriving(spark, sf_dir, payload=wide_payload()), PipelineSpec.from_dict(SPEC))
    return _drained(spark, stream).select("stream_id", "seq", "type", "timestamp", "payload")


@query("""select event_id as seq, '[{"id":' || event_id || '}]' as payload from events""")
def stream_out_of_order(spark, sf_dir):
    """Files in reversed time through dedup and batches of one: every event comes out."""
    payload = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit("}"))
    stream = _arriving(spark, sf_dir, backwards=True, stream=F.lit("all"), payload=payload)
    return _drained(spark, run_stream(stream, PipelineSpec(ttl_ms=0, batch=Batch(1, DAY)))).select("seq", "payload")


# A spec for each user's stream, by the user's number; in JSON as a control stream or a table has it.
KINDS = [
    {"transform": {"mapping": {"k": "data.props.k"}}, "dedup": {"enabled": True, "ttl": "240h"}},
    {"threshold": {"enabled": True, "path": "data.cents", "delta": 5000}},
    {"filter": {"match_types": ["view", "click"]}},
    {"enrich": {"tags": {"env": "prod"}}, "transform": {"mapping": {"k": "data.props.k"}}},
]


def user_specs(spark, sf_dir):
    """Changes ``(stream_id, effective_ms, spec)``: one for every user but each fifth."""
    users = table(spark, sf_dir, "events").select("user_id").distinct().filter(F.col("user_id") % 5 != 4)
    kinds = F.array(*(F.lit(json.dumps(kind)) for kind in KINDS))
    return users.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("stream_id"),
        F.lit(None).cast("long").alias("effective_ms"),
        F.element_at(kinds, (F.col("user_id") % 5 + 1).cast("int")).alias("spec"),
    )


USER_SPECS_SQL = f"""with recursive {env_sql(payload=WIDE_SQL)},
    d as (select *, row_number() over (partition by stream_id, k order by timestamp, seq) as rn from env where user_id % 5 = 0),
    {held_sql("timestamp", 10 * DAY + 1, "stream_id, k", source="d", output="once")},
    {ordered_sql("(select * from env where user_id % 5 = 1)")}, {held_sql("cents", 5000)}
    select d.seq, '{{"k":' || d.k || '}}' as payload from d join once using (stream_id, k, rn)
    union all select e.seq, e.payload from e join kept using (stream_id, rn)
    union all select seq, payload from env where user_id % 5 = 2 and type in ('view', 'click')
    union all select seq, '{{"env":"prod","k":' || k || '}}' from env where user_id % 5 = 3
    union all select seq, payload from env where user_id % 5 = 4"""


@query(USER_SPECS_SQL)
def specs_from_table(spark, sf_dir):
    """One spec per user, from a table that has a row for each."""
    return run_history(user_events(spark, sf_dir, wide_payload()), user_specs(spark, sf_dir)).select("seq", "payload")


def _changing(spark, changes):
    """Changes as a stream of one file."""
    landed = f"{shared_folder(spark)}/specs-{uuid.uuid4().hex}"
    changes.coalesce(1).write.parquet(landed)
    return spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(landed)


@query(USER_SPECS_SQL)
def stream_own_specs(spark, sf_dir):
    """The same on streams: the specs arrive with the first events."""
    events = _arriving(spark, sf_dir, payload=wide_payload())
    return _drained(spark, run_stream_specs(events, _changing(spark, user_specs(spark, sf_dir)))).select("seq", "payload")


# What every type's stream goes through: dedup, then dedup and batches, then batches alone, then nothing.
TYPE_CHANGES = [
    (None, {"transform": {"mapping": {"k": "data.props.k"}}, "dedup": {"enabled": True, "ttl": "48h"}}),
    (FIRST_CHANGE, {
        "transform": {"mapping": {"k": "data.props.k"}},
        "dedup": {"enabled": True, "ttl": "48h"},
        "batch": {"enabled": True, "max_batch_size": 7, "flush_interval": "2h"},
    }),
    (FIRST_CHANGE + 3 * DAY, {"batch": {"enabled": True, "max_batch_size": 5, "flush_interval": "1h"}}),
    (SECOND_CHANGE, {}),
]


def type_changes(spark, sf_dir):
    """TYPE_CHANGES for every stream that there is, but for ``error``."""
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("stream_id")).distinct().filter("stream_id <> 'error'")
    entries = F.array(
        *(F.struct(F.lit(at).cast("long").alias("effective_ms"), F.lit(json.dumps(spec)).alias("spec")) for at, spec in TYPE_CHANGES)
    )
    return types.select("stream_id", F.explode(entries).alias("c")).select("stream_id", "c.effective_ms", "c.spec")


TYPE_CHANGES_SQL = f"""with recursive {env_sql("event_type", WIDE_SQL)},
    assigned as (select * replace (case when epoch in (1, 2) then '{{"k":' || k || '}}' else payload end as payload) from (
        select *, case when type = 'error' then 0 when timestamp < {FIRST_CHANGE} then 1 when timestamp < {FIRST_CHANGE + 3 * DAY} then 2
                  when timestamp < {SECOND_CHANGE} then 3 else 4 end as epoch from env)),
    d as (select *, row_number() over (partition by stream_id, epoch, k order by timestamp, seq) as rn from assigned where epoch in (1, 2)),
    {held_sql("timestamp", 2 * DAY + 1, "stream_id, epoch, k", source="d", output="once")},
    kept as (select d.* exclude (rn) from d join once using (stream_id, epoch, k, rn)),
    two as (select *, row_number() over (partition by stream_id order by timestamp, seq) as rn from kept where epoch = 2),
    three as (select *, row_number() over (partition by stream_id order by timestamp, seq) as rn from assigned where epoch = 3),
    sized_two as (with recursive {batches_sql(7, 2 * 3_600_000, source="two")} select * from batches),
    sized_three as (with recursive {batches_sql(5, 3_600_000, source="three")} select * from batches)
    select stream_id, topic, type, timestamp, payload, seq, cast(epoch as integer) as epoch from kept where epoch = 1
    union all select stream_id, topic, type, timestamp, payload, seq, 2 from sized_two
    union all select stream_id, topic, type, timestamp, payload, seq, 3 from sized_three
    union all select stream_id, topic, type, timestamp, payload, seq, cast(epoch as integer) from assigned where epoch in (0, 4)"""
CHANGED = ["stream_id", "topic", "type", "timestamp", "payload", "seq", "epoch"]


@query(TYPE_CHANGES_SQL)
def spec_history(spark, sf_dir):
    """A table of changes: transform, dedup and batches across them."""
    return run_history(type_streams(spark, sf_dir, wide_payload()), type_changes(spark, sf_dir)).select(CHANGED)


@query(TYPE_CHANGES_SQL)
def stream_spec_epochs(spark, sf_dir):
    """The same on streams: all changes arrive before they take effect."""
    events = _arriving(spark, sf_dir, stream=F.col("event_type"), payload=wide_payload())
    stream = run_stream_specs(events, _changing(spark, type_changes(spark, sf_dir)))
    return _drained(spark, stream).select(CHANGED)


@query(SSE_SQL)
def stream_sse(spark, sf_dir):
    """Lines in files that cut blocks anywhere, and every connection many times."""
    lines = sse_lines(spark, sf_dir)
    folders = [f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}" for _ in range(2)]
    part = F.floor(F.least(F.col("seq"), F.lit(27)) / 7)
    lines.withColumn("_part", part).write.partitionBy("_part").parquet(folders[0])
    for number in range(4):
        own = spark.read.parquet(folders[0]).filter(F.col("_part") == number).drop("_part")
        own.select(lines.columns).coalesce(1).write.parquet(f"{folders[1]}/{number}")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{folders[1]}/*")
    return turns(_drained(spark, stream_sse_events(stream)))


@query(REDUCTION_SQL)
def stream_reduction_report(spark, sf_dir):
    """The fate of every event of a stream, told by one query, summed up."""
    events = _arriving(spark, sf_dir, payload=wide_payload())
    folder = f"{shared_folder(spark)}/fate-{uuid.uuid4().hex}"
    query = start_fates(stream_fate(events, PipelineSpec.from_dict(SPEC)), f"{folder}/fate", f"{folder}/checkpoint", availableNow=True)
    query.awaitTermination()
    return metrics.reduction(spark.read.parquet(f"{folder}/fate"))


def _every_third(state, event):
    """Lets each third event of a stream through, with its number as the sequence number."""
    count = (state[0] if state else 0) + 1
    return (count,), [event | {"seq": count}] if count % 3 == 0 else []


@query(
    f"""with recursive {env_sql()}, {ordered_sql("(select * from env where cast(k as bigint) >= 30)")}
    select stream_id, source || '_a' as source, rn as seq, '{{"k":' || k || ',"stage":"custom"}}' as payload
    from e where rn % 3 = 0"""
)
def stream_custom_stages(spark, sf_dir):
    """Stages of one's own around those of a spec, one of them with state."""

    def named(df):
        return df.withColumn("source", F.concat("source", F.lit("_a")))

    def larger(df):
        return df.filter(F.get_json_object("payload", "$.k").cast("int") >= 30)

    spec = PipelineSpec(tags={"stage": "custom"})
    chain = stream_chain(larger, named, *stream_stages(spec), stateful("third", "seen bigint", _every_third))
    return _drained(spark, chain(_arriving(spark, sf_dir))).select("stream_id", "source", "seq", "payload")
