"""Queries of the single stages, chains of them, and the counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import metrics
from millrace.functions import json_text as J
from millrace.operators.batch import batch
from millrace.operators.stateful import dedup, payload_key, threshold
from millrace.operators.stateless import enrich, filter_types, transform
from millrace.plans.many import run_epochs, run_streams
from millrace.plans.pipeline import chain, run, stages
from millrace.plans.spec import PipelineSpec
from millrace.queries.registry import query
from millrace.queries.tables import (
    WIDE_SQL,
    batches_sql,
    cents,
    env_sql,
    held_sql,
    one_stream,
    ordered_sql,
    table,
    type_streams,
    user_events,
    wide_payload,
)

SIX_HOURS = 6 * 3_600_000
DAY = 24 * 3_600_000
# Small enough that even the test tables have streams that are cut.
CUT_ROWS = 2_000
CUT_KEY_ROWS = 50

SHOWN = ["stream_id", "topic", "source", "type", "timestamp", "payload", "seq"]
SHOWN_SQL = ", ".join(SHOWN)


# ---- filter, transform, enrich ----------------------------------------------


@query(f"with {env_sql()} select {SHOWN_SQL} from env where type in ('purchase', 'signup')")
def filter_types_exact(spark, sf_dir):
    return filter_types(user_events(spark, sf_dir), ["purchase", "signup"])


@query(
    f"""with {env_sql()}
    select stream_id, seq, timestamp,
           '{{"cents":' || cents || ',"k":' || k || ',"user":' || user_id || '}}' as payload
    from env"""
)
def transform_flatten(spark, sf_dir):
    mapping = {"cents": "data.cents", "k": "data.props.k", "user": "u"}
    flat = transform(user_events(spark, sf_dir, wide_payload()), mapping)
    return flat.select("stream_id", "seq", "timestamp", "payload")


@query(
    f"""with {env_sql()}
    select seq, case type
        when 'purchase' then '{{"k":' || k || ',"ref":' || seq || '}}'
        when 'view' then '{{"k":' || k || ',"ref":null}}'
        when 'error' then props || ' trailing'
        when 'click' then '[' || props || ']'
        else '{{}}' end as payload
    from env"""
)
def transform_missing(spark, sf_dir):
    """Missing keys are left out, null ones stay, and what is no object stays as it is."""
    props, seq = F.col("props"), F.col("event_id").cast("string")
    payload = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"ref":'), seq, F.lit(',"in":'), props, F.lit("}")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"ref":null,"in":'), props, F.lit("}")))
        .when(F.col("event_type") == "error", F.concat(props, F.lit(" trailing")))
        .when(F.col("event_type") == "click", F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(F.concat(F.lit('{"in":['), props, F.lit("]}")))
    )
    shaped = transform(user_events(spark, sf_dir, payload), {"ref": "ref", "k": "in.k"})
    return shaped.select("seq", "payload")


@query(
    f"""with {env_sql()}
    select seq, case when type = 'error' then type
                     else '{{"env":"prod","k":"hidden","u":' || user_id || '}}' end as payload
    from env"""
)
def enrich_tags(spark, sf_dir):
    user = F.concat(F.lit('{"u":'), F.col("user_id").cast("string"), F.lit(',"k":'), F.get_json_object("props", "$.k"), F.lit("}"))
    payload = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(user)
    tagged = enrich(user_events(spark, sf_dir, payload), {"env": "prod", "k": "hidden"})
    return tagged.select("seq", "payload")


# ---- dedup, threshold, batch ------------------------------------------------

DEDUP_SQL = f"""with recursive {env_sql("'all'")},
    {ordered_sql("env", "payload")},
    {held_sql("timestamp", SIX_HOURS + 1, "payload")}
    select e.seq, e.timestamp, e.payload from e join kept using (payload, rn)"""


@query(DEDUP_SQL)
def dedup_ttl(spark, sf_dir):
    return dedup(one_stream(spark, sf_dir), SIX_HOURS).select("seq", "timestamp", "payload")


@query(DEDUP_SQL)
def dedup_ttl_cut_stream(spark, sf_dir):
    """The same with the stream, and each payload in it, cut into many slices."""
    kept = dedup(one_stream(spark, sf_dir), SIX_HOURS, CUT_KEY_ROWS)
    return kept.select("seq", "timestamp", "payload")


@query(
    f"""with recursive {env_sql()},
    {ordered_sql("env", "stream_id, payload")},
    {held_sql("timestamp", 10 * DAY + 1, "stream_id, payload")}
    select e.stream_id, e.seq from e join kept using (stream_id, payload, rn)"""
)
def dedup_per_stream(spark, sf_dir):
    """Equal payloads of different streams are no duplicates."""
    return dedup(user_events(spark, sf_dir), 10 * DAY).select("stream_id", "seq")


@query(
    f"""with recursive {env_sql()}, {ordered_sql("env")}, {held_sql("cents", 5000)}
    select e.stream_id, e.seq, e.timestamp, e.cents from e join kept using (stream_id, rn)"""
)
def threshold_delta(spark, sf_dir):
    kept = threshold(user_events(spark, sf_dir, wide_payload()), "data.cents", 5000)
    return kept.select(
        "stream_id", "seq", "timestamp", F.get_json_object("payload", "$.data.cents").cast("long").alias("cents")
    )


@query(
    f"""with recursive {env_sql("'all'")}, {ordered_sql("env")}, {held_sql("cents", 15000)}
    select e.seq from e join kept using (stream_id, rn)"""
)
def threshold_cut_stream(spark, sf_dir):
    """One stream for all events, cut into many slices."""
    return threshold(one_stream(spark, sf_dir, wide_payload()), "data.cents", 15000, CUT_ROWS).select("seq")


@query(
    f"""with recursive {env_sql()},
    numbered as (select *, row_number() over (partition by stream_id order by timestamp, seq) as place from env
                 where type in ('click', 'purchase')),
    e as (select *, place as rn from numbered),
    {held_sql("cents", 5000)}
    select stream_id, seq from e join kept using (stream_id, rn)
    union all
    select stream_id, seq from env where type not in ('click', 'purchase')"""
)
def threshold_numeric_text(spark, sf_dir):
    """Numbers and numeric strings are compared; everything else passes without a trace."""
    value = cents().cast("string")
    quoted = F.concat(F.lit('"'), value, F.lit('"'))
    value = (
        F.when(F.col("event_type") == "click", value)
        .when(F.col("event_type") == "purchase", quoted)
        .when(F.col("event_type") == "error", F.concat(F.lit('"'), value, F.lit('d"')))
        .when(F.col("event_type") == "signup", F.lit("true"))
        .otherwise(F.concat(F.lit("["), value, F.lit("]")))
    )
    payload = F.concat(F.lit('{"v":'), value, F.lit("}"))
    return threshold(user_events(spark, sf_dir, payload), "v", 5000).select("stream_id", "seq")


def _batch_columns(df):
    members = F.size(F.from_json("payload", "array<struct<k:bigint>>")).cast("long")
    return df.select("stream_id", "topic", "source", "type", "timestamp", "payload", "seq", members.alias("events"))


@query(
    f"""with {env_sql()},
    placed as (select *, (row_number() over (partition by stream_id order by timestamp, seq) - 1) // 7 as part from env)
    select stream_id, arg_max(topic, (timestamp, seq)) as topic, stream_id as source,
           arg_min(type, (timestamp, seq)) || '_batch' as type, max(timestamp) as timestamp,
           '[' || string_agg(payload, ',' order by timestamp, seq) || ']' as payload,
           arg_min(seq, (timestamp, seq)) as seq, count(*) as events
    from placed group by stream_id, part"""
)
def batch_size(spark, sf_dir):
    """An interval beyond the time covered: only the size closes a batch."""
    return _batch_columns(batch(user_events(spark, sf_dir), 7, 1000 * DAY))


BATCH_COLUMNS = "stream_id, topic, source, type, timestamp, payload, seq, events"


@query(
    f"""with recursive {env_sql()}, {ordered_sql("env")}, {batches_sql(4, DAY)}
    select {BATCH_COLUMNS} from batches"""
)
def batch_size_time(spark, sf_dir):
    return _batch_columns(batch(user_events(spark, sf_dir), 4, DAY))


@query(
    f"""with recursive {env_sql("'all'")}, {ordered_sql("env")}, {batches_sql(60, SIX_HOURS // 2)}
    select {BATCH_COLUMNS} from batches"""
)
def batch_cut_stream(spark, sf_dir):
    """One stream for all events, cut into many slices."""
    return _batch_columns(batch(one_stream(spark, sf_dir), 60, SIX_HOURS // 2, CUT_ROWS))


# ---- whole specs ------------------------------------------------------------

SPEC = {
    "filter": {"match_types": ["click", "purchase", "view"]},
    "transform": {"mapping": {"cents": "data.cents", "k": "data.props.k"}},
    "dedup": {"enabled": True, "ttl": "240h"},
    "enrich": {"tags": {"env": "prod"}},
    "threshold": {"enabled": True, "path": "cents", "delta": 3000},
}
KEY_SPEC = {**SPEC, "transform": {"mapping": {"k": "data.props.k"}}}
del KEY_SPEC["threshold"]


def chain_sql(payload: str, threshold_delta: int | None) -> str:
    """``passed``: what the spec's stages up to the threshold let through; ``cast`` shows each step."""
    limit = f"""t as (select *, row_number() over (partition by stream_id order by timestamp, seq) as rn
                      from deduped),
    {held_sql("cents", threshold_delta, source="t", output="moved")},
    passed as (select t.* exclude (rn) from t join moved using (stream_id, rn))"""
    return f"""{env_sql(payload=payload)},
    filtered as (select * from env where type in ('click', 'purchase', 'view')),
    {ordered_sql("filtered", "stream_id, payload")},
    {held_sql("timestamp", 10 * DAY + 1, "stream_id, payload")},
    deduped as (select e.* exclude (rn) from e join kept using (stream_id, payload, rn)),
    {limit if threshold_delta else "passed as (select * from deduped)"}"""


FLAT_SQL = "'{\"cents\":' || cast(round(value * 100) as bigint) || ',\"k\":' || (props ->> '$.k') || '}'"
SORTED_SQL = "'{\"cents\":' || cents || ',\"env\":\"prod\",\"k\":' || k || '}'"
KEY_SQL = "'{\"k\":' || (props ->> '$.k') || '}'"


@query(
    f"""with recursive {chain_sql(FLAT_SQL, 3000)}
    select stream_id, seq, type, timestamp, {SORTED_SQL} as payload from passed"""
)
def full_chain(spark, sf_dir):
    result = run(user_events(spark, sf_dir, wide_payload()), PipelineSpec.from_dict(SPEC))
    return result.select("stream_id", "seq", "type", "timestamp", "payload")


@query(
    f"""with recursive {chain_sql(KEY_SQL, None)}
    select stream_id, seq, '{{"env":"prod","k":' || k || '}}' as payload from passed"""
)
def dedup_after_transform(spark, sf_dir):
    """Events that differ only in fields the mapping leaves out are duplicates."""
    result = run(user_events(spark, sf_dir, wide_payload()), PipelineSpec.from_dict(KEY_SPEC))
    return result.select("stream_id", "seq", "payload")


@query(
    f"""with recursive {chain_sql(FLAT_SQL, 3000)},
    b as (select * replace ({SORTED_SQL} as payload),
                 row_number() over (partition by stream_id order by timestamp, seq) as rn from passed),
    {batches_sql(5, DAY, source="b")}
    select stream_id, topic, source, type, timestamp, payload, seq from batches"""
)
def full_chain_batched(spark, sf_dir):
    config = {**SPEC, "batch": {"enabled": True, "max_batch_size": 5, "flush_interval": "24h"}}
    return run(user_events(spark, sf_dir, wide_payload()), PipelineSpec.from_dict(config))


@query(
    f"""with {env_sql()}
    select stream_id || '_a_b' as source, seq, '{{"k":' || k || ',"stage":"custom"}}' as payload
    from env where cast(k as bigint) >= 50"""
)
def custom_stages(spark, sf_dir):
    """Stages of one's own around those of a spec: they run in the order listed."""

    def named(text):
        return lambda df: df.withColumn("source", F.concat("source", F.lit(text)))

    def upper_half(df):
        return df.filter(F.get_json_object("payload", "$.k").cast("int") >= 50)

    spec = PipelineSpec(tags={"stage": "custom"})
    result = chain(named("_a"), upper_half, *stages(spec), named("_b"))(user_events(spark, sf_dir))
    return result.select("source", "seq", "payload")


# One spec per stream; the streams are the event types.
STREAM_SPECS = {
    "click": {"dedup": {"enabled": True, "ttl": "48h"}},
    "purchase": {
        "transform": {"mapping": {"cents": "data.cents"}},
        "threshold": {"enabled": True, "path": "cents", "delta": 4000},
    },
    "signup": {"filter": {"match_types": ["view"]}},
    "view": {"enrich": {"tags": {"env": "prod"}}, "transform": {"mapping": {"k": "data.props.k"}}},
}


@query(
    f"""with recursive {env_sql("event_type", WIDE_SQL)},
    {ordered_sql("(select * from env where type = 'purchase')")}, {held_sql("cents", 4000)},
    c as (select *, row_number() over (partition by payload order by timestamp, seq) as rn
          from env where type = 'click'),
    {held_sql("timestamp", 2 * DAY + 1, "payload", source="c", output="once")}
    select seq, payload from env where type = 'error'
    union all select seq, '{{"cents":' || cents || '}}' from e join kept using (stream_id, rn)
    union all select c.seq, c.payload from c join once using (payload, rn)
    union all select seq, '{{"env":"prod","k":' || k || '}}' from env where type = 'view'"""
)
def streams_with_own_specs(spark, sf_dir):
    specs = {stream: PipelineSpec.from_dict(config) for stream, config in STREAM_SPECS.items()}
    return run_streams(type_streams(spark, sf_dir, wide_payload()), specs).select("seq", "payload")


# 2024-01-11 and 2024-01-21, in milliseconds.
FIRST_CHANGE, SECOND_CHANGE = 1_704_931_200_000, 1_705_795_200_000
HISTORY = [
    ("click", None, {"threshold": {"enabled": True, "path": "data.cents", "delta": 3000}}),
    ("click", FIRST_CHANGE, {"threshold": {"enabled": True, "path": "data.cents", "delta": 3000}}),
    ("click", SECOND_CHANGE, {}),
    ("view", FIRST_CHANGE, {"filter": {"match_types": ["other"]}}),
    ("view", SECOND_CHANGE, {"threshold": {"enabled": True, "path": "data.cents", "delta": 9000}}),
]


@query(
    f"""with recursive {env_sql("event_type")},
    history(stream_id, start, epoch, delta) as (values
      ('click', 0, 1, 3000), ('click', {FIRST_CHANGE}, 2, 3000), ('click', {SECOND_CHANGE}, 3, null),
      ('view', {FIRST_CHANGE}, 1, -1), ('view', {SECOND_CHANGE}, 2, 9000)),
    assigned as (select env.*, coalesce(h.epoch, 0) as epoch, h.delta
                 from env asof left join history h
                 on env.stream_id = h.stream_id and env.timestamp >= h.start),
    e as (select *, row_number() over (partition by stream_id, epoch order by timestamp, seq) as rn
          from assigned where delta > 0),
    kept as (
      select stream_id, epoch, rn, cents as held, delta from e where rn = 1
      union all
      select p.stream_id, p.epoch, min(n.rn), arg_min(n.cents, n.rn), p.delta
      from kept p join e n on n.stream_id = p.stream_id and n.epoch = p.epoch and n.rn > p.rn
           and abs(n.cents - p.held) >= p.delta
      group by p.stream_id, p.epoch, p.delta)
    select seq, stream_id, cast(epoch as integer) as epoch from assigned where delta is null
    union all
    select e.seq, e.stream_id, cast(e.epoch as integer) from e join kept using (stream_id, epoch, rn)"""
)
def spec_epochs(spark, sf_dir):
    """Specs that change in the middle: state starts afresh with each change."""
    history = [(stream, start, PipelineSpec.from_dict(config)) for stream, start, config in HISTORY]
    result = run_epochs(type_streams(spark, sf_dir, wide_payload()), history)
    return result.select("seq", "stream_id", "epoch")


# ---- counters ---------------------------------------------------------------


@query(
    f"""with {env_sql()}
    select stream_id, count(*) as events_ingested, cast(sum(octet_length(encode(payload))) as bigint) as bytes_ingested
    from env group by stream_id"""
)
def counters_ingested(spark, sf_dir):
    return metrics.ingested(user_events(spark, sf_dir))


@query(
    f"""with recursive {chain_sql(FLAT_SQL, 3000)}
    select stream_id, 'filter' as stage, count(*) as events_dropped from env
    where type not in ('click', 'purchase', 'view') group by stream_id
    union all
    select stream_id, 'dedup', n from (
      select stream_id, (select count(*) from filtered f where f.stream_id = s.stream_id)
                      - (select count(*) from deduped d where d.stream_id = s.stream_id) as n
      from (select distinct stream_id from env) s) where n > 0
    union all
    select stream_id, 'threshold', n from (
      select stream_id, (select count(*) from deduped f where f.stream_id = s.stream_id)
                      - (select count(*) from passed d where d.stream_id = s.stream_id) as n
      from (select distinct stream_id from env) s) where n > 0"""
)
def counters_dropped(spark, sf_dir):
    fate = run(user_events(spark, sf_dir, wide_payload()), PipelineSpec.from_dict(SPEC), keep_dropped=True)
    return metrics.dropped(fate)


@query(
    f"""with recursive {chain_sql(FLAT_SQL, 3000)}
    select stream_id, count(*) as events_published,
           cast(sum(octet_length(encode({SORTED_SQL}))) as bigint) as bytes_published
    from passed group by stream_id"""
)
def counters_published(spark, sf_dir):
    return metrics.published(run(user_events(spark, sf_dir, wide_payload()), PipelineSpec.from_dict(SPEC)))


REDUCTION_SQL = f"""with recursive {chain_sql(FLAT_SQL, 3000)}, wide as (select event_id as seq, {WIDE_SQL} as raw from events)
    select stream_id, count(*) as events_ingested,
           cast(sum(octet_length(encode(raw))) as bigint) as bytes_ingested,
           count(*) filter (where f.seq is null) as dropped_filter,
           count(*) filter (where f.seq is not null and d.seq is null) as dropped_dedup,
           count(*) filter (where d.seq is not null and p.seq is null) as dropped_threshold,
           count(p.seq) as events_published,
           cast(coalesce(sum(octet_length(encode({SORTED_SQL}))) filter (where p.seq is not null), 0) as bigint)
             as bytes_published
    from env join wide using (seq)
    left join (select seq from filtered) f using (seq)
    left join (select seq from deduped) d using (seq)
    left join (select seq from passed) p using (seq)
    group by stream_id"""


@query(REDUCTION_SQL)
def reduction_report(spark, sf_dir):
    fate = run(user_events(spark, sf_dir, wide_payload()), PipelineSpec.from_dict(SPEC), keep_dropped=True)
    return metrics.reduction(fate)


# ---- scalar functions -------------------------------------------------------


def _spellings(events):
    """Every event's ``props`` in several spellings, some of them not JSON."""
    props, user = F.col("props"), F.col("user_id").cast("string")
    texts = F.array(
        props,
        F.concat(props, F.lit(" x")),
        F.concat(props, F.lit("}")),
        F.concat(props, F.lit(","), props),
        F.concat(F.lit(" ["), user, F.lit(","), props, F.lit("] ")),
        F.concat(F.lit("["), user, F.lit(",")),
        F.col("event_type"),
        F.concat(F.lit('"'), F.col("event_type"), F.lit('"')),
        user,
        F.concat(F.lit("0"), user),
        F.lit(""),
        F.lit("null"),
    )
    return events.select("event_id", F.posexplode(texts).alias("spelling", "text"))


SPELLINGS_SQL = """spelled as (
      select event_id, cast(generate_subscripts(texts, 1) - 1 as integer) as spelling, unnest(texts) as text
      from (select event_id, [props, props || ' x', props || '}', props || ',' || props,
                   ' [' || user_id || ',' || props || '] ', '[' || user_id || ',', event_type,
                   '"' || event_type || '"', cast(user_id as varchar), '0' || user_id, '', 'null'] as texts
            from events))"""


@query(
    f"""with {SPELLINGS_SQL}
    select event_id, spelling, json_valid(text) as valid,
           case when json_valid(text) then text else to_json(text)::varchar end as as_string,
           case when json_valid(text) then text else '{{"data":' || to_json(text) || '}}' end as as_object
    from spelled"""
)
def json_check_and_wrap(spark, sf_dir):
    df = J.with_verdict(_spellings(table(spark, sf_dir, "events")), "text")
    valid = F.col("_whole")
    return df.select(
        "event_id",
        "spelling",
        valid.alias("valid"),
        F.when(valid, F.col("text")).otherwise(J.as_json_string(F.col("text"))).alias("as_string"),
        F.when(valid, F.col("text")).otherwise(J.as_data_object(F.col("text"))).alias("as_object"),
    )


@query(
    """with n as (select event_id, value, cast(round(value * 100) as bigint) as cents from events),
    spelled as (select event_id, cents, unnest(range(10)) as spelling from n)
    select event_id, cast(spelling as integer) as spelling,
           case spelling when 0 then cents when 1 then cents / 100 when 2 then cents when 3 then -cents
                when 4 then cents * 1000.0 end::double as number
    from spelled"""
)
def number_coercion(spark, sf_dir):
    """Numbers and numeric strings become doubles; other spellings do not."""
    n = cents().cast("string")
    hundredths = F.concat(F.floor(cents() / 100).cast("string"), F.lit("."), F.lpad((cents() % 100).cast("string"), 2, "0"))

    def text(*parts):
        return F.concat(F.lit('"'), *parts, F.lit('"'))

    values = F.array(
        n, hundredths, text(n), text(F.lit("-"), n), F.concat(n, F.lit("e3")),
        text(n, F.lit("d")), text(F.lit(" "), n), F.lit("true"), F.concat(F.lit("["), n, F.lit("]")), F.lit("null"),
    )
    spelled = table(spark, sf_dir, "events").select("event_id", F.posexplode(values).alias("spelling", "value"))
    parsed = J.with_document(spelled.withColumn("text", F.concat(F.lit('{"v":'), "value", F.lit("}"))), "text")
    found = parsed.withColumn("_found", J.extract(F.col("_doc"), "v"))
    return found.select("event_id", "spelling", J.number(F.col("_found")).alias("number"))


@query("select doc_id, sha256(text) as digest from documents")
def payload_digest(spark, sf_dir):
    digest = F.lower(F.hex(payload_key(F.col("text"))))
    return table(spark, sf_dir, "documents").select("doc_id", digest.alias("digest"))
