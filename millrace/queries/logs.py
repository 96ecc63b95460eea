"""Queries of the sinks: serialising, quarantine, routing, retention, replay."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.queries.registry import query
from millrace.queries.stages import DAY
from millrace.queries.tables import env_sql, table, user_events
from millrace.session import shared_folder
from millrace.sinks.log import keep_newest, keep_young, replay, routed, unrouted
from millrace.sinks.manifest import append_measured, newest_of
from millrace.sinks.publish import (
    append,
    append_all,
    publishable,
    published,
    quarantined,
    serialised,
    valid_topic,
)
from millrace.sinks.subjects import routed_by_table

MESSAGE_SQL = (
    "'{\"source\":\"' || source || '\",\"type\":\"' || type || '\",\"timestamp\":' || timestamp"
    " || ',\"payload\":' || payload || '}'"
)


@query(f"with {env_sql()} select topic, seq, {MESSAGE_SQL} as message from env")
def publish_messages(spark, sf_dir):
    return serialised(user_events(spark, sf_dir)).select("topic", "seq", "message")


def _damaged(spark, sf_dir):
    """Events whose payload is cut short when they report an error."""
    cut = F.concat(F.col("props"), F.lit("}"))
    return user_events(spark, sf_dir, F.when(F.col("event_type") == "error", cut).otherwise(F.col("props")))


@query(f"with {env_sql()} select stream_id, seq, payload || '}}' as payload from env where type = 'error'")
def publish_quarantine(spark, sf_dir):
    _, bad = publishable(_damaged(spark, sf_dir))
    return bad.select("stream_id", "seq", "payload")


@query(f"with {env_sql()} select seq, {MESSAGE_SQL} as message from env where type <> 'error'")
def publish_accepted(spark, sf_dir):
    good, _ = publishable(_damaged(spark, sf_dir))
    return good.select("seq", "message")


@query(
    f"""with {env_sql()}
    select stream_id, seq, topic, type <> 'error' as published, payload || if(type = 'error', '}}', '') as payload,
           case when type <> 'error' then {MESSAGE_SQL} end as message from env"""
)
def publish_one_pass(spark, sf_dir):
    """Log and quarantine from one write, each read back on its own."""
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    append_all(_damaged(spark, sf_dir), path)
    names = ["stream_id", "seq", "topic", "published", "payload", "message"]
    good = published(spark, path).withColumn("published", F.lit(True)).select(names)
    bad = quarantined(spark, path).withColumn("published", F.lit(False)).select(names)
    return good.unionByName(bad)


@query(
    """select topic, regexp_full_match(topic, '[a-zA-Z0-9._-]+') as valid
       from (select url as topic from pages
             union all select 'web.' || split_part(split_part(url, '//', 2), '/', 1) from pages
             union all select source || '.' || lang from documents
             union all select lang || '.>' from documents)"""
)
def topic_names(spark, sf_dir):
    pages, documents = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    host = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    topics = (
        pages.select(F.col("url").alias("topic"))
        .unionAll(pages.select(F.concat(F.lit("web."), host)))
        .unionAll(documents.select(F.concat_ws(".", "source", "lang")))
        .unionAll(documents.select(F.concat("lang", F.lit(".>"))))
    )
    return topics.select("topic", valid_topic().alias("valid"))


LOGS = {"orders": ["shop.purchase", "shop.*.purchase"], "people": ["shop.signup.>", "shop.signup"], "any": ["*.view", "web.>"]}


@query(
    f"""with {env_sql()}
    select seq, topic, case when regexp_full_match(topic, 'shop(\\.[^.]+)?\\.purchase') then 'orders'
                            when regexp_full_match(topic, 'shop\\.signup(\\.[^.]+)*') then 'people'
                            when regexp_full_match(topic, '[^.]+\\.view|web(\\.[^.]+)+') then 'any' end as log
    from env"""
)
def subject_routing(spark, sf_dir):
    return routed(user_events(spark, sf_dir), LOGS).select("seq", "topic", "log")


@query(
    f"""with {env_sql()}
    select seq, topic from env
    where not regexp_full_match(topic, 'shop(\\.[^.]+)?\\.purchase|shop\\.signup(\\.[^.]+)*|[^.]+\\.view|web(\\.[^.]+)+')"""
)
def routing_quarantine(spark, sf_dir):
    """What no log captures is set aside."""
    return unrouted(user_events(spark, sf_dir), LOGS).select("seq", "topic")


@query(f"with {env_sql()} select seq, topic, timestamp from env where regexp_full_match(topic, 'shop(\\.[^.]+)+') and topic <> 'shop'")
def subject_replay(spark, sf_dir):
    return replay(user_events(spark, sf_dir), "shop.>").select("seq", "topic", "timestamp")


def _patterns(spark, sf_dir):
    """Patterns ``(log, rank, pattern)``, five for each customer: thousands, of every shape."""
    key = F.col("c_custkey").cast("string")
    shapes = [("own", 1, "shop.purchase.u", ""), ("any", 3, "shop.*.u", ""), ("deep", 2, "*.click.u", ".>"), ("late", 4, "shop.view.u", ".*.*"), ("none", 0, "web.u", ".>")]
    shapes = F.array(
        *(
            F.struct(F.lit(log).alias("log"), F.lit(rank).alias("rank"), F.concat(F.lit(head), key, F.lit(tail)).alias("pattern"))
            for log, rank, head, tail in shapes
        )
    )
    customers = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == 0)
    return customers.select(F.explode(shapes).alias("p")).select("p.log", "p.rank", "p.pattern")


@query(
    """with t as (
        select event_id as seq, 'shop.' || event_type || '.u' || user_id ||
               case event_id % 4 when 0 then '' when 1 then '.a' when 2 then '.a.b' else '.a.b.c' end as topic,
               event_type, event_id % 4 as more, c_custkey is not null as known
        from events left join customer on c_custkey = user_id and c_custkey % 2 = 0)
    select seq, topic, case when not known then null
                            when event_type = 'purchase' and more = 0 then 'own'
                            when event_type = 'click' and more > 0 then 'deep'
                            when more = 0 then 'any'
                            when event_type = 'view' and more = 2 then 'late' end as log from t"""
)
def subject_index(spark, sf_dir):
    """Thousands of patterns from a table: every message once, with its log or with none."""
    more = F.element_at(F.array(*(F.lit(t) for t in ("", ".a", ".a.b", ".a.b.c"))), (F.col("event_id") % 4 + 1).cast("int"))
    topic = F.concat(F.lit("shop."), "event_type", F.lit(".u"), F.col("user_id").cast("string"), more)
    messages = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), topic.alias("topic"))
    return routed_by_table(messages, _patterns(spark, sf_dir))


# 2024-01-20, in milliseconds.
NOW = 1_705_708_800_000


@query(f"with {env_sql()} select seq, timestamp from env where timestamp >= {NOW} - {3 * DAY}")
def retention_age(spark, sf_dir):
    return keep_young(user_events(spark, sf_dir), NOW).select("seq", "timestamp")


@query(
    f"""with {env_sql()},
    sized as (select seq, type as log, sum(octet_length(encode({MESSAGE_SQL})))
                over (partition by type order by timestamp desc, seq desc) as upto from env)
    select log, seq from sized where upto <= 50000"""
)
def retention_bytes(spark, sf_dir):
    sized = serialised(user_events(spark, sf_dir)).withColumn("log", F.col("type"))
    return keep_newest(sized, 50_000).select("log", "seq")


@query(
    f"""with {env_sql()},
    sized as (select seq, type as log, sum(octet_length(encode({MESSAGE_SQL})))
                over (partition by type order by timestamp desc, seq desc) as upto from env)
    select log, seq from sized where upto <= 50000"""
)
def retention_manifest(spark, sf_dir):
    """The same of a stored log that was appended to twice: its manifest tells which hours are read."""
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    messages = serialised(user_events(spark, sf_dir)).withColumn("log", F.col("type"))
    for part in (0, 1):
        append_measured(messages.filter(F.col("seq") % 2 == part), path)
    return newest_of(spark, path, 50_000).select("log", "seq")


@query(
    f"""with {env_sql()}
    select cast(strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') as varchar) as day, 'shop' as topic_root,
           topic, seq, {MESSAGE_SQL} as message
    from env where type in ('purchase', 'view')"""
)
def durable_log(spark, sf_dir):
    """Append to a log on disk in two writes and read two topics back."""
    good, _ = publishable(user_events(spark, sf_dir))
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    append(good.filter("type in ('purchase', 'error')"), path)
    append(good.filter("type not in ('purchase', 'error')"), path)
    stored = spark.read.parquet(path)
    found = replay(stored, "shop.purchase").unionByName(replay(stored, "*.view"))
    return found.select(F.col("day").cast("string").alias("day"), "topic_root", "topic", "seq", "message")
