"""The given tables as captures and envelopes, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.envelope import COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(ts: str = "ts") -> Column:
    """Unix milliseconds, rounded down, of a timestamp without time zone."""
    return F.floor(F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', {ts})") / 1000)


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def wide_payload() -> Column:
    """``{"data":{"cents":655,"props":{"k": 69}},"u":8}``"""
    return F.concat(
        F.lit('{"data":{"cents":'),
        cents().cast("string"),
        F.lit(',"props":'),
        F.col("props"),
        F.lit('},"u":'),
        F.col("user_id").cast("string"),
        F.lit("}"),
    )


def event_envelopes(
    events: DataFrame, stream: Column | None = None, payload: Column | None = None
) -> DataFrame:
    """Envelopes of ``events``; by default one stream per user and ``props`` as payload."""
    stream = F.concat(F.lit("user_"), F.col("user_id").cast("string")) if stream is None else stream
    return events.select(
        stream.alias("stream_id"),
        F.concat(F.lit("shop."), F.col("event_type")).alias("topic"),
        stream.alias("source"),
        F.col("event_type").alias("type"),
        millis().alias("timestamp"),
        (F.col("props") if payload is None else payload).alias("payload"),
        F.col("event_id").alias("seq"),
    ).select(COLUMNS)


def user_events(spark: SparkSession, sf_dir: str, payload: Column | None = None) -> DataFrame:
    return event_envelopes(table(spark, sf_dir, "events"), payload=payload)


def one_stream(spark: SparkSession, sf_dir: str, payload: Column | None = None) -> DataFrame:
    return event_envelopes(table(spark, sf_dir, "events"), F.lit("all"), payload)


def type_streams(spark: SparkSession, sf_dir: str, payload: Column | None = None) -> DataFrame:
    return event_envelopes(table(spark, sf_dir, "events"), F.col("event_type"), payload)


# The same in SQL: ``env`` has the columns of the envelope and some to compute with.
def env_sql(stream: str = "'user_' || user_id", payload: str = "props") -> str:
    return f"""env as (
      select {stream} as stream_id, 'shop.' || event_type as topic, {stream} as source,
             event_type as type, epoch_us(ts) // 1000 as timestamp, {payload} as payload,
             event_id as seq, user_id, props, event_type,
             cast(round(value * 100) as bigint) as cents, props ->> '$.k' as k
      from events)"""


WIDE_SQL = (
    "'{\"data\":{\"cents\":' || cast(round(value * 100) as bigint) || ',\"props\":' || props"
    " || '},\"u\":' || user_id || '}'"
)


def ordered_sql(source: str, keys: str = "stream_id") -> str:
    """``e``: rows of ``source`` with their place ``rn`` in order per ``keys``."""
    return f"""e as (
      select *, row_number() over (partition by {keys} order by timestamp, seq) as rn from {source})"""


def held_sql(value: str, delta, keys: str = "stream_id", source: str = "e", output: str = "kept") -> str:
    """``output``: keys and ``rn`` of the rows that the hold rule keeps, one step per kept row."""
    names = [name.strip() for name in keys.split(",")]
    same = " and ".join(f"n.{name} = p.{name}" for name in names)
    carried = ", ".join(f"p.{name}" for name in names)
    return f"""{output} as (
      select {keys}, rn, {value} as held from {source} where rn = 1
      union all
      select {carried}, min(n.rn), arg_min(n.{value}, n.rn)
      from {output} p join {source} n on {same} and n.rn > p.rn and abs(n.{value} - p.held) >= {delta}
      group by {carried})"""


def batches_sql(size: int, interval: int, source: str = "e", keys: str = "stream_id") -> str:
    """``batches``: one row per batch with its members aggregated, one step per batch."""
    names = [name.strip() for name in keys.split(",")]

    def same(left: str, right: str) -> str:
        return " and ".join(f"{left}.{name} = {right}.{name}" for name in names)

    carried = ", ".join(f"b.{name}" for name in names)
    due = f"b.origin + {interval} * ((f.timestamp - b.origin) // {interval} + 1)"
    return f"""opened as (
      select {keys}, cast(1 as bigint) as first_rn, timestamp as origin from {source} where rn = 1
      union all
      select {keys}, first_rn + n, case when n = {size} then last_time else origin end
      from (select {carried}, b.first_rn, b.origin, count(*) as n, max(m.timestamp) as last_time
            from opened b
            join {source} f on {same("f", "b")} and f.rn = b.first_rn
            join {source} m on {same("m", "b")} and m.rn between b.first_rn and b.first_rn + {size} - 1
                 and m.timestamp < {due}
            group by {carried}, b.first_rn, b.origin)),
    lasts as (select {keys}, max(rn) as last_rn from {source} group by {keys}),
    batches as (
      select {carried}, any_value(f.source) as source, any_value(f.type) || '_batch' as type,
             arg_max(m.topic, m.rn) as topic, any_value(f.seq) as seq, count(*) as events,
             '[' || string_agg(m.payload, ',' order by m.rn) || ']' as payload,
             case when count(*) = {size} or max(m.rn) = any_value(l.last_rn) then max(m.timestamp)
                  else any_value({due}) end as timestamp,
             any_value({due}) as due, max(m.rn) = any_value(l.last_rn) as is_last
      from opened b
      join lasts l on {same("l", "b")}
      join {source} f on {same("f", "b")} and f.rn = b.first_rn
      join {source} m on {same("m", "b")} and m.rn between b.first_rn and b.first_rn + {size} - 1
           and m.timestamp < {due}
      group by {carried}, b.first_rn)"""
