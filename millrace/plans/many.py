"""Many streams, each with its own spec, and specs that change over time.

The settings travel as columns next to the events, so one job conditions all
streams whatever the number of specs: nothing in the plan grows with it. Specs come
as a list, or as a table of changes that never passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import json_text as J
from millrace.operators.slices import BROADCAST_ROWS, LOWEST, MAX_ROWS, bounded_join, plan_slices, with_slices
from millrace.operators.stateful import payload_key
from millrace.operators.stateless import shaped
from millrace.plans.pipeline import condition, payload_bytes
from millrace.plans.spec import PipelineSpec
from millrace.session import checkpointed

SETTINGS = (
    "struct<types:array<string>,mapping:map<string,string>,ttl:bigint,tags:map<string,string>,"
    "path:string,delta:double,size:bigint,interval:bigint>"
)


def run_streams(
    df: DataFrame,
    specs: dict[str, PipelineSpec],
    keep_dropped: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Apply to each stream the spec under its id; streams without one pass unchanged."""
    history = [(stream, None, spec) for stream, spec in specs.items()]
    return run_epochs(df, history, keep_dropped, max_rows).drop("epoch")


def run_epochs(
    df: DataFrame,
    history: list[tuple[str, int | None, PipelineSpec]],
    keep_dropped: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Apply to each event the spec in force at its time.

    ``history`` holds ``(stream_id, effective_ms, spec)``; ``None`` is the
    beginning of time. Every change starts a new ``epoch`` of its stream: state
    begins afresh and an open batch ends.
    """
    specs = [spec for _, _, spec in history]
    used = {
        "ttl": any(spec.ttl_ms is not None for spec in specs),
        "delta": any(spec.threshold for spec in specs),
        "size": any(spec.batch for spec in specs),
    }
    return _conditioned(_with_settings(df, history), used, keep_dropped, max_rows)


def run_history(
    df: DataFrame,
    history: DataFrame,
    keep_dropped: bool = False,
    max_rows: int = MAX_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``run_epochs`` with the changes as a table ``(stream_id, effective_ms, spec)``, the spec as JSON text.

    A NULL time is the beginning of time, a NULL or empty spec has no stages. Changes of one
    moment take effect in the order of their texts, so the last of them counts. A spec that cannot
    be read changes nothing; ``unreadable`` finds those. Up to ``broadcast_rows`` changes are broadcast.
    More of them are sorted in among the events of their streams, and heavy streams are cut by
    time for it.
    """
    changes = checkpointed(changes_of(history))
    found = changes.agg(
        F.count("*").alias("n"), *(F.coalesce(F.max(F.col(f"_set.{name}").isNotNull()), F.lit(False)).alias(name) for name in ("ttl", "delta", "size"))
    ).first()
    used = {name: found[name] for name in ("ttl", "delta", "size")}
    if found.n <= broadcast_rows:
        entry = F.array_sort(F.collect_list(F.struct("epoch", "effective", "told")))
        known = changes.groupBy("stream_id").agg(entry.alias("_all"))
        sets = F.transform("_all", lambda entry: F.from_json(entry["told"], SETTINGS))
        known = known.select("stream_id", F.col("_all.effective").alias("_starts"), sets.alias("_sets"))
        rows = _reached(df.join(F.broadcast(known), "stream_id", "left"))
    else:
        rows = _in_force(df, changes, max_rows)
    return _conditioned(rows, used, keep_dropped, max_rows)


def changes_of(history: DataFrame) -> DataFrame:
    """stream_id, effective, epoch (from 1 in each stream) and settings, as text ``told`` and as ``_set``, of the readable specs of a history."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = pa.array([settings_text(text) for text in batch.column("spec").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, told], [*batch.schema.names, "told"])

    given = history.select(
        "stream_id", F.coalesce(F.col("effective_ms").cast("long"), F.lit(LOWEST)).alias("effective"), F.col("spec").cast("string").alias("spec")
    )
    read = given.mapInArrow(run, "stream_id string, effective long, spec string, told string").filter("told is not null")
    order = Window.partitionBy("stream_id").orderBy("effective", F.coalesce("spec", F.lit("")))
    return read.withColumn("epoch", F.row_number().over(order)).select(
        "stream_id", "effective", "epoch", "told", F.from_json("told", SETTINGS).alias("_set")
    )


def unreadable(history: DataFrame) -> DataFrame:
    """The rows of a history whose spec cannot be read, and so changes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = [settings_text(text) is None for text in batch.column("spec").to_pylist()]
            yield batch.filter(pa.array(bad, pa.bool_()))

    return history.mapInArrow(run, history.schema)


@lru_cache(maxsize=1024)
def settings_text(spec: str | None) -> str | None:
    """The settings of a spec's JSON text as JSON in the form of SETTINGS; ``None`` if it cannot be read."""
    try:
        return settings_of(PipelineSpec.from_json(spec))
    except (ValueError, TypeError, AttributeError):
        return None


def settings_of(spec: PipelineSpec) -> str:
    """The settings of a spec as JSON in the form of SETTINGS."""
    names = ("types", "mapping", "ttl", "tags", "path", "delta", "size", "interval")
    return json.dumps(dict(zip(names, _settings(spec))))


def _in_force(df: DataFrame, changes: DataFrame, max_rows: int) -> DataFrame:
    """Add ``epoch`` and ``_set`` by sorting the changes in among the events.

    In a stream that is cut, each slice also gets the last change of the slices before it.
    """
    events = with_slices(df, plan_slices(df, max_rows))
    begins = events.filter(F.col("_slice") > LOWEST).groupBy("stream_id", "_slice").agg(F.min("timestamp").alias("_begin"))
    begins = checkpointed(begins)
    by_stream = begins.groupBy("stream_id").agg(F.array_sort(F.collect_list(F.struct("_begin", "_slice"))).alias("_all"))
    placed = bounded_join(changes, by_stream, ["stream_id"], begins.count())
    reached = F.greatest(F.size(F.filter("_all", lambda s: s["_begin"] <= F.col("effective"))), F.lit(1))
    slice_ = F.when(F.col("_all").isNull(), LOWEST).otherwise(F.element_at("_all", reached)["_slice"])
    force = F.struct("epoch", "_set")
    placed = placed.select("stream_id", slice_.alias("_slice"), F.col("effective").alias("timestamp"), F.col("epoch").alias("seq"), force.alias("_force"))
    lasts = placed.filter(F.col("_slice") > LOWEST).groupBy("stream_id", "_slice").agg(F.max_by("_force", "seq").alias("_force"))
    earlier = Window.partitionBy("stream_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = begins.select("stream_id", "_slice").join(lasts, ["stream_id", "_slice"], "left")
    carried = carried.withColumn("_force", F.last("_force", ignorenulls=True).over(earlier)).filter("_force is not null")
    carried = carried.select("stream_id", "_slice", F.lit(LOWEST).alias("timestamp"), F.lit(-1).cast("long").alias("seq"), "_force")
    controls = placed.withColumn("seq", F.col("seq").cast("long")).unionByName(carried).withColumn("_event", F.lit(False))
    both = events.withColumn("_event", F.lit(True)).unionByName(controls, allowMissingColumns=True)
    so_far = Window.partitionBy("stream_id", "_slice").orderBy("timestamp", "_event", "seq").rowsBetween(Window.unboundedPreceding, 0)
    told = both.withColumn("_force", F.last("_force", ignorenulls=True).over(so_far)).filter("_event")
    names = [F.col(name) for name in df.columns]
    return told.select(*names, F.coalesce("_force.epoch", F.lit(0)).alias("epoch"), F.col("_force._set").alias("_set"))


def _conditioned(rows: DataFrame, used: dict[str, bool], keep_dropped: bool, max_rows: int) -> DataFrame:
    """Condition events that carry ``epoch`` and ``_set``; ``used`` names the ordered stages of any spec."""
    rows = rows.withColumn("ingested_bytes", payload_bytes()) if keep_dropped else rows
    accepted = accepted_types()
    if keep_dropped:
        rows = rows.withColumn("dropped_by", F.when(~accepted, "filter"))
    else:
        rows = rows.filter(accepted)
    plan = plan_slices(rows, max_rows) if any(used.values()) else None
    rows = with_prepared(rows)

    def setting(name: str, of: str) -> Column | None:
        return F.col(f"_set_{name}") if used[of] else None

    return condition(
        rows,
        plan,
        ("stream_id", "epoch"),
        keep_dropped,
        setting("ttl", "ttl"),
        setting("delta", "delta"),
        setting("size", "size"),
        setting("interval", "size"),
    )


def accepted_types() -> Column:
    """Whether the spec in force lets the type of an event through."""
    types = F.col("_set.types")
    return types.isNull() | F.array_contains(types, F.col("type"))


def with_prepared(rows: DataFrame) -> DataFrame:
    """The stateless work by ``_set``, and the settings of the ordered stages as columns."""
    settings = {f"_set_{name}": F.col(f"_set.{name}") for name in ("ttl", "delta", "size", "interval")}
    return _prepared(rows).withColumns(settings).drop("_set")


def _with_settings(df: DataFrame, history) -> DataFrame:
    """Add ``epoch`` and ``_set``, the settings in force."""
    by_stream: dict[str, list] = {}
    for stream, start, spec in history:
        by_stream.setdefault(stream, []).append((LOWEST if start is None else start, _settings(spec)))
    lines = []
    for stream, entries in by_stream.items():
        entries.sort(key=lambda entry: entry[0])
        lines.append((stream, [start for start, _ in entries], [set_ for _, set_ in entries]))
    schema = f"stream_id string, _starts array<bigint>, _sets array<{SETTINGS}>"
    known = df.sparkSession.createDataFrame(lines, schema)
    return _reached(bounded_join(df, known, ["stream_id"], len(history)))


def _reached(joined: DataFrame) -> DataFrame:
    """Choose by time among the ``_sets`` of an event's stream, which begin at ``_starts``."""
    reached = F.size(F.filter("_starts", lambda start: start <= F.col("timestamp")))
    return (
        joined.withColumn("epoch", F.when(F.col("_starts").isNull(), 0).otherwise(reached))
        .withColumn("_set", F.when(F.col("epoch") > 0, F.try_element_at("_sets", F.col("epoch"))))
        .drop("_starts", "_sets")
    )


def _settings(spec: PipelineSpec) -> tuple:
    threshold, batch = spec.threshold, spec.batch
    return (
        list(spec.match_types) or None,
        {name: J.path_text(path) for name, path in spec.mapping.items()} or None,
        spec.ttl_ms,
        dict(spec.tags) or None,
        J.path_text(threshold.path) if threshold else None,
        threshold.delta if threshold else None,
        batch.max_size if batch else None,
        batch.interval_ms if batch else None,
    )


def _prepared(rows: DataFrame) -> DataFrame:
    """The stateless work of ``pipeline.prepared``, with settings taken from ``_set``."""
    mapping, tags = F.col("_set.mapping"), F.col("_set.tags")
    document, payload = F.col("_doc"), F.col("payload")
    mapped = F.map_filter(
        F.transform_values(mapping, lambda _, path: J.extract_text(document, path)),
        lambda _, value: value.isNotNull(),
    )
    tagged = F.map_concat(
        F.map_filter("_members", lambda key, _: ~F.map_contains_key(tags, key)),
        F.transform_values(tags, lambda _, value: value.cast("variant")),
    )
    flat = F.when(mapping.isNotNull(), F.coalesce(J.render(F.col("_members")), payload))
    rows = J.with_document(rows)
    rows = rows.withColumn("_whole", payload.isNull() | J.is_json(document))
    rows = rows.withColumn(
        "_members", F.when(mapping.isNull(), J.fields(document)).when(shaped(document), mapped)
    )
    rows = rows.withColumn("_key", payload_key(F.coalesce(flat, payload)))
    rows = rows.withColumn("_members", F.when(tags.isNull(), F.col("_members")).otherwise(tagged))
    object_ = F.to_variant_object("_members")
    rows = rows.withColumn("_found", J.extract_text(object_, F.col("_set.path")))
    rows = rows.withColumn("_number", J.number(F.col("_found")))
    rewritten = F.when(
        mapping.isNotNull() | tags.isNotNull(), F.coalesce(J.render(F.col("_members")), payload)
    )
    rows = rows.withColumn("payload", F.coalesce(rewritten, payload))
    return rows.drop("_doc", "_members", "_found")
