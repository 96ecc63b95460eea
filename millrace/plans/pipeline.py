"""Apply a spec to a frame of envelopes, in one fixed order of stages:
filter, transform, dedup, enrich, threshold, batch.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.envelope import COLUMNS
from millrace.functions import json_text as J
from millrace.operators.batch import batch, into_batches
from millrace.operators.slices import MAX_ROWS, SlicePlan, plan_slices
from millrace.operators.stateful import (
    dedup,
    hold_repeats,
    hold_small_changes,
    payload_key,
    threshold,
)
from millrace.operators.stateless import enrich, filter_types, shaped, transform
from millrace.plans.spec import PipelineSpec
from millrace.session import checkpointed

Stage = Callable[[DataFrame], DataFrame]


def chain(*stages: Stage) -> Stage:
    """One stage out of many; the first listed runs first."""
    return lambda df: reduce(DataFrame.transform, stages, df)


def stages(spec: PipelineSpec, max_rows: int = MAX_ROWS) -> list[Stage]:
    """The stages of ``spec`` one by one, to be mixed with stages of one's own."""
    built: list[Stage] = []
    if spec.match_types:
        built.append(partial(filter_types, match_types=spec.match_types))
    if spec.mapping:
        built.append(partial(transform, mapping=spec.mapping))
    if spec.ttl_ms is not None:
        built.append(partial(dedup, ttl_ms=spec.ttl_ms, max_rows=max_rows))
    if spec.tags:
        built.append(partial(enrich, tags=spec.tags))
    if spec.threshold:
        limit = spec.threshold
        built.append(partial(threshold, path=limit.path, delta=limit.delta, max_rows=max_rows))
    if spec.batch:
        size, interval = spec.batch.max_size, spec.batch.interval_ms
        built.append(partial(batch, max_size=size, interval_ms=interval, max_rows=max_rows))
    return built


def run(df: DataFrame, spec: PipelineSpec, keep_dropped: bool = False, max_rows: int = MAX_ROWS) -> DataFrame:
    """Apply ``spec`` to every stream of ``df``.

    All stateless work, the filter aside, is one projection that parses the
    payload once. Tags do not depend on other events, so they are set there
    too, while dedup still compares payloads as they were without tags.

    With ``keep_dropped`` every event comes back once, unbatched: ``dropped_by``
    names the stage that dropped it or is NULL, and ``ingested_bytes`` is the
    size of its payload on arrival.
    """
    rows, ahead = df, None
    if keep_dropped:
        rows = rows.withColumn("ingested_bytes", payload_bytes())
        ahead = F.lit(None).cast("string")
        if spec.match_types:
            ahead = F.when(~F.col("type").isin(list(spec.match_types)), "filter")
        rows = rows.withColumn("dropped_by", ahead)
    else:
        rows = filter_types(rows, spec.match_types)
    return condition(
        prepared(rows, spec),
        plan_slices(rows, max_rows) if spec.ordered else None,
        keep_dropped=keep_dropped,
        ttl=None if spec.ttl_ms is None else F.lit(spec.ttl_ms),
        delta=F.lit(spec.threshold.delta) if spec.threshold else None,
        size=F.lit(spec.batch.max_size) if spec.batch else None,
        interval=F.lit(spec.batch.interval_ms) if spec.batch else None,
    )


def payload_bytes() -> Column:
    return F.coalesce(F.octet_length("payload"), F.lit(0)).cast("long")


def prepared(rows: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Do the stateless work and add what the ordered stages look at.

    ``_key`` identifies the payload for dedup, ``_number`` is the threshold's
    value and ``_whole`` tells whether the payload can go into an array.
    """
    mapping, tags, limit = spec.mapping, spec.tags, spec.threshold
    document, payload = F.col("_doc"), F.col("payload")
    if mapping or tags or limit or spec.batch:
        rows = J.with_document(rows)
    if spec.batch:
        rows = rows.withColumn("_whole", payload.isNull() | J.is_json(document))
    found = J.extract(document, limit.path) if limit else None
    compared = final = payload
    if mapping:
        compared = F.coalesce(F.when(shaped(document), J.flat_object(document, mapping, {})), payload)
        final = F.coalesce(F.when(shaped(document), J.flat_object(document, mapping, tags)), payload)
        if limit:
            found = F.when(shaped(document), J.extract_mapped(document, mapping, tags, limit.path))
    elif tags:
        rows = rows.withColumn("_members", J.tag(J.fields(document), tags))
        final = F.coalesce(J.render(F.col("_members")), payload)
        if limit:
            found = J.extract_member(F.col("_members"), limit.path)
    if spec.ttl_ms is not None:
        rows = rows.withColumn("_key", payload_key(compared))
    if limit:
        rows = rows.withColumn("_found", found).withColumn("_number", J.number(F.col("_found")))
    return rows.withColumn("payload", final).drop("_doc", "_members", "_found")


def condition(
    rows: DataFrame,
    plan: SlicePlan | None,
    scope: tuple[str, ...] = ("stream_id",),
    keep_dropped: bool = False,
    ttl: Column | None = None,
    delta: Column | None = None,
    size: Column | None = None,
    interval: Column | None = None,
) -> DataFrame:
    """Run the ordered stages on a prepared frame.

    A stage whose setting is ``None`` is left out; where a setting is a column
    that is NULL for a row, the stage lets the row pass.
    """
    later = [setting for setting in (ttl, delta, size) if setting is not None]
    alive = F.col("dropped_by").isNull() if keep_dropped else F.lit(True)
    mark = "_kept" if keep_dropped else None
    names = [*COLUMNS, *(name for name in scope if name not in COLUMNS)]

    def settle(df: DataFrame, stage: str | None, *used: str) -> DataFrame:
        df = df.drop(*used)
        if mark and stage:
            label = F.coalesce("dropped_by", F.when(~F.col(mark), F.lit(stage)))
            df = df.withColumn("dropped_by", label).drop(mark)
        # A cut stream is read twice by the next ordered stage: keep what this one cost.
        return checkpointed(df) if plan is not None and later else df

    if ttl is not None:
        later.pop()
        rows = hold_repeats(rows, ttl, plan, scope, mark, alive & (ttl >= 0))
        rows = settle(rows, "dedup", "_key")
    if delta is not None:
        later.pop()
        rows = hold_small_changes(rows, delta, plan, scope, mark, alive)
        rows = settle(rows, "threshold", "_number")
    if keep_dropped:
        return rows.select(*names, "ingested_bytes", "dropped_by")
    if size is not None:
        rows = into_batches(rows, size, interval, plan, scope, F.col("_whole") & size.isNotNull())
    return rows.select(*names)
