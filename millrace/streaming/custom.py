"""Chains of stages on streams, those of a spec and stages of one's own.

A stage is a function from a streaming frame to a streaming frame, so stages without state are
written as on batch frames. ``stateful`` makes one with state out of a plain fold over the events of
a stream. Building a chain starts no job; every stateful stage is an operator of its own in the
query's checkpoint, with state under its own name, so a restart finds it again as long as the
stages and their order stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from itertools import groupby
from operator import itemgetter
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.operators.stateless import enrich, filter_types, transform
from millrace.plans.pipeline import Stage
from millrace.plans.spec import PipelineSpec
from millrace.streaming import stages as ordered
from millrace.streaming.packets import Packets, stateful_stage
from millrace.streaming.pipeline import configure_state

Fold = Callable[[tuple | None, dict[str, Any]], tuple[tuple | None, list[dict[str, Any]]]]


def stream_stages(spec: PipelineSpec, live: bool = False) -> list[Stage]:
    """The stages of ``spec`` one by one, as streaming stages."""
    built: list[Stage] = []
    if spec.match_types:
        built.append(partial(filter_types, match_types=spec.match_types))
    if spec.mapping:
        built.append(partial(transform, mapping=spec.mapping))
    if spec.ttl_ms is not None:
        built.append(partial(ordered.dedup, ttl_ms=spec.ttl_ms, live=live))
    if spec.tags:
        built.append(partial(enrich, tags=spec.tags))
    if spec.threshold:
        built.append(partial(ordered.threshold, path=spec.threshold.path, delta=spec.threshold.delta))
    if spec.batch:
        built.append(partial(ordered.batch, max_size=spec.batch.max_size, interval_ms=spec.batch.interval_ms, live=live))
    return built


class _Fold(Packets):
    def __init__(self, name: str, state: pa.Schema, fold: Fold, rows: pa.Schema):
        self.name, self.fields, self.fold, self.rows = name, state, fold, rows

    def settled(self, rows, ids, held, clock):
        out, changes = [], {}
        for id_, own in groupby(zip(ids, rows.to_pylist()), key=itemgetter(0)):
            before = state = held.get(id_)
            for _, event in own:
                state, events = self.fold(state, event)
                out += events
            if state != before:
                changes[id_] = state
        return pa.Table.from_pylist(out, schema=self.rows), changes


def stateful(name: str, state: str, fold: Fold, by: tuple[str, ...] = ("stream_id",)) -> Stage:
    """A stage that folds the events of each key ``by`` in ``(timestamp, seq)`` order.

    ``fold`` is given the state, a tuple of the columns ``state`` or ``None``, and an event as a
    dict; it returns the new state and the events that go on. Micro-batches are taken as they come.
    """

    def stage(df: DataFrame) -> DataFrame:
        configure_state(df.sparkSession)
        fields = to_arrow_schema(T.StructType.fromDDL(state))
        processor = _Fold(name, fields, fold, to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])))
        return stateful_stage(df, F.to_json(F.struct(*by)), processor, df.schema.fields)

    return stage


def stream_chain(*stages: Stage) -> Stage:
    """One stage out of many for streaming frames; the first listed runs first."""

    def run(df: DataFrame) -> DataFrame:
        configure_state(df.sparkSession)
        return reduce(DataFrame.transform, stages, df)

    return run
