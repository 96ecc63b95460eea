"""Pick the normaliser by the kind of feed."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from millrace.sources.captures import Webhook, grpc_events, rest_events, websocket_events
from millrace.sources.sse import sse_events

Normaliser = Callable[[DataFrame], DataFrame]


def normaliser(kind: str, token: str | None = None) -> Normaliser:
    """The function that turns captures of ``kind`` into envelopes."""
    known: dict[str, Normaliser] = {
        "websocket": websocket_events,
        "rest_poller": rest_events,
        "webhook": Webhook(token),
        "grpc": grpc_events,
        "sse": sse_events,
    }
    if kind not in known:
        raise ValueError(f"unsupported source kind: {kind!r}")
    return known[kind]


def collect_events(captures: dict[str, DataFrame], token: str | None = None) -> DataFrame:
    """Envelopes of several captures, given by kind."""
    return reduce(DataFrame.unionByName, (normaliser(kind, token)(df) for kind, df in captures.items()))
