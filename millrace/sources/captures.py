"""Turn landed captures of live feeds into envelopes.

Every capture has ``stream_id``, ``topic``, ``seq`` and the receive time
``recv_ms``; the other columns differ by kind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.envelope import envelopes
from millrace.functions import json_text as J

# Event types, outcome codes and limits of the feeds.
WEBSOCKET_TYPE = "websocket_message"
REST_TYPE = "rest_poller_response"
WEBHOOK_TYPE = "webhook_recv"
WEBHOOK_BODY_LIMIT = 5 * 1024 * 1024
METHOD_NOT_ALLOWED = 405
UNAUTHORIZED = 401
BAD_REQUEST = 400
ACCEPTED = 202


def websocket_events(frames: DataFrame) -> DataFrame:
    """One event per frame; the text is taken as it is, JSON or not."""
    return envelopes(frames, F.lit(WEBSOCKET_TYPE), F.col("frame"))


def json_or_string(df: DataFrame, text: str, output: str, depth: int | None = None) -> DataFrame:
    """Add ``output``: ``text`` itself where it is JSON, else as a JSON string.

    A text that the parser cannot judge stays as it is, for the sink to set aside. With ``depth`` there
    is no such text: each is judged, and those of up to ``depth`` levels count as JSON.
    """
    if depth is not None:
        told = J.with_verdict(df, text, "_judged", depth)
        return told.withColumn(output, F.when(F.col("_judged"), F.col(text)).otherwise(J.as_json_string(F.col(text)))).drop("_judged")
    parsed = J.with_document(df, text, "_parsed")
    as_it_stands = J.is_json(F.col("_parsed")) | J.unjudged(F.col("_parsed"), text)
    value = F.when(as_it_stands, F.col(text)).otherwise(J.as_json_string(F.col(text)))
    return parsed.withColumn(output, value).drop("_parsed")


def rest_events(responses: DataFrame, depth: int | None = None) -> DataFrame:
    """One event per successful, non-empty response; arrays stay whole. ``depth`` as in ``json_or_string``."""
    answered = F.col("status").between(200, 299) & (F.octet_length("body") > 0)
    return envelopes(
        json_or_string(responses.filter(answered), "body", "payload", depth), F.lit(REST_TYPE), F.col("payload")
    )


def webhook_status(token: str | None) -> Column:
    """Outcome code of a request; the first rule that applies decides."""
    size = F.coalesce(F.octet_length("body"), F.lit(0))
    sent = F.coalesce("authorization", F.lit(""))
    outcome = F.when(~F.col("method").eqNullSafe("POST"), METHOD_NOT_ALLOWED)
    if token:
        outcome = outcome.when(sent != f"Bearer {token}", UNAUTHORIZED)
    return (
        outcome.when(size > WEBHOOK_BODY_LIMIT, BAD_REQUEST)
        .when(size == 0, BAD_REQUEST)
        .otherwise(ACCEPTED)
    )


def webhook_outcomes(requests: DataFrame, token: str | None = None) -> DataFrame:
    """Every request with its outcome ``status``."""
    return requests.withColumn("status", webhook_status(token))


def webhook_events(requests: DataFrame, token: str | None = None) -> DataFrame:
    """One event per accepted request."""
    accepted = requests.filter(webhook_status(token) == ACCEPTED)
    return envelopes(
        json_or_string(accepted, "body", "payload"), F.lit(WEBHOOK_TYPE), F.col("payload")
    )


def grpc_events(messages: DataFrame) -> DataFrame:
    """One event per message; type and payload are taken as they are."""
    return envelopes(messages, F.col("type"), F.col("payload").cast("string"))


def grpc_processed(messages: DataFrame) -> DataFrame:
    """The count each call is answered with. Events that a stage drops count too."""
    return messages.groupBy("stream_id", "call_id").agg(F.count("*").alias("processed_count"))


@dataclass(frozen=True)
class Webhook:
    """A webhook feed that checks ``token``, for ``collect_events``."""

    token: str | None = None

    def __call__(self, requests: DataFrame) -> DataFrame:
        return webhook_events(requests, self.token)
