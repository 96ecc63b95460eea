"""The declarative description of a stream's conditioning."""

from __future__ import annotations

import json
import logging
import math
from dataclasses import dataclass, field
from fractions import Fraction

from millrace.functions.durations import parse_duration

log = logging.getLogger(__name__)

# What a spec means where it leaves a setting out.
DEFAULT_TTL = "1m"
DEFAULT_BATCH_SIZE = 100
DEFAULT_FLUSH_INTERVAL = "1s"


def _millis(text, default: str) -> Fraction:
    if text:
        try:
            return parse_duration(text)
        except ValueError:
            log.warning("bad duration %r, using %s", text, default)
    return parse_duration(default)


@dataclass(frozen=True)
class Threshold:
    path: str
    delta: float = 0.0


@dataclass(frozen=True)
class Batch:
    max_size: int = DEFAULT_BATCH_SIZE
    interval_ms: int = 1000


@dataclass(frozen=True)
class PipelineSpec:
    """Stages to apply; an empty or ``None`` setting leaves its stage out."""

    match_types: tuple[str, ...] = ()
    mapping: dict[str, str] = field(default_factory=dict)
    ttl_ms: int | None = None
    tags: dict[str, str] = field(default_factory=dict)
    threshold: Threshold | None = None
    batch: Batch | None = None

    @property
    def ordered(self) -> bool:
        """Whether any stage depends on the order of events."""
        return self.ttl_ms is not None or self.threshold is not None or self.batch is not None

    @classmethod
    def from_json(cls, text: str | None) -> PipelineSpec:
        return cls.from_dict(json.loads(text) if text else None)

    @classmethod
    def from_dict(cls, config: dict | None) -> PipelineSpec:
        """Read the nested config form, apply defaults and check it."""
        config = config or {}
        match = config.get("filter") or {}
        transform = config.get("transform") or {}
        enrich = config.get("enrich") or {}
        dedup = config.get("dedup") or {}
        threshold = config.get("threshold") or {}
        batch = config.get("batch") or {}

        ttl_ms = None
        if dedup.get("enabled"):
            # Event times are whole milliseconds, so a fraction never matters.
            ttl_ms = math.floor(_millis(dedup.get("ttl"), DEFAULT_TTL))
        limit = None
        if threshold.get("enabled") and threshold.get("path"):
            limit = Threshold(threshold["path"], float(threshold.get("delta") or 0.0))
        grouping = None
        if batch.get("enabled"):
            interval = _millis(batch.get("flush_interval"), DEFAULT_FLUSH_INTERVAL)
            if interval <= 0:
                raise ValueError("flush_interval must be positive")
            size = batch.get("max_batch_size") or 0
            grouping = Batch(size if size > 0 else DEFAULT_BATCH_SIZE, math.ceil(interval))
        return cls(
            match_types=tuple(match.get("match_types") or ()),
            mapping=dict(transform.get("mapping") or {}),
            ttl_ms=ttl_ms,
            tags=dict(enrich.get("tags") or {}),
            threshold=limit,
            batch=grouping,
        )
