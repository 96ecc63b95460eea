"""Duration strings such as ``50ms``, ``1m`` or ``1h30m``."""

from __future__ import annotations

import re
from fractions import Fraction

# Units of a duration string, in nanoseconds.
UNIT_NANOS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}

_PART = re.compile(r"(\d+\.?\d*|\.\d+)(ns|us|µs|μs|ms|s|m|h)", re.ASCII)


def parse_duration(text: str) -> Fraction:
    """Milliseconds in ``text``, exactly; ``ValueError`` when it is no duration."""
    body = text[1:] if text[:1] in ("+", "-") else text
    sign = -1 if text[:1] == "-" else 1
    if body == "0":
        return Fraction(0)
    parts = list(_PART.finditer(body))
    if not parts or "".join(part.group(0) for part in parts) != body:
        raise ValueError(f"not a duration: {text!r}")
    nanos = sum(Fraction(part.group(1).rstrip(".")) * UNIT_NANOS[part.group(2)] for part in parts)
    return sign * nanos / 1_000_000
