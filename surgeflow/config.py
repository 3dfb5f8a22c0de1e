"""Frozen configuration and injectable clocks.

The detector parameters travel as a frozen dataclass so that a
``foreachBatch`` closure captures an immutable value instead of reading
module globals.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass


@dataclass(frozen=True)
class DetectorConfig:
    """Parameters of the rate-based bot rule.

    rate_per_sec  events per second above which an IP is bot-like (strict >).
    floor_sec     lower bound of a batch's span; the trigger interval.
    """

    rate_per_sec: float = 5.0
    floor_sec: float = 5.0

    @property
    def floor_us(self) -> int:
        return int(round(self.floor_sec * 1_000_000))

    @property
    def rate_text(self) -> str:
        # Python's own float text, as the reason string shows it ("5.0").
        return str(float(self.rate_per_sec))


@dataclass(frozen=True)
class StreamConfig:
    """Where and how the streaming job runs."""

    sink_root: str
    checkpoint_location: str
    trigger_seconds: int = 5
    available_now: bool = False
    watermark: str = "1 minute"


class WallClock:
    """Real time: batch stamp truncated to the second, elapsed milliseconds."""

    def now(self) -> _dt.datetime:
        return _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0)

    def monotonic(self) -> float:
        return time.monotonic()


class FixedClock:
    """Deterministic clock for tests: a fixed stamp (UTC, if it names no zone)
    and zero elapsed time."""

    def __init__(self, stamp: _dt.datetime, step_ms: int = 0):
        self._stamp = stamp if stamp.tzinfo else stamp.replace(tzinfo=_dt.timezone.utc)
        self._step = step_ms / 1000.0
        self._t = 0.0

    def now(self) -> _dt.datetime:
        return self._stamp

    def monotonic(self) -> float:
        self._t += self._step
        return self._t
