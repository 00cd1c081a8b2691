"""Arguments of reads and writes, checked before any job runs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime

_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


def seconds(text: str | float) -> float:
    """``250ms``, ``30s``, ``15m`` or ``2h``; a bare number counts in milliseconds."""
    found = re.fullmatch(r"\s*(\d+)\s*(ms|s|m|h)?\s*", str(text).lower())
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return int(found[1]) * _UNITS[found[2] or "ms"]


def one_target(stream: str | None, superstream: str | None) -> None:
    if bool(stream and stream.strip()) == bool(superstream and superstream.strip()):
        raise ValueError("give exactly one of stream and superstream")


@dataclass(frozen=True)
class RangeOptions:
    """Where a bounded read starts and ends. Timestamps are micros since the epoch; maps go by stream and override the global one."""

    start: str = "earliest"  # earliest, latest, offset, timestamp
    start_offset: int | None = None
    start_ts: int | None = None
    start_ts_by_stream: dict[str, int] = field(default_factory=dict)
    end: str = "latest"  # latest, offset, timestamp
    end_offset: int | None = None
    end_ts: int | None = None
    end_ts_by_stream: dict[str, int] = field(default_factory=dict)
    on_no_match: str = "error"  # error, latest
    fail_on_data_loss: bool = True

    def __post_init__(self) -> None:
        if self.start not in ("earliest", "latest", "offset", "timestamp"):
            raise ValueError(f"start must be earliest, latest, offset or timestamp, not {self.start!r}")
        if self.end not in ("latest", "offset", "timestamp"):
            raise ValueError(f"end must be latest, offset or timestamp, not {self.end!r}")
        if self.on_no_match not in ("error", "latest"):
            raise ValueError("on_no_match must be error or latest")
        for mode, offset, ts, by, name in ((self.start, self.start_offset, self.start_ts, self.start_ts_by_stream, "start"), (self.end, self.end_offset, self.end_ts, self.end_ts_by_stream, "end")):
            if (mode == "offset") != (offset is not None):
                raise ValueError(f"{name}_offset goes with {name}='offset'")
            if (mode == "timestamp") != (ts is not None or bool(by)):
                raise ValueError(f"{name}_ts or {name}_ts_by_stream goes with {name}='timestamp'")
            if offset is not None and offset < 0:
                raise ValueError(f"{name}_offset must not be negative")
        if self.start == self.end == "offset" and self.start_offset > self.end_offset:
            raise ValueError("start_offset is beyond end_offset")


@dataclass(frozen=True)
class LimitOptions:
    """How much one batch takes."""

    max_records: int | None = None
    max_bytes: int | None = None
    min_records: int | None = None
    max_delay: str = "15m"
    size_estimate: int = 1024

    def __post_init__(self) -> None:
        for name in ("max_records", "max_bytes", "min_records", "size_estimate"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")
        if self.max_records and self.min_records and self.min_records > self.max_records:
            raise ValueError("min_records is beyond max_records")
        seconds(self.max_delay)


def micros(text: str) -> int:
    """Micros since the epoch of an ISO time, in UTC."""
    whole = datetime.fromisoformat(text) - datetime(1970, 1, 1)
    return (whole.days * 86_400 + whole.seconds) * 1_000_000 + whole.microseconds
