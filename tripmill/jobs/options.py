"""Options that both jobs have."""

from __future__ import annotations

import argparse
from datetime import date, datetime, time, timezone

from tripmill.contract import EventSpec


def day(text: str) -> datetime:
    """The UTC midnight that begins a day."""
    return datetime.combine(date.fromisoformat(text), time(), timezone.utc)


def event_period(parser: argparse.ArgumentParser) -> None:
    """The half-open period of valid events."""
    parser.add_argument("--event-start", type=day, default=EventSpec.start, help="first day")
    parser.add_argument("--event-end", type=day, default=EventSpec.end, help="day after the last")
