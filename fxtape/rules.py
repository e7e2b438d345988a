"""Parameters of the mart chain."""

from __future__ import annotations

from dataclasses import dataclass

from fxtape import constants as c


@dataclass(frozen=True)
class MarketRules:
    """Bar length, window lengths, thresholds and calendars.

    Window lengths are counted in bars, so a coarser bar keeps the same shape. ``session_unit``
    is any unit ``date_trunc`` knows, applied to the date in ``session_zone``.
    """

    bar_seconds: int = 60
    short_bars: int = 3
    long_bars: int = 8
    baseline_bars: int = 30
    baseline_min: int = 20
    zscore_limit: float = 3.0
    universe_size: int = len(c.STOCKS)
    quantity: int = 1
    local_zone: str = c.LOCAL_ZONE
    session_zone: str = c.SESSION_ZONE
    session_unit: str = "day"

    @property
    def short_seconds(self) -> int:
        return (self.short_bars - 1) * self.bar_seconds

    @property
    def long_seconds(self) -> int:
        return (self.long_bars - 1) * self.bar_seconds

    @property
    def baseline_seconds(self) -> int:
        return self.baseline_bars * self.bar_seconds
