"""Parameters shared by the analysis operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class AnalysisSettings:
    """One analysis run.

    ``as_of`` replaces the wall clock: every window and every latest value ends there,
    later rows change nothing, so a run can be repeated. Windows are day counts, not
    calendar months or years.
    """

    as_of: datetime
    market: str = "^GSPC"
    risk_free: str = "^TNX"
    growth_days: int = 365 * 5
    history_days: int = 365
    price_days: int = 30
    min_streak: int = 5

    @property
    def benchmarks(self) -> list[str]:
        return [self.market, self.risk_free]
