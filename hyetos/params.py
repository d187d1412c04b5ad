"""Typed parameters of the operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

# The locations monitored by default.
MONITORED_CITIES = (
    "Brussels",
    "Ghent",
    "Antwerp",
    "Liege",
    "Namur",
    "Leuven",
    "Charleroi",
)


@dataclass(frozen=True)
class Thresholds:
    """Limits beyond which a forecast hour is an alert (strict comparisons)."""

    high_temp: float = 30.0  # degrees Celsius
    low_temp: float = 0.0  # degrees Celsius
    high_wind: float = 25.0  # km/h


@dataclass(frozen=True)
class TrendParams:
    """Tumbling window length and how temperatures are summed.

    ``decimals=None`` sums temperatures as doubles. With ``decimals=n`` values
    carrying at most n fractional digits are summed as whole units of 10**-n, so
    the mean does not depend on the order in which rows and partitions arrive. Other
    values keep all their digits and are summed as doubles beside them; so are most
    single-precision values, as they widen to doubles with more digits.
    """

    window: str = "10 minutes"
    decimals: int | None = None


@dataclass(frozen=True)
class SliceParams:
    """Closed time range around ``as_of``; operators never read the clock."""

    as_of: datetime
    back: timedelta = timedelta(hours=12)
    ahead: timedelta = timedelta(hours=36)

    @property
    def start(self) -> datetime:
        return self.as_of - self.back

    @property
    def end(self) -> datetime:
        return self.as_of + self.ahead
