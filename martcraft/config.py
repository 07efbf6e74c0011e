"""Parameters of the star-schema build: segment ladders, check bounds, dates.

Every threshold is a parameter; the defaults are the values of the modelled
project. Pass another ``Bands`` when the data lives on a different scale.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Ladder:
    """Step banding: first matching rung wins, NULL falls to ``otherwise``.

    ``op`` is ">=" (descending bounds) or "<=" (ascending bounds).
    """

    op: str
    rungs: tuple[tuple[float, str], ...]
    otherwise: str

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.rungs) + (self.otherwise,)


@dataclass(frozen=True)
class TierLadder:
    """Two-measure banding: value >= v AND count >= n, first match wins."""

    rungs: tuple[tuple[float, int, str], ...]
    otherwise: str

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, _, label in self.rungs) + (self.otherwise,)


# Segment bounds and labels of the modelled project.
VALUE_SEGMENT = Ladder(">=", ((5000, "VIP"), (2000, "High Value"), (500, "Medium Value")), "Low Value")
FREQUENCY_SEGMENT = Ladder(">=", ((20, "Very Frequent"), (10, "Frequent"), (5, "Occasional")), "Rare")
RECENCY_SEGMENT = Ladder("<=", ((7, "Active"), (30, "Recent"), (90, "Lapsed")), "Inactive")
AOV_TIER = Ladder(">=", ((500, "High AOV"), (200, "Medium AOV")), "Low AOV")
CUSTOMER_TIER = TierLadder(((5000, 15, "Platinum"), (2000, 10, "Gold"), (500, 5, "Silver")), "Bronze")
REVENUE_SEGMENT = Ladder(
    ">=", ((50000, "Star Product"), (20000, "High Performer"), (5000, "Medium Performer")), "Low Performer"
)
VOLUME_SEGMENT = Ladder(">=", ((1000, "High Volume"), (500, "Medium Volume")), "Low Volume")
PRICE_TIER = Ladder(">=", ((100, "Premium"), (50, "Mid-Range")), "Value")


@dataclass(frozen=True)
class Bands:
    value_segment: Ladder = VALUE_SEGMENT
    frequency_segment: Ladder = FREQUENCY_SEGMENT
    recency_segment: Ladder = RECENCY_SEGMENT
    aov_tier: Ladder = AOV_TIER
    customer_tier: TierLadder = CUSTOMER_TIER
    revenue_segment: Ladder = REVENUE_SEGMENT
    volume_segment: Ladder = VOLUME_SEGMENT
    price_tier: Ladder = PRICE_TIER

    def with_(self, **changes) -> "Bands":
        return replace(self, **changes)


DEFAULT_BANDS = Bands()


@dataclass(frozen=True)
class Freshness:
    """Source freshness rule: warn/error after this many hours since max(loaded_at)."""

    # 12 h warn, 24 h error.
    warn_after_hours: float = 12
    error_after_hours: float = 24


@dataclass(frozen=True)
class QualityParams:
    """Bounds used by the declared data checks."""

    # Accepted year range 2020..2030 inclusive, null share 0.05, min rows 1.
    year_min: int = 2020
    year_max: int = 2030
    max_null_fraction: float = 0.05
    min_row_count: int = 1
    freshness: Freshness = field(default_factory=Freshness)
