"""Run parameters: one frozen object, validated before any job starts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


def _positive(name: str, value) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not value > 0:
        raise ValueError(f"{name} must be a positive number, got {value!r}")


def _value_list(name: str, value) -> None:
    if isinstance(value, (str, bytes)) or not isinstance(value, Sequence):
        raise ValueError(f"{name} must be a list of values, got {value!r}")


@dataclass(frozen=True)
class Params:
    start: dt.date
    end: dt.date
    cohort_date: dt.date
    outlier_revenue_mln: float
    disputed: Sequence[str] = ()
    branches: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {"kg": ("kg",), "pcs": ("pcs",)})
    thresholds: Mapping[str, float] = field(default_factory=lambda: {"kg": 0.1, "pcs": 1.0})
    returns: str = "zero"
    life: str = "active_span"
    adi: float = 1.32
    cv2: float = 0.49
    abc: Sequence[float] = (0.80, 0.95)

    def __post_init__(self):
        if self.returns != "zero":
            raise ValueError(f"returns mode {self.returns!r} is not supported, expected 'zero'")
        if self.life != "active_span":
            raise ValueError(f"life mode {self.life!r} is not supported, expected 'active_span'")
        _value_list("disputed", self.disputed)
        for branch, measures in self.branches.items():
            _value_list(f"branches.{branch}", measures)
        if not self.measures:
            raise ValueError("branches is empty: no measure belongs to any branch")
        _positive("adi", self.adi)
        _positive("cv2", self.cv2)
        bounds = tuple(self.abc)
        if (len(bounds) != 2 or not all(isinstance(b, (int, float)) for b in bounds)
                or not 0 < bounds[0] < bounds[1] < 1):
            raise ValueError(f"abc needs two bounds 0 < A < B < 1, got {self.abc!r}")

    @property
    def measures(self) -> list[str]:
        return [m for group in self.branches.values() for m in group]


LINEITEM_PARAMS = Params(
    start=dt.date(1995, 1, 1), end=dt.date(2001, 12, 31), cohort_date=dt.date(1995, 7, 1),
    outlier_revenue_mln=16.0, disputed=("L2-3",))

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

EVENTS_PARAMS = Params(
    start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 30), cohort_date=dt.date(2024, 1, 8),
    outlier_revenue_mln=0.001, disputed=(),
    branches={"kg": ("click", "purchase"), "pcs": ("error", "signup", "view")})
