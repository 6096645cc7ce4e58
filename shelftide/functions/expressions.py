"""Column expressions used by several layers."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from shelftide.functions import labels
from shelftide.params import Params


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, where there is nothing to divide by."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def map_values(column: Column, mapping: Mapping, default: Column) -> Column:
    """Dictionary lookup; a value outside the dictionary gets the default."""
    result = default
    for key, value in reversed(list(mapping.items())):
        result = F.when(column == F.lit(key), F.lit(value)).otherwise(result)
    return result


def branch_of(measure: Column, branches: Mapping[str, Sequence[str]]) -> Column:
    owners = {m: branch for branch, measures in branches.items() for m in measures}
    if not owners:
        raise ValueError("branches is empty: no measure belongs to any branch")
    return map_values(measure, owners, F.lit(labels.UNKNOWN))


def scope_of(subgroup: Column, disputed: Sequence[str]) -> Column:
    if isinstance(disputed, (str, bytes)):
        raise ValueError(f"disputed must be a list of subgroups, got {disputed!r}")
    if not disputed:
        return F.lit(labels.MAIN)
    return (F.when(subgroup.isin(list(disputed)), F.lit(labels.DISPUTED))
            .otherwise(F.lit(labels.MAIN)))


def threshold_of(branch: Column, thresholds: Mapping[str, float]) -> Column:
    """Availability threshold; a branch without one fails the job, and only if it occurs."""
    missing = F.raise_error(F.concat(F.lit("no availability threshold for branch "), branch))
    return map_values(branch, {b: float(t) for b, t in thresholds.items()},
                      missing.cast("double"))


def is_active() -> Column:
    return ((F.col("SalesQty") > 0) | (F.col("StockStartQty") > 0) | (F.col("StockEndQty") > 0))


def demand_quadrant(adi: Column, cv2: Column, params: Params) -> Column:
    rare, jumpy = adi >= F.lit(float(params.adi)), cv2 >= F.lit(float(params.cv2))
    return (F.when(adi.isNull() | cv2.isNull() | F.isnan(cv2), F.lit(labels.NOT_APPLICABLE))
            .when(rare & jumpy, F.lit(labels.LUMPY))
            .when(rare, F.lit(labels.INTERMITTENT))
            .when(jumpy, F.lit(labels.ERRATIC))
            .otherwise(F.lit(labels.SMOOTH)))


def normal_tail(z: Column) -> Column:
    """Chance of a standard normal value at least as far from 0 as z, on both sides: erfc(|z| / sqrt 2) by the
    rational formula of Abramowitz and Stegun, 7.1.26, right to 1.5e-7."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = F.lit(1.061405429)
    for c in (-1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = poly * t + c
    return poly * t * F.exp(-x * x)


def exact(value: Column) -> Column:
    """Fixed-point copy of a double, so that sums do not depend on the order of addition.

    Ten places after the point, 28 before: a value under 5e-11 becomes 0.
    """
    return value.cast("decimal(38,10)")
