"""Derived measures. All divisions are NULL on a zero divisor, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the KPI definitions.
SALES_WINDOW_DAYS = 30
NO_SALES_COVERAGE_DAYS = 999
SIGMA_LIMIT = 3


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole) * 100


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; 0 (not NULL) for an all-false group."""
    return F.count_if(condition)


def line_total(quantity: Column | str, unit_price: Column | str, discount_pct: Column | str) -> Column:
    discount = F.lit(1) - _col(discount_pct) / F.lit(100)
    return F.round(_col(quantity) * _col(unit_price) * discount, 2)


def stock_value(quantity: Column | str, unit_cost: Column | str) -> Column:
    return _col(quantity) * _col(unit_cost)


def stock_status(
    on_hand: Column | str, reorder_point: Column | str, out_of_stock_first: bool = False
) -> Column:
    """Label of a stock level.

    By default the low-stock test comes first, so an empty shelf is ``out_of_stock``
    only where the reorder point is NULL or negative. ``out_of_stock_first`` swaps
    the two tests.
    """
    low = (_col(on_hand) <= _col(reorder_point), "low_stock")
    out = (_col(on_hand) <= 0, "out_of_stock")
    first, second = (out, low) if out_of_stock_first else (low, out)
    return F.when(*first).when(*second).otherwise("in_stock")


def unit_turnover(sold: Column | str, on_hand: Column | str) -> Column:
    """Units sold per unit on hand; 0 where nothing is on hand."""
    return F.when(_col(on_hand) > 0, ratio(sold, on_hand)).otherwise(F.lit(0.0))


def coverage_days(on_hand: Column | str, sold: Column | str) -> Column:
    """Days the stock lasts at the sales pace of the window; a fixed high value without sales."""
    pace = _col(sold) / F.lit(SALES_WINDOW_DAYS)
    return F.when(_col(sold) > 0, ratio(on_hand, pace)).otherwise(
        F.lit(float(NO_SALES_COVERAGE_DAYS))
    )


def z_score(value: Column | str, mean: Column | str, deviation: Column | str) -> Column:
    """Signed distance in standard deviations; NULL for a constant or single-reading group."""
    return F.try_divide(_col(value) - _col(mean), _col(deviation))


def sigma_distance(value: Column | str, mean: Column | str, deviation: Column | str) -> Column:
    return F.abs(z_score(value, mean, deviation))


def is_true(condition: Column) -> Column:
    """Two-valued test: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def anomaly_side(value: Column | str, lower: Column | str, upper: Column | str) -> Column:
    return (
        F.when(_col(value) < _col(lower), "below_threshold")
        .when(_col(value) > _col(upper), "above_threshold")
        .otherwise("normal")
    )
