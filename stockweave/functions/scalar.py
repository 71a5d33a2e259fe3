"""Column functions. All are built-in expressions and stay inside code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season of each calendar month, and the number of each season.
SEASON_OF_MONTH = {
    1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring", 6: "Summer",
    7: "Summer", 8: "Summer", 9: "Fall", 10: "Fall", 11: "Fall", 12: "Winter",
}
SEASON_NUMBER = {"Spring": 1, "Summer": 2, "Fall": 3, "Winter": 4}

# Amounts pass through this type before rounding, so that a rounding step never
# depends on the last binary digit of a double.
ROUNDING_TYPE = "decimal(28,8)"


def as_of_date(as_of: dt.date | None = None) -> Column:
    """The day a report is made for; today unless given."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(end, start)


def year_month(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(year, month, F.lit(1))


def round_half_up(value: Column, places: int = 2) -> Column:
    return F.round(value.cast(ROUNDING_TYPE), places).cast("double")


def round_half_even(value: Column, places: int = 0) -> Column:
    return F.bround(value.cast(ROUNDING_TYPE), places).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double; null where `whole` is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    keep = F.lit(1).cast("decimal(4,2)") - discount
    return (price * quantity.cast("decimal(10,0)") * keep).cast("decimal(18,2)")


def season(month: Column) -> Column:
    names = [x for pair in SEASON_OF_MONTH.items() for x in pair]
    return F.create_map(*[F.lit(x) for x in names])[month.cast("int")]


def season_number(month: Column) -> Column:
    codes = [x for m, name in SEASON_OF_MONTH.items() for x in (m, SEASON_NUMBER[name])]
    return F.create_map(*[F.lit(x) for x in codes])[month.cast("int")]


def stock_status(on_hand: Column, reorder_point: Column) -> Column:
    return (
        F.when(on_hand > reorder_point * 2, "Overstocked")
        .when(on_hand < reorder_point, "Understocked")
        .otherwise("Normal")
    )


def risk_segment(probability: Column, cuts: tuple[float, float] = (0.3, 0.6)) -> Column:
    """Right-closed bins over (0, 1]; a probability of exactly 0 belongs to none."""
    low, high = cuts
    return (
        F.when((probability > 0) & (probability <= low), "Low Risk")
        .when((probability > low) & (probability <= high), "Medium Risk")
        .when((probability > high) & (probability <= 1), "High Risk")
    )


def rfm_segment(total: Column) -> Column:
    return (
        F.when(total >= 13, "VIP")
        .when(total >= 10, "Loyal")
        .when(total >= 7, "Potential")
        .when(total >= 4, "At Risk")
        .otherwise("Lost")
    )


def value_segment(revenue: Column, mid: float = 10_000, high: float = 50_000) -> Column:
    return (
        F.when(revenue > high, "High Value").when(revenue > mid, "Mid Value").otherwise("Low Value")
    )


def transfer_priority(needed: Column) -> Column:
    return F.when(needed > 100, "High").when(needed > 50, "Medium").otherwise("Low")
