"""Row measures and flags (C9, C10, C12, C13) and exact money aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def holiday_flag(name: Column | str = "holiday_name") -> Column:
    return F.when(_c(name).isNotNull(), 1).otherwise(0)


def profit_margin(profit: Column | str = "Profit", sales: Column | str = "Sales") -> Column:
    """round(Profit / Sales * 100, 2); Sales = 0 or NULL gives NULL."""
    return F.round(F.try_divide(_c(profit), _c(sales)) * 100, 2)


def positive_flag(c: Column | str) -> Column:
    return F.when(_c(c).isNotNull() & (_c(c) > 0.0), 1).otherwise(0)


# Thresholds of the extreme-weather flag (strictly greater than).
EXTREME_PRECIPITATION_MM = 25.0
EXTREME_SNOWFALL_CM = 5.0
EXTREME_WIND_KMH = 40.0


def extreme_weather_flag(precip="precipitation_mm", snow="snowfall_cm", wind="wind_speed_kmh") -> Column:
    p, s, w = _c(precip), _c(snow), _c(wind)
    hit = ((p.isNotNull() & (p > EXTREME_PRECIPITATION_MM))
           | (s.isNotNull() & (s > EXTREME_SNOWFALL_CM))
           | (w.isNotNull() & (w > EXTREME_WIND_KMH)))
    return F.when(hit, 1).otherwise(0)


# Money is summed as decimals of this scale: order-independent, 20 digits before the point.
EXACT = "decimal(38,18)"


def _exact(c: Column) -> Column:
    """The value as a decimal; NULL where none holds it (NaN, infinite, 1e20 and more)."""
    return c.try_cast(EXACT)


def _special(c: Column) -> Column:
    """The values that no decimal holds, as doubles."""
    return F.when(_exact(c).isNull(), c.cast("double"))


def exact_total(c: Column | str, over=None) -> tuple[Column, Column]:
    """SUM of ``c`` in two parts: the decimal sum and the sum of what no decimal holds
    (NULL where there is none); ``over`` is a window."""
    parts = F.try_sum(_exact(_c(c))), F.sum(_special(_c(c)))
    return parts if over is None else tuple(x.over(over) for x in parts)


def as_double(total: Column, special: Column) -> Column:
    """One double from the two parts of a sum (NaN and infinities win as in plain double sums)."""
    whole = total.cast("double")
    return F.when(special.isNull(), whole).otherwise(special + F.coalesce(whole, F.lit(0.0)))


def money_sum(c: Column | str) -> Column:
    """Order-independent SUM of a money column, as a double.

    Values are summed as decimals, so the total is the same whatever the
    partitioning; NaN gives NaN.  A total beyond the decimals' range falls
    back to the sum of doubles.
    """
    col = _c(c)
    total, special = exact_total(col)
    some = F.count(_exact(col)) > 0
    return F.when(some & total.isNull(), F.sum(col.cast("double"))).otherwise(as_double(total, special))


def money_avg(c: Column | str) -> Column:
    """Order-independent AVG (exact sum / non-null count)."""
    return money_sum(c) / F.count(_c(c))


def money_parts(c: Column | str, name: str) -> list[Column]:
    """Aggregates that keep the sum and the average of a money column mergeable: rows of
    partial results give the same ``money_sum`` and ``money_avg`` as the rows behind them."""
    col = _c(c)
    total, special = exact_total(col)
    return [total.cast(EXACT).alias(f"{name}__total"), special.alias(f"{name}__special"), F.count(_exact(col)).alias(f"{name}__exact"),
            F.sum(col.cast("double")).alias(f"{name}__double"), F.count(col).alias(f"{name}__values")]


def merged_sum(name: str) -> Column:
    """``money_sum`` of the rows behind partial results made with ``money_parts``."""
    total, exact = F.col(f"{name}__total"), F.col(f"{name}__exact")
    lost = F.bool_or((exact > 0) & total.isNull())  # a part was beyond the decimals' range
    whole = F.when(~lost, F.try_sum(total))
    some = F.sum(exact) > 0
    return F.when(some & whole.isNull(), F.sum(f"{name}__double")).otherwise(as_double(whole, F.sum(f"{name}__special")))


def merged_avg(name: str) -> Column:
    return merged_sum(name) / F.sum(f"{name}__values")
