"""Number expressions: safe ratios, clipping, bands and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels with the inclusive upper edge of each band.
PRECIPITATION_BANDS = (
    (0.0, "No measured precipitation"),
    (0.5, "Trace to 0.5 mm"),
    (2.0, "0.5 to 2 mm"),
    (10.0, "2 to 10 mm"),
    (None, "10+ mm"),
)
TEMPERATURE_BANDS = (
    (0.0, "Below 0 C"),
    (5.0, "0 to 5 C"),
    (10.0, "5 to 10 C"),
    (15.0, "10 to 15 C"),
    (20.0, "15 to 20 C"),
    (25.0, "20 to 25 C"),
    (None, "25+ C"),
)
LOWEST_PRECIPITATION = -0.001
MISSING_BAND = "nan"
WET, DRY = "precipitation_observed", "no_precipitation"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: Column | str, denominator: Column | str, default: float | None = 0.0) -> Column:
    """Quotient as double, or the default when the denominator is zero."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d != 0, n / d).when(d == 0, F.lit(default).cast("double"))


def clip01(c: Column | str) -> Column:
    return F.least(F.greatest(_col(c), F.lit(0.0)), F.lit(1.0))


def percent(c: Column | str) -> Column:
    """Share as a percentage, half-even rounded to two places."""
    return F.bround(_col(c) * 100, 2)


def risk_from_probability(c: Column | str) -> Column:
    return F.bround(_col(c) * 100, 1)


def scale_0_100(c: Column, low: Column, high: Column) -> Column:
    """Min-max scale to 0..100 with one decimal; null counts as 0, a constant column gives 50."""
    value = F.coalesce(c.cast("double"), F.lit(0.0))
    return F.when(high == low, F.lit(50.0)).otherwise(F.bround((value - low) / (high - low) * 100, 1))


def _band(value: Column, bands) -> Column:
    *closed, (_, top) = bands
    out = F.lit(top)
    for edge, label in reversed(closed):
        out = F.when(value <= edge, label).otherwise(out)
    return F.when(value.isNull() | F.isnan(value), MISSING_BAND).otherwise(out)


def precipitation_band(precipitation: Column | str, rain: Column | str) -> Column:
    """Right-closed band of precipitation, else rain, else 0."""
    mm = F.coalesce(_col(precipitation), _col(rain), F.lit(0.0))
    return F.when(mm <= LOWEST_PRECIPITATION, MISSING_BAND).otherwise(_band(mm, PRECIPITATION_BANDS))


def temperature_band(temperature: Column | str) -> Column:
    return _band(_col(temperature), TEMPERATURE_BANDS)


def temperature_bucket(temperature: Column | str) -> Column:
    """Whole degrees, halves away from zero as SQL ``round`` does."""
    return F.round(_col(temperature), 0)


def precipitation_flag(*amounts: Column | str) -> Column:
    """Whether the given amounts add up to more than zero; null counts as none."""
    total = sum((F.coalesce(_col(a), F.lit(0.0)) for a in amounts), F.lit(0.0))
    return F.when(total > 0, WET).otherwise(DRY)
