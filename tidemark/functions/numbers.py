"""Numeric expressions: Column in, Column out."""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidemark import fixed


def to_double(c: Column) -> Column:
    """Number or null; the type suffixes that the JVM takes are no numbers in a data file."""
    return F.when(~F.right(F.rtrim(c), F.lit(1)).isin("d", "D", "f", "F"), c.try_cast("double"))


def coordinates_valid(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(*fixed.LATITUDE_RANGE) & lon.between(*fixed.LONGITUDE_RANGE), F.lit(False))


def coordinate_error(lat_raw: Column, lon_raw: Column, lat: Column, lon: Column) -> Column:
    return (
        F.when(lat_raw.isNull() | lon_raw.isNull(), None)
        .when(lat.isNull() | lon.isNull(), "Invalid coordinate format")
        .when(~lat.between(*fixed.LATITUDE_RANGE), F.concat(F.lit("Latitude out of bounds: "), lat.cast("string")))
        .when(~lon.between(*fixed.LONGITUDE_RANGE), F.concat(F.lit("Longitude out of bounds: "), lon.cast("string")))
    )


def min_max_scaled(c: Column, by) -> Column:
    w = Window.partitionBy(*by)
    low, high = F.min(c).over(w), F.max(c).over(w)
    return F.coalesce(F.try_divide(c - low, high - low), F.lit(0.0))


def min_max_restored(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low


def standardized(c: Column, by) -> Column:
    """Centred on the mean in units of the population deviation; a constant series is only centred."""
    w = Window.partitionBy(*by)
    deviation = F.stddev_pop(c).over(w)
    return (c - F.avg(c).over(w)) / F.when(deviation == 0, 1.0).otherwise(deviation)


def restored(scaled: Column, mean: Column, deviation: Column) -> Column:
    return scaled * deviation + mean


def improvement_pct(baseline: Column, value: Column) -> Column:
    return F.try_divide(baseline - value, baseline) * 100


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def hashed_uniform(*parts: Column) -> Column:
    """Uniform draw in (0, 1) that depends on the given values alone, not on partitions or row order."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return (F.conv(F.substr(F.md5(text), F.lit(1), F.lit(8)), 16, 10).cast("double") + 0.5) / 4294967296.0


def hashed_normal(*parts: Column) -> Column:
    """Standard normal draw (Box-Muller) from two hashed uniform draws."""
    return F.sqrt(-2 * F.log(hashed_uniform(*parts, F.lit("r")))) * F.cos(
        2 * F.pi() * hashed_uniform(*parts, F.lit("a"))
    )
