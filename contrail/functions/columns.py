"""Column rules of the two cleaning profiles.

Profile ``N`` keeps bad positions and soft-deletes the row; profile ``L`` nulls
the bad value and raises a data-quality flag. All rules are three-valued where
the inputs may be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits, codes and default texts that decide the results.
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)
ALTITUDE_RANGE = {"N": (-1000, 60000), "L": (-500, 60000)}
SPEED_RANGE = {"N": (0, 1200), "L": (0, 1500)}
EMERGENCY_CODES = ("7500", "7600", "7700")
NO_CALLSIGN = "UNKNOWN"
NO_REGISTRATION = "UNREGISTERED"
ON_GROUND_TEXT = "ground"
INVALID_POSITION = "INVALID_COORDS"
DUPLICATE = "DUPLICATE"
DISAPPEARED = "DISAPPEARED"
INTEGER_TEXT = r"^-?\d+$"
ALTITUDE_BANDS = (
    (0, "ground_level"),
    (10000, "0_10k_ft"),
    (20000, "10k_20k_ft"),
    (35000, "20k_35k_ft"),
)
TOP_ALTITUDE_BAND = "35k_plus_ft"


def keep_within(value: Column, limits: Sequence[float]) -> Column:
    """The value, or NULL outside the closed range."""
    return F.when(value.between(*limits), value)


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def lenient_int(text: Column) -> Column:
    """Whole number from text; decimals are cut, anything else gives NULL."""
    return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))


def whole_number_or_null(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("int"))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def tidy(text: Column) -> Column:
    return empty_to_null(F.trim(text))


def tidy_upper(text: Column) -> Column:
    return empty_to_null(F.upper(F.trim(text)))


def callsign_or_unknown(flight: Column) -> Column:
    return F.coalesce(tidy(flight), F.lit(NO_CALLSIGN))


def operator_prefix(flight: Column, size: int = 3) -> Column:
    """Upper-case first letters of a trimmed callsign that is long enough."""
    name = F.trim(flight)
    return F.when(F.length(name) >= size, F.upper(F.substring(name, 1, size)))


def emergency_by_code(squawk: Column, emergency: Column) -> Column:
    """NULL squawk with a quiet emergency text stays NULL."""
    declared = emergency.isNotNull() & ~emergency.isin("none", "")
    return squawk.isin(*EMERGENCY_CODES) | declared


def emergency_by_text(emergency: Column) -> Column:
    text = F.lower(F.trim(emergency))
    return text.isNotNull() & ~text.isin("none", "")


def military_bit(flags: Column) -> Column:
    return F.coalesce(flags, F.lit(0)).bitwiseAND(F.lit(1)) == 1


def invalid_position(lat: Column, lon: Column) -> Column:
    """TRUE for a missing or out-of-range position, never NULL."""
    return ~F.coalesce(lat.between(*LAT_RANGE) & lon.between(*LON_RANGE), F.lit(False))


def on_ground(text: Column) -> Column:
    return F.lower(text) == ON_GROUND_TEXT


def altitude_band(altitude: Column) -> Column:
    band = F.when(altitude < ALTITUDE_BANDS[0][0], ALTITUDE_BANDS[0][1])
    for upper, label in ALTITUDE_BANDS[1:]:
        band = band.when(altitude < upper, label)
    return band.otherwise(TOP_ALTITUDE_BAND)


def grid_index(degrees: Column, cell_deg: int = 1) -> Column:
    return F.floor(degrees / cell_deg).cast("int")


def grid_cell(lat: Column, lon: Column, cell_deg: int = 1) -> Column:
    return F.concat_ws("_", grid_index(lat, cell_deg), grid_index(lon, cell_deg))


def safe_ratio(part: Column, whole: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(default))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded; NULL when the whole is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0).cast("bigint")), digits)


def heading_change(new: Column, old: Column, wrap: bool = False) -> Column:
    """Absolute difference in degrees; ``wrap`` goes the short way round north."""
    gap = F.abs(new - old)
    return F.least(gap, F.lit(360.0) - gap) if wrap else gap
