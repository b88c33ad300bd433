"""Geohash and distance columns.

A geohash of p characters spells 5p bits in base 32, longitude first and alternating with latitude.
Written in base 4, every digit holds one bit of each, and ``translate`` keeps the wanted one. Both
directions are a few built-in string functions that name their input once, so no place table has
to be decoded aside and joined back, and a filter on a coordinate can move down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public geohash base-32 alphabet, the letters it leaves out, the digits of
# ordinary base 32, and the mean Earth radius in km.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
LEFT_OUT = "ailo"
BASE32_DIGITS = "0123456789abcdefghijklmnopqrstuv"
EARTH_RADIUS_KM = 6371.0

_HIGH_BIT = "0011"
_LOW_BIT = "0101"


def _bits(precision: int, is_long: bool) -> int:
    """How many bits a coordinate has."""
    return (5 * precision + is_long) // 2


def _is_low(precision: int, is_long: bool) -> bool:
    """Whether a coordinate has the lower bit of each base-4 digit: the one whose bit is last."""
    return is_long == (5 * precision % 2 == 1)


def cell_number(geohash: Column, is_long: bool, precision: int = 6) -> Column:
    """The row (latitude) or column (longitude) number of a geohash cell.

    NULL when the geohash does not have ``precision`` characters of the alphabet.
    """
    digits = F.translate(geohash, ALPHABET + LEFT_OUT, BASE32_DIGITS)
    kept = _LOW_BIT if _is_low(precision, is_long) else _HIGH_BIT
    bits = F.translate(F.conv(digits, 32, 4), "0123", kept)
    return F.when(F.length(digits) == precision, F.conv(bits, 2, 10).cast("bigint"))


def geohash_of_cell(lat_cell: Column, long_cell: Column, precision: int = 6) -> Column:
    """The geohash of a cell given by its row and column numbers.

    A number's binary digits read in base 4 are its bits with gaps between, for the other number's.
    NULL when a number does not fit the bits of its coordinate: a code is never cut.
    """

    def spread(cell: Column) -> Column:
        return F.conv(F.conv(cell.cast("string"), 10, 2), 4, 10).cast("bigint")

    low, high = lat_cell, long_cell
    if _is_low(precision, True):
        low, high = high, low
    code = spread(high) * 2 + spread(low)
    digits = F.lpad(F.lower(F.conv(code.cast("string"), 10, 32)), precision, "0")
    fits = lat_cell.between(0, 2 ** _bits(precision, False) - 1) & long_cell.between(
        0, 2 ** _bits(precision, True) - 1
    )
    return F.when(fits, F.translate(digits, BASE32_DIGITS, ALPHABET))


def geohash_lat(geohash: Column, precision: int = 6) -> Column:
    """Latitude of the cell centre."""
    step = 180.0 / 2 ** _bits(precision, False)
    return (cell_number(geohash, False, precision) + 0.5) * step - 90.0


def geohash_long(geohash: Column, precision: int = 6) -> Column:
    """Longitude of the cell centre."""
    step = 360.0 / 2 ** _bits(precision, True)
    return (cell_number(geohash, True, precision) + 0.5) * step - 180.0


def add_lat_long(df: DataFrame, geohash: str = "geohash6", precision: int = 6) -> DataFrame:
    """Add ``lat`` and ``long``, the centre of each row's geohash cell."""
    return df.withColumns(
        {
            "lat": geohash_lat(F.col(geohash), precision),
            "long": geohash_long(F.col(geohash), precision),
        }
    )


def haversine_km(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    """Great-circle distance in km."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_long = F.radians(long2 - long1) / 2
    h = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_long), F.lit(2.0))
    return F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_KM)
