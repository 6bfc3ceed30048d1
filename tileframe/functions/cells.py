"""Web-map tile keys and geohashes as built-in expressions (no Python per row).

Both keys interleave the bits of a column and a row number. Writing each number in
binary and adding ``a + 2 * b`` as *decimal* digits interleaves them without carry:
every digit of the sum is 0..3, that is, one base-4 digit of the key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the public geohash format: digit alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# Fixed value of the public tile scheme: points this close below a cell edge count in the next cell.
EDGE_EPSILON = 1e-14

TILE_KEY_PATTERN = "^[0-3]{1,30}$"


def _clamped_cell(fraction: Column, zoom: int) -> Column:
    cells = 2**zoom
    cell = F.floor((fraction + F.lit(EDGE_EPSILON)) * F.lit(float(cells)))
    return F.when(fraction <= 0, F.lit(0)).when(fraction >= 1, F.lit(cells - 1)).otherwise(cell)


def tile_x(lon: Column, zoom: int) -> Column:
    """Tile column of a longitude; longitudes beyond +-180 fall in the edge columns."""
    usable = F.when(~F.isnan(lon), lon)
    return _clamped_cell(usable / 360.0 + 0.5, zoom).cast("long")


def tile_y(lat: Column, zoom: int) -> Column:
    """Tile row of a latitude (0 is the northern edge); NULL at and beyond the poles."""
    # Rows end near 85.05 degrees, so anything closer to a pole is in the edge row.
    usable = F.when(F.abs(lat) < 90, F.greatest(F.least(lat, F.lit(89.0)), F.lit(-89.0)))
    s = F.sin(F.radians(usable))
    fraction = 0.5 - 0.25 * F.ln((1 + s) / (1 - s)) / F.lit(math.pi)
    return _clamped_cell(fraction, zoom).cast("long")


def _base4_digits(ones: Column, twos: Column, size: int) -> Column:
    """Digits ``ones_bit + 2 * twos_bit``, as text without leading zeros in front of the first 15 from the right."""
    if size <= 18:
        return (F.bin(ones).cast("long") + F.bin(twos).cast("long") * 2).cast("string")
    low = F.lit((1 << 15) - 1)
    right = _base4_digits(ones.bitwiseAND(low), twos.bitwiseAND(low), 15)
    left = _base4_digits(F.shiftright(ones, 15), F.shiftright(twos, 15), size - 15)
    return F.concat(left, F.lpad(right, 15, "0"))


def tile_key_from_xy(x: Column, y: Column, zoom: int) -> Column:
    if zoom < 1:
        raise ValueError("zoom must be at least 1")
    return F.lpad(_base4_digits(x, y, zoom), zoom, "0")


def tile_key(lat: Column, lon: Column, zoom: int) -> Column:
    """Key of the tile that holds a point; NULL if a coordinate is missing."""
    return tile_key_from_xy(tile_x(lon, zoom), tile_y(lat, zoom), zoom)


def checked_key(key: Column) -> Column:
    """The key itself, or NULL if it is malformed."""
    return F.when(key.rlike(TILE_KEY_PATTERN), key)


def key_x(key: Column) -> Column:
    return F.conv(F.translate(checked_key(key), "0123", "0101"), 2, 10).cast("long")


def key_y(key: Column) -> Column:
    return F.conv(F.translate(checked_key(key), "0123", "0011"), 2, 10).cast("long")


def _lon_of(x: Column, size: Column) -> Column:
    return x / size * 360.0 - 180.0


def _lat_of(y: Column, size: Column) -> Column:
    return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * y / size))))


def tile_bounds(key: Column) -> dict[str, Column]:
    """West, south, east and north edge of a tile in degrees, as four columns."""
    x, y = key_x(key), key_y(key)
    size = F.pow(F.lit(2.0), F.length(key))
    return {
        "west": _lon_of(x, size),
        "south": _lat_of(y + 1, size),
        "east": _lon_of(x + 1, size),
        "north": _lat_of(y, size),
    }


def tile_centroid(key: Column) -> dict[str, Column]:
    """Planar centroid of the tile outline (the middle of its bounds)."""
    b = tile_bounds(key)
    return {"lon": (b["west"] + b["east"]) / 2, "lat": (b["south"] + b["north"]) / 2}


def plain_number(value: Column, decimals: int | None = None) -> Column:
    """Number as text without exponent or trailing zeros, as WKT writers print it."""
    if decimals is not None:
        value = F.round(value, decimals)
    digits = value.cast("decimal(38,20)").cast("string")
    return F.rtrim(F.rtrim(digits, F.lit("0")), F.lit("."))


def tile_outline(key: Column, decimals: int | None = None) -> Column:
    """Outline of a tile as WKT, from the south-west corner by the north-west; NULL for a bad key."""
    b = {edge: plain_number(v, decimals) for edge, v in tile_bounds(key).items()}
    corners = [("west", "south"), ("west", "north"), ("east", "north"), ("east", "south"), ("west", "south")]
    text: list[Column] = []
    for x, y in corners:
        text += [F.lit(", " if text else "POLYGON (("), b[x], F.lit(" "), b[y]]
    return F.concat(*text, F.lit("))"))


def geohash(lat: Column, lon: Column, precision: int) -> Column:
    """Geohash of a point; NULL if a coordinate is missing or the latitude is not in [-90, 90)."""
    if not 1 <= precision <= 12:
        raise ValueError("precision must be 1..12")
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2
    inside = (lon >= -180) & (lon < 180)
    wrapped = F.when(inside, lon).when(~F.isnan(lon), F.pmod(lon + 180.0, F.lit(360.0)) - 180.0)
    usable = F.when((lat >= -90) & (lat < 90), lat)
    col = F.floor((wrapped + 180.0) / 360.0 * F.lit(float(2**lon_bits))).cast("long")
    row = F.floor((usable + 90.0) / 180.0 * F.lit(float(2**lat_bits))).cast("long")
    ones, twos = (row, col) if lon_bits == lat_bits else (col, row)
    code = F.lower(F.conv(_base4_digits(ones, twos, lon_bits), 4, 32))
    return F.translate(F.lpad(code, precision, "0"), "0123456789abcdefghijklmnopqrstuv", GEOHASH_ALPHABET)


def parent_cell(key: Column, length: int) -> Column:
    """Key of the enclosing coarser cell: a prefix, for tiles and geohashes alike."""
    return F.substring(key, 1, length)
