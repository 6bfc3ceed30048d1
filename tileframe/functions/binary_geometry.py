"""Polygons from and to well-known binary, in built-in expressions.

Both byte orders are read, also mixed within one value, with or without heights, measures and a reference system (as flags or
as thousands of the type number; they are passed by). Numbers are put together from their bits, so that they are exact.

A walk over the headers finds where each ring starts; points are decoded from those places. It takes a step per ring or part;
the steps offered are one per four bytes, the least that either can take, and those left over do nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tileframe.functions.geometry import RINGS_TYPE, close_ring, oriented

# Fixed values of the format.
_POLYGON, _MULTIPOLYGON = 3, 6
_HEIGHT, _MEASURE, _SYSTEM = 0x80000000, 0x40000000, 0x20000000

_RING = "struct<at:bigint,n:bigint,hole:boolean,little:boolean,width:bigint>"


def _turned(digits: str, size: int) -> str:
    """The bytes of a hexadecimal text in the other order."""
    return "concat(" + ", ".join(f"substr({digits}, {2 * i + 1}, 2)" for i in reversed(range(size))) + ")"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _whole(wkb: str, at: str, little: str) -> str:
    """The unsigned number of four bytes; NULL beyond the end."""
    number = f"IF(length(h4) = 8, CAST(conv(IF({little}, {_turned('h4', 4)}, h4), 16, 10) AS BIGINT), NULL)"
    return _let(f"hex(substring({wkb}, CAST({at} AS INT) + 1, 4))", "h4", number)


def _double(wkb: str, at: str, little: str) -> str:
    """The number of eight bytes; NULL for infinities and what is no number."""
    power = "IF(e = 0, m * pow(2D, -1074), (m + 4503599627370496L) * pow(2D, e - 1075))"
    value = f"IF(e = 2047, NULL, IF(high >= 2147483648L, -1D, 1D) * {power})"
    value = _let("(high & 1048575L) * 4294967296L + CAST(conv(substr(h8, 9, 8), 16, 10) AS BIGINT)", "m", value)
    value = _let("shiftright(high & 2146435072L, 20)", "e", value)
    value = _let("CAST(conv(substr(h8, 1, 8), 16, 10) AS BIGINT)", "high", value)
    digits = f"hex(substring({wkb}, CAST({at} AS INT) + 1, 8))"
    return _let(digits, "raw", _let(f"IF({little}, {_turned('raw', 8)}, raw)", "h8", value))


def _walk(wkb: str) -> str:
    """The rings of a value, each with the place of its points; NULL if it is no polygon or does not end where it should."""
    start = f"""named_struct('at', 0L, 'parts', 1L, 'rings', 0L, 'hole', false, 'little', false, 'width', 16L,
        'bad', false, 'out', CAST(array() AS array<{_RING}>))"""
    failed = "named_struct('at', s.at, 'parts', 0L, 'rings', 0L, 'hole', false, 'little', false, 'width', 16L, 'bad', true, 'out', s.out)"
    ring = f"""IF(n IS NULL OR n * s.width > length({wkb}) - s.at - 4, {failed}, named_struct(
        'at', s.at + 4 + n * s.width, 'parts', s.parts, 'rings', s.rings - 1, 'hole', true, 'little', s.little, 'width', s.width,
        'bad', false, 'out', IF(n = 0, s.out,
            concat(s.out, array(named_struct('at', s.at + 4, 'n', n, 'hole', s.hole, 'little', s.little, 'width', s.width))))))"""
    ring = _let(_whole(wkb, "s.at", "s.little"), "n", ring)

    # A header: byte order, type, perhaps a reference system, then the number of rings or of parts.
    def has(flag: int, thousands: tuple[int, int]) -> str:
        return f"IF((t & {flag}L) <> 0 OR (t & 268435455L) DIV 1000 IN {thousands}, 8L, 0L)"

    part = f"""named_struct('at', f + 4, 'parts', s.parts - 1, 'rings', c, 'hole', false, 'little', little,
        'width', 16L + {has(_HEIGHT, (1, 3))} + {has(_MEASURE, (2, 3))}, 'bad', false, 'out', s.out)"""
    parts = f"""named_struct('at', f + 4, 'parts', c, 'rings', 0L, 'hole', false, 'little', little, 'width', 16L,
        'bad', false, 'out', s.out)"""
    kind = "(t & 268435455L) % 1000"
    header = f"""CASE WHEN c IS NULL OR c > length({wkb}) THEN {failed} WHEN {kind} = {_POLYGON} THEN {part}
        WHEN {kind} = {_MULTIPOLYGON} AND s.at = 0 THEN {parts} ELSE {failed} END"""
    header = _let(_whole(wkb, "f", "little"), "c", header)
    header = _let(f"s.at + 5 + IF((t & {_SYSTEM}L) <> 0, 4L, 0L)", "f", header)
    header = _let(_whole(wkb, "s.at + 1", "little"), "t", header)
    order = f"hex(substring({wkb}, CAST(s.at AS INT) + 1, 1))"
    header = f"IF({order} IN ('00', '01'), {_let(f'{order} = ' + repr('01'), 'little', header)}, {failed})"

    step = f"CASE WHEN s.rings > 0 THEN {ring} WHEN s.parts > 0 THEN {header} ELSE s END"
    done = f"IF(s.bad OR s.parts > 0 OR s.rings > 0 OR s.at <> length({wkb}), NULL, s.out)"
    return f"IF(length({wkb}) < 9, NULL, aggregate(sequence(1, length({wkb}) DIV 4 + 1), {start}, (s, _) -> {step}, s -> {done}))"


def rings_from_wkb(wkb: str) -> Column:
    """Rings of the polygon or multi-polygon in a binary column, as ``geometry.rings_from_wkt`` gives them for text.

    NULL for other kinds, for numbers that are not finite, and for values that end too early or too late. Empty rings drop out.
    """
    # Held as a variable, as a read of a binary column copies it whole.
    x = _double("held", "r.at + i * r.width", "r.little")
    y = _double("held", "r.at + i * r.width + 8", "r.little")
    points = f"transform(sequence(0L, r.n - 1), i -> named_struct('x', {x}, 'y', {y}))"
    rings = F.expr(_let(wkb, "held", f"transform({_walk('held')}, r -> named_struct('points', {points}, 'hole', r.hole))"))
    closed = F.transform(rings, lambda r: F.struct(close_ring(r["points"]).alias("points"), r["hole"].alias("hole")))
    turned = F.transform(closed, lambda r: oriented(r["points"], r["hole"]))
    # Points without a number are looked for once, in the finished rings.
    whole = F.transform(F.array(turned), lambda t: F.when(~F.exists(F.flatten(t), lambda p: p["x"].isNull() | p["y"].isNull()), t))
    return F.get(whole, F.lit(0)).cast(RINGS_TYPE)


def _bits(value: str) -> str:
    """Sixteen hexadecimal digits of a normal double or zero."""
    mantissa = f"CAST(abs({value}) * pow(2D, 52 - e) AS BIGINT)"
    # The logarithm may be off by one next to a power of two.
    guess = f"CAST(floor(log2(abs({value}))) AS INT)"
    fitted = _let(guess, "g", f"CASE WHEN abs({value}) < pow(2D, g) THEN g - 1 WHEN abs({value}) >= pow(2D, g + 1) THEN g + 1 ELSE g END")
    digits = f"hex(({mantissa} - 4503599627370496L) + (e + 1023L) * 4503599627370496L)"
    signed = f"IF({value} < 0, concat(substr('89ABCDEF', CAST(conv(substr(d, 1, 1), 16, 10) AS INT) + 1, 1), substr(d, 2)), d)"
    return f"IF({value} = 0, '0000000000000000', {_let(fitted, 'e', _let(f'lpad({digits}, 16, ' + repr('0') + ')', 'd', signed))})"


def wkb_from_rings(rings: str, little: bool = True) -> Column:
    """A polygon of one part, its outer ring first, as binary. For coordinates that are zero or between 2^-900 and 2^900."""

    def ordered(digits: str, size: int) -> str:
        return _let(digits, "o", _turned("o", size)) if little else digits

    def whole(number: str) -> str:
        return ordered(f"lpad(hex(CAST({number} AS BIGINT)), 8, '0')", 4)

    point = f"concat({ordered(_bits('q.x'), 8)}, {ordered(_bits('q.y'), 8)})"
    ring = f"concat({whole('size(r)')}, array_join(transform(r, q -> {point}), ''))"
    head = f"concat('{'01' if little else '00'}', {whole(str(_POLYGON))}, {whole(f'size({rings})')})"
    return F.expr(f"unhex(concat({head}, array_join(transform({rings}, r -> {ring}), '')))")
