"""Polygons in binary against bytes written by hand and against the same polygons as text."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from tileframe.functions.binary_geometry import rings_from_wkb, wkb_from_rings
from tileframe.functions.geometry import rings_from_wkt
from workload.inputs import Inputs

SMALL = "/root/testdata/sf0.001"


def polygon(rings, order="<", kind=3, system=None, more=0):
    out = struct.pack(order + "BI", order == "<", kind)
    out += b"" if system is None else struct.pack(order + "I", system)
    out += struct.pack(order + "I", len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring))
        for x, y in ring:
            out += struct.pack(order + "dd", x, y) + struct.pack(order + "d", 7.5) * more
    return out


def text(parts):
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in p) + ")" for p in parts) + ")"


def box(x, y, size, rng=None):
    ring = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    return ring[::-1] if rng and rng.random() < 0.5 else ring


def decoded(spark, values):
    df = spark.createDataFrame([(i, v if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, b binary")
    return [r.rings for r in df.select("i", rings_from_wkb("b").alias("rings")).orderBy("i").collect()]


def test_equal_to_text(spark):
    rng = random.Random(4)
    values, texts = [], []
    for _ in range(60):
        parts = []
        for _ in range(rng.choice([1, 1, 2, 4])):
            x, y = rng.uniform(-180, 180), rng.uniform(-90, 90) * 10.0 ** rng.randint(-6, 3)
            parts.append([box(x, y, 4.0, rng)] + [box(x + 1 + k, y + 1, 0.5, rng) for k in range(rng.randint(0, 2))])
        orders = [rng.choice("<>") for _ in parts]
        if len(parts) == 1 and rng.random() < 0.7:
            values.append(polygon(parts[0], orders[0]))
        else:
            outer = rng.choice("<>")
            values.append(struct.pack(outer + "BII", outer == "<", 6, len(parts)) + b"".join(map(polygon, parts, orders)))
        texts.append(text(parts))
    want = [r.rings for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", rings_from_wkt(F.col("t")).alias("rings")).orderBy("i").collect()]
    assert decoded(spark, values) == want


def test_heights_measures_and_systems(spark):
    ring = box(100.0, 13.0, 1.0)
    plain, *others = decoded(spark, [
        polygon([ring]), polygon([ring], kind=1003, more=1), polygon([ring], ">", kind=3003, more=2), polygon([ring], kind=2003, more=1),
        polygon([ring], kind=3 | 0x80000000, more=1), polygon([ring], kind=3 | 0x20000000, system=4326),
        polygon([ring], ">", kind=3 | 0xE0000000, system=4326, more=2), polygon([ring[:-1]]),
    ])
    assert [(p.x, p.y) for p in plain[0]] == ring
    assert all(o == plain for o in others)


def test_extreme_numbers(spark):
    ring = [(0.0, -0.0), (5e-324, 1.7976931348623157e308), (-2.2250738585072014e-308, 0.1), (1 / 3, -1e-300), (0.0, 0.0)]
    got = decoded(spark, [polygon([ring]), polygon([ring], ">")])
    for rings in got:
        assert sorted((p.x, p.y) for p in rings[0]) == sorted(ring)


def test_broken_values_are_null(spark):
    good = polygon([box(0.0, 0.0, 1.0)])
    bad = [
        None, b"", good[:-1], good + b"\0", b"\2" + good[1:], struct.pack("<BIdd", 1, 1, 0, 0), struct.pack("<BII", 1, 3, 2**32 - 1),
        struct.pack("<BIII", 1, 3, 1, 2**32 - 1), polygon([[(0.0, float("nan")), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]),
        polygon([[(float("inf"), 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]),
        struct.pack("<BII", 1, 6, 1) + struct.pack("<BII", 1, 6, 1) + good,
    ]
    assert decoded(spark, bad) == [None] * len(bad)
    assert decoded(spark, [polygon([]), polygon([[]]), struct.pack("<BII", 1, 6, 0)]) == [[], [], []]


@pytest.mark.parametrize("little", [True, False])
def test_round_trip_of_all_areas(spark, little):
    areas = Inputs(spark, SMALL).areas()
    back = areas.select("rings", wkb_from_rings("rings", little).alias("b")).select("rings", "b", rings_from_wkb("b").alias("again")).collect()
    assert back and all(r.rings == r.again for r in back)
    order = "<" if little else ">"
    assert all(bytes(r.b) == polygon([[(p.x, p.y) for p in ring] for ring in r.rings], order) for r in back)


def test_long_rings(spark):
    """A ring of many points takes no more than a moment."""
    ring = [(i / 7, (i * i % 1009) / 11) for i in range(20_000)]
    (got,) = decoded(spark, [polygon([ring + ring[:1]])])
    assert len(got[0]) == 20_001
