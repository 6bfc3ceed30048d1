"""Operator inputs, derived by Spark from the given tables.

Positions come from integer arithmetic modulo primes and one division, so that both engines
compute the same doubles. The area of interest is longitude 100-101, latitude 13-14.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tileframe.functions.binary_geometry import wkb_from_rings
from tileframe.functions.cells import key_x, tile_centroid, tile_key
from tileframe.functions.geometry import RINGS_TYPE
from tileframe.sources.workspace import stored

ZOOM = 14


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._tile_map: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @staticmethod
    def _lattice(df: DataFrame, key: str) -> DataFrame:
        return df.selectExpr(
            "*",
            f"100D + (({key} * 7919L) % 100003L) / 100003D AS lon",
            f"13D + (({key} * 15485863L) % 99991L) / 99991D AS lat",
        )

    @staticmethod
    def _tiled(df: DataFrame, zoom: int) -> DataFrame:
        return df.withColumn("tile", tile_key(F.col("lat"), F.col("lon"), zoom))

    # --- pings

    def pings(self) -> DataFrame:
        return self._pings()

    def _pings(self, *more: str) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "user_id AS device_id",
            "ts",
            "100D + ((event_id * 7919L + user_id * 104729L) % 100003L) / 100003D AS lon",
            """IF(event_id % 97 = 0, NULL,
                13D + ((event_id * 15485863L + user_id * 32452843L) % 99991L) / 99991D) AS lat""",
            *more,
        )

    def pings_ms(self) -> DataFrame:
        """The second feed: epoch milliseconds, a consent text, an internet provider."""
        epoch = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
        return self._pings("event_type AS isp", "props AS consent").selectExpr("event_id", "device_id", f"{epoch} AS ts_ms", "lon", "lat", "isp", "consent")

    # --- areas

    def nations(self) -> DataFrame:
        """Nations with their region; both tables have a fixed number of rows."""
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "n_nationkey", "r_name AS adm1", "n_name AS adm2"
        )

    def areas(self) -> DataFrame:
        """Nations as a 5 x 5 grid, each cell cut by its diagonals into four triangles."""
        cells = self.nations().selectExpr(
            "*", "n_nationkey DIV 5 AS r", "n_nationkey % 5 AS c", "explode(sequence(0, 3)) AS t"
        )
        corners = [(0, 0), (1, 0), (1, 1), (0, 1)]

        def point(dx: int, dy: int) -> str:
            return f"named_struct('x', (500 + c + {dx}) / 5D, 'y', (65 + r + {dy}) / 5D)"

        middle = "named_struct('x', (1001 + 2 * c) / 10D, 'y', (131 + 2 * r) / 10D)"
        rings = [
            f"array({point(*a)}, {point(*b)}, {middle}, {point(*a)})"
            for a, b in zip(corners, corners[1:] + corners[:1])
        ]
        picked = " ".join(f"WHEN {i} THEN {ring}" for i, ring in enumerate(rings))
        return cells.selectExpr(
            "adm1", "adm2", "concat(adm2, '_', t) AS adm3", f"CAST(array(CASE t {picked} END) AS {RINGS_TYPE}) AS rings"
        )

    def area_wkt(self) -> DataFrame:
        """The same areas as text, the form in which polygon tables arrive."""
        return self.areas().selectExpr(
            "adm3",
            """concat('POLYGON ((', array_join(transform(rings[0], p -> concat(p.x, ' ', p.y)), ', '), '))') AS wkt""",
        )

    def area_wkb(self) -> DataFrame:
        """The same areas as well-known binary, the form of native geometry columns, in both byte orders."""
        shape = F.when(F.substring("adm3", -1, 1).isin("0", "2"), wkb_from_rings("rings")).otherwise(wkb_from_rings("rings", little=False))
        return self.areas().select("adm3", shape.alias("shape"))

    @staticmethod
    def with_nation(df: DataFrame, nations: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
        """Add adm1, adm2, adm3 of a position by grid arithmetic."""
        east, north = f"(({lon} - 100D) * 5D)", f"(({lat} - 13D) * 5D)"
        placed = df.selectExpr(
            "*",
            f"greatest(least(floor({east}), 4), 0) AS _c",
            f"greatest(least(floor({north}), 4), 0) AS _r",
        ).selectExpr("*", f"{east} - _c - 0.5D AS _dx", f"{north} - _r - 0.5D AS _dy")
        named = placed.join(F.broadcast(nations), F.expr("_r * 5 + _c = n_nationkey"))
        part = "IF(abs(_dy) >= abs(_dx), IF(_dy < 0, 0, 2), IF(_dx > 0, 1, 3))"
        return named.withColumn("adm3", F.expr(f"concat(adm2, '_', {part})")).drop(
            "_c", "_r", "_dx", "_dy", "n_nationkey"
        )

    # --- buildings

    def parts(self) -> DataFrame:
        return self._lattice(self.table("part"), "p_partkey")

    def footprints(self) -> DataFrame:
        """A box around each centre, every third one an L."""
        shape = """IF(p_partkey % 3 = 0,
            array(array(-1, -1), array(1, -1), array(1, 0), array(0, 0), array(0, 1), array(-1, 1), array(-1, -1)),
            array(array(-1, -1), array(1, -1), array(1, 1), array(-1, 1), array(-1, -1)))"""
        # A file of many rows can be one task; the shapes are the work.
        parts = self.parts().select("p_partkey", "p_size", "lon", "lat").hint("rebalance")
        placed = self.with_nation(parts, self.nations())
        return placed.selectExpr(
            "p_partkey AS building_id",
            "concat('pl_', p_partkey) AS place_id",
            "adm1",
            f"""CAST(array(transform({shape}, m -> named_struct(
                'x', lon + m[0] * (p_size / 5000D), 'y', lat + m[1] * (p_size / 5000D)))) AS {RINGS_TYPE}) AS rings""",
        )

    def buildings(self, zoom: int = ZOOM) -> DataFrame:
        return self._tiled(self.parts(), zoom).selectExpr(
            "p_partkey AS building_id", "tile", "p_size % 5 + 1 AS floors", "p_partkey % 2 AS residential", "p_size"
        )

    def tile_metric(self, zoom: int = ZOOM) -> DataFrame:
        return self.buildings(zoom).groupBy("tile").agg(F.expr("sum(p_size * floors * 10D) AS floor_area"))

    # --- population and maps

    def pop_points(self, zoom: int = ZOOM) -> DataFrame:
        orders = self._lattice(self.table("orders"), "o_orderkey")
        return self._tiled(orders, zoom).selectExpr("tile", "o_totalprice / 1000D AS pop")

    def surveyed_points(self, zoom: int = ZOOM) -> DataFrame:
        """Population of the surveyed tiles; one quarter of all tiles, by the last digit of the key, has none, as
        the queries on missing populations need."""
        return self.pop_points(zoom).filter("substr(tile, -1) <> '3'")

    def map_tiles(self, tiles: DataFrame) -> DataFrame:
        """Names of each tile by the position of its middle."""
        middle = tile_centroid(F.col("tile"))
        placed = tiles.select("tile", middle["lon"].alias("lon"), middle["lat"].alias("lat"))
        return self.with_nation(placed, self.nations()).select("tile", "adm1", "adm2", "adm3")

    def tile_map(self) -> DataFrame:
        """The finished map of tiles, as a stored table."""
        if self._tile_map is None:
            known = self.buildings().select("tile").union(self.pop_points().select("tile")).distinct()
            self._tile_map = stored(self.map_tiles(stored(known, "tiles")), "tile_map")
        return self._tile_map

    def wide_tiles(self) -> DataFrame:
        """Tiles of an area somewhat larger than that of the areas."""
        points = self.table("orders").selectExpr(
            "99.9D + ((o_orderkey * 7919L) % 100003L) * 1.2D / 100003D AS lon",
            "12.9D + ((o_orderkey * 15485863L) % 99991L) * 1.2D / 99991D AS lat",
        )
        return self._tiled(points, ZOOM).select("tile")

    def control_province(self) -> DataFrame:
        customer = self.table("customer")
        summed = (
            customer.join(F.broadcast(self.nations()), customer.c_nationkey == F.col("n_nationkey"))
            .groupBy("adm1")
            .agg(F.sum(F.abs(F.col("c_acctbal").cast("decimal(15,2)"))).cast("double").alias("population"))
        )
        return summed.selectExpr("adm1 AS name", "population", "round(population / 3.1D, 0) AS households").selectExpr(
            "*", "round(population / households, 2) AS pop_to_hh"
        )

    def control_district(self) -> DataFrame:
        """Truth populations; those of every third nation are far above their estimates at every size of the tables."""
        supplier = self.table("supplier")
        return (
            supplier.join(F.broadcast(self.nations()), supplier.s_nationkey == F.col("n_nationkey"))
            .groupBy("adm1", "adm2", "n_nationkey")
            .agg(F.sum(F.abs(F.col("s_acctbal").cast("decimal(15,2)"))).cast("double").alias("s"))
            .selectExpr("adm1", "adm2", "s * IF(n_nationkey % 3 = 0, 5000D, 1D) / 5D AS population")
        )

    def estimates(self) -> DataFrame:
        """Finished tile estimates, to feed the later operators."""
        summed = self.pop_points().groupBy("tile").agg(F.sum(F.expr("CAST(pop AS DECIMAL(20, 5))")).alias("s"))
        mapped = summed.selectExpr("tile", "CAST(s AS DOUBLE) AS adjusted_pop").join(self.tile_map(), "tile")
        rated = mapped.withColumn("pop_to_hh", 2.5 + (key_x(F.col("tile")) % 7) / 10.0)
        return rated.withColumn("hh", F.expr("round(adjusted_pop / pop_to_hh, 0)"))

    # --- places

    def places(self) -> DataFrame:
        return self._lattice(self.table("customer"), "c_custkey").selectExpr(
            "c_custkey AS place_id", "c_name AS name", "lon", "IF(c_custkey % 50 = 0, NULL, lat) AS lat",
            "c_mktsegment AS category",
        )

    def place_labels(self) -> DataFrame:
        customer = self.table("customer")
        return customer.join(F.broadcast(self.nations()), customer.c_nationkey == F.col("n_nationkey")).selectExpr(
            "c_custkey AS place_id", "adm2 AS country", "split(concat(c_mktsegment, ',', adm2), ',') AS labels"
        )

    # --- producers of estimates

    def producers(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Three overlapping sets of estimates whose names are written in different ways."""
        customers = self._tiled(self._lattice(self.table("customer"), "c_custkey"), ZOOM)
        named = self.with_nation(customers, self.nations())
        first = named.filter("c_custkey % 3 <> 2").selectExpr(
            "tile", "adm1", "adm2", "adm3", "c_acctbal / 100D AS hh"
        )
        second = named.filter("c_custkey % 3 <> 1").selectExpr(
            "tile", "initcap(adm1) AS adm1", "replace(adm2, '_', '-') AS adm2", "replace(adm3, '_', ' ') AS adm3",
            "c_acctbal / 200D AS hh",
        )
        third = named.filter("c_custkey % 3 <> 0").selectExpr(
            "tile", "lower(adm1) AS adm1", "lower(adm2) AS adm2", "lower(adm3) AS adm3", "c_acctbal / 50D AS total"
        )
        return first, second, third.withColumnRenamed("total", "hh")
