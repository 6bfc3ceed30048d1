"""The registered queries. Each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tileframe.functions import cells, geometry, keys
from tileframe.functions.binary_geometry import rings_from_wkb
from tileframe.operators import assign, band, features, households, ordered, profile, qc, rank, sampling, spatial_join, tables
from tileframe.plans import households as household_jobs
from tileframe.plans import pings as ping_jobs
from tileframe.sources import readers, workspace, writers
from workload.inputs import ZOOM, Inputs

ZONE = "Asia/Bangkok"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AREA = ["adm1", "adm2", "adm3"]


def query(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
    return f


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Doubles rounded for comparison, integers as long."""
    shaped = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double" and (not columns or name in columns):
            c = F.round(c, digits)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        elif kind == "date":
            c = c.cast("string")
        shaped.append(c.alias(name))
    return df.select(*shaped)


# --- scans and sinks


@query
def src_recursive_scan(i: Inputs) -> DataFrame:
    path = workspace.shared_path(i.spark, "nested")
    dated = i.pings().withColumn("day", F.to_date("ts"))
    writers.write_partitioned(dated.select("event_id", "device_id", "day"), path, ["day"])
    return readers.read_nested_parquet(i.spark, f"{path}/day=*", schema="event_id long, device_id long")


@query
def src_csv_control_totals(i: Inputs) -> DataFrame:
    path = workspace.shared_path(i.spark, "csv")
    text = i.control_province().withColumn(
        "households", F.expr("IF(name = 'ASIA', '1,000', CAST(households AS STRING))")
    )
    writers.write_csv(text, path)
    return readers.read_csv_table(i.spark, path, numbers=["population", "households"], round_to={"pop_to_hh": 2})


@query
def src_catalog_filtered(i: Inputs) -> DataFrame:
    path = workspace.shared_path(i.spark, "catalog")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    i.place_labels().write.partitionBy("country").option("path", path).saveAsTable(name)
    found = readers.read_catalog_rows(i.spark, name, F.col("country") == "NATION_3", ["place_id", "labels"])
    return found.select("place_id", F.array_join("labels", ",").alias("labels"))


@query
def sink_partitioned_roundtrip(i: Inputs) -> DataFrame:
    path = workspace.shared_path(i.spark, "days")
    pings = i.pings()
    dated = pings.withColumn("event_date", keys.event_day(pings, "ts", ZONE))
    ping_jobs.write_days(dated.select("event_id", "lon", "lat", "event_date"), path)
    back = i.spark.read.schema("event_id long, lon double, lat double, event_date date").parquet(path)
    return rounded(back, 9)


@query
def sink_overwrite(i: Inputs) -> DataFrame:
    """A written table is replaced as a whole."""
    path = workspace.shared_path(i.spark, "overwritten")
    pings = i.pings_ms().select("event_id", "isp")
    writers.write_parquet(i.pings().selectExpr("event_id", "'old' AS isp"), path)
    writers.write_parquet(pings, path, overwrite=True)
    return i.spark.read.schema("event_id long, isp string").parquet(path)


@query
def sink_refuses_existing(i: Inputs) -> DataFrame:
    """The default sink leaves a table that is there as it is, and says so."""
    path = workspace.shared_path(i.spark, "kept")
    pings = i.pings_ms().select("event_id", "isp")
    writers.write_parquet(pings, path)
    try:
        writers.write_parquet(pings.selectExpr("-event_id AS event_id", "isp"), path)
        outcome = "written"
    except AnalysisException:
        outcome = "refused"
    return i.spark.read.schema("event_id long, isp string").parquet(path).withColumn("second", F.lit(outcome))


@query
def src_catalog_tables(i: Inputs) -> DataFrame:
    """Tables found by listing a catalog, each with its rows."""
    database = workspace.shared_path(i.spark, "listed").rsplit("/", 1)[1].replace("-", "_")
    i.spark.sql(f"CREATE DATABASE {database}")
    for name in ("customer", "nation"):
        i.table(name).write.saveAsTable(f"{database}.{name}")
    found = [name for _, name in readers.list_catalog_tables(i.spark, database)]
    return tables.union_all(
        *[i.spark.table(f"{database}.{n}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n in found]
    )


@query
def union_same_columns(i: Inputs) -> DataFrame:
    """Two feeds are united after a check of their columns."""
    first, second = (i.pings_ms().select("event_id", "isp", F.lit(f).alias("feed")) for f in ("first", "second"))
    tables.same_columns(first, second)
    return tables.union_all(first, second)


@query
def probe_existence(i: Inputs) -> DataFrame:
    """Which nations have any rich supplier: one row for each is enough."""
    rich = i.table("supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    nations = i.table("nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"))
    known = rich.select("n_nationkey", F.lit(True).alias("found"))
    if known.isEmpty():
        return nations.withColumn("found", F.lit(False))
    return nations.join(F.broadcast(known), "n_nationkey", "left").select("n_nationkey", F.coalesce("found", F.lit(False)).alias("found"))


@query
def sink_partition_counts(i: Inputs) -> DataFrame:
    pings = i.pings()
    dated = pings.withColumn("event_date", keys.event_day(pings, "ts", ZONE))
    return rounded(writers.partition_counts(dated, ["event_date"]))


@query
def sink_audited(i: Inputs) -> DataFrame:
    """Rows per day, counted while the days are written."""
    path = workspace.shared_path(i.spark, "audited")
    pings = i.pings()
    dated = pings.select("event_id", "lon", "lat", keys.event_day(pings, "ts", ZONE).alias("event_date"))
    first, last = dated.agg(F.min("event_date"), F.max("event_date")).first()
    days = [first + timedelta(n) for n in range((last - first).days + 1)]
    return rounded(writers.write_audited(dated, path, "event_date", days, "all"))


# --- filters, names, time


@query
def filter_keys(i: Inputs) -> DataFrame:
    wanted = (F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderpriority") == "2-HIGH")
    return i.table("orders").filter(wanted & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_custkey", "o_totalprice")


@query
def filter_excluded_groups(i: Inputs) -> DataFrame:
    return tables.without_groups(i.tile_map(), "adm1", ["ASIA", "EUROPE"])


@query
def normalize_names(i: Inputs) -> DataFrame:
    brand, kind = F.col("p_brand"), F.concat_ws(" - ", "p_type", "p_name")
    return i.table("part").select(
        "p_partkey",
        keys.squash_name(F.col("p_name")).alias("squashed"),
        keys.snake_name(kind).alias("snake"),
        keys.guard_key(brand).alias("guarded"),
        keys.unguard_key(keys.guard_key(brand)).alias("unguarded"),
    )


@query
def time_epoch_ms(i: Inputs) -> DataFrame:
    back = keys.from_epoch_ms(F.col("ts_ms"))
    pings = i.pings_ms().withColumn("t", back)
    wall = keys.zone_time(pings, "t", "UTC")
    return pings.select("event_id", F.date_format(wall, "yyyy-MM-dd HH:mm:ss").alias("utc_time"))


@query
def time_local_day(i: Inputs) -> DataFrame:
    pings = i.pings()
    local = keys.zone_time(pings, "ts", ZONE)
    return rounded(
        pings.select(
            "event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
            keys.event_day(pings, "ts", ZONE).alias("day"),
        )
    )


@query
def busiest_day(i: Inputs) -> DataFrame:
    pings = i.pings()
    dated = pings.withColumn("event_date", keys.event_day(pings, "ts", ZONE))
    return rounded(ping_jobs.busiest_day(dated))


@query
def topk_desc(i: Inputs) -> DataFrame:
    return (
        i.table("lineitem")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
        .limit(100)
        .select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_extendedprice")
    )


# --- joins


@query
def join_inner_using(i: Inputs) -> DataFrame:
    population = households.tile_population(i.pop_points())
    return rounded(i.tile_metric().join(population, "tile"), 6)


@query
def join_inner_expr(i: Inputs) -> DataFrame:
    orders, customer = i.table("orders"), i.table("customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).drop(customer.c_custkey)
    return joined.select("o_orderkey", "o_custkey", "c_mktsegment", "o_totalprice")


@query
def join_left_missing(i: Inputs) -> DataFrame:
    population = households.tile_population(i.surveyed_points())
    return rounded(i.tile_metric().join(population, "tile", "left"), 6)


@query
def join_left_anti(i: Inputs) -> DataFrame:
    return i.tile_metric().join(i.surveyed_points(), "tile", "left_anti").select("tile", "floor_area")


@query
def join_left_semi(i: Inputs) -> DataFrame:
    late = i.table("lineitem").filter("l_returnflag = 'R' AND l_quantity > 49").select("l_orderkey")
    orders = i.table("orders")
    return orders.join(late, orders.o_orderkey == late.l_orderkey, "left_semi").select("o_orderkey", "o_totalprice")


def _tiles_with_gaps(i: Inputs, zoom: int) -> DataFrame:
    population = i.surveyed_points(zoom).groupBy("tile").agg(
        F.sum(F.col("pop").cast("decimal(20,5)")).cast("double").alias("pop")
    )
    metric = i.tile_metric(zoom)
    return metric.join(i.map_tiles(metric.select("tile")), "tile").join(population, "tile", "left")


@query
def join_band(i: Inputs) -> DataFrame:
    tiles = _tiles_with_gaps(i, ZOOM)
    missing = tiles.filter("pop IS NULL").select("tile", "adm1", "adm2", "adm3", "floor_area")
    known = tiles.filter("pop IS NOT NULL")
    return rounded(band.band_join(missing, known, AREA, "floor_area", "pop"), 6)


# --- aggregates


@query
def agg_group_sum(i: Inputs) -> DataFrame:
    return rounded(
        i.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
            F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price")
        ), 2,
    )


@query
def agg_group_count(i: Inputs) -> DataFrame:
    return i.table("lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("rows"), F.count("l_returnflag").alias("flags")
    )


@query
def agg_global(i: Inputs) -> DataFrame:
    return rounded(
        i.table("lineitem").agg(
            F.sum("l_extendedprice").alias("total"), F.max("l_quantity").alias("largest"), F.count(F.lit(1)).alias("rows")
        ), 2,
    )


@query
def agg_distinct_tuples(i: Inputs) -> DataFrame:
    lineitem = i.table("lineitem")
    keys_ = lineitem.select("l_partkey", "l_suppkey").distinct()
    per_part = keys_.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("suppliers"))
    return per_part


@query
def agg_tile_buildings(i: Inputs) -> DataFrame:
    return rounded(features.building_profile(i.buildings()), 6)


# --- profiles


@query
def profile_numeric(i: Inputs) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profile.profile_numeric(i.table("lineitem"), columns), 5)


@query
def profile_nulls(i: Inputs) -> DataFrame:
    return profile.profile_nulls(i.pings())


@query
def profile_histogram(i: Inputs) -> DataFrame:
    return rounded(profile.histogram(i.table("lineitem"), "l_extendedprice", bins=50, group="l_returnflag"), 6)


# --- cells


@query
def tile_points(i: Inputs) -> DataFrame:
    return i.pings().select("event_id", cells.tile_key(F.col("lat"), F.col("lon"), 16).alias("tile"))


@query
def geohash_points(i: Inputs) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    return i.pings().select("event_id", *[cells.geohash(lat, lon, p).alias(f"gh{p}") for p in (5, 6, 8)])


@query
def tile_outline(i: Inputs) -> DataFrame:
    return i.tile_map().select("tile", cells.tile_outline(F.col("tile"), decimals=9).alias("outline"))


@query
def tile_centroid(i: Inputs) -> DataFrame:
    middle = cells.tile_centroid(F.col("tile"))
    return rounded(i.tile_map().select("tile", middle["lon"].alias("lon"), middle["lat"].alias("lat")), 9)


@query
def cell_rollup(i: Inputs) -> DataFrame:
    tile = cells.tile_key(F.col("lat"), F.col("lon"), 16)
    counts = i.pings().groupBy(tile.alias("tile")).agg(F.count(F.lit(1)).alias("pings"))
    return features.roll_up_cells(counts, "tile", 12, "parent")


@query
def pivot_cell_category(i: Inputs) -> DataFrame:
    """Both resolutions in one table; the coarse matrix is the sum of the fine one."""
    lat, lon = F.col("lat"), F.col("lon")
    places = i.places().withColumn("gh6", cells.geohash(lat, lon, 6))
    fine = features.category_counts(places, "gh6", "category")
    coarse = features.roll_up_cells(fine, "gh6", 5, "gh5")
    return fine.withColumnRenamed("gh6", "cell").unionByName(coarse.withColumnRenamed("gh5", "cell"))


@query
def cell_category_matrix(i: Inputs) -> DataFrame:
    """Sparse rows of two resolutions over as many categories as there are orders."""
    goods = Inputs._lattice(i.table("lineitem"), "(l_orderkey * 8 + l_linenumber)").withColumn("kind", F.expr("concat('k', l_orderkey)"))
    cells_ = [cells.geohash(F.col("lat"), F.col("lon"), p) for p in (5, 4)]
    dictionary = workspace.stored(features.category_dictionary(goods, "kind"), "dictionary")
    matrix = features.category_matrix(goods, cells_, "kind", dictionary)
    pairs = F.zip_with("indices", "counts", lambda a, b: F.concat(a.cast("string"), F.lit(":"), b.cast("string")))
    return matrix.select("cell", F.array_join(pairs, " ").alias("counts"))


@query
def ping_cell_features(i: Inputs) -> DataFrame:
    text = i.pings().withColumns({"lat": F.col("lat").cast("string"), "lon": F.col("lon").cast("string")})
    return features.ping_cells(text).select("event_id", "gh6", "gh5", "tile")


# --- polygons and spatial joins


@query
def load_polygons(i: Inputs) -> DataFrame:
    loaded = i.area_wkt().select("adm3", geometry.rings_from_wkt(F.col("wkt")).alias("rings"))
    middle = geometry.polygon_centroid(F.col("rings"))
    return rounded(
        loaded.select(
            "adm3", F.size(geometry.ring_edges("rings")).cast("long").alias("edges"),
            geometry.polygon_area(F.col("rings")).alias("area"), middle["x"].alias("x"), middle["y"].alias("y"),
        ), 9,
    )


@query
def load_polygons_binary(i: Inputs) -> DataFrame:
    """The polygons of a native geometry column."""
    loaded = i.area_wkb().select("adm3", rings_from_wkb("shape").alias("rings"))
    middle = geometry.polygon_centroid(F.col("rings"))
    return rounded(
        loaded.select(
            "adm3", F.size(geometry.ring_edges("rings")).cast("long").alias("edges"),
            geometry.polygon_area(F.col("rings")).alias("area"), middle["x"].alias("x"), middle["y"].alias("y"),
        ), 9,
    )


@query
def spatial_contains(i: Inputs) -> DataFrame:
    return spatial_join.join_points(i.pings(), i.areas(), ["adm3"], predicate="contains").select("event_id", "adm3")


@query
def spatial_within(i: Inputs) -> DataFrame:
    joined = spatial_join.join_points(i.pings(), i.footprints(), ["building_id"], predicate="within")
    return joined.select("event_id", "building_id")


@query
def spatial_intersects_point(i: Inputs) -> DataFrame:
    """Pings, and points that lie exactly on the borders between areas."""
    borders = i.table("customer").selectExpr(
        "-1 - c_custkey AS event_id", "(500 + c_custkey % 6) / 5D AS lon",
        "13D + ((c_custkey * 15485863L) % 99991L) / 99991D AS lat",
    )
    points = i.pings().select("event_id", "lon", "lat").unionByName(borders)
    return spatial_join.join_points(points, i.areas(), ["adm3"], predicate="intersects").select("event_id", "adm3")


@query
def spatial_intersects_tile(i: Inputs) -> DataFrame:
    return assign.tile_overlaps(workspace.stored(i.wide_tiles().distinct()), i.areas(), ["adm3"])


@query
def spatial_join_keyed(i: Inputs) -> DataFrame:
    pings = Inputs.with_nation(i.pings().filter("lat IS NOT NULL"), i.nations())
    joined = spatial_join.join_points(
        pings.select("event_id", "lon", "lat", "adm1"), i.footprints(), ["building_id"],
        predicate="intersects", keys={"adm1": "adm1"},
    )
    return joined.select("event_id", "adm1", "building_id")


@query
def overlap_area(i: Inputs) -> DataFrame:
    return rounded(assign.tile_overlaps(workspace.stored(i.wide_tiles().distinct()), i.areas(), ["adm3"], area="area"), 10)


@query
def tile_admin_assignment(i: Inputs) -> DataFrame:
    return assign.assign_tiles(i.wide_tiles(), i.areas(), AREA)


@query
def tile_unassigned(i: Inputs) -> DataFrame:
    return assign.unassigned_tiles(i.wide_tiles(), i.areas(), ["adm3"])


# --- pings


@query
def ping_admin_tags(i: Inputs) -> DataFrame:
    tagged = ping_jobs.tag_pings(i.pings(), i.areas(), AREA, zone=ZONE)
    return rounded(tagged.select("event_id", "device_id", "event_date", *AREA))


@query
def ping_building_visits(i: Inputs) -> DataFrame:
    visits = ping_jobs.building_visits(i.pings_ms(), i.footprints(), zone=ZONE, day_type="string")
    return rounded(visits.select("event_id", "event_date", "building_id"))


@query
def busy_day_batches(i: Inputs) -> DataFrame:
    """Written as folders of day and part, and read back."""
    visits = ping_jobs.busy_day_visits(i.pings_ms(), i.footprints(), zone=ZONE)
    path = workspace.shared_path(i.spark, "busy-day")
    ping_jobs.write_busy_day(visits.select("event_id", "building_id", "event_date", "part"), path)
    return rounded(i.spark.read.schema("event_id long, building_id long, `date` date, part long").parquet(path))


@query
def ping_place_visits(i: Inputs) -> DataFrame:
    tagged = ping_jobs.tag_pings(i.pings(), i.areas(), AREA, zone=ZONE)
    # As text before the join, once for each ping.
    tagged = tagged.withColumn("event_date", F.col("event_date").cast("string"))
    visits = ping_jobs.place_visits(tagged, i.footprints())
    return rounded(visits.select("event_id", "event_date", "adm1", "adm3", "building_id", "place_id"))


@query
def ping_isp_filter(i: Inputs) -> DataFrame:
    chosen = i.pings_ms().select("device_id", "isp")
    return features.pings_of_providers(chosen, ["click", "purchase"])


@query
def global_ntile(i: Inputs) -> DataFrame:
    return rounded(ordered.global_ntile(i.pings().select("event_id", "ts"), ["ts", "event_id"], 12).drop("ts"))


# --- places


@query
def attach_categories(i: Inputs) -> DataFrame:
    catalog = i.place_labels().filter(F.col("country") == "NATION_3")
    return features.attach_labels(i.places(), catalog, text="label_text").select("place_id", "name", "label_text")


# --- households


@query
def tile_population(i: Inputs) -> DataFrame:
    return rounded(households.tile_population(i.pop_points()), 6)


@query
def impute_cascade(i: Inputs) -> DataFrame:
    return rounded(band.impute_cascade(_tiles_with_gaps(i, 16), stage="stage"), 8)


@query
def control_ratio(i: Inputs) -> DataFrame:
    placed = i.pop_points().join(i.tile_map(), "tile")
    return rounded(households.control_ratio(placed, i.control_province()), 9)


@query
def scale_to_control(i: Inputs) -> DataFrame:
    population = households.tile_population(i.pop_points())
    ratios = households.control_ratio(population.join(i.tile_map(), "tile"), i.control_province())
    return rounded(households.scale_to_control(population, i.tile_map(), ratios), 6)


@query
def sample_bounds(i: Inputs) -> DataFrame:
    """Bounds per province, looked up for each tile by a join instead of one value at a time."""
    means = i.control_province().select(keys.squash_name(F.col("name")).alias("adm1"), "pop_to_hh")
    bounds = workspace.broadcast_if_small(sampling.ratio_bounds(means, spread=2))
    tiles = i.tile_map().select("tile", keys.squash_name(F.col("adm1")).alias("adm1"))
    return rounded(tiles.join(bounds, "adm1"), 4)


def _sample_groups(i: Inputs) -> DataFrame:
    counts = i.tile_map().groupBy(keys.squash_name(F.col("adm1")).alias("adm1")).agg(F.count(F.lit(1)).alias("n"))
    means = i.control_province().select(keys.squash_name(F.col("name")).alias("adm1"), "pop_to_hh")
    return sampling.ratio_bounds(means).join(counts, "adm1")


@query
def sample_bounded_gaussian(i: Inputs) -> DataFrame:
    return rounded(sampling.gaussian_samples(_sample_groups(i), "adm1"), 6)


@query
def sample_bounded_uniform(i: Inputs) -> DataFrame:
    return rounded(sampling.uniform_samples(_sample_groups(i), "adm1", seed=42), 6)


@query
def rank_match(i: Inputs) -> DataFrame:
    named = i.tile_map().withColumn("adm1", keys.squash_name(F.col("adm1")))
    tiles = i.tile_metric().join(named.select("tile", "adm1"), "tile")
    samples = sampling.gaussian_samples(_sample_groups(i), "adm1")
    return rounded(rank.rank_match(tiles, samples, "adm1", "floor_area", ["tile"], rank="place"), 6)


def _household_estimates(i: Inputs) -> DataFrame:
    population = i.pop_points().groupBy("tile").agg(
        F.sum(F.col("pop").cast("decimal(20,5)")).cast("double").alias("pop")
    )
    return household_jobs.estimate_households(population, i.tile_map(), i.tile_metric(), i.control_province())


@query
def household_estimate(i: Inputs) -> DataFrame:
    return rounded(_household_estimates(i), 5)


@query
def household_uniform(i: Inputs) -> DataFrame:
    """Uniform draws within two deviations, households not rounded."""
    population = i.pop_points().groupBy("tile").agg(F.sum(F.col("pop").cast("decimal(20,5)")).cast("double").alias("pop"))
    out = household_jobs.estimate_households(
        population, i.tile_map(), i.tile_metric(), i.control_province(), spread=2.0, kind="uniform", rounded=False
    )
    return rounded(out.select("tile", "adm1", "adjusted_pop", "floor_area", "pop_to_hh", "hh"), 5)


@query
def household_correction(i: Inputs) -> DataFrame:
    control = i.control_province()
    corrected = households.household_correction(i.estimates().withColumn("adm1", keys.squash_name(F.col("adm1"))), control)
    return rounded(
        corrected.select("tile", "adm1", "hh", "province_hh", "control_hh", "hh_corrected", "pop_to_hh_corrected"), 6
    )


@query
def district_multiplier(i: Inputs) -> DataFrame:
    estimates = i.estimates()
    multipliers = households.district_multipliers(estimates, i.control_district())
    scaled = households.apply_multipliers(estimates.drop("hh"), multipliers)
    return rounded(scaled.select("tile", *AREA, "multiplier", "truth_adjusted_pop", "hh"), 6)


@query
def district_extremes(i: Inputs) -> DataFrame:
    multipliers = households.district_multipliers(i.estimates(), i.control_district())
    usual, extreme = households.split_extremes(multipliers, 0.8)
    both = usual.withColumn("extreme", F.lit(0)).unionByName(extreme.withColumn("extreme", F.lit(1)))
    return rounded(both, 6)


@query
def reallocate_by_buildings(i: Inputs) -> DataFrame:
    estimates = i.estimates().drop("hh")
    _, extreme = households.split_extremes(
        households.district_multipliers(estimates, i.control_district()), 0.8
    )
    out = None
    for kind in ("buildings", "rows"):
        spread = households.reallocate_by_buildings(estimates, extreme, i.buildings(), denominator=kind)
        part = spread.select(
            "tile", *AREA, "tile_buildings", "district_total", "truth_adjusted_pop", "hh", F.lit(kind).alias("denominator")
        )
        out = part if out is None else out.unionByName(part)
    return rounded(out, 6)


@query
def district_route(i: Inputs) -> DataFrame:
    """Usual and extreme districts in one pass."""
    routed = households.route_districts(i.estimates().drop("hh"), i.control_district(), i.buildings(), 0.8)
    return rounded(routed.select("tile", *AREA, "multiplier", "method", "truth_adjusted_pop", "hh"), 6)


@query
def district_job(i: Inputs) -> DataFrame:
    """The routed districts united with another producer, and overrides."""
    other = i.producers()[1]
    overrides = i.tile_metric().filter("floor_area >= 6000").selectExpr("tile", "floor_area / 10D AS hh")
    tiles = i.estimates().drop("hh")
    return rounded(household_jobs.district_job(tiles, i.control_district(), i.buildings(), other, limit=0.8, overrides=overrides))


@query
def correction_recheck(i: Inputs) -> DataFrame:
    estimates = i.estimates().withColumn("adm1", keys.squash_name(F.col("adm1")))
    return rounded(household_jobs.corrected_households(estimates, i.control_province())[1], 6)


@query
def combine_sources(i: Inputs) -> DataFrame:
    overrides = i.producers()[0].groupBy("tile").agg(F.expr("CAST(count(1) * 1000 AS DOUBLE) AS hh")).filter("hh >= 4000")
    return rounded(households.combine_sources(*i.producers(), overrides=overrides))


@query
def override_values(i: Inputs) -> DataFrame:
    estimates = i.estimates().select("tile", "hh")
    overrides = i.tile_metric().filter("floor_area >= 6000").selectExpr("tile", "floor_area / 10D AS hh")
    return rounded(tables.override_values(estimates, overrides, "tile", "hh"), 4)


@query
def district_totals(i: Inputs) -> DataFrame:
    return rounded(households.district_totals(i.estimates().drop(*AREA), i.tile_map()), 6)


@query
def built_up_share(i: Inputs) -> DataFrame:
    area = F.col("floor_area")
    return rounded(
        i.tile_metric().select(
            "tile", households.built_up_share(area).alias("share"),
            households.built_up_share(area, percent=True).alias("share_pct"),
        ), 8,
    )


@query
def export_area_tiles(i: Inputs) -> DataFrame:
    """Written as CSV by the executors and read back."""
    named = tables.only_groups(i.estimates().drop("adm2", "adm3"), "adm1", ["ASIA", "EUROPE"])
    outlined = named.select(
        "tile", "adm1", "hh", F.round("pop_to_hh", 2).alias("pop_to_hh"),
        cells.tile_outline(F.col("tile"), decimals=9).alias("outline"),
    )
    path = workspace.shared_path(i.spark, "export")
    writers.write_csv(outlined, path)
    return readers.read_csv_table(i.spark, path, numbers=["hh", "pop_to_hh"])


# --- quality checks


@query
def qc_control_diff(i: Inputs) -> DataFrame:
    return rounded(qc.control_difference(i.estimates(), i.control_province()), 6)


def _measured(i: Inputs) -> DataFrame:
    return i.estimates().join(i.tile_metric(), "tile")


@query
def qc_area_per_household(i: Inputs) -> DataFrame:
    checked = qc.area_per_household(_measured(i), low=(1, 2), high=(20, 10))
    flags = ["outlier", "too_low", "too_high"]
    return rounded(
        checked.select("tile", "area_per_hh", *[F.col(f).cast("int").alias(f) for f in flags]), 6
    )


@query
def qc_floor_excess_top(i: Inputs) -> DataFrame:
    excess = qc.floor_excess(i.buildings(), i.estimates())
    return rounded(qc.worst_buildings(i.buildings().drop("p_size"), excess).drop("residential"), 6)


@query
def qc_worst_tiles(i: Inputs) -> DataFrame:
    """The 300 tiles with the largest excess of households over floors."""
    return rounded(qc.worst_floor_excess(qc.floor_excess(i.buildings(), i.estimates())), 6)


@query
def qc_more_households(i: Inputs) -> DataFrame:
    counted = i.estimates().join(features.building_profile(i.buildings()).select("tile", "buildings"), "tile")
    return rounded(qc.more_households_than_buildings(counted).select("tile", "buildings", "hh"))
