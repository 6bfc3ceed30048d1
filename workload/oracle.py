"""The SQL twin of each query, for a plain SQL engine on the same tables.

Written independently of the library: spatial tests compare every point with every edge,
windows and sorts are plain SQL. Shared inputs are common table expressions.
"""

from __future__ import annotations

ZOOM = 14
_HASH = "((('0x' || substr(md5({seed}), {at}, 8))::BIGINT)::DOUBLE + 0.5) / 4294967296.0::DOUBLE"


def tile_x(lon: str, zoom: int) -> str:
    return f"greatest(0, least({2**zoom - 1}, floor(({lon} / 360.0::DOUBLE + 0.5::DOUBLE + 1e-14) * {2**zoom}::DOUBLE)::BIGINT))"


def tile_y(lat: str, zoom: int) -> str:
    s = f"sin(radians({lat}))"
    part = f"(0.5::DOUBLE - 0.25::DOUBLE * ln((1 + {s}) / (1 - {s})) / pi())"
    return f"greatest(0, least({2**zoom - 1}, floor(({part} + 1e-14) * {2**zoom}::DOUBLE)::BIGINT))"


def tile(lat: str, lon: str, zoom: int) -> str:
    x, y = tile_x(lon, zoom), tile_y(lat, zoom)
    return (
        f"CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN NULL ELSE array_to_string(list_transform("
        f"range({zoom - 1}, -1, -1), lambda i: (({x} >> i) & 1) + 2 * (({y} >> i) & 1)), '') END"
    )


def key_x(key: str) -> str:
    return f"list_sum(list_transform(range(1, length({key}) + 1), lambda i: (substr({key}, i, 1)::BIGINT & 1) << (length({key}) - i)))::BIGINT"


def key_y(key: str) -> str:
    return f"list_sum(list_transform(range(1, length({key}) + 1), lambda i: (substr({key}, i, 1)::BIGINT >> 1) << (length({key}) - i)))::BIGINT"


def geohash(lat: str, lon: str, precision: int) -> str:
    nlon, nlat = (5 * precision + 1) // 2, 5 * precision // 2
    x = f"floor(({lon} + 180.0::DOUBLE) / 360.0::DOUBLE * {2**nlon}::DOUBLE)::BIGINT"
    y = f"floor(({lat} + 90.0::DOUBLE) / 180.0::DOUBLE * {2**nlat}::DOUBLE)::BIGINT"

    def bit(g: int) -> str:
        return f"((x >> {nlon - 1 - g // 2}) & 1)" if g % 2 == 0 else f"((y >> {nlat - 1 - g // 2}) & 1)"

    chars = [
        "substr('0123456789bcdefghjkmnpqrstuvwxyz', (1 + "
        + " + ".join(f"({bit(5 * j + b)} << {4 - b})" for b in range(5))
        + ")::INT, 1)"
        for j in range(precision)
    ]
    return f"(SELECT {' || '.join(chars)} FROM (SELECT {x} AS x, {y} AS y))"


def nation_of(source: str) -> str:
    """Add adm1, adm2, adm3 by grid arithmetic to a relation with lon and lat."""
    return f"""(SELECT s.*, adm1, adm2,
        adm2 || '_' || (CASE WHEN abs(dy) >= abs(dx) THEN CASE WHEN dy < 0 THEN 0 ELSE 2 END
                             ELSE CASE WHEN dx > 0 THEN 1 ELSE 3 END END) AS adm3
      FROM (SELECT *, (lon - 100) * 5 - c - 0.5::DOUBLE AS dx, (lat - 13) * 5 - r - 0.5::DOUBLE AS dy
            FROM (SELECT *, greatest(least(floor((lon - 100) * 5), 4), 0)::BIGINT AS c,
                            greatest(least(floor((lat - 13) * 5), 4), 0)::BIGINT AS r FROM ({source}))) s
      JOIN nat ON r * 5 + c = n_nationkey)"""


def lattice(key: str) -> str:
    return (
        f"100 + (({key} * 7919) % 100003)::DOUBLE / 100003::DOUBLE AS lon, "
        f"13 + (({key} * 15485863) % 99991)::DOUBLE / 99991::DOUBLE AS lat"
    )


def _map(tiles: str) -> str:
    size = "(2.0::DOUBLE ** length(tile))"
    lat = f"degrees(atan(sinh(pi() * (1 - 2 * (y + {{d}}) / {size}))))"
    west, east = f"(x / {size} * 360.0::DOUBLE - 180)", f"((x + 1) / {size} * 360.0::DOUBLE - 180)"
    return f"""SELECT tile, ({west} + {east}) / 2 AS lon, ({lat.format(d=1)} + {lat.format(d=0)}) / 2 AS lat,
        {west} AS west, {east} AS east, {lat.format(d=1)} AS south, {lat.format(d=0)} AS north
      FROM (SELECT tile, ({key_x('tile')})::DOUBLE AS x, ({key_y('tile')})::DOUBLE AS y FROM ({tiles}))"""


def _squash(name: str) -> str:
    return f"lower(replace({name}, ' ', ''))"


_UP = "(ya < yb OR (ya = yb AND xa <= xb))"
_TURN = f"""CASE WHEN {_UP} THEN xa ELSE xb END AS x1, CASE WHEN {_UP} THEN ya ELSE yb END AS y1,
    CASE WHEN {_UP} THEN xb ELSE xa END AS x2, CASE WHEN {_UP} THEN yb ELSE ya END AS y2,
    CASE WHEN {_UP} THEN 1 ELSE -1 END AS s"""

CTES: dict[str, str] = {
    "nat": "SELECT n_nationkey, r_name AS adm1, n_name AS adm2 FROM nation JOIN region ON n_regionkey = r_regionkey",
    "pings": """SELECT event_id, user_id AS device_id, ts, event_type AS isp,
        100 + ((event_id * 7919 + user_id * 104729) % 100003)::DOUBLE / 100003::DOUBLE AS lon,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE
            13 + ((event_id * 15485863 + user_id * 32452843) % 99991)::DOUBLE / 99991::DOUBLE END AS lat,
        ts + INTERVAL 7 HOUR AS local_ts FROM events""",
    "corners": """SELECT adm1, adm2, adm2 || '_' || t AS adm3, t, n_nationkey // 5 AS r, n_nationkey % 5 AS c
        FROM nat, range(4) q(t)""",
    "area_points": """SELECT adm1, adm2, adm3, i,
            CASE WHEN i = 2 THEN (1001 + 2 * c)::DOUBLE / 10 ELSE (500 + c + dx)::DOUBLE / 5 END AS x,
            CASE WHEN i = 2 THEN (131 + 2 * r)::DOUBLE / 10 ELSE (65 + r + dy)::DOUBLE / 5 END AS y
        FROM (SELECT *, CASE WHEN (t + i % 3) % 4 IN (1, 2) THEN 1 ELSE 0 END AS dx,
                        CASE WHEN (t + i % 3) % 4 IN (2, 3) THEN 1 ELSE 0 END AS dy
              FROM corners, range(4) q(i))""",
    "area_edges": f"""SELECT adm1, adm2, adm3, {_TURN} FROM (
        SELECT a.adm1, a.adm2, a.adm3, a.x AS xa, a.y AS ya, b.x AS xb, b.y AS yb
        FROM area_points a JOIN area_points b ON a.adm3 = b.adm3 AND b.i = a.i + 1)""",
    "parts": f"SELECT p_partkey, p_size, {lattice('p_partkey')} FROM part",
    "placed_parts": "SELECT * FROM " + nation_of("SELECT * FROM parts"),
    "shape": """SELECT p_partkey, adm1, lon, lat, p_size::DOUBLE / 5000::DOUBLE AS h, CASE WHEN p_partkey % 3 = 0
        THEN [[-1,-1],[1,-1],[1,0],[0,0],[0,1],[-1,1],[-1,-1]] ELSE [[-1,-1],[1,-1],[1,1],[-1,1],[-1,-1]] END AS m
        FROM placed_parts""",
    "foot_edges": f"""SELECT p_partkey AS building_id, adm1, {_TURN} FROM (
        SELECT p_partkey, adm1, lon + m[i][1] * h AS xa, lat + m[i][2] * h AS ya,
               lon + m[i + 1][1] * h AS xb, lat + m[i + 1][2] * h AS yb
        FROM (SELECT *, unnest(range(1, len(m))) AS i FROM shape))""",
    "foot_boxes": """SELECT building_id, adm1, min(least(x1, x2)) AS w, max(greatest(x1, x2)) AS e, min(y1) AS s,
        max(y2) AS n FROM foot_edges GROUP BY 1, 2""",
    "buildings": f"""SELECT p_partkey AS building_id, {tile('lat', 'lon', ZOOM)} AS tile, p_size,
        p_size % 5 + 1 AS floors, p_partkey % 2 AS residential FROM parts""",
    "tile_metric": "SELECT tile, sum(p_size * floors * 10.0::DOUBLE) AS floor_area FROM buildings GROUP BY 1",
    "pop_points": f"""SELECT {tile('lat', 'lon', ZOOM)} AS tile, o_totalprice / 1000::DOUBLE AS pop FROM (
        SELECT o_totalprice, {lattice('o_orderkey')} FROM orders)""",
    "surveyed_points": "SELECT * FROM pop_points WHERE right(tile, 1) <> '3'",
    "surveyed_pop": "SELECT tile, sum(pop) AS pop FROM surveyed_points GROUP BY 1",
    "tile_pop": "SELECT tile, sum(pop) AS pop FROM pop_points GROUP BY 1",
    "tile_places": _map("SELECT tile FROM buildings UNION SELECT tile FROM pop_points"),
    "tile_map": "SELECT tile, adm1, adm2, adm3 FROM " + nation_of("SELECT tile, lon, lat FROM tile_places"),
    "wide_places": _map(
        f"""SELECT DISTINCT {tile('lat', 'lon', ZOOM)} AS tile FROM (SELECT
            99.9::DOUBLE + ((o_orderkey * 7919) % 100003)::DOUBLE * 1.2::DOUBLE / 100003::DOUBLE AS lon,
            12.9::DOUBLE + ((o_orderkey * 15485863) % 99991)::DOUBLE * 1.2::DOUBLE / 99991::DOUBLE AS lat FROM orders)"""
    ),
    "control_province": """SELECT *, round(population / households, 2) AS pop_to_hh FROM (
        SELECT adm1 AS name, population, round(population / 3.1::DOUBLE, 0) AS households FROM (
            SELECT adm1, sum(abs(c_acctbal::DECIMAL(15, 2)))::DOUBLE AS population
            FROM customer JOIN nat ON c_nationkey = n_nationkey GROUP BY 1))""",
    "control_district": """SELECT adm1, adm2, s * CASE WHEN n_nationkey % 3 = 0 THEN 5000 ELSE 1 END / 5::DOUBLE AS population
        FROM (SELECT adm1, adm2, n_nationkey, sum(abs(s_acctbal::DECIMAL(15, 2)))::DOUBLE AS s
              FROM supplier JOIN nat ON s_nationkey = n_nationkey GROUP BY 1, 2, 3)""",
    "estimates": f"""SELECT *, round(adjusted_pop / pop_to_hh, 0) AS hh FROM (
        SELECT tile, pop AS adjusted_pop, adm1, adm2, adm3, 2.5::DOUBLE + ({key_x('tile')} % 7) / 10.0::DOUBLE AS pop_to_hh
        FROM (SELECT tile, sum(pop::DECIMAL(20, 5))::DOUBLE AS pop FROM pop_points GROUP BY 1) JOIN tile_map USING (tile))""",
    "multipliers": """SELECT adm1, adm2, estimated_pop, population AS truth_pop, population / nullif(estimated_pop, 0) AS multiplier
        FROM (SELECT adm1, adm2, sum(adjusted_pop) AS estimated_pop FROM estimates GROUP BY 1, 2)
        JOIN control_district USING (adm1, adm2)""",
    "district_routed": """SELECT e.*, multiplier, CASE WHEN multiplier > 0.8 THEN 'buildings' ELSE 'multiplier' END AS method,
        CASE WHEN multiplier > 0.8 THEN truth_pop * n / sum(n) OVER (PARTITION BY adm1, adm2) ELSE multiplier * adjusted_pop END AS p
        FROM estimates e JOIN multipliers USING (adm1, adm2)
        LEFT JOIN (SELECT tile, count(*) AS n FROM buildings GROUP BY 1) USING (tile) WHERE multiplier IS NOT NULL""",
    "places": f"""SELECT c_custkey AS place_id, c_name AS name, c_mktsegment AS category, lon,
        CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE lat END AS lat
        FROM (SELECT c_custkey, c_name, c_mktsegment, {lattice('c_custkey')} FROM customer)""",
    "goods": f"""SELECT 'k' || l_orderkey AS k, {lattice('(l_orderkey * 8 + l_linenumber)')} FROM lineitem""",
    "sample_groups": f"""SELECT g.adm1, n, round(pop_to_hh + 3 * 0.29::DOUBLE, 2) AS upper, round(pop_to_hh - 3 * 0.29::DOUBLE, 2) AS lower
        FROM (SELECT {_squash('adm1')} AS adm1, count(*) AS n FROM tile_map GROUP BY 1) g
        JOIN (SELECT {_squash('name')} AS adm1, pop_to_hh FROM control_province) USING (adm1)""",
}


def _powers(x: str, factors: list[str]) -> str:
    """A polynomial, lowest power first."""
    value = f"{factors[-1]}::DOUBLE"
    for factor in factors[-2::-1]:
        value = f"({value} * {x} + {factor}::DOUBLE)"
    return value


# Fixed values of the published approximation AS 241, lowest power first.
_NUMERATOR = ["3.3871328727963666080e0", "1.3314166789178437745e2", "1.9715909503065514427e3", "1.3731693765509461125e4",
              "4.5921953931549871457e4", "6.7265770927008700853e4", "3.3430575583588128105e4", "2.5090809287301226727e3"]
_DENOMINATOR = ["1", "4.2313330701600911252e1", "6.8718700749205790830e2", "5.3941960214247511077e3",
                "2.1213794301586595867e4", "3.9307895800092710610e4", "2.8729085735721942674e4", "5.2264952788528545610e3"]
_FAR_NUMERATOR = ["1.42343711074968357734e0", "4.63033784615654529590e0", "5.76949722146069140550e0", "3.64784832476320460504e0",
                  "1.27045825245236838258e0", "2.41780725177450611770e-1", "2.27238449892691845833e-2", "7.74545014278341407640e-4"]
_FAR_DENOMINATOR = ["1", "2.05319162663775882187e0", "1.67638483018380384940e0", "6.89767334985100004550e-1",
                    "1.48103976427480074590e-1", "1.51986665636164571966e-2", "5.47593808499534494600e-4", "1.05075007164441684324e-9"]


def _draws(groups: str) -> str:
    """Normal draws cut off at the bounds, for (adm1, n, lower, upper), by the inverse of the distribution."""
    chance = f"(0.0013498980316300933::DOUBLE + (1 - 2 * 0.0013498980316300933::DOUBLE) * {_HASH.format(seed="(adm1 || ':' || slot)", at=1)})"
    near = f"(p - 0.5) * {_powers('r', _NUMERATOR)} / {_powers('r', _DENOMINATOR)}"
    far = f"sign(p - 0.5) * {_powers('t', _FAR_NUMERATOR)} / {_powers('t', _FAR_DENOMINATOR)}"
    return f"""SELECT adm1, slot, greatest(lower, least(upper, (lower + upper) / 2
            + (upper - lower) / 6 * CASE WHEN abs(p - 0.5) <= 0.425 THEN {near} ELSE {far} END)) AS sample
        FROM (SELECT *, 0.180625::DOUBLE - (p - 0.5) * (p - 0.5) AS r, sqrt(-ln(least(p, 1 - p))) - 1.6::DOUBLE AS t
              FROM (SELECT *, {chance} AS p FROM (SELECT *, unnest(range(1, n + 1)) AS slot FROM {groups})))"""


CTES["samples"] = _draws("sample_groups")

# Household estimation: scaled tiles with floor area, then draws for exactly those tiles.
CTES["ratios"] = f"""SELECT adm1, population / nullif(p, 0) AS ratio
    FROM (SELECT {_squash('adm1')} AS adm1, sum(pop) AS p FROM tile_pop JOIN tile_map USING (tile) GROUP BY 1)
    JOIN (SELECT {_squash('name')} AS adm1, population FROM control_province) USING (adm1)"""
CTES["scaled"] = f"""SELECT tile, m.adm1, ratio, pop, ratio * pop AS adjusted_pop FROM tile_pop
    JOIN (SELECT tile, {_squash('adm1')} AS adm1 FROM tile_map) m USING (tile) JOIN ratios USING (adm1)"""
CTES["measured"] = "SELECT scaled.*, floor_area FROM scaled JOIN tile_metric USING (tile)"
CTES["measured_groups"] = f"""SELECT g.adm1, n, round(pop_to_hh + 3 * 0.29::DOUBLE, 2) AS upper,
        round(pop_to_hh - 3 * 0.29::DOUBLE, 2) AS lower
    FROM (SELECT adm1, count(*) AS n FROM measured GROUP BY 1) g
    JOIN (SELECT {_squash('name')} AS adm1, pop_to_hh FROM control_province) USING (adm1)"""
CTES["measured_draws"] = _draws("measured_groups")

_SIDE = "((x2 - x1) * (py - y1) - (px - x1) * (y2 - y1))"
_INSIDE = f"sum(CASE WHEN py >= y1 AND py < y2 AND {_SIDE} < 0 THEN 1 ELSE 0 END) % 2 = 1"
_ON = f"max(CASE WHEN {_SIDE} = 0 AND py BETWEEN y1 AND y2 AND px BETWEEN least(x1, x2) AND greatest(x1, x2) THEN 1 ELSE 0 END) = 1"
_STRICT, _CLOSED = f"({_INSIDE}) AND NOT ({_ON})", f"({_INSIDE}) OR ({_ON})"

CTES["area_hits"] = f"""SELECT event_id, adm1, adm2, adm3, ({_STRICT}) AS strict, ({_CLOSED}) AS closed
    FROM (SELECT event_id, lon AS px, lat AS py FROM pings WHERE lat IS NOT NULL), area_edges GROUP BY 1, 2, 3, 4"""
CTES["foot_hits"] = f"""SELECT event_id, building_id, f.adm1, ({_STRICT}) AS strict, ({_CLOSED}) AS closed
    FROM (SELECT event_id, lon AS px, lat AS py, building_id FROM pings JOIN foot_boxes
          ON lon BETWEEN w AND e AND lat BETWEEN s AND n) JOIN foot_edges f USING (building_id) GROUP BY 1, 2, 3"""


def _corner(x: str, y: str) -> str:
    return f"((x2 - x1) * ({y} - y1) - ({x} - x1) * (y2 - y1))"


_CORNERS = ", ".join(
    _corner(x, y) for x, y in (("west", "south"), ("west", "north"), ("east", "north"), ("east", "south"))
)
_TOUCH = f"""max(CASE WHEN y1 <= north AND y2 >= south AND least(x1, x2) <= east AND greatest(x1, x2) >= west
    AND least({_CORNERS}) <= 0 AND greatest({_CORNERS}) >= 0 THEN 1 ELSE 0 END) = 1"""
_LO, _HI = "greatest(y1, south)", "least(y2, north)"
_GAP = "(east - (x1 + (x2 - x1) / nullif(y2 - y1, 0) * ({y} - y1)))"
_PIECES = f"""SELECT *, least({_GAP.format(y=_LO)}, {_GAP.format(y=_HI)}) AS near,
    greatest({_GAP.format(y=_LO)}, {_GAP.format(y=_HI)}) AS far, east - west AS width FROM wide_places, area_edges"""
_MEAN = """CASE WHEN far > near THEN (greatest(far - greatest(near, width), 0) * width
    + greatest(least(far, width) - greatest(near, 0), 0) * (greatest(near, 0) + least(far, width)) / 2) / (far - near)
    ELSE least(greatest(near, 0), width) END"""
CTES["tile_pairs"] = f"""SELECT tile, adm1, adm2, adm3, middle_strict, area FROM (
    SELECT tile, adm1, adm2, adm3, ({_TOUCH}) OR ({_CLOSED}) AS meets, {_STRICT} AS middle_strict,
        sum(CASE WHEN {_HI} > {_LO} THEN -s * ({_HI} - {_LO}) * ({_MEAN}) ELSE 0 END) AS area
    FROM (SELECT *, lon AS px, lat AS py FROM ({_PIECES})) GROUP BY 1, 2, 3, 4) WHERE meets"""

_BAND = "d.floor_area >= t.floor_area * 0.8::DOUBLE AND d.floor_area <= t.floor_area * 1.2::DOUBLE"
for _zoom, _tag in ((ZOOM, "14"), (16, "16")):
    CTES[f"metric_{_tag}"] = f"""SELECT tile, sum(p_size * (p_size % 5 + 1) * 10.0::DOUBLE) AS floor_area
        FROM (SELECT p_size, {tile('lat', 'lon', _zoom)} AS tile FROM parts) GROUP BY 1"""
    CTES[f"pop_{_tag}"] = f"""SELECT tile, sum(pop::DECIMAL(20, 5))::DOUBLE AS pop FROM (
        SELECT {tile('lat', 'lon', _zoom)} AS tile, o_totalprice / 1000::DOUBLE AS pop FROM (
            SELECT o_totalprice, {lattice('o_orderkey')} FROM orders)) WHERE right(tile, 1) <> '3' GROUP BY 1"""
    CTES[f"gaps_{_tag}"] = f"""SELECT m.tile, m.floor_area, adm1, adm2, adm3, pop FROM metric_{_tag} m JOIN {nation_of(
        'SELECT tile, lon, lat FROM (' + _map(f'SELECT tile FROM metric_{_tag}') + ')')} n USING (tile)
        LEFT JOIN pop_{_tag} USING (tile)"""

ORACLE: dict[str, str] = {
    "src_recursive_scan": "SELECT event_id, device_id FROM pings",
    "src_csv_control_totals": """SELECT name, population, CASE WHEN name = 'ASIA' THEN NULL ELSE households END AS households,
        pop_to_hh FROM control_province""",
    "src_catalog_filtered": """SELECT c_custkey AS place_id, c_mktsegment || ',' || adm2 AS labels
        FROM customer JOIN nat ON c_nationkey = n_nationkey WHERE adm2 = 'NATION_3'""",
    "sink_partitioned_roundtrip": """SELECT event_id, round(lon, 9) AS lon, round(lat, 9) AS lat,
        strftime(local_ts, '%Y-%m-%d') AS event_date FROM pings""",
    "sink_partition_counts": "SELECT strftime(local_ts, '%Y-%m-%d') AS event_date, count(*) AS rows FROM pings GROUP BY 1",
    "filter_keys": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH') AND o_orderstatus = 'F'""",
    "filter_excluded_groups": "SELECT tile, adm1, adm2, adm3 FROM tile_map WHERE adm1 NOT IN ('ASIA', 'EUROPE')",
    "normalize_names": """SELECT p_partkey, lower(replace(p_name, ' ', '')) AS squashed,
        lower(regexp_replace(p_type || ' - ' || p_name, '[^a-zA-Z0-9]+', '_', 'g')) AS snake,
        '_' || p_brand AS guarded, p_brand AS unguarded FROM part""",
    "time_epoch_ms": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc_time FROM pings",
    "time_local_day": """SELECT event_id, strftime(local_ts, '%Y-%m-%d %H:%M:%S') AS local_time,
        strftime(local_ts, '%Y-%m-%d') AS day FROM pings""",
    "busiest_day": """SELECT strftime(local_ts, '%Y-%m-%d') AS event_date, count(*) AS rows FROM pings
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "topk_desc": """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 100""",
    "join_inner_using": "SELECT tile, floor_area, round(pop, 6) AS pop FROM tile_metric JOIN tile_pop USING (tile)",
    "join_inner_expr": """SELECT o_orderkey, o_custkey, c_mktsegment, o_totalprice FROM orders
        JOIN customer ON o_custkey = c_custkey""",
    "join_left_missing": "SELECT tile, floor_area, round(pop, 6) AS pop FROM tile_metric LEFT JOIN surveyed_pop USING (tile)",
    "join_left_anti": "SELECT tile, floor_area FROM tile_metric WHERE tile NOT IN (SELECT tile FROM surveyed_points)",
    "join_left_semi": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (
        SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)""",
    "join_band": f"""SELECT t.tile, t.adm1, t.adm2, t.adm3, t.floor_area, d.floor_area AS neighbour_floor_area,
        round(d.pop, 6) AS neighbour_pop FROM (SELECT * FROM gaps_14 WHERE pop IS NULL) t
        LEFT JOIN (SELECT * FROM gaps_14 WHERE pop IS NOT NULL) d
        ON t.adm1 = d.adm1 AND t.adm2 = d.adm2 AND t.adm3 = d.adm3 AND {_BAND}""",
    "agg_group_sum": """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity,
        round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1, 2""",
    "agg_group_count": "SELECT l_partkey, count(*) AS rows, count(l_returnflag) AS flags FROM lineitem GROUP BY 1",
    "agg_global": """SELECT round(sum(l_extendedprice), 2) AS total, max(l_quantity) AS largest, count(*) AS rows
        FROM lineitem""",
    "agg_distinct_tuples": "SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1",
    "agg_tile_buildings": """SELECT tile, count(*) AS buildings, sum(floors)::BIGINT AS floors,
        round(avg(floors), 6) AS floors_per_building, sum(residential)::BIGINT AS residential,
        count(residential) AS classified FROM buildings GROUP BY 1""",
    "profile_numeric": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,
        min({c}) AS min, round(quantile_cont({c}, 0.25), 5) AS p25, round(quantile_cont({c}, 0.5), 5) AS p50,
        round(quantile_cont({c}, 0.75), 5) AS p75, max({c}) AS max FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "profile_nulls": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM pings"""
        for c in ("event_id", "device_id", "ts", "lon", "lat")
    ),
    "profile_histogram": """SELECT l_returnflag, bin, round(lo + (hi - lo) / 50 * bin, 6) AS start,
        round(lo + (hi - lo) / 50 * (bin + 1), 6) AS stop, count(*) AS rows
        FROM (SELECT l_returnflag, lo, hi, least(49, floor((l_extendedprice - lo) / ((hi - lo) / 50))::BIGINT) AS bin
              FROM lineitem JOIN (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
                                  FROM lineitem GROUP BY 1) USING (l_returnflag)) GROUP BY l_returnflag, bin, lo, hi""",
    "tile_points": f"SELECT event_id, {tile('lat', 'lon', 16)} AS tile FROM pings",
    "geohash_points": "SELECT event_id, "
    + ", ".join(f"CASE WHEN lat IS NOT NULL THEN {geohash('lat', 'lon', p)} END AS gh{p}" for p in (5, 6, 8))
    + " FROM pings",
    "tile_outline": r"""SELECT tile, 'POLYGON ((' || w || ' ' || s || ', ' || w || ' ' || n || ', ' || e || ' ' || n || ', '
        || e || ' ' || s || ', ' || w || ' ' || s || '))' AS outline FROM (SELECT tile,
            regexp_replace(round(west, 9)::VARCHAR, '\.0$', '') AS w, regexp_replace(round(south, 9)::VARCHAR, '\.0$', '') AS s,
            regexp_replace(round(east, 9)::VARCHAR, '\.0$', '') AS e, regexp_replace(round(north, 9)::VARCHAR, '\.0$', '') AS n
            FROM tile_places)""",
    "tile_centroid": "SELECT tile, round(lon, 9) AS lon, round(lat, 9) AS lat FROM tile_places",
    "cell_rollup": f"""SELECT substr({tile('lat', 'lon', 16)}, 1, 12) AS parent, count(*) AS pings FROM pings
        GROUP BY 1""",
    "pivot_cell_category": "SELECT cell, "
    + ", ".join(
        f"count(*) FILTER (category = '{c}') AS \"{c}\""
        for c in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + f""" FROM (SELECT {geohash('lat', 'lon', 6)} AS cell, category, 6 AS r FROM places
        UNION ALL SELECT {geohash('lat', 'lon', 5)} AS cell, category, 5 AS r FROM places) GROUP BY 1, r""",
    "cell_category_matrix": "SELECT cell, string_agg(i || ':' || n, ' ' ORDER BY i) AS counts FROM ("
    + f"""SELECT cell, i, count(*) AS n FROM (
            SELECT {geohash('lat', 'lon', 5)} AS cell, k FROM goods UNION ALL SELECT {geohash('lat', 'lon', 4)}, k FROM goods)
        JOIN (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM (SELECT DISTINCT k FROM goods)) USING (k) GROUP BY 1, 2) GROUP BY 1""",
    "sink_audited": "SELECT strftime(local_ts, '%Y-%m-%d') AS event_date, count(*) AS rows FROM pings GROUP BY 1",
    "sink_overwrite": "SELECT event_id, isp FROM pings",
    "sink_refuses_existing": "SELECT event_id, isp, 'refused' AS second FROM pings",
    "src_catalog_tables": "SELECT 'customer' AS name, count(*) AS rows FROM customer UNION ALL SELECT 'nation', count(*) FROM nation",
    "union_same_columns": "SELECT event_id, isp, 'first' AS feed FROM pings UNION ALL SELECT event_id, isp, 'second' AS feed FROM pings",
    "probe_existence": """SELECT n_nationkey, n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) AS found FROM nation""",
    "ping_cell_features": f"""SELECT event_id, {geohash('lat', 'lon', 6)} AS gh6, {geohash('lat', 'lon', 5)} AS gh5,
        {tile('lat', 'lon', 16)} AS tile FROM pings""",
    "load_polygons": """SELECT adm3, 3::BIGINT AS edges, 0.01::DOUBLE AS area, round(avg(x), 9) AS x, round(avg(y), 9) AS y
        FROM area_points WHERE i < 3 GROUP BY 1""",
    "load_polygons_binary": """SELECT adm3, 3::BIGINT AS edges, 0.01::DOUBLE AS area, round(avg(x), 9) AS x, round(avg(y), 9) AS y
        FROM area_points WHERE i < 3 GROUP BY 1""",
    "spatial_contains": "SELECT event_id, adm3 FROM area_hits WHERE strict",
    "spatial_within": "SELECT event_id, building_id FROM foot_hits WHERE strict",
    "spatial_intersects_point": f"""SELECT event_id, adm3 FROM (SELECT event_id, adm3, ({_CLOSED}) AS hit FROM (
        SELECT event_id, lon AS px, lat AS py FROM pings WHERE lat IS NOT NULL UNION ALL
        SELECT -1 - c_custkey, (500 + c_custkey % 6)::DOUBLE / 5, 13 + ((c_custkey * 15485863) % 99991)::DOUBLE / 99991::DOUBLE
        FROM customer), area_edges GROUP BY 1, 2) WHERE hit""",
    "spatial_intersects_tile": "SELECT tile, adm3 FROM tile_pairs",
    "spatial_join_keyed": f"""SELECT event_id, adm1, building_id FROM (SELECT event_id, adm1 FROM {nation_of(
        'SELECT event_id, lon, lat FROM pings WHERE lat IS NOT NULL')})
        JOIN foot_hits USING (event_id, adm1) WHERE closed""",
    "overlap_area": "SELECT tile, adm3, round(area, 10) AS area FROM tile_pairs",
    "tile_admin_assignment": """SELECT tile, adm1, adm2, adm3 FROM tile_pairs WHERE middle_strict UNION ALL
        SELECT tile, adm1, adm2, adm3 FROM (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY area DESC, adm1, adm2, adm3) AS k
            FROM tile_pairs WHERE tile NOT IN (SELECT tile FROM tile_pairs WHERE middle_strict)) WHERE k = 1""",
    "tile_unassigned": "SELECT tile FROM wide_places WHERE tile NOT IN (SELECT tile FROM tile_pairs)",
    "ping_admin_tags": """SELECT event_id, device_id, strftime(local_ts, '%Y-%m-%d') AS event_date, adm1, adm2, adm3
        FROM pings JOIN area_hits USING (event_id) WHERE closed""",
    "ping_building_visits": """SELECT event_id, strftime(local_ts, '%Y-%m-%d') AS event_date, building_id
        FROM pings JOIN foot_hits USING (event_id) WHERE strict""",
    "ping_place_visits": """SELECT event_id, strftime(local_ts, '%Y-%m-%d') AS event_date, a.adm1, a.adm3, f.building_id,
        'pl_' || f.building_id AS place_id FROM pings JOIN area_hits a USING (event_id)
        JOIN foot_hits f USING (event_id) WHERE a.closed AND f.closed AND a.adm1 = f.adm1""",
    "ping_isp_filter": "SELECT DISTINCT device_id, isp FROM pings WHERE isp IN ('click', 'purchase')",
    "global_ntile": "SELECT event_id, ntile(12) OVER (ORDER BY ts, event_id) AS bucket FROM pings",
    "attach_categories": """SELECT place_id, name, category || ', ' || adm2 AS label_text FROM places
        JOIN customer ON place_id = c_custkey JOIN nat ON c_nationkey = n_nationkey
        WHERE adm2 = 'NATION_3' AND lat IS NOT NULL""",
    "tile_population": "SELECT tile, round(pop, 6) AS pop FROM tile_pop",
    "impute_cascade": f"""SELECT tile, floor_area, adm3, adm2, adm1, round(pop, 8) AS pop, 0::BIGINT AS stage FROM gaps_16
        WHERE pop IS NOT NULL UNION ALL
        SELECT tile, floor_area, adm3, adm2, adm1, round(coalesce(p3, p2, p1), 8) AS pop,
            CASE WHEN p3 IS NOT NULL THEN 1 WHEN p2 IS NOT NULL THEN 2 ELSE 3 END AS stage FROM (
            SELECT t.tile, t.floor_area, t.adm3, t.adm2, t.adm1,
                avg(d.pop) FILTER (d.adm3 = t.adm3 AND d.adm2 = t.adm2) AS p3,
                avg(d.pop) FILTER (d.adm2 = t.adm2) AS p2, avg(d.pop) AS p1
            FROM (SELECT * FROM gaps_16 WHERE pop IS NULL) t JOIN (SELECT * FROM gaps_16 WHERE pop IS NOT NULL) d
            ON t.adm1 = d.adm1 AND {_BAND} GROUP BY 1, 2, 3, 4, 5)""",
    "control_ratio": "SELECT adm1, round(ratio, 9) AS ratio FROM ratios",
    "scale_to_control": """SELECT tile, adm1, round(ratio, 6) AS ratio, round(pop, 6) AS pop,
        round(adjusted_pop, 6) AS adjusted_pop FROM scaled""",
    "sample_bounds": f"""SELECT tile, m.adm1, pop_to_hh, round(pop_to_hh + 2 * 0.29::DOUBLE, 2) AS upper,
        round(pop_to_hh - 2 * 0.29::DOUBLE, 2) AS lower FROM (SELECT tile, {_squash('adm1')} AS adm1 FROM tile_map) m
        JOIN control_province c ON m.adm1 = {_squash('c.name')}""",
    "sample_bounded_gaussian": "SELECT adm1, slot, round(sample, 6) AS sample FROM samples",
    "sample_bounded_uniform": f"""SELECT adm1, slot, round(lower + (upper - lower) * ({_HASH.format(
        seed="('42:' || adm1 || ':' || slot)", at=1)}), 6) AS sample
        FROM (SELECT *, unnest(range(1, n + 1)) AS slot FROM sample_groups)""",
    "rank_match": f"""SELECT tile, floor_area, adm1, place, round(sample, 6) AS sample FROM (
        SELECT tile, floor_area, {_squash('adm1')} AS adm1,
            row_number() OVER (PARTITION BY adm1 ORDER BY floor_area DESC, tile) AS place
        FROM tile_metric JOIN tile_map USING (tile))
        JOIN (SELECT adm1, sample, row_number() OVER (PARTITION BY adm1 ORDER BY sample, slot) AS place FROM samples)
        USING (adm1, place)""",
    "household_estimate": """SELECT tile, adm1, round(ratio, 5) AS ratio, round(pop, 5) AS pop,
        round(adjusted_pop, 5) AS adjusted_pop, floor_area, round(sample, 5) AS pop_to_hh,
        round(adjusted_pop / sample, 0) AS hh FROM (
            SELECT *, row_number() OVER (PARTITION BY adm1 ORDER BY floor_area DESC, tile) AS k FROM measured)
        JOIN (SELECT adm1, sample, row_number() OVER (PARTITION BY adm1 ORDER BY sample, slot) AS k FROM measured_draws)
        USING (adm1, k)""",
    "household_uniform": f"""SELECT tile, adm1, round(adjusted_pop, 5) AS adjusted_pop, floor_area, round(sample, 5) AS pop_to_hh,
        round(adjusted_pop / sample, 5) AS hh FROM (
            SELECT *, row_number() OVER (PARTITION BY adm1 ORDER BY floor_area DESC, tile) AS k FROM measured)
        JOIN (SELECT adm1, sample, row_number() OVER (PARTITION BY adm1 ORDER BY sample, slot) AS k FROM (
            SELECT adm1, slot, lower + (upper - lower) * ({_HASH.format(seed="('42:' || adm1 || ':' || slot)", at=1)}) AS sample
            FROM (SELECT *, unnest(range(1, n + 1)) AS slot FROM (
                SELECT g.adm1, n, round(pop_to_hh + 2 * 0.29::DOUBLE, 2) AS upper, round(pop_to_hh - 2 * 0.29::DOUBLE, 2) AS lower
                FROM (SELECT adm1, count(*) AS n FROM measured GROUP BY 1) g
                JOIN (SELECT {_squash('name')} AS adm1, pop_to_hh FROM control_province) USING (adm1)))))
        USING (adm1, k)""",
    "household_correction": f"""SELECT tile, adm1, hh, province_hh, control_hh, hh_corrected,
        round(adjusted_pop / nullif(hh_corrected, 0), 6) AS pop_to_hh_corrected FROM (
        SELECT *, round(hh * control_hh / nullif(province_hh, 0), 0) AS hh_corrected FROM (
            SELECT tile, e.adm1, adjusted_pop, hh, households AS control_hh, sum(hh) OVER (PARTITION BY e.adm1) AS province_hh
            FROM (SELECT * REPLACE ({_squash('adm1')} AS adm1) FROM estimates) e
            JOIN control_province c ON e.adm1 = {_squash('c.name')}))""",
    "district_multiplier": """SELECT tile, adm1, adm2, adm3, round(multiplier, 6) AS multiplier,
        round(multiplier * adjusted_pop, 6) AS truth_adjusted_pop, round(multiplier * adjusted_pop / pop_to_hh, 6) AS hh
        FROM estimates JOIN multipliers USING (adm1, adm2)""",
    "district_extremes": """SELECT adm1, adm2, round(estimated_pop, 6) AS estimated_pop, round(truth_pop, 6) AS truth_pop,
        round(multiplier, 6) AS multiplier, CASE WHEN multiplier > 0.8 THEN 1 ELSE 0 END::BIGINT AS extreme FROM multipliers""",
    "reallocate_by_buildings": " UNION ALL ".join(
        f"""SELECT tile, adm1, adm2, adm3, tile_buildings, district_total,
        round(truth_pop * tile_buildings / district_total, 6) AS truth_adjusted_pop,
        round(truth_pop * tile_buildings / district_total / pop_to_hh, 6) AS hh, '{kind}' AS denominator FROM (
            SELECT *, ({total} OVER (PARTITION BY adm1, adm2))::BIGINT AS district_total FROM estimates
            JOIN (SELECT adm1, adm2, truth_pop FROM multipliers WHERE multiplier > 0.8) USING (adm1, adm2)
            JOIN (SELECT tile, count(*) AS tile_buildings FROM buildings GROUP BY 1) USING (tile))"""
        for kind, total in (("buildings", "sum(tile_buildings)"), ("rows", "count(*)"))
    ),
    "combine_sources": f"""WITH c AS (SELECT * FROM {nation_of(
        f"SELECT c_custkey, c_acctbal, lon, lat, {tile('lat', 'lon', ZOOM)} AS tile FROM (SELECT c_custkey, c_acctbal, {lattice('c_custkey')} FROM customer)")}),
        o AS (SELECT tile, count(*) * 1000.0::DOUBLE AS hh FROM c WHERE c_custkey % 3 <> 2 GROUP BY 1 HAVING count(*) * 1000 >= 4000)
        SELECT tile, adm1, adm2, adm3, ceil(hh)::BIGINT AS hh FROM (
            SELECT s.tile, adm1, adm2, adm3, coalesce(o.hh, s.hh) AS hh FROM (
                SELECT tile, lower(regexp_replace(adm1, '[^a-zA-Z0-9]+', '_', 'g')) AS adm1, lower(adm2) AS adm2, lower(adm3) AS adm3,
                    sum(hh) AS hh FROM (
                    SELECT tile, adm1, adm2, adm3, c_acctbal / 100::DOUBLE AS hh FROM c WHERE c_custkey % 3 <> 2 UNION ALL
                    SELECT tile, adm1, adm2, adm3, c_acctbal / 200::DOUBLE FROM c WHERE c_custkey % 3 <> 1 UNION ALL
                    SELECT tile, adm1, adm2, adm3, c_acctbal / 50::DOUBLE FROM c WHERE c_custkey % 3 <> 0) GROUP BY 1, 2, 3, 4) s
            LEFT JOIN o ON s.tile = o.tile) WHERE hh > 0""",
    "override_values": """SELECT e.tile, round(CASE WHEN m.tile IS NULL THEN e.hh ELSE m.floor_area / 10 END, 4) AS hh
        FROM estimates e LEFT JOIN (SELECT * FROM tile_metric WHERE floor_area >= 6000) m ON e.tile = m.tile""",
    "district_totals": """SELECT adm1, adm2, round(sum(adjusted_pop), 6) AS adjusted_pop, sum(hh) AS hh
        FROM estimates GROUP BY 1, 2""",
    "built_up_share": """SELECT tile, round(floor_area / 360000::DOUBLE, 8) AS share,
        round(floor_area * 100 / 360000::DOUBLE, 8) AS share_pct FROM tile_metric""",
    "export_area_tiles": r"""SELECT tile, adm1, hh, round(pop_to_hh, 2) AS pop_to_hh,
        'POLYGON ((' || w || ' ' || s || ', ' || w || ' ' || n || ', ' || e || ' ' || n || ', '
        || e || ' ' || s || ', ' || w || ' ' || s || '))' AS outline FROM estimates JOIN (SELECT tile,
            regexp_replace(round(west, 9)::VARCHAR, '\.0$', '') AS w, regexp_replace(round(south, 9)::VARCHAR, '\.0$', '') AS s,
            regexp_replace(round(east, 9)::VARCHAR, '\.0$', '') AS e, regexp_replace(round(north, 9)::VARCHAR, '\.0$', '') AS n
            FROM tile_places) USING (tile) WHERE adm1 IN ('ASIA', 'EUROPE')""",
    "busy_day_batches": """SELECT event_id, "date", part, building_id FROM (
        SELECT event_id, strftime(local_ts, '%Y-%m-%d') AS "date", ntile(12) OVER (ORDER BY ts, event_id) AS part FROM pings
        WHERE strftime(local_ts, '%Y-%m-%d') = (SELECT strftime(local_ts, '%Y-%m-%d') AS d FROM pings
            GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) JOIN foot_hits USING (event_id) WHERE strict""",
    "district_route": """SELECT tile, adm1, adm2, adm3, round(multiplier, 6) AS multiplier, method, round(p, 6) AS truth_adjusted_pop,
        round(p / pop_to_hh, 6) AS hh FROM district_routed WHERE p IS NOT NULL""",
    "district_job": f"""WITH c AS (SELECT * FROM {nation_of(
        f"SELECT c_custkey, c_acctbal, lon, lat, {tile('lat', 'lon', ZOOM)} AS tile FROM (SELECT c_custkey, c_acctbal, {lattice('c_custkey')} FROM customer)")})
        SELECT tile, adm1, adm2, adm3, ceil(hh)::BIGINT AS hh, method FROM (
            SELECT s.tile, s.adm1, s.adm2, s.adm3, coalesce(m.floor_area / 10, s.hh) AS hh, method FROM (
                SELECT tile, lower(regexp_replace(adm1, '[^a-zA-Z0-9]+', '_', 'g')) AS adm1, lower(adm2) AS adm2, lower(adm3) AS adm3,
                    sum(hh) AS hh, string_agg(DISTINCT method, ',' ORDER BY method) AS method FROM (
                    SELECT tile, adm1, adm2, adm3, p / pop_to_hh AS hh, method FROM district_routed WHERE p IS NOT NULL UNION ALL
                    SELECT tile, adm1, adm2, adm3, c_acctbal / 200::DOUBLE, 'other' FROM c WHERE c_custkey % 3 <> 1)
                GROUP BY 1, 2, 3, 4) s
            LEFT JOIN (SELECT * FROM tile_metric WHERE floor_area >= 6000) m ON s.tile = m.tile) WHERE hh > 0""",
    "correction_recheck": f"""SELECT adm1, sum(hh_corrected) AS est_hh, max(control_hh) AS control_hh,
        round((sum(hh_corrected) - max(control_hh)) * 100 / nullif(max(control_hh), 0), 6) AS pct_diff FROM (
        SELECT *, round(hh * control_hh / nullif(province_hh, 0), 0) AS hh_corrected FROM (
            SELECT e.adm1, hh, households AS control_hh, sum(hh) OVER (PARTITION BY e.adm1) AS province_hh
            FROM (SELECT * REPLACE ({_squash('adm1')} AS adm1) FROM estimates) e
            JOIN control_province c ON e.adm1 = {_squash('c.name')})) GROUP BY 1""",
    "qc_control_diff": """SELECT e.adm1, est_hh, households AS control_hh, round((est_hh - households) * 100 / nullif(households, 0), 6) AS pct_diff
        FROM (SELECT lower(replace(adm1, ' ', '')) AS adm1, sum(hh) AS est_hh FROM estimates GROUP BY 1) e
        JOIN control_province c ON e.adm1 = lower(replace(c.name, ' ', ''))""",
    "qc_area_per_household": """SELECT tile, round(r, 6) AS area_per_hh, (r <= 1 OR r > 20)::BIGINT AS outlier, (r <= 2)::BIGINT AS too_low,
        (r >= 10)::BIGINT AS too_high FROM (SELECT tile, floor_area / nullif(hh, 0) AS r FROM estimates JOIN tile_metric USING (tile))""",
    "qc_floor_excess_top": """SELECT b.tile, building_id, floors, round(excess, 6) AS excess_pct FROM buildings b JOIN (
        SELECT tile, (hh - total) * 100 / total AS excess FROM estimates
        JOIN (SELECT tile, sum(floors)::DOUBLE AS total FROM buildings GROUP BY 1) USING (tile)) x ON b.tile = x.tile
        WHERE excess > 0 ORDER BY excess DESC, b.tile, building_id LIMIT 300""",
    "qc_worst_tiles": """SELECT tile, total AS total_floors, hh, round((hh - total) * 100 / total, 6) AS excess_pct FROM estimates
        JOIN (SELECT tile, sum(floors)::BIGINT AS total FROM buildings GROUP BY 1) USING (tile)
        WHERE (hh - total) * 100 / total > 0 ORDER BY (hh - total) * 100 / total DESC, tile LIMIT 300""",
    "qc_more_households": """SELECT tile, buildings, hh FROM estimates
        JOIN (SELECT tile, count(*) AS buildings FROM buildings GROUP BY 1) USING (tile) WHERE buildings <= hh""",
}


def _needed(body: str, seen: dict[str, None]) -> None:
    for name, text in CTES.items():
        if name not in seen and _mentions(body, name):
            _needed(text, seen)
            seen[name] = None


def _mentions(text: str, name: str) -> bool:
    cleaned = text
    for mark in "(),.\n":
        cleaned = cleaned.replace(mark, " ")
    return name in cleaned.split()


def oracle_sql() -> dict[str, str]:
    """Each query with the common table expressions it needs."""
    out = {}
    for name, body in ORACLE.items():
        seen: dict[str, None] = {}
        _needed(body, seen)
        heads = ",\n".join(f"{cte} AS ({CTES[cte]})" for cte in seen)
        if not heads:
            out[name] = body
        elif body.lstrip().startswith("WITH "):
            out[name] = f"WITH {heads},\n{body.lstrip()[5:]}"
        else:
            out[name] = f"WITH {heads}\n{body}"
    return out
