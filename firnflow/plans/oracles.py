"""Comparison SQL for the registered queries, written for DuckDB from the definitions, not from the Spark plans.

Regions are tested by separating axes or case by case, running means by a literal range join, calendars by generated series,
projections by
series that are fitted here to the definitions of the latitudes.
"""

from __future__ import annotations

import math

from firnflow.plans.queries import ELEVATION_GRID, IRREGULAR_AXIS, PROFILE_INTERVAL
from firnflow.plans.views import VIEWS

ORACLES: dict[str, str] = {}


def add(key: str, views: str, body: str, ctes: str = "") -> None:
    parts = [f"{n} AS ({VIEWS[n].sql})" for n in views.split()]
    if ctes:
        parts.append(ctes.strip().rstrip(","))
    head = f"WITH {', '.join(parts)} " if parts else ""
    ORACLES[key] = (head + body).strip()


PERIOD = "datetime >= TIMESTAMP '1990-01-01' AND datetime < TIMESTAMP '2026-01-01'"


def overlaps(x0, y0, x1, y1) -> str:
    return f"(minx <= {x1} AND maxx >= {x0} AND miny <= {y1} AND maxy >= {y0})"


BBOX = overlaps(-50, 65, -40, 75)
WIDE = overlaps(-70, 60, -30, 85)
VALID = "percent_valid_pixels >= 1"


def convex_meets(ring: list[tuple[float, float]]) -> str:
    """Box against convex polygon: no axis of the box and no polygon edge has them on different sides."""
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    tests = [overlaps(min(xs), min(ys), max(xs), max(ys))]
    for i, (px, py) in enumerate(ring):
        qx, qy = ring[(i + 1) % len(ring)]
        # Counter-clockwise ring: the box is outside an edge when all its corners are to the right of it.
        corner = [f"({qx - px}) * ({y} - ({py})) - ({qy - py}) * ({x} - ({px})) < 0" for x in ("minx", "maxx") for y in ("miny", "maxy")]
        tests.append("NOT (" + " AND ".join(corner) + ")")
    return "(" + " AND ".join(tests) + ")"


CONVEX_CCW = [(-50, 65), (-42, 64), (-40, 70), (-44, 75), (-50, 73)]
CONVEX = convex_meets(CONVEX_CCW)

# ---- search --------------------------------------------------------------------------------------------------------
add(
    "search_bbox_props",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE {BBOX} AND percent_valid_pixels >= 40 AND date_dt BETWEEN 7 AND 30
        AND datetime >= TIMESTAMP '1996-01-01' AND datetime < TIMESTAMP '2001-01-01'""",
)
wide_sql = f"SELECT DISTINCT href FROM granules WHERE {WIDE} AND percent_valid_pixels >= 10 AND {PERIOD}"
add("search_wide", "granules", wide_sql)
add("stream_search", "granules", wide_sql)
add("search_polygon", "granules", f"SELECT DISTINCT href FROM granules WHERE {CONVEX} AND {VALID} AND {PERIOD}")
add(
    "search_concave",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE ({overlaps(-60, 62, -40, 66)} OR {overlaps(-60, 62, -54, 78)})
        AND {VALID} AND {PERIOD}""",
)
add(
    "search_geojson_hole",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE {overlaps(-65, 62, -35, 80)}
        AND NOT (minx > -58 AND maxx < -42 AND miny > 66 AND maxy < 77) AND {VALID} AND {PERIOD}""",
)
add(
    "search_geojson_point",
    "granules",
    f"SELECT DISTINCT href FROM granules WHERE {overlaps(-45, 75, -45, 75)} AND {VALID} AND {PERIOD}",
)
add(
    "search_many_rois",
    "granules rois",
    f"""SELECT roi_id, granule_id, href FROM granules JOIN rois
        ON minx <= roi_maxx AND maxx >= roi_minx AND miny <= roi_maxy AND maxy >= roi_miny
        WHERE percent_valid_pixels >= 20 AND {PERIOD}""",
)
add(
    "search_many_polygons",
    "granules rois",
    """SELECT roi_id, granule_id FROM granules JOIN rois
       ON minx <= roi_maxx AND maxx >= roi_minx AND miny <= roi_maxy AND maxy >= roi_miny
       AND greatest(0, minx - roi_cx, roi_cx - maxx) + greatest(0, miny - roi_cy, roi_cy - maxy) <= roi_half""",
)
add(
    "search_valid_regions",
    "granules rois",
    """SELECT roi_id, granule_id, NULL AS reason FROM granules JOIN rois
       ON minx <= roi_maxx AND maxx >= roi_minx AND miny <= roi_maxy AND maxy >= roi_miny
       AND greatest(0, minx - roi_cx, roi_cx - maxx) + greatest(0, miny - roi_cy, roi_cy - maxy) <= roi_half
       WHERE roi_id % 3 <> 0 AND roi_id % 11 <> 0
       UNION ALL SELECT roi_id, NULL, CASE WHEN roi_id % 3 = 0 THEN 'edges cross' ELSE 'edge without length' END FROM rois
       WHERE roi_id % 3 = 0 OR roi_id % 11 = 0""",
)
add(
    "stream_regions",
    "granules rois",
    f"""SELECT DISTINCT roi_id, href FROM granules JOIN rois
       ON minx <= roi_maxx AND maxx >= roi_minx AND miny <= roi_maxy AND maxy >= roi_miny
       AND greatest(0, minx - roi_cx, roi_cx - maxx) + greatest(0, miny - roi_cy, roi_cy - maxy) <= roi_half
       WHERE percent_valid_pixels >= 20 AND {PERIOD}""",
)
add(
    "stream_region_coverage",
    "granules rois",
    f"""SELECT roi_id, CAST(year(datetime) AS INT) AS year, count(*) AS files FROM granules JOIN rois
        ON minx <= roi_maxx AND maxx >= roi_minx AND miny <= roi_maxy AND maxy >= roi_miny
        WHERE percent_valid_pixels >= 20 AND {PERIOD} GROUP BY ALL""",
)
for key in ("search_pruned", "search_unpruned"):
    add(key, "granules", f"SELECT DISTINCT href FROM granules WHERE {BBOX} AND percent_valid_pixels >= 10 AND {PERIOD}")
_HOLED = f"({overlaps(-65, 62, -35, 80)} AND NOT (minx > -58 AND maxx < -42 AND miny > 66 AND maxy < 77))"
add(
    "search_precedence",
    "granules",
    f"""SELECT DISTINCT 'bbox+polygon+geojson' AS given, href FROM granules WHERE {_HOLED} AND {VALID} AND {PERIOD}
        UNION ALL SELECT DISTINCT 'bbox+polygon', href FROM granules WHERE {CONVEX} AND {VALID} AND {PERIOD}""",
)
add(
    "search_collection_overlap",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE ({overlaps(-60, 62, -40, 76)} OR {overlaps(-56, 64, -36, 80)})
        AND {VALID} AND {PERIOD}""",
)
add(
    "search_ring_footprints",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE ({_HOLED} OR {overlaps(-56, 68, -52, 70)} OR {overlaps(-50, 72, -44, 72)})
        AND {VALID} AND {PERIOD}""",
)
add(
    "search_default_period",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE {WIDE} AND {VALID}
        AND datetime >= TIMESTAMP '2000-01-01' AND datetime < TIMESTAMP '2026-01-01'""",
)
add(
    "search_count",
    "granules",
    f"SELECT count(*) AS matches FROM granules WHERE {BBOX} AND date_dt <= 100 AND {VALID} AND {PERIOD}",
)
add(
    "search_top",
    "granules",
    f"SELECT DISTINCT href FROM granules WHERE {WIDE} AND {VALID} AND {PERIOD} ORDER BY href LIMIT 25",
)

# ---- filters -------------------------------------------------------------------------------------------------------
add(
    "filter_ops_all",
    "granules",
    """SELECT granule_id FROM granules WHERE platform = 'L8' AND version <> '001' AND percent_valid_pixels >= 5
       AND date_dt <= 500 AND granule_id > 20 AND minx < -30.5""",
)
add("filter_not_equal_null", "granules", "SELECT granule_id FROM granules WHERE proj_code <> 'EPSG:3031'")
add(
    "filter_nested",
    "granules",
    "SELECT granule_id, date_dt FROM granules WHERE version = '002' AND date_dt >= 7 AND date_dt <= 60",
)
add(
    "filter_default",
    "granules",
    "SELECT granule_id FROM granules WHERE percent_valid_pixels >= 85.0 AND proj_code = 'EPSG:3413'",
)
add(
    "filter_text_search",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE {WIDE} AND percent_valid_pixels >= 20 AND proj_code = 'EPSG:3413'
        AND version = '002' AND date_dt < 200.5 AND {PERIOD}""",
)
add(
    "filter_text_parse",
    "saved_filters",
    r"""SELECT filter_id, CASE WHEN ok THEN property END AS property, CASE WHEN ok THEN op END AS op,
        CASE WHEN ok THEN value END AS value,
        CASE WHEN NOT ok THEN NULL
             WHEN CAST(TRY_CAST(value AS BIGINT) AS VARCHAR) = value THEN 'int'
             WHEN TRY_CAST(value AS BIGINT) IS NULL AND TRY_CAST(value AS DOUBLE) IS NOT NULL THEN 'float'
             WHEN regexp_matches(value, '^[0-9]*\.[0-9]+$') THEN 'float'
             ELSE 'text' END AS value_kind
        FROM split""",
    r"""split AS (SELECT filter_id, regexp_matches(filter_text, ':(>=|<=|!=|=|>|<):') AS ok,
        regexp_extract(filter_text, '^(.*?):(>=|<=|!=|=|>|<):(.*)$', 1) AS property,
        regexp_extract(filter_text, '^(.*?):(>=|<=|!=|=|>|<):(.*)$', 2) AS op,
        regexp_extract(filter_text, '^(.*?):(>=|<=|!=|=|>|<):(.*)$', 3) AS value FROM saved_filters)""",
)
add(
    "mission_platforms",
    "granules",
    f"""SELECT m.mission, granule_id, platform FROM granules JOIN (VALUES ('sentinel1','S1A'), ('sentinel1','S1B'),
        ('SENTINEL2','S2A'), ('SENTINEL2','S2B'), ('landsatOLI','L8'), ('landsatOLI','L9')) m(mission, p) ON p = platform
        WHERE {WIDE} AND {VALID} AND {PERIOD}""",
)
add(
    "interval_minimum",
    "granules",
    f"SELECT DISTINCT href FROM granules WHERE {BBOX} AND date_dt >= 300 AND {VALID} AND {PERIOD}",
)
add("interval_maximum", "granules", f"SELECT DISTINCT href FROM granules WHERE {BBOX} AND date_dt <= 60 AND {PERIOD}")
add(
    "checked_boxes",
    "rois",
    """SELECT roi_id, CASE WHEN abs(roi_minx * 3) > 180 THEN 'lon_out_of_range' WHEN abs(roi_miny * 1.2e0) > 90 THEN 'lat_out_of_range'
       WHEN abs(roi_maxx * 3) > 180 THEN 'lon_out_of_range' WHEN abs(roi_maxy * 1.2e0) > 90 THEN 'lat_out_of_range' END AS reason
       FROM rois""",
)
add(
    "checked_dates",
    "",
    """SELECT o_orderkey, concat_ws('-', '1999', o_orderkey % 14, o_orderkey % 33) AS date_text,
       TRY_CAST(concat_ws('-', '1999', o_orderkey % 14, o_orderkey % 33) AS DATE) AS date_value FROM orders""",
)

# ---- assets and addresses ------------------------------------------------------------------------------------------
add(
    "asset_explode",
    "granule_assets",
    """SELECT granule_id, json_extract_string(assets, '$.data.href') AS href FROM granule_assets
       WHERE json_extract_string(assets, '$.data.href') LIKE '%.nc'""",
)
add(
    "asset_json_href",
    "granule_assets",
    "SELECT granule_id, json_extract_string(assets, '$.data.href') AS href FROM granule_assets",
)
_CUBE_URL = r"^(https://[^/]+\.s3\.amazonaws\.com/)datacubes/[^/]+/([^/]+)/ICE_vel_(EPSG[0-9]+)_G0120_(X-?[0-9]+_Y-?[0-9]+)\.zarr"
_COMPOSITE = (
    "CASE WHEN regexp_matches({u}, '" + _CUBE_URL + "') THEN concat(regexp_extract({u}, '" + _CUBE_URL + "', 1), "
    "'composites/annual/v2-updated-september2025/', regexp_extract({u}, '" + _CUBE_URL + "', 2), '/ICE_velocity_', "
    "regexp_extract({u}, '" + _CUBE_URL + "', 3), '_120m_', regexp_extract({u}, '" + _CUBE_URL + "', 4), '.zarr') ELSE '' END"
)
add(
    "cube_items",
    "cube_items",
    f"""SELECT item_id, url AS zarr_url, {_COMPOSITE.replace('{u}', 'url')} AS composite_zarr_url,
        coalesce(replace(proj_code, 'EPSG:', ''), '3413') AS epsg
        FROM (SELECT item_id, proj_code,
          CASE WHEN item_id % 5 <> 0 THEN json_extract_string(assets, '$.a.href')
               WHEN json_extract_string(assets, '$.b.href') LIKE '%.zarr' THEN json_extract_string(assets, '$.b.href') END AS url
          FROM cube_items) WHERE url IS NOT NULL""",
)
add(
    "composite_url",
    "cube_items",
    f"""SELECT item_id, url, {_COMPOSITE.replace('{u}', 'url')} AS composite FROM (
        SELECT item_id, json_extract_string(assets, '$.a.href') AS url FROM cube_items
        UNION ALL SELECT item_id, json_extract_string(assets, '$.b.href') FROM cube_items)""",
)
add(
    "url_parts",
    "",
    """SELECT o_orderkey, concat('b', o_orderkey, '.nc') AS file_name,
       concat('https://bucket', o_orderkey % 7, '.s3.amazonaws.com/a/b', o_orderkey, '.nc') AS https,
       concat('s3://bucket', o_orderkey % 7, '/a/b', o_orderkey, '.nc') AS s3, concat('bucket', o_orderkey % 7) AS bucket,
       concat('a/b', o_orderkey, '.nc') AS object_key FROM orders""",
)
add(
    "url_csv",
    "granules",
    f"""SELECT href AS url, concat('g', granule_id, '.nc') AS filename FROM granules WHERE {BBOX} AND {VALID} AND {PERIOD}""",
)
add(
    "download_manifest",
    "",
    """SELECT concat(CASE WHEN o_orderkey % 4 = 0 THEN 'https://example-data.s3.amazonaws.com/v/'
       ELSE 'https://archive.example.org/v/' END, o_orderkey, '.nc') AS href, concat(o_orderkey, '.nc') AS filename,
       CASE WHEN o_orderkey % 4 = 0 THEN 's3' ELSE 'daac' END AS route FROM orders""",
)

# ---- coverage and tiles --------------------------------------------------------------------------------------------
add(
    "coverage_by_year",
    "granules",
    f"""SELECT CAST(year(datetime) AS INT) AS year, count(*) AS files FROM granules WHERE {BBOX} AND {VALID} AND {PERIOD}
        GROUP BY 1""",
)
add(
    "coverage_rollup",
    "granules",
    f"""SELECT yr AS year, platform, count(*) AS files FROM (SELECT CAST(year(datetime) AS INT) AS yr, platform FROM granules
        WHERE {CONVEX} AND {VALID} AND {PERIOD}) GROUP BY ROLLUP (yr, platform)""",
)


def _tile(lat: str, lon: str) -> str:
    rows, cols = f"least(floor(abs({lat}) / 10) * 10, 80)", f"least(floor(abs({lon}) / 10) * 10, 170)"
    return (
        f"concat(CASE WHEN {lat} >= 0 THEN 'N' ELSE 'S' END, lpad(CAST(CAST({rows} AS INT) AS VARCHAR), 2, '0'), "
        f"CASE WHEN {lon} >= 0 THEN 'E' ELSE 'W' END, lpad(CAST(CAST({cols} AS INT) AS VARCHAR), 3, '0'))"
    )


_TILED = f"tiled AS (SELECT *, {_tile('((miny + maxy) / 2)', '((minx + maxx) / 2)')} AS tile FROM granules)"
add("count_by_tile", "granules", "SELECT tile, count(*) AS matches FROM tiled GROUP BY tile", _TILED)
add(
    "tile_index",
    "granules",
    """SELECT tile, round(min(minx), 6) AS t_minx, round(min(miny), 6) AS t_miny, round(max(maxx), 6) AS t_maxx,
       round(max(maxy), 6) AS t_maxy, count(*) AS granules FROM tiled GROUP BY tile""",
    _TILED,
)
add("catalog_hive", "granules", "SELECT granule_id, tile FROM tiled WHERE tile IN ('N70W050', 'N60W040')", _TILED)
add(
    "tile_names_point",
    "utm_points",
    f"""SELECT point_id, tile, concat('base/dir/', tile) AS path FROM (SELECT point_id,
        {_tile('(lat * 90 / 80)', '(lon * 180 / 179)')} AS tile FROM utm_points)""",
)
add(
    "tile_cover_bbox",
    "rois",
    """SELECT roi_id, lon_c, lat_c, concat(CASE WHEN lat_c >= 0 THEN 'N' ELSE 'S' END, lpad(CAST(abs(lat_c) AS VARCHAR), 2, '0'),
       CASE WHEN lon_c >= 0 THEN 'E' ELSE 'W' END, lpad(CAST(abs(lon_c) AS VARCHAR), 3, '0')) AS tile
       FROM rois, (SELECT CAST(x * 10 AS INT) AS lon_c FROM range(-19, 20) t(x)), (SELECT CAST(x * 10 AS INT) AS lat_c FROM range(-10, 11) t(x))
       WHERE lon_c - 5 <= roi_maxx AND lon_c + 5 >= roi_minx AND lat_c - 5 <= roi_maxy AND lat_c + 5 >= roi_miny""",
)
add(
    "tile_cover_polygon",
    "rois",
    """SELECT roi_id, concat(CASE WHEN lat_c >= 0 THEN 'N' ELSE 'S' END, lpad(CAST(abs(lat_c) AS VARCHAR), 2, '0'),
       CASE WHEN lon_c >= 0 THEN 'E' ELSE 'W' END, lpad(CAST(abs(lon_c) AS VARCHAR), 3, '0')) AS tile
       FROM rois, (SELECT CAST(x * 10 AS INT) AS lon_c FROM range(-19, 20) t(x)), (SELECT CAST(x * 10 AS INT) AS lat_c FROM range(-10, 11) t(x))
       WHERE greatest(0, lon_c - 5 - roi_cx, roi_cx - lon_c - 5) + greatest(0, lat_c - 5 - roi_cy, roi_cy - lat_c - 5) <= roi_half""",
)
add(
    "wrapped_longitudes",
    "points",
    "SELECT point_id, round(CASE WHEN lon * 5 < -180 THEN lon * 5 + 360 ELSE lon * 5 END, 6) AS lon FROM points",
)


# ---- projections ---------------------------------------------------------------------------------------------------
# The WGS 84 ellipsoid, the polar systems (latitude of true scale, central meridian, side) and the scale of UTM.
_MAJOR, _FLAT = 6378137.0, 1 / 298.257223563
_ECC = math.sqrt(_FLAT * (2 - _FLAT))
_POLAR = {3413: (70.0, -45.0, 1), 3031: (71.0, 0.0, -1)}
_UTM_SCALE = 0.9996

# The series are not taken from the library but fitted here, from the definitions of the latitudes, by sums over a period.
_POINTS = 512


def _conformal(phi: float) -> float:
    return math.atan(math.sinh(math.asinh(math.tan(phi)) - _ECC * math.atanh(_ECC * math.sin(phi))))


def _solved(f, y: float) -> float:
    """Angle at which a function near the identity has the value y."""
    x = y
    for _ in range(60):
        x += y - f(x)
    return x


def _curvature(phi: float) -> float:
    return _MAJOR * (1 - _ECC**2) / (1 - (_ECC * math.sin(phi)) ** 2) ** 1.5


_WAVES = [sum(_curvature(math.pi * i / _POINTS) * math.cos(2 * k * math.pi * i / _POINTS) for i in range(_POINTS)) / _POINTS for k in range(8)]
_RECTIFYING = _WAVES[0]  # radius of the circle that is as long as the meridian


def _rectifying(phi: float) -> float:
    return phi + sum(_WAVES[k] * math.sin(2 * k * phi) / k for k in range(1, 8)) / _RECTIFYING


def _sines(f, terms: int = 5) -> list[float]:
    """Coefficients of sin 2x, sin 4x and so on of an odd function of period pi."""
    places = [math.pi * i / _POINTS for i in range(1, _POINTS // 2)]
    values = [f(x) for x in places]
    return [4 / _POINTS * sum(v * math.sin(2 * k * x) for x, v in zip(places, values)) for k in range(1, terms + 1)]


_TO_GEODETIC = _sines(lambda chi: _solved(_conformal, chi) - chi)
_TO_RECTIFYING = _sines(lambda chi: _rectifying(_solved(_conformal, chi)) - chi)
_FROM_RECTIFYING = _sines(lambda mu: mu - _conformal(_solved(_rectifying, mu)))


def _polar_scale(true: float) -> float:
    """Metres of radius per unit of the isometric co-latitude's exponential, from the radius at the latitude of true scale."""
    phi = math.radians(true)
    radius = _MAJOR * math.cos(phi) / math.sqrt(1 - (_ECC * math.sin(phi)) ** 2)
    return radius / math.tan(math.pi / 4 - _conformal(phi) / 2)


def polar_xy(lon: str, lat: str, epsg: int) -> tuple[str, str]:
    true, lon0, side = _POLAR[epsg]
    phi, e = f"radians({side} * ({lat}))", repr(_ECC)
    t = f"(tan(pi() / 4 - {phi} / 2) / pow((1 - {e} * sin({phi})) / (1 + {e} * sin({phi})), {e} / 2))"
    rho, turn = f"({_polar_scale(true)!r} * {t})", f"radians(({lon}) - ({lon0}))"
    return f"({rho} * sin({turn}))", f"({-side} * {rho} * cos({turn}))"


def polar_lonlat(x: str, y: str, epsg: int) -> tuple[str, str]:
    true, lon0, side = _POLAR[epsg]
    chi = f"(pi() / 2 - 2 * atan(sqrt(({x}) * ({x}) + ({y}) * ({y})) / {_polar_scale(true)!r}))"
    series = " + ".join(f"({c!r}) * sin({2 * k} * {chi})" for k, c in enumerate(_TO_GEODETIC, start=1))
    lon = f"({lon0} + degrees(atan2({x}, {-side} * ({y}))))"
    wrapped = f"(CASE WHEN {lon} > 180 THEN {lon} - 360 WHEN {lon} < -180 THEN {lon} + 360 ELSE {lon} END)"
    return wrapped, f"({side} * degrees({chi} + {series}))"


_ZONE = """CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32
    WHEN lat BETWEEN 72 AND 84 AND lon >= 0 AND lon < 9 THEN 31 WHEN lat BETWEEN 72 AND 84 AND lon >= 9 AND lon < 21 THEN 33
    WHEN lat BETWEEN 72 AND 84 AND lon >= 21 AND lon < 33 THEN 35 WHEN lat BETWEEN 72 AND 84 AND lon >= 33 AND lon < 42 THEN 37
    ELSE CAST(floor((lon + 180) / 6) AS INT) % 60 + 1 END"""
_SYSTEM = f"""CAST(CASE WHEN lat < -65 THEN 3031 WHEN lat > 65 THEN 3413 WHEN lat >= 0 THEN 32600 + {_ZONE}
    ELSE 32700 + {_ZONE} END AS INT)"""

x, y = polar_xy("lon", "lat", 3413)
add("project_3413", "points", f"SELECT point_id, round({x}, 2) AS x, round({y}, 2) AS y FROM points")
x, y = polar_xy("lon", "lat", 3031)
add("project_3031", "south_points", f"SELECT point_id, round({x}, 2) AS x, round({y}, 2) AS y FROM south_points")
lon, lat = polar_lonlat("px", "py", 3413)
add(
    "unproject_3413",
    "polylines",
    f"""SELECT profile_id, seq, round({lon}, 6) AS lon, round({lat}, 6) AS lat
        FROM (SELECT profile_id, seq, x * 300 - 900000 AS px, y * -310 - 300000 AS py FROM polylines)""",
)
add("working_system", "utm_points", f"SELECT point_id, {_SYSTEM} AS epsg FROM utm_points")
_Q = repr(_ECC)
_K = repr(_UTM_SCALE * _RECTIFYING)
_xi = "xi0 + " + " + ".join(f"({a!r}) * sin({2 * j} * xi0) * cosh({2 * j} * eta0)" for j, a in enumerate(_TO_RECTIFYING, start=1))
_eta = "eta0 + " + " + ".join(f"({a!r}) * cos({2 * j} * xi0) * sinh({2 * j} * eta0)" for j, a in enumerate(_TO_RECTIFYING, start=1))
_NX, _NY = polar_xy("lon", "lat", 3413)
_SX, _SY = polar_xy("lon", "lat", 3031)
# UTM goes as far as 84 degrees; the working systems are polar from 65 on.
for key, system in (("project_utm", _SYSTEM.replace("65", "84")), ("project_mixed", _SYSTEM)):
    add(
        key,
        "utm_points",
        f"""SELECT point_id, epsg, round(CASE epsg WHEN 3413 THEN {_NX} WHEN 3031 THEN {_SX} ELSE 500000 + {_K} * ({_eta}) END, 2) AS x,
            round(CASE epsg WHEN 3413 THEN {_NY} WHEN 3031 THEN {_SY}
                  ELSE CASE WHEN epsg > 32700 THEN 10000000 ELSE 0 END + {_K} * ({_xi}) END, 2) AS y FROM c""",
        f"""a AS (SELECT point_id, {system} AS epsg, sin(radians(lat)) AS s, lon, lat FROM utm_points),
            b AS (SELECT point_id, epsg, lon, lat, sinh(atanh(s) - {_Q} * atanh({_Q} * s)) AS t, radians(lon - (6 * (epsg % 100) - 183)) AS dl FROM a),
            c AS (SELECT point_id, epsg, lon, lat, atan2(t, cos(dl)) AS xi0, CASE WHEN epsg > 32000 THEN atanh(sin(dl) / sqrt(1 + t * t)) ELSE 0 END AS eta0 FROM b)""",
    )
_xi0 = "xi - (" + " + ".join(f"({b!r}) * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(_FROM_RECTIFYING, start=1)) + ")"
_eta0 = "eta - (" + " + ".join(f"({b!r}) * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(_FROM_RECTIFYING, start=1)) + ")"
_lat = "chi + " + " + ".join(f"({d!r}) * sin({2 * j} * chi)" for j, d in enumerate(_TO_GEODETIC, start=1))
add(
    "unproject_utm",
    "polylines",
    f"""SELECT profile_id, seq, epsg, round(6 * (epsg % 100) - 183 + degrees(atan2(sinh(eta0), cos(xi0))), 6) AS lon,
        round(degrees({_lat}), 6) AS lat FROM c""",
    f"""a AS (SELECT profile_id, seq, CAST(CASE WHEN seq % 2 = 0 THEN 32600 ELSE 32700 END + seq % 60 + 1 AS INT) AS epsg,
          (y * 700 + 1000000 - CASE WHEN seq % 2 = 0 THEN 0 ELSE 10000000 END) / {_K} AS xi,
          (x * 50 + 300000 - 500000) / {_K} AS eta FROM polylines),
        b AS (SELECT profile_id, seq, epsg, {_xi0} AS xi0, {_eta0} AS eta0 FROM a),
        c AS (SELECT *, asin(sin(xi0) / cosh(eta0)) AS chi FROM b)""",
)

# ---- where points lie ----------------------------------------------------------------------------------------------
_FIRST = """located AS (SELECT point_id, any_value(lon) AS lon, any_value(lat) AS lat, min(cube_id) AS cube_id FROM points JOIN cubes
    ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy GROUP BY point_id)"""
add("locate_points", "points cubes", "SELECT point_id, cube_id, epsg, zarr_url FROM located JOIN cubes USING (cube_id)", _FIRST)
add(
    "missing_points",
    "points cubes",
    "SELECT point_id FROM points WHERE point_id NOT IN (SELECT point_id FROM located)",
    _FIRST,
)
add(
    "find_cubes",
    "cubes rois",
    """SELECT roi_id, cube_id, zarr_url FROM cubes JOIN rois
       ON minx <= roi_maxx AND maxx >= roi_minx AND miny <= roi_maxy AND maxy >= roi_miny""",
)
_PX, _PY = polar_xy("lon", "lat", 3413)
# Brute force over all cell indices of an axis; the larger coordinate wins a tie.
_SNAPPED = (
    _FIRST
    + f""", placed AS (SELECT point_id, lon, lat, cube_id, composite_zarr_url, x0, y0, dx, dy, {_PX} AS px, {_PY} AS py FROM located JOIN cubes USING (cube_id)),
    sx AS (SELECT point_id, arg_min(i, struct_pack(d := abs(x0 + i * dx - px), n := -(x0 + i * dx))) AS ix
           FROM placed, (SELECT CAST(r AS INT) AS i FROM range(5) t(r)) GROUP BY point_id),
    sy AS (SELECT point_id, arg_min(i, struct_pack(d := abs(y0 + i * dy - py), n := -(y0 + i * dy))) AS iy
           FROM placed, (SELECT CAST(r AS INT) AS i FROM range(8) t(r)) GROUP BY point_id),
    snapped AS (SELECT *, x0 + ix * dx AS x, y0 + iy * dy AS y FROM placed JOIN sx USING (point_id) JOIN sy USING (point_id)),
    cells AS (SELECT *, sqrt(pow(x - px, 2) + pow(y - py, 2)) AS offset_m FROM snapped)"""
)
lon, lat = polar_lonlat("x", "y", 3413)
add(
    "snapped_points",
    "points cubes",
    f"""SELECT point_id, cube_id, ix, iy, round(x, 2) AS x, round(y, 2) AS y, round(offset_m, 2) AS offset_m,
        round({lon}, 6) AS returned_lon, round({lat}, 6) AS returned_lat FROM cells""",
    _SNAPPED,
)
add(
    "nearest_cell",
    "probes",
    """SELECT probe_id, ix, iy, 240e0 * ix AS x, 0e0 - 240e0 * iy AS y,
       round(sqrt(pow(240e0 * ix - px, 2) + pow(-240e0 * iy - py, 2)), 4) AS offset_m FROM probes JOIN a USING (probe_id) JOIN b USING (probe_id)""",
    """a AS (SELECT probe_id, arg_min(CAST(i AS INT), struct_pack(d := abs(240e0 * i - px), n := -i)) AS ix
         FROM probes, range(50) t(i) GROUP BY probe_id),
       b AS (SELECT probe_id, arg_min(CAST(i AS INT), struct_pack(d := abs(-240e0 * i - py), n := i)) AS iy
         FROM probes, (SELECT DISTINCT CAST(floor(p_partkey / 50) AS INT) AS i FROM part) GROUP BY probe_id)""",
)
_AXIS = ", ".join(f"({a!r}::DOUBLE)" for a in IRREGULAR_AXIS)
add(
    "nearest_irregular",
    "points",
    f"""SELECT point_id, arg_min(a, struct_pack(d := abs(a - lon), n := -a)) AS axis_lon FROM points, (VALUES {_AXIS}) t(a)
        GROUP BY point_id""",
)
add(
    "asof_axes",
    "axis_probes axis_lines",
    """SELECT p.probe_id, p.cube_id, p.wanted, best.axis_value, best.line_id FROM axis_probes p LEFT JOIN (
         SELECT probe_id, arg_min(struct_pack(axis_value := axis_value, line_id := line_id),
                struct_pack(d := abs(axis_value - wanted), n := -axis_value, i := line_id)) AS best
         FROM axis_probes JOIN axis_lines USING (cube_id) WHERE wanted IS NOT NULL GROUP BY probe_id) b USING (probe_id)""",
)
add(
    "asof_backward",
    "axis_probes axis_lines",
    """SELECT p.probe_id, p.cube_id, p.wanted,
         (SELECT max(axis_value) FROM axis_lines a WHERE a.cube_id = p.cube_id AND axis_value <= p.wanted AND axis_value >= p.wanted - 2) AS axis_value FROM axis_probes p""",
)
_MLON, _MLAT = polar_lonlat("mx", "my", 3413)
_STRICT = "BY_LON > minx AND BY_LON < maxx AND BY_LAT > miny AND BY_LAT < maxy"
_TWO_STEP = f"""a AS (SELECT point_id, lon, lat, {_PX} AS px, {_PY} AS py, (SELECT min(cube_id) FROM cubes WHERE
          {_STRICT.replace('BY_', '')}) AS c1 FROM points),
        b AS (SELECT a.*, xmin, xmax, ymin, ymax, px > xmin AND px < xmax AND py > ymin AND py < ymax AS s1
          FROM a LEFT JOIN cubes ON c1 = cube_id),
        c AS (SELECT *, CASE WHEN py < ymin THEN py - 10000 WHEN py > ymax THEN py + 10000 ELSE py END AS my,
          CASE WHEN py < ymin OR py > ymax THEN px WHEN px < xmin THEN px - 10000 WHEN px > xmax THEN px + 10000 ELSE px END AS mx FROM b),
        d AS (SELECT c.point_id, c.c1, c.s1, c.px, c.py, CASE WHEN NOT s1 THEN {_MLON} END AS mlon, CASE WHEN NOT s1 THEN {_MLAT} END AS mlat FROM c),
        d2 AS (SELECT d.*, (SELECT min(cube_id) FROM cubes WHERE {_STRICT.replace('BY_LON', 'mlon').replace('BY_LAT', 'mlat')}) AS c2 FROM d),
        e AS (SELECT d2.*, px > xmin AND px < xmax AND py > ymin AND py < ymax AS s2 FROM d2 LEFT JOIN cubes ON c2 = cube_id)"""
add(
    "legacy_locate",
    "points cubes",
    """SELECT point_id, CASE WHEN s1 THEN c1 WHEN s2 THEN c2 END AS cube_id,
       CASE WHEN s1 OR c2 IS NOT NULL THEN round(px, 2) END AS x, CASE WHEN s1 OR c2 IS NOT NULL THEN round(py, 2) END AS y,
       CASE WHEN c1 IS NULL THEN 'no_cube' WHEN s1 THEN 'direct' WHEN c2 IS NULL THEN 'no_cube_after_offset'
            WHEN s2 THEN 'offset' ELSE 'not_in_box_after_offset' END AS status FROM e""",
    _TWO_STEP,
)
_CELL_OF = """near AS (SELECT point_id, cube_id,
    CAST(least(greatest(floor((px - x0) / dx + 0.5), 0), 4) AS INT) AS ix,
    CAST(least(greatest(ceil((py - y0) / dy - 0.5), 0), 7) AS INT) AS iy
    FROM (SELECT point_id, px, py, CASE WHEN s1 THEN c1 WHEN s2 THEN c2 END AS cube_id FROM e) JOIN cubes USING (cube_id))"""
add(
    "legacy_series",
    "points cubes observations",
    """SELECT n.point_id, n.cube_id, n.ix, n.iy, mid_date, v FROM near n
       JOIN observations o ON o.cube_id = n.cube_id AND o.ix = n.ix AND o.iy = n.iy""",
    _TWO_STEP + ", " + _CELL_OF,
)

# ---- series --------------------------------------------------------------------------------------------------------
add(
    "point_series",
    "points cubes observations",
    """SELECT c.point_id, c.cube_id, c.ix, c.iy, x, y, mid_date, o.v, o.v_error, satellite_img1
       FROM cells c JOIN observations o ON o.cube_id = c.cube_id AND o.ix = c.ix AND o.iy = c.iy""",
    _SNAPPED,
)
add(
    "series_found",
    "points cubes observations",
    """SELECT count(DISTINCT c.point_id) AS points_found
       FROM cells c JOIN observations o ON o.cube_id = c.cube_id AND o.ix = c.ix AND o.iy = c.iy""",
    _SNAPPED,
)
add(
    "annual_series",
    "points cubes observations",
    """SELECT c.point_id, c.cube_id, a.year, round(a.v, 4) AS v, round(a.v_error, 4) AS v_error, a.count, round(s.v0, 4) AS v0, s.count0
       FROM cells c JOIN annual a ON a.cube_id = c.cube_id AND a.ix = c.ix AND a.iy = c.iy
       JOIN still s ON s.cube_id = c.cube_id AND s.ix = c.ix AND s.iy = c.iy WHERE c.composite_zarr_url <> ''""",
    _SNAPPED
    + """, annual AS (SELECT cube_id, ix, iy, CAST(year(mid_date) AS INT) AS year, avg(v) AS v, max(v_error) AS v_error, count(*) AS count
           FROM observations GROUP BY ALL),
    still AS (SELECT cube_id, ix, iy, avg(v) AS v0, count(*) AS count0 FROM observations GROUP BY ALL)""",
)
add(
    "export_from_points",
    "points cubes observations",
    """SELECT mid_date, round(c.lon, 4) AS lon, round(c.lat, 4) AS lat, o.v AS "v [m/yr]", o.v_error AS "v_error [m/yr]",
       o.vx AS "vx [m/yr]", o.vx_error AS "vx_error [m/yr]", o.vy AS "vy [m/yr]", o.vy_error AS "vy_error [m/yr]",
       CAST(floor(date_dt_days) AS INT) AS "date_dt [days]", mission_img1 AS mission, satellite_img1 AS satellite, k.epsg
       FROM cells c JOIN observations o ON o.cube_id = c.cube_id AND o.ix = c.ix AND o.iy = c.iy
       JOIN cubes k ON k.cube_id = c.cube_id
       WHERE o.v IS NOT NULL AND o.vx IS NOT NULL AND o.vy IS NOT NULL AND o.v_error IS NOT NULL AND o.vx_error IS NOT NULL
         AND o.vy_error IS NOT NULL AND date_dt_days IS NOT NULL AND mission_img1 IS NOT NULL AND satellite_img1 IS NOT NULL""",
    _SNAPPED,
)
# Points are rounded before they are looked up.
_GIVEN = ", points AS (SELECT * REPLACE (round(lon, 4) AS lon, round(lat, 4) AS lat) FROM given), cubes AS ("
ORACLES["export_from_points"] = (
    ORACLES["export_from_points"].replace("WITH points AS (", "WITH given AS (", 1).replace(", cubes AS (", _GIVEN, 1)
)
_LABELLED = "labelled AS (SELECT *, -50 + point_id / 7 AS lon, 60 + point_id / 90 AS lat, 3413 AS epsg FROM observations)"
add(
    "export_rows",
    "observations",
    """SELECT mid_date, round(lon, 4) AS lon, round(lat, 4) AS lat, v AS "v [m/yr]", v_error AS "v_error [m/yr]",
       vx AS "vx [m/yr]", vx_error AS "vx_error [m/yr]", vy AS "vy [m/yr]",
       vy_error AS "vy_error [m/yr]", CAST(floor(date_dt_days) AS INT) AS "date_dt [days]", mission_img1 AS mission,
       satellite_img1 AS satellite, epsg FROM labelled
       WHERE v IS NOT NULL AND vx IS NOT NULL AND vy IS NOT NULL AND v_error IS NOT NULL""",
    _LABELLED,
)
add(
    "export_clustered",
    "observations",
    """SELECT round(lon, 4) AS lon, round(lat, 4) AS lat, count(*) AS rows, min(mid_date) AS first, max(mid_date) AS last, round(sum(v), 4) AS total_v
       FROM labelled WHERE v IS NOT NULL AND vx IS NOT NULL AND vy IS NOT NULL AND v_error IS NOT NULL GROUP BY ALL""",
    _LABELLED,
)
add(
    "export_extra_variable",
    "observations",
    """SELECT mid_date, round(lat, 4) AS lat, round(lon, 4) AS lon, v AS "v [m/yr]",
       CAST(floor(date_dt_days) AS INT) AS "date_dt [days]", satellite_img1 AS satellite FROM labelled
       WHERE v IS NOT NULL AND vx IS NOT NULL AND vy IS NOT NULL AND l_partkey % 3 <> 0""",
    _LABELLED,
)
_DESCRIBED = (
    ("v", "Ice velocity magnitude [m/yr]", "Velocity (m/yr)"),
    ("v_error", "Ice velocity magnitude error [m/yr]", "Velocity Error (m/yr)"),
    ("vx", "Ice velocity x-component [m/yr]", "Vx (m/yr)"),
    ("vx_error", "Ice velocity x-component error [m/yr]", "Vx Error (m/yr)"),
    ("vy", "Ice velocity y-component [m/yr]", "Vy (m/yr)"),
    ("vy_error", "Ice velocity y-component error [m/yr]", "Vy Error (m/yr)"),
    ("satellite_img1", "Satellite name for image 1", "satellite_img1"),
    ("mission_img1", "Mission name for image 1", "mission_img1"),
)
add(
    "variable_counts",
    "observations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS variable, count({n}) AS valid_values, '{d}' AS description, '{lb}' AS label FROM observations"
        for n, d, lb in _DESCRIBED
    ),
)

# ---- calendar ------------------------------------------------------------------------------------------------------
_SINGLE = """single AS (SELECT point_id, mid_date, v FROM (SELECT *, row_number() OVER (PARTITION BY point_id, mid_date
    ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM observations) WHERE rn = 1)"""
add("first_per_timestamp", "observations", "SELECT point_id, mid_date, v FROM single", _SINGLE)

_LABEL = {
    "m": "last_day(CAST(mid_date AS DATE))",
    "w": "CAST(date_trunc('week', mid_date) AS DATE) + 6",
    "d": "CAST(mid_date AS DATE)",
}
_SPINE = {
    "m": "last_day(CAST(s AS DATE)) FROM ends, unnest(generate_series(date_trunc('month', lo), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) u(s)",
    "w": "CAST(s AS DATE) FROM ends, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) u(s)",
    "d": "CAST(s AS DATE) FROM ends, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) u(s)",
}


def calendar(op: str, freq: str) -> str:
    return (
        _SINGLE
        + f""", reduced AS (SELECT point_id, {_LABEL[freq]} AS period, {op}(v) AS value FROM single GROUP BY 1, 2),
        ends AS (SELECT point_id, min(period) AS lo, max(period) AS hi FROM reduced GROUP BY 1),
        spine AS (SELECT point_id, {_SPINE[freq].replace(' FROM ends', ' AS period FROM ends')}),
        plain AS (SELECT point_id, period, value FROM spine LEFT JOIN reduced USING (point_id, period)),
        filled AS (SELECT point_id, period, last_value(value IGNORE NULLS) OVER (PARTITION BY point_id ORDER BY period
            ROWS UNBOUNDED PRECEDING) AS value FROM plain)"""
    )


for key, op, freq, source in (
    ("monthly_max_ffill", "max", "m", "filled"),
    ("resample_mean_m", "avg", "m", "plain"),
    ("resample_median_m", "median", "m", "plain"),
    ("resample_average_w", "avg", "w", "plain"),
    ("resample_min_w_ffill", "min", "w", "filled"),
    ("resample_max_d", "max", "d", "plain"),
):
    add(key, "observations", f"SELECT point_id, period, round(value, 4) AS value FROM {source}", calendar(op, freq))
add(
    "series_stats",
    "observations",
    """SELECT point_id, round(avg(value), 4) AS mean, round(max(value), 4) AS max, count(value) AS n FROM filled
       WHERE value IS NOT NULL GROUP BY point_id""",
    calendar("max", "m"),
)
_SHORT = "CASE satellite_img1 WHEN '1' THEN 'S1' WHEN '2' THEN 'S2' ELSE concat('L', satellite_img1) END"
add(
    "satellite_counts",
    "observations",
    f"SELECT point_id, satellite_img1, count(*) AS observations, {_SHORT} AS label FROM observations GROUP BY point_id, satellite_img1",
)
_LONG = "concat(CASE WHEN satellite_img1 IN ('1', '2') THEN 'Sentinel ' ELSE 'Landsat ' END, satellite_img1)"
add(
    "satellites",
    "observations",
    f"""SELECT DISTINCT satellite_img1 AS satellite, {_SHORT} AS short_label, {_LONG} AS long_label, satellite_img1 AS from_text,
        satellite_img1 AS from_number FROM observations""",
)
add(
    "series_max",
    "observations",
    """SELECT point_id, v AS max_value, mid_date AS max_date FROM (SELECT *, row_number() OVER (PARTITION BY point_id
       ORDER BY v DESC, mid_date) AS rn FROM observations WHERE v > 0) WHERE rn = 1""",
)


def running(low: int, high: int, days: int, least: int) -> tuple[str, str]:
    half = days // 2
    ctes = f"""obs AS (SELECT point_id, mid_date, v FROM observations WHERE date_dt_days BETWEEN {low} AND {high}),
    ends AS (SELECT point_id, min(mid_date) AS t0, max(mid_date) AS t1 FROM obs GROUP BY 1),
    bins AS (SELECT point_id, t0, CAST(b AS BIGINT) AS bin, t0 + to_days(CAST(b * {days} AS INT)) AS lo, t0 + to_days(CAST((b + 1) * {days} AS INT)) AS hi
        FROM ends, unnest(range(CAST(floor((epoch_us(t1) - epoch_us(t0)) / ({days} * 86400000000)) AS BIGINT))) u(b)),
    joined AS (SELECT b.point_id, bin, any_value(b.lo) AS lo, count(v) AS n, avg(v) AS m, avg(epoch_us(mid_date) - epoch_us(b.lo)) AS off
        FROM bins b LEFT JOIN obs o ON o.point_id = b.point_id AND o.v IS NOT NULL
        AND o.mid_date >= b.lo - to_days({half}) AND o.mid_date < b.hi + to_days({half}) GROUP BY b.point_id, bin)"""
    body = f"""SELECT point_id, bin, CASE WHEN n >= {least} THEN make_timestamp(epoch_us(lo) + CAST(floor(off) AS BIGINT)) ELSE lo END AS time,
        CASE WHEN n >= {least} THEN round(m, 4) END AS value FROM joined"""
    return body, ctes


for key, args in (("running_mean", (5, 90, 30, 5)), ("running_mean_wide", (5, 365, 30, 5)), ("running_mean_odd", (5, 545, 7, 2))):
    body, ctes = running(*args)
    add(key, "observations", body, ctes)

# ---- products ------------------------------------------------------------------------------------------------------


def decimal_year(t: str) -> str:
    return (
        f"(year({t}) + date_diff('day', make_date(year({t}), 1, 1), CAST({t} AS DATE))::DOUBLE "
        f"/ date_diff('day', make_date(year({t}), 1, 1), make_date(year({t}) + 1, 1, 1)))"
    )


add("decimal_year", "", f"SELECT event_id, {decimal_year('ts')} AS decimal_year FROM events")
add(
    "day_forms",
    "",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(d) AS INT) AS whole_days, CAST(round_even(floor(d) + 0.5, 0) AS INT) AS half_even,
       round(d, 6) AS days FROM (SELECT *, l_extendedprice / 97 AS d FROM lineitem)""",
)
_DATED = """dated AS (SELECT *, CAST(mid_date AS DATE) - CAST(floor(date_dt_days / 2) AS INT) AS t1,
    CAST(mid_date AS DATE) + (CAST(floor(date_dt_days) AS INT) - CAST(floor(date_dt_days / 2) AS INT)) AS t2 FROM observations)"""
add(
    "interval_segments",
    "observations",
    """SELECT point_id, CAST(date_dt_days AS INT) AS days, v, t1, t2, round((date_dt_days - 5) / 85, 6) AS shade
       FROM dated WHERE v IS NOT NULL AND date_dt_days BETWEEN 5 AND 90""",
    _DATED,
)
add(
    "series_by_location",
    "observations",
    """SELECT point_id, mid_date, v AS value, concat('Lat: ', CAST(round(60 + point_id / 64, 4) AS VARCHAR), ', Lon: ',
       CAST(round(-50 + point_id / 8, 4) AS VARCHAR)) AS label FROM observations WHERE date_dt_days BETWEEN 5 AND 90""",
)
add(
    "series_by_sensor",
    "observations",
    f"""SELECT point_id, mid_date, v AS value, satellite_img1 AS satellite, {_LONG} AS label FROM observations
        WHERE date_dt_days BETWEEN 5 AND 90""",
)
add("one_sensor", "observations", "SELECT point_id, mid_date, v FROM observations WHERE satellite_img1 = '8'")
add(
    "value_scale",
    "observations",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN v > 1400 THEN 1e0 WHEN v < 0 THEN 0e0 ELSE round(v / 1400, 6) END AS linear,
       CASE WHEN v > 1400 THEN 1e0 WHEN v < 1 THEN 0e0 ELSE round(log10(v) / log10(1400), 6) END AS logarithmic FROM observations""",
)


def lines(view: str) -> str:
    return f"""legs AS (SELECT profile_id, seq, x, y, lead(x) OVER w - x AS sx, lead(y) OVER w - y AS sy FROM {view}
        WINDOW w AS (PARTITION BY profile_id ORDER BY seq)),
    sized AS (SELECT *, sqrt(sx * sx + sy * sy) AS len FROM legs WHERE sx IS NOT NULL),
    walked AS (SELECT *, sum(len) OVER (PARTITION BY profile_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS c1,
        sum(len) OVER (PARTITION BY profile_id) AS total FROM sized),
    spans AS (SELECT *, coalesce(lag(c1) OVER (PARTITION BY profile_id ORDER BY seq), 0) AS c0 FROM walked)"""


def samples(view: str, step: float) -> str:
    d = f"{step!r}e0"
    # Sample k lies on the leg whose range of distances (c0, c1] holds k·d; sample 0 is the first vertex.
    return (
        lines(view)
        + f""", samples AS (SELECT profile_id, CAST(k AS INT) AS k, k * {d} AS distance, x + (k * {d} - c0) / len * sx AS x,
        y + (k * {d} - c0) / len * sy AS y, CAST(floor(total / {d}) + 1 AS INT) AS n_points
        FROM spans, unnest(range(CAST(floor(c0 / {d}) AS BIGINT), CAST(floor(c1 / {d}) AS BIGINT) + 1)) u(k)
        WHERE len > 0 AND (k * {d} > c0 OR (k = 0 AND c0 = 0)) AND k * {d} <= c1)"""
    )


add(
    "profile_points",
    "polylines",
    "SELECT profile_id, k, distance, round(x, 4) AS x, round(y, 4) AS y, n_points FROM samples",
    samples("polylines", 1000e0),
)
add(
    "profile_sizes",
    "polylines",
    "SELECT profile_id, count(*) AS n_segments, CAST(floor(max(total) / 1000) + 1 AS INT) AS n_points FROM spans GROUP BY profile_id",
    lines("polylines"),
)
add(
    "profile_centre",
    "utm_points",
    f"SELECT profile_id, round(lon, 6) AS mean_lon, round(lat, 6) AS mean_lat, {_SYSTEM} AS epsg FROM means",
    """means AS (SELECT CAST(floor(point_id / 4) AS BIGINT) AS profile_id, avg(lon / 3) AS lon, avg(lat / 2) AS lat FROM utm_points GROUP BY 1)""",
)
_EDGES = """edged AS (SELECT *, CASE WHEN k = 0 THEN distance ELSE distance - HALF END AS x_start,
    CASE WHEN k > 0 AND k = n_points - 1 THEN distance ELSE distance + HALF END AS x_stop FROM samples)"""
add(
    "profile_edges",
    "polylines",
    "SELECT profile_id, k, n_points, x_start, x_stop FROM edged",
    samples("polylines", 2500e0) + ", " + _EDGES.replace("HALF", "1250e0"),
)
lon, lat = polar_lonlat("x", "y", 3413)
_SAMPLE_CELLS = _SNAPPED.replace("FROM points JOIN", "FROM wanted JOIN")
add(
    "profile_patches",
    "profiles cubes observations",
    f"""SELECT c.point_id.profile_id AS profile_id, c.point_id.k AS k, c.point_id.x_start AS x_start, c.point_id.x_stop AS x_stop,
        {decimal_year('t1')} AS start_year, {decimal_year('t2')} AS stop_year, CAST(floor(date_dt_days) AS INT) AS days,
        v, least(v, 1400) AS shade_value
        FROM cells c JOIN dated o ON o.cube_id = c.cube_id AND o.ix = c.ix AND o.iy = c.iy WHERE v IS NOT NULL""",
    samples("profiles", PROFILE_INTERVAL)
    + ", "
    + _EDGES.replace("HALF", repr(PROFILE_INTERVAL / 2))
    + f""", wanted AS (SELECT struct_pack(profile_id, k, x_start, x_stop) AS point_id, {lon} AS lon, {lat} AS lat FROM edged), """
    + _DATED
    + ", "
    + _SAMPLE_CELLS,
)

# ---- cut-outs ------------------------------------------------------------------------------------------------------
_NEAR = "near AS (SELECT probe_id, ix, iy, x, y, v FROM grid JOIN probes ON abs(x - px) < 1000 AND abs(y - py) < 1000)"
add("subcube_point", "grid probes", "SELECT probe_id, ix, iy, x, y, v FROM near", _NEAR)
add(
    "subcube_geotransform",
    "grid probes",
    "SELECT probe_id, min(x) - 120 AS ul_x, max(y) + 120 AS ul_y, count(*) AS cells FROM near GROUP BY probe_id",
    _NEAR,
)
_CLON, _CLAT = polar_lonlat("cx", "cy", 3413)
_PASS2 = _STRICT.replace("BY_LON", "mlon").replace("BY_LAT", "mlat")
add(
    "subcube_bbox",
    "cubes observations",
    """SELECT box_id, cube_id, x0 + ix * dx AS x, y0 + iy * dy AS y, mid_date, v FROM observations JOIN cubes USING (cube_id)
       JOIN held USING (cube_id) WHERE x0 + ix * dx BETWEEN held.cx - 120000 AND held.cx + 120000
       AND y0 + iy * dy BETWEEN held.cy - 130000 AND held.cy + 130000""",
    f"""z AS (SELECT s_suppkey AS box_id, -1500000 + (s_suppkey * 137 % 2500) * 1000e0 AS cx, -3200000 + (s_suppkey * 211 % 2600) * 1000e0 AS cy FROM supplier),
        y1 AS (SELECT *, {_CLON} AS lon, {_CLAT} AS lat FROM z),
        a AS (SELECT *, (SELECT min(cube_id) FROM cubes WHERE {_STRICT.replace('BY_', '')}) AS c1 FROM y1),
        b AS (SELECT a.*, xmin, xmax, ymin, ymax, cx > xmin AND cx < xmax AND cy > ymin AND cy < ymax AS s1 FROM a JOIN cubes ON c1 = cube_id),
        c AS (SELECT *,
          CASE WHEN cy < ymin THEN cy - 10000 WHEN cy > ymax THEN cy + 10000 WHEN cx < xmin OR cx > xmax THEN cy
               WHEN cy = ymin THEN cy + 1 WHEN cy = ymax THEN cy - 1 ELSE cy END AS my,
          CASE WHEN cy < ymin OR cy > ymax THEN cx WHEN cx < xmin THEN cx - 10000 WHEN cx > xmax THEN cx + 10000
               WHEN cy = ymin OR cy = ymax THEN cx WHEN cx = xmin THEN cx + 1 WHEN cx = xmax THEN cx - 1 ELSE cx END AS mx FROM b),
        d AS (SELECT box_id, cx, cy, c1, s1, {_MLON} AS mlon, {_MLAT} AS mlat FROM c),
        d2 AS (SELECT d.*, (SELECT min(cube_id) FROM cubes WHERE {_PASS2}) AS c2 FROM d),
        e AS (SELECT d2.*, cx > xmin AND cx < xmax AND cy > ymin AND cy < ymax AS s2 FROM d2 LEFT JOIN cubes ON c2 = cube_id),
        held AS (SELECT box_id, cx, cy, CASE WHEN s1 THEN c1 WHEN s2 THEN c2 END AS cube_id FROM e WHERE s1 OR s2)""",
)
_EX, _EY = polar_xy("lon", "lat", 3031)
_gx, _gy, _gdx, _gdy = (f"{v!r}e0" for v in ELEVATION_GRID[:4])
_gnx, _gny = ELEVATION_GRID[4:]
add(
    "elevation_series",
    "south_points elevation",
    f"""SELECT point_id, {_gx} + ix * {_gdx} AS x, {_gy} + iy * ({_gdy}) AS y, time, round(dh, 6) AS dh
        FROM snapped JOIN elevation USING (ix, iy) WHERE dh IS NOT NULL""",
    f"""placed AS (SELECT point_id, {_EX} AS px, {_EY} AS py FROM south_points WHERE lat < -60),
        sx AS (SELECT point_id, arg_min(CAST(i AS INT), struct_pack(d := abs({_gx} + i * {_gdx} - px), n := -i)) AS ix FROM placed, range({_gnx}) t(i) GROUP BY 1),
        sy AS (SELECT point_id, arg_min(CAST(i AS INT), struct_pack(d := abs({_gy} + i * ({_gdy}) - py), n := i)) AS iy FROM placed, range({_gny}) t(i) GROUP BY 1),
        snapped AS (SELECT * FROM sx JOIN sy USING (point_id))""",
)
add(
    "chunk_flatten",
    "",
    """SELECT vec_id, CAST(vec_id * 4 + floor(i / floor(n / 4)) % 4 AS BIGINT) AS iy, CAST(i % CAST(floor(n / 4) AS BIGINT) AS BIGINT) AS ix,
       round(CAST(embedding[i + 1] AS DOUBLE), 6) AS v FROM (SELECT vec_id, embedding, len(embedding) AS n FROM embeddings), unnest(range(n)) u(i)""",
)

add(
    "series_from_chunks",
    "value_chunks chunk_points",
    """SELECT point_id, cube_id, ix, iy, CAST(it AS INT) AS it, round(CAST(values[it * 16 + (iy % 4) * 4 + ix % 4 + 1] AS DOUBLE), 6) AS v
       FROM chunk_points p JOIN value_chunks k USING (cube_id), unnest(range(len(values) // 16)) t(it)
       WHERE k.cy = p.iy // 4 AND k.cx = p.ix // 4""",
)
_BOXED = (
    _NEAR
    + """, kept AS (SELECT probe_id, ix, iy, v FROM near WHERE (ix + iy) % 7 <> 0),
        box AS (SELECT probe_id, min(iy) AS y0, max(iy) AS y1, min(ix) AS x0, max(ix) AS x1 FROM kept GROUP BY probe_id),
        full_box AS (SELECT probe_id, y0, x0, y1, x1, iy, ix, (iy - y0) // 3 AS c_iy, (ix - x0) // 4 AS c_ix FROM box,
          unnest(range(y0, y1 + 1)) a(iy), unnest(range(x0, x1 + 1)) b(ix)),
        elements AS (SELECT f.*, k.v FROM full_box f LEFT JOIN kept k USING (probe_id, iy, ix))"""
)
add(
    "subcube_dense",
    "grid probes",
    """SELECT probe_id, CAST(c_iy AS BIGINT) AS c_iy, CAST(c_ix AS BIGINT) AS c_ix, CAST(min(iy) AS BIGINT) AS iy_start, CAST(min(ix) AS BIGINT) AS ix_start,
       CAST(max(iy) - min(iy) + 1 AS INT) AS iy_length, CAST(max(ix) - min(ix) + 1 AS INT) AS ix_length,
       string_agg(coalesce(CAST(CAST(round(v * 100) AS BIGINT) AS VARCHAR), '-'), ' ' ORDER BY iy, ix) AS v,
       array_to_string(list_transform(list_sort(list(DISTINCT iy)), lambda i: CAST(i * -24000 AS VARCHAR)), ' ') AS iy_values,
       array_to_string(list_transform(list_sort(list(DISTINCT ix)), lambda i: CAST(i * 24000 AS VARCHAR)), ' ') AS ix_values
       FROM elements GROUP BY probe_id, c_iy, c_ix HAVING count(v) > 0""",
    _BOXED,
)
add("subcube_round_trip", "grid probes", "SELECT probe_id, CAST(iy AS BIGINT) AS iy, CAST(ix AS BIGINT) AS ix, v FROM kept", _BOXED)

add(
    "saved_searches",
    "granules",
    """SELECT search_id, granule_id FROM (SELECT s_suppkey AS search_id FROM supplier) s JOIN granules g ON CASE search_id % 5
         WHEN 0 THEN percent_valid_pixels >= search_id % 60 AND platform = CASE WHEN search_id % 2 = 0 THEN 'S2A' ELSE 'S2B' END
         WHEN 1 THEN date_dt >= search_id % 500 AND date_dt < search_id % 500 + 30
         WHEN 2 THEN minx > CAST(concat(CAST(-75 + search_id % 40 AS VARCHAR), '.25') AS DOUBLE) AND maxx < -72 + search_id % 40
         WHEN 3 THEN href >= concat('https://example.org/pairs/g', 10 + search_id % 80) AND href < concat('https://example.org/pairs/g', 11 + search_id % 80)
         ELSE percent_valid_pixels <> search_id % 60 AND version <> '002' END
       WHERE search_id % 17 <> 0 AND CASE WHEN search_id % 3 = 0 THEN proj_code = 'EPSG:3413' WHEN search_id % 19 = 0 THEN false ELSE version > '000' END""",
)

add(
    "catalog_integer",
    "granules",
    f"""SELECT granule_id, minx, href, CASE granule_id % 3 WHEN 0 THEN '{int('8001fffffffffff', 16)}' ELSE '{int('8005fffffffffff', 16)}' END AS directory
        FROM granules WHERE granule_id % 3 IN (0, 2)""",
)

add(
    "search_zoned",
    "granules",
    f"""SELECT DISTINCT href FROM granules WHERE {CONVEX} AND percent_valid_pixels >= 40 AND platform IN ('S2A', 'S2B') AND date_dt <= 200
        AND version = '002' AND datetime >= TIMESTAMP '1995-03-01' AND datetime < TIMESTAMP '1998-01-01'""",
)

add(
    "visible_patches",
    "observations",
    """SELECT point_id, DATE '1970-01-01' + CAST(min(d) AS INT) AS first, DATE '1970-01-01' + CAST(max(d) + 1 AS INT) AS after, date_dt_days, l_orderkey, l_linenumber, l_partkey
       FROM (SELECT *, CAST(d AS INT) - CAST(row_number() OVER (PARTITION BY point_id, date_dt_days, l_orderkey, l_linenumber, l_partkey ORDER BY d) AS INT) AS run
             FROM (SELECT point_id, n AS d, date_dt_days, l_orderkey, l_linenumber, l_partkey FROM painted
                   QUALIFY row_number() OVER (PARTITION BY point_id, n ORDER BY date_dt_days, l_orderkey, l_linenumber, l_partkey) = 1))
       GROUP BY point_id, run, date_dt_days, l_orderkey, l_linenumber, l_partkey""",
    """pairs AS (SELECT *, CAST(mid_date AS DATE) - DATE '1970-01-01' AS m, CAST(floor(date_dt_days / 2) AS INT) AS half FROM observations WHERE v IS NOT NULL),
       painted AS (SELECT point_id, date_dt_days, l_orderkey, l_linenumber, l_partkey, unnest(range(m - half, m + CAST(date_dt_days AS INT) - half)) AS n FROM pairs)""",
)

# ---- point files and rings -----------------------------------------------------------------------------------------
_PARSED = """parsed AS (SELECT line_id, TRY_CAST(split_part(value, ',', 1) AS DOUBLE) AS a, TRY_CAST(split_part(value, ',', 2) AS DOUBLE) AS b
    FROM point_lines)"""


def reason(lon: str, lat: str) -> str:
    return (
        f"CASE WHEN {lon} IS NULL THEN 'lon_not_a_number' WHEN {lat} IS NULL THEN 'lat_not_a_number' "
        f"WHEN abs({lon}) > 180 THEN 'lon_out_of_range' WHEN abs({lat}) > 90 THEN 'lat_out_of_range' END"
    )


add("points_csv_quarantine", "point_lines", f"SELECT line_id, a AS lon, b AS lat, {reason('a', 'b')} AS reason FROM parsed", _PARSED)
add("points_latlon", "point_lines", f"SELECT line_id, b AS lon, a AS lat FROM parsed WHERE {reason('b', 'a')} IS NULL", _PARSED)
add(
    "points_wkt",
    "wkt_lines",
    f"SELECT line_id, lon, lat, {reason('lon', 'lat')} AS reason FROM w",
    r"""w AS (SELECT line_id, TRY_CAST(regexp_extract(wkt, 'POINT \((\S+) (\S+)\)', 1) AS DOUBLE) AS lat,
        TRY_CAST(regexp_extract(wkt, 'POINT \((\S+) (\S+)\)', 2) AS DOUBLE) AS lon FROM wkt_lines)""",
)
add(
    "ring_checks",
    "rois",
    """SELECT roi_id, roi_id % 3 <> 0 AS is_simple, round(roi_minx, 6) AS minx, round(roi_maxy, 6) AS maxy, FALSE AS edge_strict,
       FALSE AS far_point FROM rois""",
)
add("ring_texts", "granules", "SELECT granule_id, 4 AS vertices, minx, miny, maxx, maxy FROM granules")
