"""Geometry on WGS84 coordinates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
EDGE_TOLERANCE = 1e-10
# A point counts as on an edge up to 1e-5 degrees beyond it, so boxes are widened by more than that.
BOX_MARGIN_DEG = 1e-4


def number(value: float) -> str:
    """A double literal."""
    return f"{float(value)!r}D"


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in metres."""
    half_lat, half_lon = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    a = f"{half_lat} * {half_lat} + {half_lon} * {half_lon} * cos(radians({lat1})) * cos(radians({lat2}))"
    return f"({number(EARTH_RADIUS_M)} * 2 * atan2(sqrt({a}), sqrt(1 - ({a}))))"


def is_finite(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) < double('Infinity'))"


def box_around(lat: float, lon: float, radius_m: float) -> tuple[float, float, float, float]:
    """(min_lat, max_lat, min_lon, max_lon) holding every point within the radius; whole parallels near a pole or the date line."""
    reach = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
    south, north = lat - reach, lat + reach
    if north >= 90 or south <= -90:
        return south, north, -180.0, 180.0
    sideways = math.degrees(
        math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(lat))))
    ) * (1 + 1e-9)
    west, east = lon - sideways, lon + sideways
    if west < -180 or east > 180:
        return south, north, -180.0, 180.0
    return south, north, west, east


def boundary_box(polygons) -> tuple[float, float, float, float]:
    """(min_lat, max_lat, min_lon, max_lon) of the outer rings, widened by the edge tolerance."""
    points = [p for rings in polygons for p in rings[0]]
    lons, lats = [p[0] for p in points], [p[1] for p in points]
    return (
        min(lats) - BOX_MARGIN_DEG,
        max(lats) + BOX_MARGIN_DEG,
        min(lons) - BOX_MARGIN_DEG,
        max(lons) + BOX_MARGIN_DEG,
    )


def in_box(lat: str, lon: str, box) -> str:
    south, north, west, east = (number(v) for v in box)
    return f"({lat} BETWEEN {south} AND {north} AND {lon} BETWEEN {west} AND {east})"


def on_edge(x: str, y: str, x1: str, y1: str, x2: str, y2: str) -> str:
    cross = f"({y} - {y1}) * ({x2} - {x1}) - ({x} - {x1}) * ({y2} - {y1})"
    dot = f"({x} - {x1}) * ({x} - {x2}) + ({y} - {y1}) * ({y} - {y2})"
    return f"(abs({cross}) <= {number(EDGE_TOLERANCE)} AND {dot} <= {number(EDGE_TOLERANCE)})"


def crosses_edge(x: str, y: str, x1: str, y1: str, x2: str, y2: str) -> str:
    """Whether a ray from (x, y) to the east crosses the edge."""
    at = f"try_divide(({x2} - {x1}) * ({y} - {y1}), {y2} - {y1} + {number(EDGE_TOLERANCE)}) + {x1}"
    return f"((({y1} > {y}) <> ({y2} > {y})) AND coalesce({x} < {at}, false))"


def _in_ring(lat: str, lon: str, ring) -> str:
    """One pass over the ring's edges, the closing edge from the last point to the first included."""
    edges = ",".join(
        "array(" + ",".join(number(v) for v in (*ring[i - 1], *ring[i])) + ")" for i in range(len(ring))
    )
    ends = ("e[0]", "e[1]", "e[2]", "e[3]")
    return (
        f"aggregate(array({edges}), named_struct('touched', false, 'odd', false), (s, e) -> named_struct("
        f"'touched', s.touched OR {on_edge(lon, lat, *ends)}, 'odd', s.odd <> {crosses_edge(lon, lat, *ends)}), "
        "s -> s.touched OR s.odd)"
    )


def in_polygons(lat: str, lon: str, polygons) -> str:
    """Point in any polygon: inside its outer ring and in none of its holes; edges count as inside.

    Meant for a boundary of fixed size: the rings travel as constants inside the plan. A box test of each polygon
    comes first, so the edge scan only runs for points that may lie inside.
    """
    tests = []
    for rings in polygons:
        if not rings:
            continue
        parts = [_in_ring("p.y", "p.x", rings[0])] + [f"NOT {_in_ring('p.y', 'p.x', hole)}" for hole in rings[1:]]
        tests.append(f"CASE WHEN {in_box('p.y', 'p.x', boundary_box([rings]))} THEN {' AND '.join(parts)} ELSE false END")
    found = f"{is_finite('p.y')} AND ({' OR '.join(tests) or 'false'})"
    # The position is bound once, however it is computed.
    return f"transform(array(named_struct('x', {lon}, 'y', {lat})), p -> {found})[0]"


class RadiusGrid:
    """Grid whose 3 x 3 neighbourhood of a point holds everything within the radius, poles and date line included.

    Latitude is cut into bands one radius high. Each band has its own number of longitude cells, wide enough
    for the radius at the band's highest latitude; a band that touches a pole's cap is one cell.
    """

    def __init__(self, radius_m: float):
        self.radius_m = radius_m
        self.reach_deg = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)
        self.band_deg = self.reach_deg + 1e-9

    def _band(self, lat: str) -> str:
        return f"floor(({lat} + 90) / {number(self.band_deg)})"

    def _edges(self, band: str) -> tuple[str, str]:
        return f"({band} * {number(self.band_deg)} - 90)", f"(({band} + 1) * {number(self.band_deg)} - 90)"

    def _columns(self, band: str) -> str:
        """Number of longitude cells of a band."""
        low, high = self._edges(band)
        farthest = f"greatest(abs({low}), abs({high}))"
        ratio = f"{number(math.sin(math.radians(self.reach_deg)))} / cos(radians({farthest}))"
        width = f"(degrees(asin(least(1.0D, {ratio}))) * {number(1 + 1e-9)})"
        return (
            f"CASE WHEN {farthest} + {number(self.reach_deg)} >= 90 THEN 1L "
            f"ELSE greatest(1L, floor(360.0D / {width})) END"
        )

    @staticmethod
    def _turn(lon: str) -> str:
        return f"(pmod({lon} + 180, 360.0D) / 360.0D)"

    def _column(self, lon: str, columns: str) -> str:
        return f"least(floor({self._turn(lon)} * {columns}), {columns} - 1)"

    def with_cell(self, df: DataFrame, lat: str, lon: str, name: str = "cell") -> DataFrame:
        """Add the point's cell."""
        return (
            df.withColumn("_band", F.expr(self._band(lat)))
            .withColumn("_columns", F.expr(self._columns("_band")))
            .withColumn(name, F.expr(f"_band * 4294967296 + {self._column(lon, '_columns')}"))
            .drop("_band", "_columns")
        )

    def with_neighbourhood(self, df: DataFrame, lat: str, lon: str, name: str = "cell") -> DataFrame:
        """Repeat each row for the at most nine distinct cells that can hold a point within the radius."""
        around = f"transform(array(-1, 0, 1), side -> _band * 4294967296 + pmod({self._column(lon, '_columns')} + side, _columns))"
        return (
            df.withColumn("_band", F.expr(f"explode(transform(array(-1, 0, 1), step -> {self._band(lat)} + step))"))
            .withColumn("_columns", F.expr(self._columns("_band")))
            .withColumn(name, F.expr(f"explode(array_distinct({around}))"))
            .drop("_band", "_columns")
        )

    def with_parts(self, df: DataFrame, lat: str, lon: str, splits: dict[str, int]) -> DataFrame:
        """Add, under each name, the index of the point's part when its cell is cut into n x n parts."""
        df = (
            df.withColumn("_band", F.expr(self._band(lat)))
            .withColumn("_columns", F.expr(self._columns("_band")))
            .withColumn("_up", F.expr(f"({lat} + 90) / {number(self.band_deg)} - _band"))
            .withColumn("_right", F.expr(f"{self._turn(lon)} * _columns - {self._column(lon, '_columns')}"))
        )

        def part(fraction, n):
            return f"greatest(0L, least(floor({fraction} * {n}), {n - 1}L))"

        parts = {name: F.expr(f"{part('_up', n)} * {n} + {part('_right', n)}") for name, n in splits.items()}
        return df.withColumns(parts).drop("_band", "_columns", "_up", "_right")

    def part_span_m(self, cell: str, splits: int) -> str:
        """Upper bound for the distance between two points of one part of the cell."""
        band = f"floor({cell} / 4294967296.0D)"
        low, high = self._edges(band)
        nearest = f"CASE WHEN {low} <= 0 AND {high} >= 0 THEN 0.0D ELSE least(abs({low}), abs({high})) END"
        wide = f"360.0D / ({self._columns(band)}) / {splits} * cos(radians({nearest}))"
        metres_per_degree = math.radians(1) * EARTH_RADIUS_M * (1 + 1e-6)
        return f"(({number(self.band_deg / splits)} + {wide}) * {number(metres_per_degree)} + 1e-3D)"


MERCATOR_LIMIT = 85.0511287798066


def mercator_cell(lat: str, lon: str, zoom: int, cell_px: int = 40, tile_px: int = 512) -> tuple[str, str]:
    """(column, row) of the web-mercator grid cell at a zoom level, in a world tile_px * 2^zoom pixels wide."""
    cells = number(tile_px * 2.0**zoom / cell_px)
    # The projection ends at the latitude where the world is a square.
    s = f"sin(radians(greatest(-{MERCATOR_LIMIT}D, least({MERCATOR_LIMIT}D, {lat}))))"
    x = f"(({lon} + 180) / 360)"
    y = f"(0.5D - ln((1 + {s}) / (1 - {s})) / {number(4 * math.pi)})"
    return f"floor({x} * {cells})", f"floor({y} * {cells})"
