"""Geographic Column functions. Coordinates are WGS84 degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_MI = 3958.8
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = 6371000.0
METERS_PER_DEGREE = 111320.0

_RADIUS = {"mi": EARTH_RADIUS_MI, "km": EARTH_RADIUS_KM, "m": EARTH_RADIUS_M}


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def haversine(lat1, lon1, lat2, lon2, unit: str = "m", radius: float | None = None) -> Column:
    """Great-circle distance in miles, kilometres or metres."""
    r = _RADIUS[unit] if radius is None else radius
    if all(isinstance(v, str) for v in (lat1, lon1, lat2, lon2)):
        # one expression text instead of many small calls to the JVM
        s_lat, s_lon = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
        h = f"({s_lat} * {s_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {s_lon} * {s_lon})"
        return F.expr(f"{2.0 * r!r}D * asin(sqrt(case when {h} > 1 then 1D else {h} end))")
    lat1, lon1, lat2, lon2 = map(col, (lat1, lon1, lat2, lon2))
    s_lat = F.sin(F.radians(lat2 - lat1) / 2)
    s_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon
    return F.lit(2 * r) * F.asin(F.sqrt(F.when(h > 1, F.lit(1.0)).otherwise(h)))


def degrees_for(distance: float, unit: str = "m") -> float:
    """Degrees of latitude spanned by a distance."""
    return distance / (_RADIUS[unit] * 3.141592653589793 / 180.0)


def degrees_for_metres(metres, lat) -> tuple[Column, Column]:
    """Padding (latitude degrees, longitude degrees) for a distance in metres at a latitude."""
    m = F.lit(metres) if isinstance(metres, (int, float)) else col(metres)
    return m / METERS_PER_DEGREE, m / (F.lit(METERS_PER_DEGREE) * F.cos(F.radians(col(lat))))


def grid_radius_cells(max_m: float, cell_deg: float, lat) -> Column:
    """Number of grid cells to search around a point so that ``max_m`` metres are covered."""
    narrow = F.least(
        F.lit(cell_deg * METERS_PER_DEGREE),
        F.lit(cell_deg * METERS_PER_DEGREE) * F.cos(F.radians(col(lat))),
    )
    # half the globe is enough anywhere; at the poles the cells have no width
    most = float(-(-180.0 // cell_deg))
    return F.greatest(F.lit(1), (F.least(F.ceil(F.lit(float(max_m)) / F.greatest(narrow, F.lit(1e-9))), F.lit(most)) + 1).cast("int"))


def fixed_cell(lat, lon, size_deg: float) -> Column:
    """Text key ``i:j`` of a fixed-degree grid cell."""
    return F.concat_ws(
        ":",
        F.floor(col(lat) / size_deg).cast("string"),
        F.floor(col(lon) / size_deg).cast("string"),
    )


def mean_lon(lon, weight=1) -> Column:
    """Aggregate: mean longitude of rows close together, also where they lie on both sides of the date line."""
    lon, w = col(lon), F.lit(weight) if isinstance(weight, (int, float)) else col(weight)
    across = F.max(lon) - F.min(lon) > 180

    def mean(value: Column) -> Column:
        return F.avg(value) if isinstance(weight, int) else F.sum(value * w) / F.sum(w)

    turned = mean(F.when(lon < 0, lon + 360).otherwise(lon))
    return F.when(across, F.when(turned > 180, turned - 360).otherwise(turned)).otherwise(mean(lon))


def half_up(value, scale: float) -> Column:
    """Round half toward positive infinity at 1/scale."""
    return F.floor(col(value) * scale + 0.5) / F.lit(float(scale))


def nearest_fraction(px, py, ax, ay, bx, by) -> Column:
    """Position in [0, 1] of the planar projection of p on segment ab (0 for a zero segment)."""
    dx, dy = bx - ax, by - ay
    norm = dx * dx + dy * dy
    t = ((px - ax) * dx + (py - ay) * dy) / F.nullif(norm, F.lit(0.0))
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)), F.lit(0.0))


def segment_distance_degrees(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Metres to a segment; the foot point is found in plain degree space."""
    lat, lon, lat1, lon1, lat2, lon2 = map(col, (lat, lon, lat1, lon1, lat2, lon2))
    t = nearest_fraction(lat, lon, lat1, lon1, lat2, lon2)
    return haversine(lat, lon, lat1 + t * (lat2 - lat1), lon1 + t * (lon2 - lon1))


def segment_distance_local(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Metres to a segment; the foot point is found in a local metre plane around the point."""
    lat, lon, lat1, lon1, lat2, lon2 = map(col, (lat, lon, lat1, lon1, lat2, lon2))
    kx = F.lit(METERS_PER_DEGREE) * F.cos(F.radians(lat))
    ky = F.lit(METERS_PER_DEGREE)
    t = nearest_fraction(lon * kx, lat * ky, lon1 * kx, lat1 * ky, lon2 * kx, lat2 * ky)
    return haversine(lat, lon, lat1 + t * (lat2 - lat1), lon1 + t * (lon2 - lon1))


def valid_coordinate(lat, lon, box: tuple[float, float, float, float]) -> Column:
    """Finite, not 0/0, and inside (south, west, north, east). Never null."""
    lat, lon = col(lat), col(lon)
    south, west, north, east = box
    ok = (
        lat.between(south, north)
        & lon.between(west, east)
        & ~F.isnan(lat)
        & ~F.isnan(lon)
        & ~((lat == 0) & (lon == 0))
    )
    return F.coalesce(ok, F.lit(False))


def in_box(lat, lon, south, west, north, east) -> Column:
    lat, lon = col(lat), col(lon)
    return (lat >= south) & (lat <= north) & (lon >= west) & (lon <= east)


def ring_bounds(ring) -> Column:
    """Bounding box struct (south, west, north, east) of an array of (lon, lat) structs."""
    ring = col(ring)
    lats = F.transform(ring, lambda p: p["lat"])
    lons = F.transform(ring, lambda p: p["lon"])
    return F.struct(
        F.array_min(lats).alias("south"),
        F.array_min(lons).alias("west"),
        F.array_max(lats).alias("north"),
        F.array_max(lons).alias("east"),
    )


def bounds_area(bounds) -> Column:
    b = col(bounds)
    return (b["north"] - b["south"]) * (b["east"] - b["west"])


def bounds_centre(bounds) -> tuple[Column, Column]:
    b = col(bounds)
    return (b["south"] + b["north"]) / 2, (b["west"] + b["east"]) / 2


def mean_vertex(ring) -> tuple[Column, Column]:
    """Mean of the listed vertices (a closed ring counts its first vertex twice)."""
    ring = col(ring)
    n = F.nullif(F.size(ring), F.lit(0))

    def mean(name: str) -> Column:
        return F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[name]) / n

    return mean("lat"), mean("lon")


def geometry_point(kind, coordinates_point, ring, line) -> tuple[Column, Column]:
    """Point of a GeoJSON-like geometry: the point, the mean of a ring, or a line's middle vertex."""
    kind = col(kind)
    ring_lat, ring_lon = mean_vertex(ring)
    middle = F.get(col(line), F.floor(F.size(col(line)) / 2).cast("int"))

    def pick(name: str, ring_value: Column) -> Column:
        return (
            F.when(kind == "Point", col(coordinates_point)[name])
            .when(kind.isin("Polygon", "MultiPolygon"), ring_value)
            .when(kind == "LineString", middle[name])
        )

    return pick("lat", ring_lat), pick("lon", ring_lon)
