"""Zone polygons: rings, projection, centroids, text export and map colouring.

A polygon arrives as one GeoJSON feature per row; its rings are handled as
arrays inside the row, so nothing is shuffled to walk along a ring.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.text import compact_count, upper_key
from zoneflow.operators.marts import rank_zones

POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = f"array<{POLYGON}>"
# Colours of the map.
UNMATCHED_COLOUR = "rgba(216,226,235,0.34)"
OPACITY = 0.72

# GRS80 ellipsoid and the EPSG:2926 Lambert conformal conic grid, US survey feet.
AXIS, INVERSE_FLATTENING = 6378137.0, 298.257222101
US_FOOT = 1200.0 / 3937.0
PARALLEL_1, PARALLEL_2 = 48 + 44 / 60, 47.5
ORIGIN_LAT, ORIGIN_LON = 47.0, -(120 + 50 / 60)
FALSE_EASTING_FEET, FALSE_NORTHING_FEET = 1640416.666667, 0.0
LATITUDE_STEPS = 6


def parts(features: DataFrame) -> DataFrame:
    """One row per polygon of a feature: ``zone_id``, ``part`` and its rings, the outer one first.

    Input has ``zone_id``, the geometry ``type`` and its ``coordinates`` as JSON text.
    """
    kind, text = F.col("type"), F.col("coordinates")
    polygons = F.when(kind == "Polygon", F.array(F.from_json(text, POLYGON))).when(
        kind == "MultiPolygon", F.from_json(text, MULTIPOLYGON)
    )
    exploded = features.select("zone_id", F.posexplode(polygons).alias("part", "rings"))
    return exploded.filter(F.size("rings") > 0)


def outer_rings(features: DataFrame) -> DataFrame:
    """The outer ring of every polygon."""
    return parts(features).select("zone_id", "part", F.get("rings", F.lit(0)).alias("ring"))


def vertices(features: DataFrame) -> DataFrame:
    """Vertex table of the outer rings in drawing order."""
    points = outer_rings(features).select("zone_id", "part", F.posexplode("ring").alias("seq", "point"))
    return points.select(
        "zone_id", "part", "seq", F.get("point", F.lit(0)).alias("x"), F.get("point", F.lit(1)).alias("y")
    )


def is_projected(x: Column, y: Column) -> Column:
    """Whether a coordinate pair cannot be degrees."""
    return (F.abs(x) > 180) | (F.abs(y) > 90)


def _lambert_constants() -> tuple[float, float, float, float]:
    f = 1 / INVERSE_FLATTENING
    e = math.sqrt(2 * f - f * f)

    def m(lat):
        return math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)

    def t(lat):
        s = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    p1, p2, p0 = (math.radians(d) for d in (PARALLEL_1, PARALLEL_2, ORIGIN_LAT))
    n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2))
    scale = m(p1) / (n * t(p1) ** n)
    return e, n, scale, AXIS * scale * t(p0) ** n


def to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of projected feet: the closed-form inverse of the conic projection.

    The latitude is a short fixed-point iteration; six steps are exact to the
    last digits of a double at these latitudes.
    """
    e, n, scale, rho0 = _lambert_constants()
    east = (x - FALSE_EASTING_FEET) * US_FOOT
    north = F.lit(rho0) - (y - FALSE_NORTHING_FEET) * US_FOOT
    rho = F.sqrt(east * east + north * north)
    t = F.pow(rho / (AXIS * scale), F.lit(1 / n))
    lon = F.degrees(F.atan2(east, north) / n) + ORIGIN_LON
    half_pi = F.lit(math.pi / 2)

    def step(lat: Column, _: Column) -> Column:
        s = F.sin(lat) * e
        return half_pi - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))

    start = half_pi - 2 * F.atan(t)
    lat = F.aggregate(F.sequence(F.lit(1), F.lit(LATITUDE_STEPS)), start, step)
    return lon, F.degrees(lat)


def reproject(points: DataFrame) -> DataFrame:
    """Vertex table in degrees; vertices that are degrees already stay as they are."""
    lon, lat = to_degrees(F.col("x"), F.col("y"))
    projected = is_projected(F.col("x"), F.col("y"))
    return points.withColumns(
        {
            "longitude": F.when(projected, lon).otherwise(F.col("x")),
            "latitude": F.when(projected, lat).otherwise(F.col("y")),
        }
    )


def _ring_moments(ring: Column) -> Column:
    """Twice the signed area of a closed ring and its first moments around its first vertex, by the shoelace sums.

    Around the origin of the map the sums of a small ring cancel to few digits.
    """
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def at(i: Column, k: int) -> Column:
        return F.get(F.get(ring, i), F.lit(k))

    def add(s: Column, i: Column) -> Column:
        zero = F.lit(0)
        x0, x1 = at(i, 0) - at(zero, 0), at(i + 1, 0) - at(zero, 0)
        y0, y1 = at(i, 1) - at(zero, 1), at(i + 1, 1) - at(zero, 1)
        cross = x0 * y1 - x1 * y0
        return F.struct(
            (s["a"] + cross).alias("a"),
            (s["mx"] + (x0 + x1) * cross).alias("mx"),
            (s["my"] + (y0 + y1) * cross).alias("my"),
        )

    steps = F.slice(F.sequence(F.lit(0), F.size(ring)), 1, F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.aggregate(steps, zero, add)


def centroids(features: DataFrame) -> DataFrame:
    """Area and centroid per zone over all its polygons; inner rings count as holes."""
    rings = parts(features).select("zone_id", F.posexplode("rings").alias("inner", "ring"))
    corner = F.get("ring", F.lit(0))
    moments = rings.select(
        "zone_id", "inner", _ring_moments(F.col("ring")).alias("m"),
        F.get(corner, F.lit(0)).alias("x"), F.get(corner, F.lit(1)).alias("y"),
    )
    # Moments of all rings of a zone are moved to one corner of it, then summed.
    origin = moments.groupBy("zone_id").agg(F.min("x").alias("ox"), F.min("y").alias("oy"))
    outward = F.when(F.col("inner") == 0, 1.0).otherwise(-1.0) * F.signum("m.a")
    a = F.col("m.a")
    sums = moments.join(origin, "zone_id").groupBy("zone_id").agg(
        F.min("ox").alias("ox"), F.min("oy").alias("oy"),
        F.sum(outward * a).alias("a"),
        F.sum(outward * (F.col("m.mx") + 3 * a * (F.col("x") - F.col("ox")))).alias("mx"),
        F.sum(outward * (F.col("m.my") + 3 * a * (F.col("y") - F.col("oy")))).alias("my"),
    )
    return sums.select(
        "zone_id",
        (F.col("a") / 2).alias("area"),
        (F.col("ox") + F.try_divide("mx", F.col("a") * 3)).alias("centroid_x"),
        (F.col("oy") + F.try_divide("my", F.col("a") * 3)).alias("centroid_y"),
    )


def centroids_in_degrees(features: DataFrame) -> DataFrame:
    """Centroid per zone, taken on the grid of the input and then turned into degrees."""
    points = centroids(features).withColumnsRenamed({"centroid_x": "x", "centroid_y": "y"})
    return reproject(points).select(
        "zone_id", "area", F.col("longitude").alias("centroid_longitude"), F.col("latitude").alias("centroid_latitude")
    )


def wkt(features: DataFrame) -> DataFrame:
    """Well-known text per zone as a multi-polygon, or a polygon when it has one part."""
    def ring_text(ring: Column) -> Column:
        points = F.transform(
            ring, lambda p: F.concat_ws(" ", F.get(p, F.lit(0)).cast("string"), F.get(p, F.lit(1)).cast("string"))
        )
        return F.concat(F.lit("("), F.array_join(points, ", "), F.lit(")"))

    def polygon_text(rings: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(rings, ring_text), ", "), F.lit(")"))

    kind, text = F.col("type"), F.col("coordinates")
    return features.select(
        "zone_id",
        F.when(kind == "Polygon", F.concat(F.lit("POLYGON "), polygon_text(F.from_json(text, POLYGON))))
        .when(
            kind == "MultiPolygon",
            F.concat(
                F.lit("MULTIPOLYGON ("),
                F.array_join(F.transform(F.from_json(text, MULTIPOLYGON), polygon_text), ", "),
                F.lit(")"),
            ),
        )
        .alias("geometry_wkt"),
    )


def fill_colour(intensity: Column) -> Column:
    """Colour text on a green-to-red scale; the intensity is cut to 0..1."""
    i = F.least(F.greatest(intensity, F.lit(0.0)), F.lit(1.0))
    red, green = F.floor(i * 160 + 38), F.floor(F.lit(185) - i * 80)
    return F.format_string(f"rgba(%d,%d,148,{OPACITY:.2f})", red, green)


def map_zones(lookup: DataFrame, features: DataFrame) -> DataFrame:
    """Zone lookup with centroid and text geometry; zones without a polygon stay."""
    shapes = centroids_in_degrees(features).join(wkt(features), "zone_id")
    return lookup.join(shapes, "zone_id", "left")


def choropleth(polygons: DataFrame, summary: DataFrame) -> DataFrame:
    """Each polygon zone with its demand, rank, intensity and fill colour; unmatched ones get defaults."""
    ranked = rank_zones(summary.withColumn("zone_id", upper_key("zone_id")), "total_service_demand")
    peak = summary.agg(F.greatest(F.max("total_service_demand").cast("double"), F.lit(1.0))).scalar()
    zones = polygons.select(upper_key("zone_id").alias("zone_id")).distinct()
    demand = F.col("total_service_demand")
    joined = zones.join(ranked, "zone_id", "left").withColumn("_peak", peak)
    return joined.select(
        "zone_id",
        F.coalesce(demand.cast("double"), F.lit(0.0)).alias("total_service_demand"),
        F.coalesce("avg_calls_per_zone_hour", F.lit(0.0)).alias("avg_calls_per_zone_hour"),
        F.coalesce("weekend_share", F.lit(0.0)).alias("weekend_share"),
        "peak_hour",
        "rank",
        demand.isNotNull().alias("matched"),
        F.coalesce(demand / F.col("_peak"), F.lit(0.0)).alias("intensity"),
        F.when(demand.isNull(), UNMATCHED_COLOUR).otherwise(fill_colour(demand / F.col("_peak"))).alias("fill_color"),
    )


def map_coverage(coloured: DataFrame, summary: DataFrame) -> DataFrame:
    """Polygons, matched ones, zones with data, and the legend's demand range, in one row."""
    zones = summary.agg(F.count(F.lit(1))).scalar()
    positive = F.when(F.col("total_service_demand") > 0, F.col("total_service_demand"))
    totals = coloured.agg(
        F.count(F.lit(1)).alias("polygons"), F.count(F.when(F.col("matched"), 1)).alias("matched_polygons"),
        F.min(positive).alias("lowest_demand"), F.max(positive).alias("highest_demand"),
    )
    return totals.withColumns(
        {
            "analytic_zones": zones,
            "low_label": F.when(F.col("lowest_demand").isNull(), "0").otherwise(compact_count("lowest_demand")),
            "high_label": F.when(F.col("highest_demand").isNull(), "0").otherwise(compact_count("highest_demand")),
        }
    )
