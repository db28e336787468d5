import math

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import geo


def shape(spark, kind, coordinates, zone="Z"):
    return spark.createDataFrame([(zone, kind, coordinates)], "zone_id string, type string, coordinates string")


def project(lon, lat):
    """Forward conic projection to feet, written from the published formulas."""
    e, n, scale, rho0 = geo._lambert_constants()
    phi, lam = math.radians(lat), math.radians(lon - geo.ORIGIN_LON)
    s = e * math.sin(phi)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)
    rho = geo.AXIS * scale * t**n
    east, north = rho * math.sin(n * lam), rho0 - rho * math.cos(n * lam)
    return east / geo.US_FOOT + geo.FALSE_EASTING_FEET, north / geo.US_FOOT + geo.FALSE_NORTHING_FEET


def test_reprojection_inverts_the_forward_formulas(spark):
    places = [(-122.33, 47.61), (-120.8333333, 47.0), (-124.5, 48.9), (-117.1, 45.6)]
    rows = [(float(i), *project(*p)) for i, p in enumerate(places)] + [(9.0, -122.3, 47.6)]
    df = geo.reproject(spark.createDataFrame(rows, "i double, x double, y double")).orderBy("i").collect()
    assert [(r.longitude, r.latitude) for r in df[:4]] == [pytest.approx(p, abs=1e-9) for p in places]
    assert (df[4].longitude, df[4].latitude) == (-122.3, 47.6)  # degrees already
    assert project(geo.ORIGIN_LON, geo.ORIGIN_LAT) == pytest.approx((geo.FALSE_EASTING_FEET, 0.0), abs=1e-6)


def test_centroid_of_shapes_with_holes_and_parts(spark):
    square = "[[[0,0],[4,0],[4,4],[0,4],[0,0]]"
    holed = shape(spark, "Polygon", square + ",[[0,0],[2,0],[2,4],[0,4],[0,0]]]")
    row = geo.centroids(holed).first()
    assert (row.area, row.centroid_x, row.centroid_y) == pytest.approx((8.0, 3.0, 2.0))
    clockwise = shape(spark, "Polygon", "[[[0,0],[0,4],[4,4],[4,0],[0,0]]]")
    assert geo.centroids(clockwise).first().area == pytest.approx(16.0)
    pair = shape(spark, "MultiPolygon", "[" + square + "],[[[10,0],[14,0],[14,4],[10,4],[10,0]]]]")
    row = geo.centroids(pair).first()
    assert (row.area, row.centroid_x) == pytest.approx((32.0, 7.0))
    for side in (0.0005, 0.00002):
        x, y = -122.33, 47.61
        ring = [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
        small = spark.createDataFrame([("S", "Polygon", str([ring]))], "zone_id string, type string, coordinates string")
        row = geo.centroids(small).first()
        assert abs(row.centroid_x - (x + side / 2)) < 1e-9 and abs(row.centroid_y - (y + side / 2)) < 1e-9
    assert geo.vertices(pair).count() == 10
    assert geo.wkt(clockwise).first().geometry_wkt.startswith("POLYGON ((0.0 0.0, 0.0 4.0,")


def test_unusable_geometries_give_no_rings(spark):
    df = shape(spark, "Point", "[1,2]").unionAll(shape(spark, "Polygon", "[]")).unionAll(shape(spark, None, None))
    assert geo.outer_rings(df).count() == 0


def test_map_zones_keeps_zones_without_polygon(spark):
    lookup = spark.createDataFrame([("A",), ("B",)], "zone_id string")
    corners = [project(-122.3 + a, 47.6 + b) for a, b in ((0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01), (0, 0))]
    feature = shape(spark, "Polygon", "[[" + ",".join(f"[{x},{y}]" for x, y in corners) + "]]", "A")
    rows = {r.zone_id: r for r in geo.map_zones(lookup, feature).collect()}
    assert rows["A"].centroid_longitude == pytest.approx(-122.295, abs=1e-5)
    assert rows["A"].centroid_latitude == pytest.approx(47.605, abs=1e-5)
    assert rows["B"].geometry_wkt is None


def test_choropleth(spark):
    summary = spark.createDataFrame(
        [("a", 50, 1.0, 0.1, 7), ("B", 100, 2.0, 0.2, 8), ("c", 10, 3.0, 0.3, 9)],
        "zone_id string, total_service_demand long, avg_calls_per_zone_hour double, weekend_share double, peak_hour int",
    )
    polygons = spark.createDataFrame([("A",), (" b",), ("X",)], "zone_id string")
    coloured = geo.choropleth(polygons, summary)
    rows = {r.zone_id: r for r in coloured.collect()}
    assert (rows["A"]["rank"], rows["A"].fill_color) == (2, "rgba(118,145,148,0.72)")
    assert (rows["B"]["rank"], rows["B"].intensity) == (1, 1.0)
    assert (rows["X"].matched, rows["X"]["rank"], rows["X"].fill_color) == (False, None, geo.UNMATCHED_COLOUR)
    totals = geo.map_coverage(coloured, summary).first()
    assert (totals.polygons, totals.matched_polygons, totals.analytic_zones) == (3, 2, 3)
    assert (totals.low_label, totals.high_label) == ("50", "100")
    assert coloured.filter(F.col("intensity") > 1).count() == 0
