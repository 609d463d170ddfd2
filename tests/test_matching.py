"""Matching, orphans and summaries on small fixtures with known results."""

from pyspark.sql import functions as F

from parcelwright.functions import geometry as G
from parcelwright.operators import matching, orphans, summary

ROLES = "rid long, manzana string, rol string, lat double, lon double, x double, y double, valid boolean, address string, _status string"


def polygons(spark, boxes, classes=None):
    rows = [(i, *map(float, b), (classes or {}).get(i, "parcel_scale")) for i, b in enumerate(boxes)]
    df = spark.createDataFrame(rows, "_poly_idx long, a double, b double, c double, d double, pol_size_class string")
    rings = G.box(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    return df.select("_poly_idx", rings.alias("rings"), G.area(rings).alias("pol_area_m2"), "pol_size_class")


def role(rid, x=None, y=None, manzana="1", address=None, status="ok", lat=None, lon=None):
    valid = x is not None
    return (rid, manzana, f"{manzana}-{rid}", lat if lat is not None else y, lon if lon is not None else x, x, y, valid, address, status)


def matched(spark, roles, polys):
    return {r["rid"]: r for r in matching.match_roles(spark.createDataFrame(roles, ROLES), polys).collect()}


def test_two_roles_two_polygons(spark):
    m = matched(spark, [role(1, 5.0, 5.0), role(2, 35.0, 5.0)], polygons(spark, [(0, 0, 10, 10), (20, 0, 30, 10)]))
    assert (m[1]["_match_method"], m[1]["_poly_idx"], m[1]["_match_dist_m"]) == ("point_in_polygon", 0, 0.0)
    assert (m[2]["_match_method"], m[2]["_poly_idx"], m[2]["_match_dist_m"]) == ("nearest_10m", 1, 5.0)


def test_boundary_is_not_inside(spark):
    m = matched(spark, [role(1, 10.0, 5.0)], polygons(spark, [(0, 0, 10, 10)]))
    assert (m[1]["_match_method"], m[1]["_match_dist_m"]) == ("nearest_10m", 0.0)


def test_negative_coordinates(spark):
    m = matched(spark, [role(1, -12183000.5, -3150000.5)], polygons(spark, [(-12183010, -3150010, -12182990, -3149990)]))
    assert m[1]["_match_method"] == "point_in_polygon"


def test_coordinate_inheritance_across_the_cut(spark):
    near, far = role(1, 19.9999, 5.0, lat=1.0, lon=2.0), role(2, 20.0001, 5.0, lat=1.0, lon=2.0)
    m = matched(spark, [near, far], polygons(spark, [(0, 0, 10, 10)]))
    assert m[2]["_match_method"] == "coord_inheritance" and m[2]["_match_dist_m"] is None


def test_address_inheritance_takes_the_first_donor(spark):
    rows = [role(1, 5.0, 5.0, address="CALLE 1"), role(2, 25.0, 5.0, address="calle  1 DP 3"), role(3, address="Calle 1 BX 7"), role(4, address="CALLE 1", manzana="2"), role(5, address="")]
    m = matched(spark, rows, polygons(spark, [(0, 0, 10, 10), (20, 0, 30, 10)]))
    assert (m[3]["_match_method"], m[3]["_poly_idx"]) == ("address_inheritance", 0)
    assert m[4]["_poly_idx"] is None and m[5]["_poly_idx"] is None


def test_quality_of_unmatched(spark):
    rows = [role(2), role(3, status="not_found"), role(4, status="error"), role(5, 500.0, 500.0), role(6, 5.0, 5.0), role(7, status="other")]
    m = matched(spark, rows, polygons(spark, [(0, 0, 10, 10)], {0: "large_component"}))
    assert [m[i]["calidad_geom"] for i in (2, 3, 4, 5, 6, 7)] == [
        "vigente_sin_visualizacion_sii", "rol_no_encontrado_periodo_actual", "consulta_sii_error", "vigente_con_coordenada_sin_geometria", "componente_grande_revision", "sin_dibujo",
    ]
    counts = matching.match_metrics(spark.createDataFrame(list(m.values()), matching.match_roles(spark.createDataFrame(rows, ROLES), polygons(spark, [(0, 0, 10, 10)])).schema)).first()
    assert counts["current_without_published_geometry"] == counts["not_found_current_period"] == counts["api_error_without_geometry"] == counts["current_with_coordinates_unmatched"] == 1


def test_empty_sides(spark):
    polys = polygons(spark, [(0, 0, 10, 10)])
    assert matching.match_roles(spark.createDataFrame([], ROLES), polys).count() == 0
    assert matching.match_roles(spark.createDataFrame([role(1, 5.0, 5.0)], ROLES), polys.limit(0)).first()["_poly_idx"] is None
    assert matching.match_metrics(matching.match_roles(spark.createDataFrame([], ROLES), polys)).first()["coverage_pct"] == 0.0


def test_final_summary(spark):
    rows = [("1-1", 10), ("1-1", 10), ("2-1", 20), (None, 30), ("3-1", None)]
    s = summary.final_summary(spark.createDataFrame(rows, "rol string, _poly_idx long")).first()
    assert (s["rows_total"], s["rows_with_geometry"], s["polygons_total"], s["polygons_with_role"], s["polygons_without_role"]) == (5, 4, 3, 2, 1)
    assert s["polygon_attribution_pct"] == 66.667
    assert (s["unique_roles_total"], s["unique_roles_with_geometry"], s["unique_roles_without_geometry"]) == (3, 2, 1)
    assert summary.final_summary(spark.createDataFrame([], "rol string, _poly_idx long")).first()["rows_total"] == 0


def test_equal_shapes_share_a_response(spark):
    orphan = spark.createDataFrame([(1, "k"), (2, "k"), (3, "other")], "_poly_idx long, geometry_key string")
    answers = spark.createDataFrame([("k", "ok", 1, "t", "5", "6", "5-6")], "geometry_key string, status string, attempts int, queried_at string, manzana string, predio string, rol string")
    got = {r["_poly_idx"]: r for r in orphans.recover(orphan, answers).collect()}
    assert got[1]["calidad_geom"] == got[2]["calidad_geom"] == "rol_recuperado" and got[3]["_status"] == "pending" and got[3]["_match_dist_m"] is None


def test_geometry(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]
    df = spark.createDataFrame([([ring, hole],)], f"rings {G.RINGS}")
    lit = lambda v: F.lit(float(v))
    r = F.col("rings")
    got = df.select(G.area(r), G.contains(lit(1.5), lit(1.5), r), G.contains(lit(3), lit(3), r), G.point_distance(lit(1.5), lit(1.5), r), G.point_distance(lit(7), lit(8), r), G.wkb(r)).first()
    assert list(got[:5]) == [15.0, False, True, 0.5, 5.0]
    import struct

    want = struct.pack("<BII", 1, 3, 2)
    for part in (ring, hole):
        want += struct.pack("<I", 5) + b"".join(struct.pack("<dd", *p) for p in [*part, part[0]])
    assert got[5] == want.hex()
