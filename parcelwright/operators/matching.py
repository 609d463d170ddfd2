"""The match cascade of roles to parcels.

Spatial joins are equi-joins on a grid cell with a residual predicate: a parcel is listed in every cell that its bounds,
widened by the match distance, touch; a role has one cell. One join and one aggregation give both the containing parcel
and the nearest one. Joins are by shuffle and sort, as no side has a bound: the files' size says little of the rows that
come of them, and a broadcast passes the driver. Ties go to the smallest ``_poly_idx``; inherited matches come from the first donor by ``rid``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwright.functions import geometry as G
from parcelwright.functions.scalars import coordinate_key, normalize_address, round_half_even

# Fixed values of the outputs.
PIP, NEAREST, COORDINATE, ADDRESS = "point_in_polygon", "nearest_10m", "coord_inheritance", "address_inheritance"
DRAWN, IMPRECISE, NOT_DRAWN = "predio_con_dibujo", "dibujo_impreciso", "sin_dibujo"
NOT_SHOWN, SHOWN_UNMATCHED = "vigente_sin_visualizacion_sii", "vigente_con_coordenada_sin_geometria"
NOT_FOUND, FAILED, LARGE = "rol_no_encontrado_periodo_actual", "consulta_sii_error", "componente_grande_revision"


def in_cells(polygons: DataFrame, reach: float, cell: float) -> DataFrame:
    """Each polygon once per grid cell that its bounds, widened by ``reach``, touch."""
    at = lambda v: F.floor(v / cell).cast("long")
    b = polygons.withColumn("_b", G.bounds(F.col("rings")))
    xs = F.sequence(at(F.col("_b.minx") - reach), at(F.col("_b.maxx") + reach))
    ys = F.sequence(at(F.col("_b.miny") - reach), at(F.col("_b.maxy") + reach))
    return b.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys)).drop("_b")


def near_polygons(points: DataFrame, polygons: DataFrame, reach: float, cell: float = 32.0) -> DataFrame:
    """``rid, _poly_idx, inside, dist`` of the pairs within ``reach``; points without coordinates have none."""
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    p = points.where("x is not null and y is not null").select("rid", "x", "y", at("x").alias("_cx"), at("y").alias("_cy"))
    pairs = p.join(in_cells(polygons.select("_poly_idx", "rings"), reach, cell).hint("merge"), ["_cx", "_cy"])
    x, y, rings = F.col("x"), F.col("y"), F.col("rings")
    pairs = pairs.select("rid", "_poly_idx", G.contains(x, y, rings).alias("inside"), G.point_distance(x, y, rings).alias("dist"))
    return pairs.where(F.col("dist") <= reach)


def _inherit(matched: DataFrame, key: list[str], recipients: Column, method: str) -> DataFrame:
    """Give unmatched rows the parcel of the first matched row with the same key; null keys never meet."""
    donors = matched.where(F.col("_poly_idx").isNotNull()).groupBy(*key).agg(F.min_by("_poly_idx", "rid").alias("_given"))
    out = matched.join(donors.hint("merge"), key, "left")
    takes = F.col("_poly_idx").isNull() & recipients & F.col("_given").isNotNull()
    return out.withColumns({"_match_method": F.when(takes, F.lit(method)).otherwise(F.col("_match_method")), "_poly_idx": F.when(takes, F.col("_given")).otherwise(F.col("_poly_idx"))}).drop("_given")


def match_roles(roles: DataFrame, polygons: DataFrame, max_distance: float = 10.0, cell: float = 32.0) -> DataFrame:
    """J06-J10 and the quality class for every role.

    ``roles``: rid, manzana, lat, lon, x, y (projected), valid, address, _status; ``polygons``: _poly_idx, rings,
    pol_area_m2, pol_size_class. Invalid coordinates take part in address inheritance only. Distances of contained
    points are 0, of inherited ones null. An empty side gives unmatched roles or no rows.
    """
    usable = roles.select("rid", F.when(F.col("valid"), F.col("x")).alias("x"), F.when(F.col("valid"), F.col("y")).alias("y"))
    near = near_polygons(usable, polygons, max_distance, cell)
    best = near.groupBy("rid").agg(F.min(F.when(F.col("inside"), F.col("_poly_idx"))).alias("_in"), F.min(F.struct("dist", "_poly_idx")).alias("_near"))
    m = roles.join(best.hint("merge"), "rid", "left").withColumns({
        "_poly_idx": F.coalesce("_in", "_near._poly_idx"),
        "_match_method": F.when(F.col("_in").isNotNull(), PIP).when(F.col("_near").isNotNull(), NEAREST),
        "_match_dist_m": F.when(F.col("_in").isNotNull(), 0.0).otherwise(round_half_even(F.col("_near.dist"), 2)),
    }).drop("_in", "_near")
    m = m.withColumns({"_lat6": coordinate_key(F.col("lat")), "_lon6": coordinate_key(F.col("lon")), "_addr": F.when(normalize_address(F.col("address")) != "", normalize_address(F.col("address")))})
    m = _inherit(m, ["_lat6", "_lon6"], F.col("valid"), COORDINATE).drop("_lat6", "_lon6")
    m = _inherit(m, ["manzana", "_addr"], F.lit(True), ADDRESS).drop("_addr")
    m = m.join(polygons.select("_poly_idx", "pol_area_m2", "pol_size_class").hint("merge"), "_poly_idx", "left")
    return m.withColumn("calidad_geom", quality())


def quality() -> Column:
    """The last rule overrides all others."""
    none, status = F.col("_poly_idx").isNull(), F.col("_status")
    return (
        F.when(F.col("pol_size_class") == "large_component", LARGE)
        .when(none & (status == "ok") & ~F.col("valid"), NOT_SHOWN)
        .when(none & (status == "ok"), SHOWN_UNMATCHED)
        .when(none & (status == "not_found"), NOT_FOUND)
        .when(none & (status == "error"), FAILED)
        .when(F.col("_match_method") == PIP, DRAWN)
        .when(~none, IMPRECISE)
        .otherwise(NOT_DRAWN)
    )


def match_metrics(matched: DataFrame) -> DataFrame:
    """One row of counts and the coverage in percent."""
    method = lambda name: F.count_if(F.col("_match_method") == name).alias(name)
    kind = lambda value, name: F.count_if(F.col("calidad_geom") == value).alias(name)
    have = F.count_if(F.col("_poly_idx").isNotNull())
    return matched.agg(
        F.count("*").alias("roles"), *[method(n) for n in (PIP, NEAREST, COORDINATE, ADDRESS)], F.count_if(F.col("_poly_idx").isNull()).alias("without_geometry"),
        kind(NOT_SHOWN, "current_without_published_geometry"), kind(SHOWN_UNMATCHED, "current_with_coordinates_unmatched"), kind(NOT_FOUND, "not_found_current_period"), kind(FAILED, "api_error_without_geometry"),
        F.when(F.count("*") > 0, round_half_even(have / F.count("*") * 100, 3)).otherwise(0.0).alias("coverage_pct"),
    )
