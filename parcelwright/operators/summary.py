"""Summaries of the final output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwright.functions.scalars import round_half_even

STATUSES = ("ok", "not_found", "error")


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames as one row, without a join: their union, then the only value of each column."""
    both = rows[0]
    for r in rows[1:]:
        both = both.unionByName(r, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def status_counts(results: DataFrame) -> DataFrame:
    """Rows by status."""
    return results.groupBy("status").agg(F.count("*").alias("n"))


def status_row(results: DataFrame, source: str | None = None) -> DataFrame:
    """One row with a count for each known status, 0 if there is none; of one ``source`` on request."""
    rows = results if source is None else results.where(F.col("source") == source)
    return rows.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def final_summary(output: DataFrame) -> DataFrame:
    """``output`` has rol, _poly_idx (null without geometry). Percentages have three places.

    A polygon counts as attributed if any of its rows has a role that is not blank. Roles are compared trimmed.
    """
    role = F.trim("rol")
    rows = output.select("_poly_idx", F.when(role != "", role).alias("role"))
    with_shape = F.col("_poly_idx").isNotNull()
    polygons = rows.where(with_shape).groupBy("_poly_idx").agg(F.bool_or(F.col("role").isNotNull()).alias("has")).agg(F.count("*").alias("polygons_total"), F.count_if("has").alias("polygons_with_role"))
    roles = rows.where("role is not null").groupBy("role").agg(F.bool_or(with_shape).alias("shaped")).agg(F.count("*").alias("unique_roles_total"), F.count_if("shaped").alias("unique_roles_with_geometry"))
    totals = rows.agg(F.count("*").alias("rows_total"), F.count_if(with_shape).alias("rows_with_geometry"))
    s = _side_by_side(totals, polygons, roles)
    share = lambda a, b: F.when(F.col(b) > 0, round_half_even(F.col(a) / F.col(b) * 100, 3)).otherwise(0.0)
    return s.select(
        "rows_total", "rows_with_geometry", "polygons_total", "polygons_with_role", (F.col("polygons_total") - F.col("polygons_with_role")).alias("polygons_without_role"),
        share("polygons_with_role", "polygons_total").alias("polygon_attribution_pct"), "unique_roles_total", "unique_roles_with_geometry",
        (F.col("unique_roles_total") - F.col("unique_roles_with_geometry")).alias("unique_roles_without_geometry"), share("unique_roles_with_geometry", "unique_roles_total").alias("unique_role_geometry_coverage_pct"),
    )


def observed_periods(output: DataFrame, expected: Column) -> DataFrame:
    """``periodo, unexpected`` of the distinct periods; nothing is unexpected where none is expected."""
    return output.where("periodo is not null").select("periodo").distinct().withColumn("unexpected", F.coalesce(expected.isNotNull() & (F.upper("periodo") != expected), F.lit(False)))


def observations(output: DataFrame, status: DataFrame, limited: bool = False, periods: DataFrame | None = None) -> DataFrame:
    """A10, P20: the counters over output and responses, and the final status.

    ``geometry_valid`` of the output, where it has one, tells invalid shapes; ``periods`` is what ``observed_periods`` gives.
    """
    kind = lambda v: F.count_if(F.col("calidad_geom") == v)
    invalid = F.count_if(~F.col("geometry_valid")) if "geometry_valid" in output.columns else F.lit(0).cast("long")
    counted = output.agg(
        F.count_if(F.col("_poly_idx").isNull()).alias("roles_without_geometry"), kind("vigente_sin_visualizacion_sii").alias("current_roles_without_published_geometry"),
        kind("vigente_con_coordenada_sin_geometria").alias("current_roles_with_coordinates_unmatched"), kind("rol_no_encontrado_periodo_actual").alias("roles_not_found_current_period"),
        kind("poligono_sin_rol").alias("unmatched_polygons"), F.count_if(F.col("pol_size_class") == "large_component").alias("large_components"), invalid.alias("invalid_geometries"),
    )
    api = status_row(status).select(F.col("error").alias("api_error"), F.col("not_found").alias("api_not_found"))
    unexpected = periods.agg(F.count_if("unexpected").alias("unexpected_api_periods")) if periods is not None else api.agg(F.lit(0).cast("long").alias("unexpected_api_periods"))
    out = _side_by_side(counted, api, unexpected)
    clean = None
    for c in out.columns:
        clean = (F.col(c) == 0) if clean is None else clean & (F.col(c) == 0)
    return out.withColumn("status", F.lit("parcial_control") if limited else F.when(clean, "completa").otherwise("completa_con_observaciones"))


def vectorization_metrics(merged: DataFrame, blocks: DataFrame) -> DataFrame:
    """``merged`` has pol_size_class and geometry_valid; ``blocks`` has fill_pixels and pixels."""
    ratio = F.col("fill_pixels") / F.col("pixels")
    a = merged.agg(F.count("*").alias("polygons"), F.count_if("geometry_valid").alias("valid_polygons"), F.count_if(F.col("pol_size_class") == "large_component").alias("large"))
    b = blocks.agg(F.count("*").alias("blocks"), F.sum("fill_pixels").alias("fill_pixels"), F.min(ratio).alias("min_fill_ratio"), F.max(ratio).alias("max_fill_ratio"))
    return _side_by_side(a, b)
