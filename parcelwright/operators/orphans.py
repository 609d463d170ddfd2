"""Parcels without a role, their recovery and the final union.

Joins are by shuffle and sort, as no side has a bound (see ``matching``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the outputs.
RECOVERED, UNMATCHED = "get_feature_info_orphan", "unmatched_polygon"
RECOVERED_QUALITY, UNMATCHED_QUALITY = "rol_recuperado", "poligono_sin_rol"
NO_PARCEL = "El punto no devolvió un predio"


def orphans(polygons: DataFrame, matched: DataFrame) -> DataFrame:
    """The polygons that no role uses."""
    return polygons.join(matched.select("_poly_idx").where("_poly_idx is not null").distinct().hint("merge"), "_poly_idx", "left_anti")


def point_status(data_present: F.Column, error: F.Column) -> F.Column:
    """With data ok; without an error, or with the no-parcel message, not found; else error."""
    return F.when(data_present, "ok").when(error.isNull() | (error == NO_PARCEL), "not_found").otherwise("error")


def recover(orphan: DataFrame, responses: DataFrame) -> DataFrame:
    """Orphans (with geometry_key) joined to stored responses (geometry_key, status, attempts, queried_at, manzana, predio, rol).

    Equal shapes share one response. A polygon without a response is pending; a response without a role recovers nothing.
    """
    r = responses.select("geometry_key", F.col("status").alias("_status"), F.col("attempts").alias("_api_attempts"), F.col("queried_at").alias("_api_queried_at"), "manzana", "predio", "rol")
    out = orphan.join(r.hint("merge"), "geometry_key", "left").withColumn("_status", F.coalesce("_status", F.lit("pending")))
    found = F.col("rol").isNotNull()
    return out.withColumns({
        "_ok": F.col("_status") == "ok", "_api_attempts": F.coalesce("_api_attempts", F.lit(0)),
        "_match_method": F.when(found, RECOVERED).otherwise(UNMATCHED), "_match_dist_m": F.when(found, 0.0), "calidad_geom": F.when(found, RECOVERED_QUALITY).otherwise(UNMATCHED_QUALITY),
    })


def final_output(matched: DataFrame, recovered: DataFrame) -> DataFrame:
    """Matched roles and orphans, columns united by name."""
    return matched.unionByName(recovered, allowMissingColumns=True)
