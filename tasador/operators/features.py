"""Feature construction.

``build_features`` turns any frame with ``area, bedrooms, bathrooms,
latitude, longitude, property_type, balcony_count`` into the 40 model
features of the segmented model, in their fixed order. Landmark math is a
flat projection (constant-folded literals, whole-stage codegen); the only
exchange is the radius join for the neighbourhood statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import (COMMERCIAL_AREAS, CULTURAL_LANDMARKS, GREEN_SPACES,
                             NEAREST_LANDMARK_SET, WATERFRONT_KM, inverse_distance,
                             landmark_distance_columns, min_distance)
from .neighborhood import RADIUS_KM, area_vs_neighborhood, radius_stats

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): the model's feature order.
# FEATURES_40 is the segmented model's list; FEATURES_45 the simple model's
# and the classifier's; NON_FEATURE_COLUMNS are never features.
# ---------------------------------------------------------------------------
FEATURES_40 = [
    "area", "balcony_count", "bathrooms", "bedrooms", "latitude", "longitude",
    "is_departamento", "is_casa",
    "dist_to_obelisco", "dist_to_plaza_de_mayo", "dist_to_microcentro", "dist_to_calle_florida",
    "dist_to_av_santa_fe_alto_palermo", "dist_to_av_cabildo_belgrano", "dist_to_retiro_station",
    "dist_to_constitucion_station", "dist_to_teatro_colon", "dist_to_la_boca_caminito",
    "dist_to_uba_law", "dist_to_uca", "dist_to_bosques_de_palermo", "dist_to_reserva_ecologica",
    "dist_to_puerto_madero_north",
    "min_dist_to_commercial", "min_dist_to_landmark",
    "city_centrality_score", "commercial_accessibility", "transport_hub_score", "accessibility_score",
    "min_dist_to_green", "min_dist_to_culture",
    "is_waterfront_nearby", "tourist_area_proximity",
    "neighborhood_area_mean", "neighborhood_area_std",
    "area_vs_neighborhood", "local_property_density",
    "premium_x_area", "premium_x_accessibility", "centrality_x_tier_premium",
]

GROUP_MEANS = [
    "neighborhood_bathrooms_mean", "neighborhood_bedrooms_mean",
    "neighborhood_area_loo_mean", "neighborhood_bathrooms_loo_mean", "neighborhood_bedrooms_loo_mean",
]
FEATURES_45 = FEATURES_40[:35] + GROUP_MEANS + FEATURES_40[35:]

NON_FEATURE_COLUMNS = ["price", "currency", "location", "neighborhood_tier"]
# ---------------------------------------------------------------------------

GEO_COLUMNS = FEATURES_40[8:33]


def feature_columns(df: DataFrame, exclude=NON_FEATURE_COLUMNS) -> list[str]:
    """Dtype-driven selection (P2): numeric columns (not boolean), minus the
    excluded names, in schema order. Reads the schema only, no data."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, T.NumericType)]


def property_flags(pt: str = "property_type") -> list[Column]:
    """``is_departamento``/``is_casa`` from a case-insensitive match."""
    low = F.lower(F.col(pt))
    return [F.when(low == "departamento", 1).otherwise(0).alias("is_departamento"),
            F.when(low == "casa", 1).otherwise(0).alias("is_casa")]


def geo_features(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Adds the 15 landmark distances, four group minima, accessibility
    scores, the waterfront flag and tourist proximity (P8-P11)."""
    dists = landmark_distance_columns(lat, lon)
    d = df.select("*", *dists)
    mins = [
        min_distance(lat, lon, COMMERCIAL_AREAS).alias("min_dist_to_commercial"),
        F.least(*[F.col(f"dist_to_{n}") for n in NEAREST_LANDMARK_SET]).alias("min_dist_to_landmark"),
        min_distance(lat, lon, GREEN_SPACES).alias("min_dist_to_green"),
        min_distance(lat, lon, CULTURAL_LANDMARKS).alias("min_dist_to_culture"),
    ]
    d = d.select("*", *mins)
    centrality = inverse_distance("dist_to_microcentro")
    commercial = inverse_distance("min_dist_to_commercial")
    hub = inverse_distance(F.least("dist_to_retiro_station", "dist_to_constitucion_station"))
    d = d.select("*", centrality.alias("city_centrality_score"), commercial.alias("commercial_accessibility"),
                 hub.alias("transport_hub_score"))
    return d.select(
        "*",
        ((F.col("city_centrality_score") + F.col("commercial_accessibility") + F.col("transport_hub_score"))
         / F.lit(3.0)).alias("accessibility_score"),
        F.when(F.col("dist_to_puerto_madero_north") < F.lit(WATERFRONT_KM), 1).otherwise(0)
         .alias("is_waterfront_nearby"),
        inverse_distance("dist_to_la_boca_caminito").alias("tourist_area_proximity"),
    )


def tier_interactions(tier: Column) -> list[Column]:
    """P14. ``tier`` is ``lit(0)`` when scoring (as the service does) or
    ``neighborhood_tier = 'premium'`` as 0/1 for training rows."""
    return [(tier * F.col("area")).alias("premium_x_area"),
            (tier * F.col("accessibility_score")).alias("premium_x_accessibility"),
            (F.col("city_centrality_score") * tier).alias("centrality_x_tier_premium")]


def derived_features(df: DataFrame) -> DataFrame:
    """Derived columns named in the importance report (P24, inferred)."""
    return df.select(
        "*",
        F.log1p("area").alias("log_area"),
        (F.col("area") * F.col("bathrooms")).alias("area_x_bathrooms"),
        (F.col("area") * F.col("bedrooms")).alias("area_x_bedrooms"),
        F.try_divide(F.col("area"), F.col("bedrooms")).alias("area_per_bedroom"),
        F.when(F.col("balcony_count") > 0, 1).otherwise(0).alias("has_balcony"),
    )


def build_features(targets: DataFrame, reference: DataFrame, id_col: str, tier: Column | None = None,
                   radius_km: float = RADIUS_KM, summary: dict | None = None, keep: list[str] | None = None,
                   **kw) -> DataFrame:
    """The 40 features of every target row (R4). ``reference`` is the raw
    listings frame used for neighbourhood statistics."""
    keep = keep or []
    base = targets.select(
        id_col, *keep,
        F.col("area").cast("double").alias("area"),
        F.col("balcony_count").cast("bigint").alias("balcony_count"),
        F.col("bathrooms").cast("double").alias("bathrooms"),
        F.col("bedrooms").cast("bigint").alias("bedrooms"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        *property_flags(),
        *([] if tier is None else [tier.alias("_tier")]),
    )
    # One join: the point-level neighbourhood aggregate is joined back to the
    # rows on their coordinates (no second join on the id), before the distances make them wide.
    j = radius_stats(base, reference, id_col=id_col, keep=[c for c in base.columns if c != id_col],
                     radius_km=radius_km, summary=summary, **kw).drop("n_nearby")
    j = geo_features(j)
    t = F.col("_tier") if tier is not None else F.lit(0)
    j = j.select("*", area_vs_neighborhood().alias("area_vs_neighborhood"), *tier_interactions(t))
    return j.select(id_col, *keep, *FEATURES_40)
