"""Geographic column expressions: haversine, landmark distances, minima and
accessibility scores. Everything is a native Catalyst expression; literal
coordinates are constant-folded, so each distance is a handful of codegen'd
floating-point operations per row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical features).
# Earth radius in km, landmark coordinates (lat, lon) in degrees, the three
# point groups used for minimum distances, the landmarks used for the
# "nearest landmark" minimum, and the 10 km fallback for an empty group.
# ---------------------------------------------------------------------------
EARTH_RADIUS_KM = 6371.0

LANDMARKS: dict[str, tuple[float, float]] = {
    "obelisco": (-34.603722, -58.381592),
    "plaza_de_mayo": (-34.608295, -58.370373),
    "microcentro": (-34.603722, -58.381592),
    "calle_florida": (-34.603722, -58.375000),
    "av_santa_fe_alto_palermo": (-34.589722, -58.410833),
    "av_cabildo_belgrano": (-34.563056, -58.458333),
    "retiro_station": (-34.592778, -58.375556),
    "constitucion_station": (-34.625833, -58.390278),
    "teatro_colon": (-34.601389, -58.383611),
    "la_boca_caminito": (-34.635278, -58.363889),
    "uba_law": (-34.600556, -58.383056),
    "uca": (-34.589722, -58.410833),
    "bosques_de_palermo": (-34.587222, -58.410833),
    "reserva_ecologica": (-34.610833, -58.360833),
    "puerto_madero_north": (-34.610833, -58.360833),
}

COMMERCIAL_AREAS: list[tuple[float, float]] = [
    (-34.603722, -58.381592),
    (-34.589722, -58.410833),
    (-34.563056, -58.458333),
]

GREEN_SPACES: list[tuple[float, float]] = [
    (-34.587222, -58.410833),
    (-34.610833, -58.360833),
]

CULTURAL_LANDMARKS: list[tuple[float, float]] = [
    (-34.601389, -58.383611),
    (-34.635278, -58.363889),
]

NEAREST_LANDMARK_SET = ["obelisco", "plaza_de_mayo", "teatro_colon"]

EMPTY_GROUP_DISTANCE_KM = 10.0
WATERFRONT_KM = 3.0
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km: ``2 R asin(sqrt(a))``.

    Arguments are column names, Columns or Python floats (a float becomes a
    folded literal)."""
    def rad(x):
        return F.lit(math.radians(x)) if isinstance(x, (int, float)) else F.radians(_col(x))

    p1, l1, p2, l2 = rad(lat1), rad(lon1), rad(lat2), rad(lon2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def landmark_distance_columns(lat="latitude", lon="longitude",
                              landmarks: dict[str, tuple[float, float]] | None = None) -> list[Column]:
    """``dist_to_<name>`` for every landmark, in the given order."""
    lm = LANDMARKS if landmarks is None else landmarks
    return [haversine_km(lat, lon, la, lo).alias(f"dist_to_{name}") for name, (la, lo) in lm.items()]


def min_distance(lat, lon, points: Sequence[tuple[float, float]]) -> Column:
    """Distance to the nearest point of a group; 10 km for an empty group.

    ``least`` skips NULL but a NULL coordinate makes every term NULL, so the
    result is NULL exactly when Python's ``min`` would see NaN everywhere."""
    if not points:
        return F.lit(EMPTY_GROUP_DISTANCE_KM)
    terms = [haversine_km(lat, lon, la, lo) for la, lo in points]
    return terms[0] if len(terms) == 1 else F.least(*terms)


def inverse_distance(d) -> Column:
    """``1 / (1 + d)``, the score shape used for all accessibility scores."""
    return F.lit(1.0) / (F.lit(1.0) + _col(d))


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Unit vector on the sphere; squared chord length between two unit
    vectors is monotone in great-circle distance."""
    p, l = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)


def chord2_for_radius(radius_km: float) -> float:
    """Squared chord length of a great-circle arc of ``radius_km``."""
    return (2.0 * math.sin(radius_km / (2.0 * EARTH_RADIUS_KM))) ** 2
