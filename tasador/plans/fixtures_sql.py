"""SQL text of the derived test views (FIXTURES.md), used by the DuckDB
oracle. The Spark side builds the same views with the DataFrame API in
``tasador.sources``; both were checked equal row by row."""

from __future__ import annotations

import math

from ..functions.geo import COMMERCIAL_AREAS, CULTURAL_LANDMARKS, GREEN_SPACES

LISTINGS = """
SELECT o_orderkey AS listing_id,
  CASE o_orderkey % 500 WHEN 1 THEN 3e4 WHEN 2 THEN 1.2e5 WHEN 3 THEN 3e5 WHEN 4 THEN 6e5 ELSE o_totalprice*1.25e0 END AS price,
  CASE WHEN o_orderkey % 20 = 0 THEN 'ARS' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 193 = 0 THEN 0e0
       ELSE (CASE o_orderkey % 500 WHEN 1 THEN 3e4 WHEN 2 THEN 1.2e5 WHEN 3 THEN 3e5 WHEN 4 THEN 6e5 ELSE o_totalprice*1.25e0 END)
            / CAST(600 + (o_custkey*7919 + o_orderkey*31) % 4601 AS DOUBLE) END AS area,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS BIGINT) END AS bedrooms,
  1e0 + 5e-1*CAST(o_custkey % 5 AS DOUBLE) AS bathrooms,
  CAST(o_orderkey % 3 AS BIGINT) AS balcony_count,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE -3.47e1 + CAST((o_orderkey*7919) % 10007 AS DOUBLE)/1.0007e4*1.8e-1 END AS latitude,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE -5.853e1 + CAST((o_orderkey*104729) % 10009 AS DOUBLE)/1.0009e4*2e-1 END AS longitude,
  CASE WHEN o_orderkey % 10 < 7 THEN 'Departamento' WHEN o_orderkey % 10 < 9 THEN 'casa' ELSE 'PH' END AS property_type,
  n_name AS location,
  CASE WHEN n_regionkey = 0 THEN 'premium' WHEN n_regionkey < 3 THEN 'mid' ELSE 'standard' END AS neighborhood_tier
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

REQUESTS = """
SELECT event_id AS request_id, ts AS event_time,
  concat('{',
    CASE WHEN event_id % 31 = 0 THEN '' WHEN event_id % 37 = 0 THEN '"area": "abc", ' ELSE concat('"area": ', CAST(20 + event_id % 180 AS VARCHAR), '.5, ') END,
    CASE WHEN event_id % 43 = 0 THEN '' ELSE concat('"bedrooms": ', CAST(1 + event_id % 4 AS VARCHAR), ', ') END,
    '"bathrooms": ', CAST(1 + event_id % 3 AS VARCHAR), '.0, ',
    '"latitude": -34.', CAST(560000 + (event_id * 7919) % 90000 AS VARCHAR), ', ',
    '"longitude": -58.', CAST(360000 + (event_id * 104729) % 99000 AS VARCHAR),
    CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN ', "property_type": "Departamento"' ELSE ', "property_type": "casa"' END,
    CASE WHEN event_id % 2 = 0 THEN '' ELSE concat(', "balcony_count": ', CAST(event_id % 4 AS VARCHAR)) END,
    CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN ', "segment": "luxury"' WHEN 2 THEN ', "segment": "budget"' WHEN 3 THEN ', "segment": "premium"' ELSE ', "segment": "mid_range"' END,
    '}') AS payload
FROM events
"""

POIS = """
SELECT c_custkey AS poi_id,
  CASE c_custkey % 3 WHEN 0 THEN 'restaurant' WHEN 1 THEN 'park' ELSE 'subway_station' END AS kind,
  -3.47e1 + CAST((c_custkey * 6151) % 9973 AS DOUBLE) / 9.973e3 * 1.8e-1 AS latitude,
  -5.853e1 + CAST((c_custkey * 3079) % 9967 AS DOUBLE) / 9.967e3 * 2e-1 AS longitude
FROM customer
"""

IMPORTANCES = """
SELECT p_brand AS feature, CAST(sum(p_size) AS DOUBLE) AS importance FROM part GROUP BY p_brand
"""

SEGMENTS = """
SELECT * FROM (VALUES
  (0, 'budget',     3e4, 1.2e5, 'Budget properties - first-time buyers, small apartments'),
  (1, 'mid_range', 1.2e5, 3e5, 'Mid-range properties - majority of market, families, professionals'),
  (2, 'premium',   3e5, 6e5, 'Premium properties - luxury apartments, penthouses, premium neighborhoods')
) AS t(ord, name, price_min, price_max, description)
"""

CLEAN = """
SELECT * FROM listings
WHERE currency = 'USD' AND price BETWEEN 3e4 AND 6e5
  AND price / NULLIF(area, 0e0) BETWEEN 8e2 AND 5e3
"""

SEGMENT_CASE = """CASE WHEN price >= 3e4 AND price < 1.2e5 THEN 'budget'
  WHEN price >= 1.2e5 AND price < 3e5 THEN 'mid_range'
  WHEN price >= 3e5 AND price < 6e5 THEN 'premium'
  WHEN price = 6e5 THEN 'premium' END"""


def with_views(body: str, *names: str, extra: str = "") -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    defs = {
        "listings": LISTINGS, "requests": REQUESTS, "pois": POIS, "importances": IMPORTANCES,
        "segments": SEGMENTS, "clean": CLEAN,
    }
    need = list(names)
    if "clean" in need and "listings" not in need:
        need.insert(0, "listings")
    order = ["listings", "requests", "pois", "importances", "segments", "clean"]
    ctes = [f"{n} AS ({defs[n]})" for n in order if n in need]
    if extra:
        ctes.append(extra)
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


def sql_haversine(lat1: str, lon1: str, lat2, lon2) -> str:
    """Haversine km as DuckDB SQL; float arguments become radian literals."""
    def rad(x):
        return repr(math.radians(x)) if isinstance(x, (int, float)) else f"radians({x})"
    p1, l1, p2, l2 = rad(lat1), rad(lon1), rad(lat2), rad(lon2)
    a = (f"pow(sin(({p2} - {p1}) / 2), 2) + cos({p1}) * cos({p2}) * "
         f"pow(sin(({l2} - {l1}) / 2), 2)")
    return f"(12742e0 * asin(sqrt({a})))"


def sql_min_distance(points, lat: str = "latitude", lon: str = "longitude") -> str:
    terms = [sql_haversine(lat, lon, la, lo) for la, lo in points]
    if not terms:
        return "1e1"
    return terms[0] if len(terms) == 1 else f"least({', '.join(terms)})"


COMMERCIAL_SQL = sql_min_distance(COMMERCIAL_AREAS)
GREEN_SQL = sql_min_distance(GREEN_SPACES)
CULTURAL_SQL = sql_min_distance(CULTURAL_LANDMARKS)
