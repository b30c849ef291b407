"""Radius join: grid equi-join equals brute force, including edge cases."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.functions.geo import haversine_km
from tasador.operators.neighborhood import radius_stats
from tasador.operators.radius import grid_steps

SCHEMA = "listing_id long, area double, latitude double, longitude double"


def _hav(a, b, c, d):
    p1, l1, p2, l2 = map(math.radians, (a, b, c, d))
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(x))


def _brute(tgts, refs, r=2.0):
    out = {}
    for tid, _, la, lo in tgts:
        near = [x for x in refs if la is not None and x[2] is not None and _hav(la, lo, x[2], x[3]) <= r]
        areas = [x[1] for x in near if x[1] is not None]
        out[tid] = (len(near), sum(areas) / len(areas) if areas else None)
    return out


def _rows(n, seed, dup=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, rnd.choice([None, rnd.uniform(20, 300)]) if i % 9 == 0 else rnd.uniform(20, 300),
                     -34.7 + rnd.random() * 0.18, -58.53 + rnd.random() * 0.2))
    # A group of copies at one address.
    rows += [(n + k, 50.0 + k, rows[0][2], rows[0][3]) for k in range(dup)]
    return rows


@pytest.mark.parametrize("hot", [200_000, 3])
def test_grid_equals_brute_force(spark, hot):
    refs = _rows(400, 1, dup=40)
    tgts = _rows(120, 2) + [(999, 80.0, None, None), (998, 80.0, -36.0, -58.4)]
    t = spark.createDataFrame(tgts, SCHEMA)
    r = spark.createDataFrame(refs, SCHEMA)
    got = {x["listing_id"]: x for x in radius_stats(t, r, fallback=False, hot_cell_points=hot).collect()}
    want = _brute(tgts, refs)
    for tid, (n, mean) in want.items():
        assert got[tid]["n_nearby"] == n
        if mean is None:
            assert got[tid]["neighborhood_area_mean"] is None
        else:
            assert got[tid]["neighborhood_area_mean"] == pytest.approx(mean, rel=1e-9)


def test_fallback_and_single_neighbour(spark):
    refs = [(1, 100.0, -34.6, -58.4), (2, 50.0, -34.9, -58.9), (3, None, -34.6, -58.4001)]
    tgts = [(10, 80.0, -34.9, -58.9), (11, 80.0, -36.0, -58.0), (12, 80.0, None, None)]
    got = {x["listing_id"]: x for x in radius_stats(spark.createDataFrame(tgts, SCHEMA),
                                                      spark.createDataFrame(refs, SCHEMA)).collect()}
    # One neighbour: std is 0 (not NULL), density 1 / (pi r^2).
    assert got[10]["n_nearby"] == 1 and got[10]["neighborhood_area_std"] == 0.0
    assert got[10]["local_property_density"] == pytest.approx(1 / (math.pi * 4))
    # No neighbour / no coordinates: reference median, sample std, rows / 1000.
    for tid in (11, 12):
        assert got[tid]["neighborhood_area_mean"] == pytest.approx(75.0)
        assert got[tid]["neighborhood_area_std"] == pytest.approx(35.35533905932738)
        assert got[tid]["local_property_density"] == pytest.approx(3 / 1000)


def test_grid_steps_cover_radius():
    lat_step, ncx, lon_step = grid_steps(34.7, 2.0)
    assert lat_step * 6371 * 3.141592653589793 / 180 > 2.0
    assert ncx * lon_step == pytest.approx(360.0)
    # Near the pole one longitude cell spans everything.
    assert grid_steps(89.999, 2.0)[1] == 1


def test_haversine_matches_python(spark):
    df = spark.createDataFrame([(-34.6, -58.4, -34.61, -58.38)], "a double, b double, c double, d double")
    v = df.select(haversine_km("a", "b", "c", "d").alias("d")).first()["d"]
    assert v == pytest.approx(_hav(-34.6, -58.4, -34.61, -58.38), rel=1e-12)


def test_dense_two_level_equals_brute_force(spark):
    # Dense enough that most cells of r/k lie fully inside each circle, so the
    # interior (pre-aggregated) path carries most of the matches.
    rnd = random.Random(5)
    refs = [(i, rnd.uniform(20, 300), -34.6 + rnd.random() * 0.03, -58.4 + rnd.random() * 0.03)
            for i in range(3000)]
    tgts = [(10_000 + i, 1.0, -34.6 + rnd.random() * 0.03, -58.4 + rnd.random() * 0.03) for i in range(40)]
    got = {x["listing_id"]: x for x in radius_stats(spark.createDataFrame(tgts, SCHEMA),
                                                      spark.createDataFrame(refs, SCHEMA),
                                                      radius_km=1.0, fallback=False).collect()}
    want = _brute(tgts, refs, r=1.0)
    for tid, (n, mean) in want.items():
        assert got[tid]["n_nearby"] == n
        assert got[tid]["neighborhood_area_mean"] == pytest.approx(mean, rel=1e-9)


@pytest.mark.parametrize("lat,lon,dlat,dlon,radius", [(-34.7, -58.53, 0.18, 0.2, 2.0), (60, 179.9, 0.1, 0.2, 2.0), (89.9, -180, 0.1, 360, 2.0),
                                                      (0, 0, 1e-3, 0, 0.05), (-2, 10, 3, 3, 80.0)])
def test_circle_sums_equal_all_pairs(lat, lon, dlat, dlon, radius):
    from tasador.operators.radius import _all_pairs, circle_sums
    rng = np.random.default_rng(3)
    p = [(lat + rng.random(n) * dlat, (lon + rng.random(n) * dlon + 180) % 360 - 180) for n in (60, 1500)]
    values = [rng.integers(0, 9, 1500) * 0.5, rng.normal(0, 50, 1500)]
    want = _all_pairs(*p[0], *p[1], values, radius)
    for few in (0, 32, 10**9):
        got = circle_sums(*p[0], *p[1], values, radius, few)
        assert (got[0] == want[0]).all() and (got[2] == want[2]).all() and np.allclose(got[1], want[1], atol=1e-9)
    values[1][7] = np.inf  # reaches only the circles that hold it
    assert np.isfinite(circle_sums(*p[0], *p[1], values, radius)[1]).tolist() == np.isfinite(_all_pairs(*p[0], *p[1], values, radius)[1]).tolist()


def test_shuffled_rows_grow_with_the_points(spark):
    # Before, a target went to each of some 240 cells of its circle.
    from tasador.operators.radius import choose_tiles
    rnd = random.Random(6)
    pts = spark.createDataFrame([(-34.7 + rnd.random() * 0.18, -58.53 + rnd.random() * 0.2) for _ in range(3000)], "r_lat double, r_lon double")
    tiles = choose_tiles(pts, 2.0)
    assert tiles.of_reference(pts, "r_lat", "r_lon").count() <= 4 * 3000
    assert tiles.of_targets(pts, "r_lat", "r_lon").count() == 3000


def test_tiles_meet_across_the_antimeridian_and_poles(spark):
    refs = [(1, 10.0, 60.0, -179.995), (2, 20.0, 60.001, 179.99), (3, 40.0, 89.999, 5.0), (4, 80.0, 89.999, -170.0), (5, 160.0, 0.0, 0.0)]
    tgts = [(10, 1.0, 60.0, 179.995), (11, 1.0, 89.9995, 100.0), (12, 1.0, float("nan"), 3.0)]
    got = {x["listing_id"]: x["n_nearby"] for x in radius_stats(spark.createDataFrame(tgts, SCHEMA), spark.createDataFrame(refs, SCHEMA), fallback=False, hot_cell_points=1).collect()}
    assert got == {10: 2, 11: 2, 12: 0}


def test_shuffled_points_are_packed_and_copies_added_up(spark):
    # Before, every reference point was a row of 8 bytes a column for each of its tiles.
    from tasador.operators.radius import packed, unpacked
    rows = [(k % 3, 0, 0, -34.6 - (k % 50) / 100, -58.4, 1, None if k % 7 == 0 else 0.25) for k in range(600)]
    df = spark.createDataFrame(rows, "ty long, tx long, salt int, r_lat double, r_lon double, n int, s double").coalesce(1)
    got = packed(df, "r_lat", "r_lon", ["n", "s"]).toArrow()
    assert got.num_rows == 3
    assert {x for kinds in got.column("kinds").to_pylist() for x in kinds[:1]} == {"|u1"}
    lat, lon, (n, s) = unpacked(got, 2)
    assert len(lat) == len(lon) == 150 and n.sum() == 600
    assert s.sum() == sum(r[-1] or 0 for r in rows)


def test_shuffled_points_take_few_bytes(spark):
    # Before, coordinates and a sum with its square took 32 bytes a point.
    from tasador.operators.radius import packed, restored, squeezed, unpacked
    rng = np.random.default_rng(3)
    y, x, s = -34.7 + rng.random(2000) * 0.1, -58.5 + rng.random(2000) * 0.1, rng.normal(0, 50, 2000)
    rows = [(0, 0, 0, a, b, c, c * c) for a, b, c in zip(y.tolist(), x.tolist(), s.tolist())]
    df = spark.createDataFrame(rows, "ty long, tx long, salt int, r_lat double, r_lon double, s1 double, s2 double").coalesce(1)
    got = packed(df, "r_lat", "r_lon", ["s1", "s2"]).toArrow()
    sent = sum(len(r[c]) for r in got.to_pylist() for c in ("lat", "lon")) + sum(len(v) for r in got.to_pylist() for v in r["values"])
    assert sent < 21 * 2000
    lat, lon, values = unpacked(got, 2)
    assert sorted(zip(lat, lon, *values)) == sorted(r[3:] for r in rows)
    for odd in (np.array([0.0]), np.array([-0.0, 0.0, 5e-324, -180.0, 180.0]), np.full(3, 7.25)):
        assert restored(squeezed(odd), len(odd)).tobytes() == odd.tobytes()
    copies = spark.createDataFrame([*rows[:5], *rows[:5]], df.schema).coalesce(1)  # a sum of squares that is no square
    assert unpacked(packed(copies, "r_lat", "r_lon", ["s1", "s2"]).toArrow(), 2)[2][1].sum() == pytest.approx(2 * (s[:5] ** 2).sum())


def test_reference_and_targets_are_not_checkpointed(spark, monkeypatch):
    # Before, the reference, its points and the targets' points were checkpointed as whole rows.
    r, done = spark.createDataFrame(_rows(50, 1), SCHEMA), []
    monkeypatch.setattr(type(r), "checkpoint", lambda self, eager=True: done.append(self.columns) or self)
    assert radius_stats(r, r, fallback=False).count() == 50
    assert not done


def test_features_are_joined_before_the_distances(spark):
    # Before, all forty features went through the shuffle of the join.
    from tasador.operators.features import build_features
    rows = [(i, 50.0, 1, 1.0, 0, -34.6 - i / 1e3, -58.4, "casa") for i in range(9)]
    df = spark.createDataFrame(rows, "listing_id long, area double, bedrooms long, bathrooms double, balcony_count long, latitude double, longitude double, property_type string")
    plan = build_features(df, df, "listing_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "dist_to_uca" not in plan[plan.index("Join"):]


@pytest.mark.parametrize("tile_rows", [4_000_000, 1])
def test_rows_take_their_columns_through_the_join(spark, tile_rows):
    # Before, the rows were shuffled a second time to join their points' sums, and so were the sums.
    from tasador.operators.neighborhood import reference_points
    from tasador.operators.radius import radius_row_sums
    refs = _rows(300, 1, dup=20)
    rows = [(7, "x", -34.65, -58.45), (7, None, -34.65, -58.45), (None, "y", refs[0][2], refs[0][3]), (8, "z", None, -58.45), (9, "w", float("nan"), 1.0), (9, "far", 10.0, 10.0)]
    t = spark.createDataFrame(rows, "id long, ty string, t_lat double, t_lon double")
    out = radius_row_sums(t, reference_points(spark.createDataFrame(refs, SCHEMA), 0.0), 2.0, ["n_rows", "s1"], ["id", "ty"], tile_rows=tile_rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("Join" in plan) == (tile_rows == 1)
    want = _brute([(i, 0, r[2] if r[2] == r[2] else None, r[3]) for i, r in enumerate(rows)], refs)
    got = {(r.id, r.ty): r.n_rows for r in out.collect()}
    assert len(got) == len(rows) and got == {r[:2]: want[i][0] or None for i, r in enumerate(rows)}
