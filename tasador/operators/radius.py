"""Radius range join (J1, J8): "every reference point within r km".

Open-source Catalyst has no range-join rewrite; a bare distance predicate
plans as a broadcast nested loop or a cartesian product. This module writes
the join as a grid equi-join whose shuffled rows grow with the points, not
with their pairs or the cells of a circle:

* Each task first reduces both sides to **distinct points**, a batch at a time: reference rows are
  added up per exact coordinate (row count, sums of the measure), so a
  group of copies at one address -- which may be a third of all rows --
  becomes a row a batch before any shuffle; targets are de-duplicated the same
  way, and again in their tile, and the result is joined back to them.
* What is shuffled is **packed** (``packed``): a row holds all points of a batch in one tile as arrays, numbers in
  as few bytes as hold them, coordinates by their distance from the least, squares of single rows not at all. This is the only shuffle of the reference, which is neither grouped nor copied before.
* The sphere is cut into **tiles** at least ``2 r`` wide (rows of latitude, each with a
  longitude width of its own). A target lies in one tile; a reference point goes to
  each tile within ``r`` of it, four at most (three on average, tiles being as wide as the cores allow), and both sides meet in a cogroup by tile.
* In a tile (``circle_sums``) the reference points are sorted into strips of latitude and small cells
  along them. A strip crosses a target's circle in one interval of longitude, whose least and
  largest half widths follow from the haversine formula at the strip's edges: what lies
  within the least is summed by a difference of two prefix sums, and only the points
  between the two are checked one by one. A target costs the root of the density, in time and not in rows.
* The check is the squared chord between unit vectors; only
  pairs within 1e-9 (relative) of the boundary evaluate the haversine, so
  the accepted set is exactly ``haversine <= r`` (the reference's rule) at
  the cost of the cheap test.
* Tiles with more than ``hot_cell_points`` distinct reference points are
  **salted**: these are spread over ``ceil(n / hot)`` groups, the tile's targets go to each,
  and the partial sums are added, so no task holds more than that many at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import EARTH_RADIUS_KM, chord2_for_radius
from ..session import ship_package

HOT_CELL_POINTS = 4_000_000  # a group of these takes under 1 GB in its task
TILE_POINTS = 1_000_000  # wanted in a tile at most, if it need not be less than 2 r wide for it
MAX_BROADCAST_HOT_CELLS = 100_000
TILE_ROWS = 4_000_000  # target rows that may go through a tile's task with their columns
_BAND = 1e-9
_MARGIN = 1e-7  # of the bounds on a strip's interval, far above rounding
_PAIRS = 1 << 20  # checked at a time
_FEW = 32  # points that are checked rather than taken from prefix sums


def grid_steps(max_abs_lat_deg: float, radius_km: float) -> tuple[float, int, float]:
    """Cell sizes in degrees: ``(lat_step, n_lon_cells, lon_step)``.

    Two points within ``r`` satisfy ``|dlat| <= r/R`` and
    ``sin(|dlon|/2) <= sin(r/2R) / cos(phi_max)``; both steps get a 1e-6
    safety margin and the longitude step divides 360 so cells wrap at the
    antimeridian."""
    ang = radius_km / EARTH_RADIUS_KM
    lat_step = math.degrees(ang) * (1 + 1e-6)
    c = math.cos(math.radians(min(90.0, max_abs_lat_deg)))
    s = math.sin(ang / 2) / c if c > 0 else 2.0
    dlon = 360.0 if s >= 1 else math.degrees(2 * math.asin(s)) * (1 + 1e-6)
    ncx = max(1, int(math.floor(360.0 / dlon)))
    return lat_step, ncx, 360.0 / ncx


def _degrees_within(radius_km: float, max_abs_lat: Column) -> Column:
    """Longitude that two points within the radius may lie apart at most, at latitudes up to
    ``max_abs_lat``: the bound of ``grid_steps`` as a column."""
    s = F.lit(math.sin(radius_km / EARTH_RADIUS_KM / 2)) / F.cos(F.radians(max_abs_lat))
    return F.when((max_abs_lat >= 90.0) | (s >= 1), F.lit(360.0)).otherwise(F.degrees(2 * F.asin(s)) * F.lit(1 + 1e-6))


class _Tiles:
    """Tiles of ``width`` radii: rows of latitude, each parted by its own width of longitude."""

    def __init__(self, radius_km: float, width: float):
        self.radius_km = radius_km
        self.halo = grid_steps(0.0, radius_km)[0]
        self.width, self.step = width, self.halo * width

    def row(self, lat: Column) -> Column:
        return F.floor((lat + F.lit(90.0)) / F.lit(self.step)).cast("bigint")

    def columns(self, row: Column) -> tuple[Column, Column]:
        """Number of tiles in a row, and the reach of its targets in tiles' widths."""
        south = row.cast("double") * F.lit(self.step) - F.lit(90.0)
        reach = F.greatest(F.abs(south - F.lit(self.halo)), F.abs(south + F.lit(self.step + self.halo)))
        degrees = _degrees_within(self.radius_km, reach)
        n = F.greatest(F.lit(1.0), F.floor(F.lit(360.0) / (degrees * F.lit(float(self.width)))))
        return n, degrees * n / F.lit(360.0)

    def of_targets(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        row = self.row(F.col(lat))
        n, _ = self.columns(row)
        return df.select("*", row.alias("ty"), F.pmod(F.floor(self.place(lon, n)), n).cast("bigint").alias("tx"))

    def of_reference(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """Each point once for every tile that may hold targets within the radius."""
        rows = F.sequence(self.row(F.col(lat) - F.lit(self.halo)), self.row(F.col(lat) + F.lit(self.halo)))
        d = df.select("*", F.explode(rows).alias("ty"))
        n, reach = self.columns(F.col("ty"))
        x = self.place(lon, n)
        spread = F.sequence(F.floor(x - reach).cast("bigint"), F.floor(x + reach).cast("bigint"))
        return d.select("*", F.explode(F.array_distinct(F.transform(spread, lambda i: F.pmod(i, n.cast("bigint"))))).alias("tx"))

    @staticmethod
    def place(lon: str, n: Column) -> Column:
        return (F.col(lon) + F.lit(180.0)) / F.lit(360.0) * n


def _points(lat: str, lon: str) -> Column:
    """About how many distinct points."""
    return F.approx_count_distinct(F.xxhash64(lat, lon))


def choose_tiles(reference: DataFrame, radius_km: float, r_lat: str = "r_lat", r_lon: str = "r_lon") -> _Tiles:
    """Tiles of at most about ``TILE_POINTS`` points, at least one a core and 2 to 64 radii wide: by the number of occupied cells
    of ``r`` and of the points in them. One small aggregate. The wider the tiles, the fewer points go to several."""
    fine = _Tiles(radius_km, 1)
    cells = fine.of_targets(reference.select(r_lat, r_lon), r_lat, r_lon).groupBy("ty", "tx").agg(_points(r_lat, r_lon).alias("n"))
    found = cells.agg(F.avg("n").alias("mean"), F.count(F.lit(1)).alias("cells")).first()
    tiles = reference.sparkSession.sparkContext.defaultParallelism
    width = math.sqrt(min(TILE_POINTS / max(1.0, found["mean"] or 1.0), found["cells"] / tiles))
    return _Tiles(radius_km, min(64.0, max(2.0, width)))


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    p, l = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(p) * np.cos(l), np.cos(p) * np.sin(l), np.sin(p)])


def _within(t_lat, t_lon, t, r_lat, r_lon, r, radius_km: float) -> np.ndarray:
    """Whether pairs of points, given as degrees and unit vectors, lie within the radius."""
    c2 = chord2_for_radius(radius_km)
    d = t[0] - r[0]
    chord2 = d * d
    for k in (1, 2):
        d = t[k] - r[k]
        chord2 += d * d
    ok = chord2 <= c2 * (1 - _BAND)
    at = np.flatnonzero(~ok & (chord2 <= c2 * (1 + _BAND)))
    if len(at):
        p1, l1, p2, l2 = (np.radians(x) for x in (t_lat(at), t_lon(at), r_lat(at), r_lon(at)))
        a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((l2 - l1) / 2) ** 2
        ok[at] = 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(1.0, a))) <= radius_km
    return ok


def circle_sums(t_lat: np.ndarray, t_lon: np.ndarray, r_lat: np.ndarray, r_lon: np.ndarray, values: list[np.ndarray],
                radius_km: float, few: int = _FEW) -> np.ndarray:
    """(values + 1) x targets: the sums of each of ``values`` and the number of points over the reference points within the
    radius of each target. Coordinates are finite."""
    out = np.zeros((len(values) + 1, len(t_lat)))
    odd = np.zeros(len(r_lat), dtype=bool)
    for v in values:
        odd |= ~np.isfinite(v)
    if odd.any():
        # Sums of these would spoil the prefix sums: they are checked one by one.
        for rows, least in ((odd, len(r_lat) + 1), (~odd, few)):
            if rows.any():
                out += _strips(t_lat, t_lon, r_lat[rows], r_lon[rows], [v[rows] for v in values], radius_km, least)
        return out
    return _strips(t_lat, t_lon, r_lat, r_lon, values, radius_km, few)


def _all_pairs(t_lat, t_lon, r_lat, r_lon, values, radius_km: float) -> np.ndarray:
    """``circle_sums`` pair by pair: for circles that reach around a pole or half the sphere."""
    out = np.zeros((len(values) + 1, len(t_lat)))
    t, r = _unit(t_lat, t_lon), _unit(r_lat, r_lon)
    for a in range(len(t_lat)):
        for b in range(0, len(r_lat), _PAIRS):
            part = slice(b, b + _PAIRS)
            ok = _within(lambda _: t_lat[a], lambda _: t_lon[a], t[:, a], lambda i: r_lat[part][i], lambda i: r_lon[part][i], r[:, part], radius_km)
            for k, v in enumerate(values):
                out[k, a] += v[part][ok].sum()
            out[-1, a] += ok.sum()
    return out


def _strips(t_lat, t_lon, r_lat, r_lon, values, radius_km: float, few: int) -> np.ndarray:
    ang = radius_km / EARTH_RADIUS_KM
    # Longitudes relative to one target, so a tile across the antimeridian is whole.
    centre = t_lon[0]
    t_rel, r_rel = ((x - centre + 540.0) % 360.0 - 180.0 for x in (t_lon, r_lon))
    high = max(np.abs(t_lat).max(), np.abs(r_lat).max())
    steep = math.sin(ang) / math.cos(math.radians(np.abs(t_lat).max())) if high < 90 else 1.0
    widest = 180.0 if steep >= 1 or ang >= math.pi / 4 else math.degrees(math.asin(steep))
    if widest * (1 + _MARGIN) + np.abs(t_rel).max() + 1e-6 >= 180.0:
        return _all_pairs(t_lat, t_lon, r_lat, r_lon, values, radius_km)

    # Strips and cells of a few points each, by the mean density.
    n = len(r_lat)
    south, west = r_lat.min(), r_rel.min()
    tall, wide = r_lat.max() - south, r_rel.max() - west
    across = max(1e-9, math.cos(math.radians(np.abs(r_lat).min())))
    side = math.sqrt(3.3 * max(tall * wide * across, 1e-12) / n)  # degrees of latitude
    rows, cols = (int(min(8192, max(1, math.ceil(x)))) for x in (tall / side, 4 * wide * across / side))
    if (over := rows * cols / (8 * n + 1024)) > 1:
        rows, cols = max(1, int(rows / math.sqrt(over))), max(1, int(cols / math.sqrt(over)))
    row_step, col_step = (x / k if x else 1.0 for x, k in ((tall, rows), (wide, cols)))
    row = np.minimum((r_lat - south) / row_step, rows - 1).astype(np.int64)
    col = np.minimum((r_rel - west) / col_step, cols - 1).astype(np.int64)
    cell = row * cols + col
    order = np.argsort(cell, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=rows * cols))])
    r_lat, r_lon = r_lat[order], r_lon[order]
    values = [v[order] for v in [*values, np.ones(n)]]
    # Whole numbers add up exactly; others do so with more digits than they have.
    prefix = [np.concatenate([[0], np.cumsum(v if (v == np.rint(v)).all() else v.astype(np.longdouble))]) for v in values]
    r = _unit(r_lat, r_lon)
    edges = np.radians(south + np.arange(rows + 1) * row_step)
    cos_edges = np.cos(edges)
    s2 = math.sin(ang / 2) ** 2

    out = np.zeros((len(values), len(t_lat)))
    t = _unit(t_lat, t_lon)
    # Neighbours in both directions come together.
    band = np.floor((t_lat - t_lat.min()) / max(math.degrees(ang) / 8, 1e-9))
    todo = np.lexsort((t_rel, band))
    at = 0
    block = 64
    while at < len(todo):
        own = todo[at : at + block]
        at += block
        phi, x = np.radians(t_lat[own]), t_rel[own]
        reach = math.degrees(ang) * (1 + _MARGIN)
        first = int(max(0, math.floor((t_lat[own].min() - reach - south) / row_step) - 1))
        last = int(min(rows - 1, math.floor((t_lat[own].max() + reach - south) / row_step) + 1))
        if last < first:
            continue
        e = slice(first, last + 2)
        apart = np.sin((edges[e] - phi[:, None]) / 2) ** 2
        scale = np.cos(phi)[:, None] * cos_edges[e]

        def half_width(bound: float) -> np.ndarray:
            left = bound - apart
            return np.where(left < 0, -1.0, 2 * np.degrees(np.arcsin(np.sqrt(np.clip(left / scale, 0.0, 1.0)))))

        inner, outer = half_width(s2 * (1 - _MARGIN)), half_width(s2 * (1 + _MARGIN))
        inner = np.minimum(inner[:, :-1], inner[:, 1:]) * (1 - _MARGIN)
        outer = np.maximum(outer[:, :-1], outer[:, 1:])
        # The circle is widest at a latitude of its own, which lies in one strip.
        peak = np.degrees(np.arcsin(np.sin(phi) / math.cos(ang)))
        most = np.degrees(np.arcsin(np.minimum(1.0, math.sin(ang) / np.cos(phi))))
        strip = np.floor((peak - south) / row_step).astype(np.int64) - first
        for k in (-1, 0, 1):
            here = np.flatnonzero((strip + k >= 0) & (strip + k <= last - first))
            outer[here, strip[here] + k] = np.maximum(outer[here, strip[here] + k], most[here])
        target, strip = np.nonzero(outer >= 0)
        i, o, x0 = inner[target, strip], outer[target, strip] * (1 + _MARGIN) + 1e-10, x[target]
        base = (strip + first) * cols
        place = lambda y: np.clip(np.floor((y - west) / col_step), -1, cols).astype(np.int64)
        a, d = place(x0 - o), place(x0 + o) + 1
        b, c = place(x0 - i + 1e-10) + 1, place(x0 + i - 1e-10)
        a, b, c, d = (starts[base + np.clip(y, 0, cols)] for y in (a, b, c, d))
        taken = (i > 0) & (c - b >= few)
        if taken.any():
            lo, hi, who = b[taken], c[taken], target[taken]
            for k, sums in enumerate(prefix):
                out[k, own] += np.bincount(who, (sums[hi] - sums[lo]).astype(np.float64), minlength=len(own))
        # Windows to check: both ends of a strip with an inner part, else all of it.
        lo = np.concatenate([a, c[taken]])
        hi = np.concatenate([np.where(taken, b, d), d[taken]])
        who = np.concatenate([target, target[taken]])
        some = np.flatnonzero(hi > lo)
        lo, size, who = lo[some], (hi - lo)[some], who[some]
        total = np.cumsum(size)
        part = 0
        while part < len(size):
            stop = max(part + 1, int(np.searchsorted(total, (total[part - 1] if part else 0) + _PAIRS, "right")))
            z = size[part:stop]
            ends = np.cumsum(z)
            ref = np.arange(ends[-1]) + np.repeat(lo[part:stop] - ends + z, z)
            tgt = np.repeat(who[part:stop], z)
            mine = own[tgt]
            ok = np.flatnonzero(_within(lambda j: t_lat[mine[j]], lambda j: t_lon[mine[j]], t[:, own][:, tgt], lambda j: r_lat[ref[j]], lambda j: r_lon[ref[j]],
                                        [x[ref] for x in r], radius_km))
            ref, tgt = ref[ok], tgt[ok]
            for k, v in enumerate(values):
                out[k, own] += np.bincount(tgt, v[ref], minlength=len(own))
            part = stop
        if len(size):
            block = int(min(1024, max(1, block * min(2.0, _PAIRS / 4 / total[-1]))))
    return out


PACKED = "lat binary, lon binary, kinds array<string>, values array<binary>, n int"
_SQUARE = "square"  # kind of a sum that is the square of the one before, point by point


def narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as hold them, if they are whole."""
    if not len(x) or not np.isfinite(x).all() or (x != np.rint(x)).any() or np.abs(x).max() >= 2.0**53:
        return x
    return x.astype(np.result_type(np.min_scalar_type(int(x.min())), np.min_scalar_type(int(x.max()))))


def squeezed(x: np.ndarray) -> bytes:
    """Doubles as the least of their bit patterns (8 bytes) and how far each lies above it, in as few bytes as hold
    the largest: neighbouring coordinates share their first bytes."""
    bits = np.ascontiguousarray(x, dtype="<f8").view("<u8")
    least = bits.min()
    above = bits - least
    size = (int(above.max()).bit_length() + 7) // 8
    return least.tobytes() + np.ascontiguousarray(above.view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def restored(data: bytes, n: int) -> np.ndarray:
    """The ``n`` doubles that ``squeezed`` was given, to the last bit."""
    above = np.zeros((n, 8), dtype=np.uint8)
    size = (len(data) - 8) // n
    above[:, :size] = np.frombuffer(data, np.uint8, offset=8).reshape(n, size)
    return (above.reshape(-1).view("<u8") + np.frombuffer(data[:8], "<u8")).view("<f8")


def packed_sums(values: list[np.ndarray]) -> tuple[list[str], list[bytes]]:
    """Kinds and bytes of the sums of a batch's points in a tile. A sum of squares over single rows is not sent."""
    kinds, out = [], []
    for before, v in zip([None, *values], values, strict=False):
        if before is not None and np.array_equal(v, before * before):
            kinds.append(_SQUARE)
            out.append(b"")
        else:
            short = narrow(v)
            kinds.append(short.dtype.str)
            out.append(short.tobytes())
    return kinds, out


def unpacked_sums(kinds: list[str], data: list[bytes]) -> list[np.ndarray]:
    """What ``packed_sums`` was given."""
    out: list[np.ndarray] = []
    for kind, x in zip(kinds, data, strict=True):
        if kind == _SQUARE:
            out.append(out[-1] * out[-1])
        else:
            out.append(np.frombuffer(x, kind).astype(np.float64))
    return out


def packed(points: DataFrame, lat: str, lon: str, sums: Sequence[str]) -> DataFrame:
    """(ty, tx, salt, PACKED) of rows with their tiles: each batch's distinct points of a tile with their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(k).to_numpy() for k in range(3)]
            y, x, *values = (batch.column(k).fill_null(0.0).to_numpy(zero_copy_only=False) for k in range(3, batch.num_columns))
            order = np.lexsort((x, y, *keys))
            keys, y, x = [k[order] for k in keys], y[order], x[order]
            tile = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
            firsts = np.flatnonzero(tile | np.r_[True, (y[1:] != y[:-1]) | (x[1:] != x[:-1])])
            values = [np.add.reduceat(v[order], firsts) for v in values]
            keys, y, x = [k[firsts] for k in keys], y[firsts], x[firsts]
            starts = np.flatnonzero(tile[firsts])
            parts = [slice(*ends) for ends in zip(starts.tolist(), [*starts[1:].tolist(), len(y)], strict=True)]
            short = [packed_sums([v[part] for v in values]) for part in parts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k[starts]) for k in keys), *(pa.array([squeezed(v[part]) for part in parts], pa.binary()) for v in (y, x)),
                 pa.array([kinds for kinds, _ in short], pa.list_(pa.string())), pa.array([data for _, data in short], pa.list_(pa.binary())), pa.array([part.stop - part.start for part in parts], pa.int32())],
                names=["ty", "tx", "salt", "lat", "lon", "kinds", "values", "n"])

    return points.select("ty", "tx", "salt", lat, lon, *[F.col(s).cast("double").alias(f"_v{i}") for i, s in enumerate(sums)]).mapInArrow(run, f"ty bigint, tx bigint, salt int, {PACKED}")


def packed_rows(points: DataFrame, lat: str, lon: str, columns: Sequence[str]) -> DataFrame:
    """(ty, tx, salt, lat, lon, n, c0, c1, ...) of rows with their tiles: each batch's rows of a tile, whose ``columns`` are arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(k).to_numpy() for k in range(3)]
            order = np.lexsort(keys)
            keys = [k[order] for k in keys]
            starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            ends = np.r_[starts[1:], len(order)]
            y, x = (batch.column(k).to_numpy(zero_copy_only=False)[order] for k in (3, 4))
            offsets, rows = pa.array(np.r_[0, ends], pa.int32()), pa.array(order)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k[starts]) for k in keys), *(pa.array([squeezed(v[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()) for v in (y, x)),
                 pa.array(ends - starts, pa.int32()), *(pa.ListArray.from_arrays(offsets, batch.column(k).take(rows)) for k in range(5, batch.num_columns))], names=names)

    kinds = T.StructType([*T._parse_datatype_string("ty bigint, tx bigint, salt int, lat binary, lon binary, n int").fields,
                          *(T.StructField(f"c{i}", T.ArrayType(points.schema[c].dataType)) for i, c in enumerate(columns))])
    names = kinds.names
    return points.select("ty", "tx", "salt", lat, lon, *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, kinds)


def unpacked(table: pa.Table, sums: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Latitudes, longitudes and sums of PACKED rows."""
    n = table.column("n").to_pylist()
    lat, lon = (np.concatenate([restored(x, k) for x, k in zip(table.column(c).to_pylist(), n, strict=True)]) for c in ("lat", "lon"))
    rows = [unpacked_sums(k, v) for k, v in zip(table.column("kinds").to_pylist(), table.column("values").to_pylist(), strict=True)]
    return lat, lon, [np.concatenate([row[i] for row in rows]) for i in range(sums)]


def radius_point_aggregate(targets: DataFrame, reference: DataFrame, radius_km: float,
                           sums: Sequence[str], t_lat: str = "t_lat", t_lon: str = "t_lon",
                           r_lat: str = "r_lat", r_lon: str = "r_lon",
                           hot_cell_points: int = HOT_CELL_POINTS) -> DataFrame:
    """Core of J1/J8 on points.

    ``targets``: rows with ``(t_lat, t_lon)``, read once.
    ``reference``: rows with ``(r_lat, r_lon)`` and additive
    columns ``sums`` (counts, sums), read three times. Points may repeat on both sides; those with
    a NULL or non-finite coordinate take no part. Returns ``(t_lat, t_lon, *sums)`` of distinct targets, summed
    over all reference points with ``haversine <= radius_km``; targets with
    no match are absent (callers left-join). A NULL among the sums adds nothing."""
    finite = _finite(t_lat, t_lon)
    tgt, ref, keys, salted = _sides(targets.filter(finite).select(t_lat, t_lon), reference, radius_km, sums, t_lat, t_lon, r_lat, r_lon, hot_cell_points)
    return _point_sums(tgt, ref, keys, salted, radius_km, sums, t_lat, t_lon, r_lat, r_lon)


def radius_row_sums(rows: DataFrame, reference: DataFrame, radius_km: float, sums: Sequence[str], columns: Sequence[str],
                    t_lat: str = "t_lat", t_lon: str = "t_lon", r_lat: str = "r_lat", r_lon: str = "r_lon",
                    hot_cell_points: int = HOT_CELL_POINTS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``columns`` of every row of ``rows`` with its ``sums`` as by ``radius_point_aggregate``, NULL where it gives none.

    The rows, read three times, go to their tile with their columns, so that nothing is joined back: that would shuffle the
    rows again, and a row of sums for each of their points. Only if a tile has more than ``tile_rows`` of them, or is
    salted, they stay and the points' sums are joined to them."""
    # Names of their own: a column may be called as a tile's.
    own = {f"__c{i}": c for i, c in enumerate(columns)}
    rows = rows.select(F.col(t_lat).alias("__lat"), F.col(t_lon).alias("__lon"), *[F.col(f"`{c}`").alias(k) for k, c in own.items()])
    finite = _finite("__lat", "__lon")
    tgt, ref, keys, salted = _sides(rows.filter(finite), reference, radius_km, sums, "__lat", "__lon", r_lat, r_lon, hot_cell_points)
    most = None if salted else tgt.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if salted or most > tile_rows:
        found = rows.filter(finite).join(_point_sums(tgt, ref, keys, salted, radius_km, sums, "__lat", "__lon", r_lat, r_lon), ["__lat", "__lon"], "left").select(*own, *sums)
    else:
        found = _row_sums(tgt, ref, keys, radius_km, sums, list(own), "__lat", "__lon", r_lat, r_lon)
    # Rows without a place match nothing.
    found = found.unionByName(rows.filter(~finite).select(*own, *[F.lit(None).cast(found.schema[s].dataType).alias(s) for s in sums]))
    return found.select(*[F.col(k).alias(c) for k, c in own.items()], *sums)


def _finite(lat: str, lon: str) -> Column:
    inside = lambda c: F.abs(F.col(c)) < F.lit(float("inf"))  # noqa: E731  -- NaN is larger
    return F.coalesce(inside(lat) & inside(lon), F.lit(False))


def _sides(targets: DataFrame, reference: DataFrame, radius_km: float, sums: Sequence[str], t_lat: str, t_lon: str, r_lat: str, r_lon: str,
           hot_cell_points: int) -> tuple[DataFrame, DataFrame, list[str], bool]:
    """Both sides with their tiles, the names of the tiles' columns, and whether tiles are salted."""
    spark = targets.sparkSession
    ship_package(spark.sparkContext.applicationId)
    reference = reference.filter(_finite(r_lat, r_lon)).select(r_lat, r_lon, *sums)
    tiles = choose_tiles(reference, radius_km, r_lat, r_lon)
    ref = tiles.of_reference(reference, r_lat, r_lon)
    tgt = tiles.of_targets(targets, t_lat, t_lon)
    keys = ["ty", "tx"]
    hot = (ref.groupBy(*keys).agg(_points(r_lat, r_lon).alias("_n")).filter(F.col("_n") > F.lit(hot_cell_points))
           .select(*keys, F.ceil(F.col("_n") / F.lit(float(hot_cell_points))).cast("int").alias("_ns")))
    hot_rows = hot.limit(MAX_BROADCAST_HOT_CELLS + 1).collect()
    if hot_rows:
        small = len(hot_rows) <= MAX_BROADCAST_HOT_CELLS
        hot_t = F.broadcast(spark.createDataFrame(hot_rows, hot.schema)) if small else hot
        ref = (ref.join(hot_t, keys, "left")
               .withColumn("salt", F.pmod(F.xxhash64(r_lat, r_lon), F.coalesce(F.col("_ns"), F.lit(1))).cast("int")).drop("_ns"))
        tgt = (tgt.join(hot_t, keys, "left")
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ns"), F.lit(1)) - 1))).drop("_ns"))
    else:
        ref, tgt = ref.withColumn("salt", F.lit(0)), tgt.withColumn("salt", F.lit(0))
    return tgt, ref, [*keys, "salt"], bool(hot_rows)


def _kinds(ref: DataFrame, sums: Sequence[str]) -> list:
    """Types of the sums."""
    return [T.LongType() if ref.schema[s].dataType.simpleString() in ("bigint", "int") else T.DoubleType() for s in sums]


def _arrow(values: np.ndarray, kind, none: np.ndarray | None = None) -> pa.Array:
    whole = isinstance(kind, T.LongType)
    return pa.array(np.rint(values).astype(np.int64) if whole else values, pa.int64() if whole else pa.float64(), mask=none)


def _row_sums(tgt: DataFrame, ref: DataFrame, keys: list[str], radius_km: float, sums: Sequence[str], columns: Sequence[str],
              t_lat: str, t_lon: str, r_lat: str, r_lon: str) -> DataFrame:
    """``columns`` and ``sums`` of every target row, the tiles not salted."""
    kinds = _kinds(ref, sums)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = [left.column(f"c{i}").combine_chunks().flatten() for i in range(len(columns))]
        if left.num_rows:
            n = left.column("n").to_pylist()
            lat, lon = (np.concatenate([restored(x, k) for x, k in zip(left.column(c).to_pylist(), n, strict=True)]) for c in ("lat", "lon"))
            points, at = np.unique(np.stack([lat, lon], axis=1), axis=0, return_inverse=True)
            at = at.reshape(-1)
        else:
            points, at = np.empty((0, 2)), np.empty(0, np.int64)
        found = np.zeros((len(sums) + 1, len(points)))
        if len(points) and right.num_rows:
            y, x, values = unpacked(right, len(sums))
            found = circle_sums(*np.ascontiguousarray(points.T), y, x, values, radius_km)
        none = (found[-1] == 0)[at]
        return pa.Table.from_arrays([*own, *(_arrow(v[at], k, none) for v, k in zip(found, kinds))], names=names)

    out = T.StructType([*(T.StructField(c, tgt.schema[c].dataType) for c in columns), *(T.StructField(s, k) for s, k in zip(sums, kinds))])
    names = out.names
    n = join_partitions(tgt.sparkSession)
    tgt, ref = packed_rows(tgt, t_lat, t_lon, columns), packed(ref, r_lat, r_lon, sums)
    return tgt.repartition(n, *keys).groupBy(*keys).cogroup(ref.repartition(n, *keys).groupBy(*keys)).applyInArrow(run, out)


def _point_sums(tgt: DataFrame, ref: DataFrame, keys: list[str], salted: bool, radius_km: float, sums: Sequence[str],
                t_lat: str, t_lon: str, r_lat: str, r_lon: str) -> DataFrame:
    """``sums`` of every distinct target point that has any."""
    spark = tgt.sparkSession
    kinds = _kinds(ref, sums)
    out = T.StructType([T.StructField(t_lat, T.DoubleType()), T.StructField(t_lon, T.DoubleType()), *(T.StructField(s, k) for s, k in zip(sums, kinds))])
    names = out.names

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([_arrow(np.empty(0), f.dataType) for f in out.fields], names=names)
        points = np.unique(np.stack(unpacked(left, 0)[:2], axis=1), axis=0)
        lat, lon = np.ascontiguousarray(points.T)
        y, x, values = unpacked(right, len(kinds))
        found = circle_sums(lat, lon, y, x, values, radius_km)
        met = np.flatnonzero(found[-1] > 0)
        return pa.Table.from_arrays([_arrow(v[met], f.dataType) for v, f in zip([lat, lon, *found[:-1]], out.fields, strict=True)], names=names)

    # The inputs are small in bytes but the work is not: left alone, AQE would
    # coalesce the tiles into a few tasks. The explicit count is never coalesced.
    n = join_partitions(spark)
    tgt, ref = packed(tgt, t_lat, t_lon, []), packed(ref, r_lat, r_lon, sums)
    met = (tgt.repartition(n, *keys).groupBy(*keys).cogroup(ref.repartition(n, *keys).groupBy(*keys))
           .applyInArrow(run, out))
    return met.groupBy(t_lat, t_lon).agg(*[F.sum(s).alias(s) for s in sums]) if salted else met


def join_partitions(spark) -> int:
    """Partitions for the join of the tiles: the configured shuffle
    partitions, at least sixteen per available core, so that few tiles share one."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, 16 * spark.sparkContext.defaultParallelism)
