"""Exact greedy leader clustering on a circle, spread over many tasks.

The greedy rule reads points in a given order; a point joins the earliest leader that is
within ``slop`` on both coordinates, else it becomes a leader. Whether a point is a leader
depends only on earlier leaders within ``slop`` of it. An assignment in which that holds at
every point is the only one, whatever way it was found.

So the points are cut into square tiles of the (left, right) plane, and every tile first settles
its points together with a halo of its neighbours' points, as if there were nothing else. What it
believed about leaders just outside is then compared with what the neighbours found. Tiles that
believed rightly are done and their points stay in the table they were written to; only the others
run again, now with the neighbours' leaders given. What lies beyond the halo seldom matters, so
one or two such passes are the rule. Points in a full regular lattice, read in the order of their
coordinates, are the exception: there a shift travels from tile to tile, one a pass.

Only distinct coordinates enter a tile, so the size of a tile is bounded by its area however
many rows share one coordinate. Order columns are made one number by a sort in Spark, nulls first.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.durable import materialize
from circlet.operators.ranking import numbered

TILE_POINTS = 100_000
HALO_SLOPS = 8
FIELDS = "ord long, l int, r int, leader_l int, leader_r int, home boolean"


def tile_geometry(length: int, slop: int, points: int, tile_points: int = TILE_POINTS) -> tuple[int, int, int]:
    """(side, halo, number of tiles per axis) for a table of ``points`` distinct coordinates.

    Aims at ``tile_points`` per tile on average. Sides shrink as the table grows, so even if all
    points crowd into one tile it holds at most a few million of them.
    """
    halo = HALO_SLOPS * slop
    smallest = max(24 * slop, 2 * halo)
    wanted = max(1, math.isqrt(points // tile_points) + (points > tile_points))
    count = max(1, min(wanted, length // smallest))
    return length // count, halo, count


class _Cells:
    """Points in cells so narrow that a cell holds one leader at most."""

    def __init__(self, left: np.ndarray, right: np.ndarray, slop: int, length: int):
        self.left, self.right, self.slop, self.length = left, right, slop, length
        n = -(-length // (slop + 1))
        reach = 1 if length // n >= slop else 2
        moves = np.unique(np.arange(-reach, reach + 1) % n)
        a, b = (left - 1) * n // length, (right - 1) * n // length
        keys, self.own = np.unique(a * n + b, return_inverse=True)
        self.near = np.empty((len(left), len(moves) ** 2), dtype=np.int32)
        for low in range(0, len(left), 1 << 16):
            at = slice(low, low + (1 << 16))
            near = (((a[at, None] + moves) % n)[:, :, None] * n + ((b[at, None] + moves) % n)[:, None, :]).reshape(-1, len(moves) ** 2)
            place = np.minimum(np.searchsorted(keys, near), len(keys) - 1)
            self.near[at] = np.where(keys[place] == near, place, len(keys))
        self.members = np.append(np.bincount(self.own, minlength=len(keys)), 0)
        self.leader = np.full(len(keys) + 1, -1, dtype=np.int64)

    def close(self, rows: np.ndarray) -> np.ndarray:
        """For each row and neighbouring cell: the cell's leader if it is within slop, else -1."""
        found = self.leader[self.near[rows]]
        x = np.abs(self.left[rows][:, None] - self.left[found])
        y = np.abs(self.right[rows][:, None] - self.right[found])
        fits = (np.minimum(x, self.length - x) <= self.slop) & (np.minimum(y, self.length - y) <= self.slop)
        return np.where(fits, found, -1)

    def any_close(self, i: int, near: list[int]) -> bool:
        """The same for one row, whether any is."""
        leader, left, right, slop, far = self.leader, self.left, self.right, self.slop, self.length - self.slop
        for cell in near:
            j = leader[cell]
            if j >= 0:
                x, y = abs(left[i] - left[j]), abs(right[i] - right[j])
                if (x <= slop or x >= far) and (y <= slop or y >= far):
                    return True
        return False


def greedy(left: np.ndarray, right: np.ndarray, given: np.ndarray, slop: int, length: int) -> np.ndarray:
    """Index of the leader of every point, for points in their order; ``given`` marks leaders known from elsewhere.

    Blocks of points are compared with the leaders so far at once. Only those without a close leader are looked
    at one by one, so Python steps are about as many as leaders.
    """
    n = len(left)
    if not n:
        return np.zeros(0, dtype=np.int64)
    cells = _Cells(left.astype(np.int64), right.astype(np.int64), slop, length)
    alone = sum(cells.members[column] for column in cells.near.T) == 1
    cells.leader[cells.own[alone]] = np.flatnonzero(alone)
    open_points = np.flatnonzero(~alone)
    low, size = 0, 64
    while low < len(open_points):
        block = open_points[low : low + size]
        free = block[given[block] | (cells.close(block) < 0).all(axis=1)]
        for i, near in zip(free.tolist(), cells.near[free].tolist()):
            own = cells.own[i]
            if cells.leader[own] < 0 and (given[i] or not cells.any_close(i, near)):
                cells.leader[own] = i
        low += size
        size = min(8192, size * 2) if 4 * len(free) < size else max(64, size // 2)
    out = np.empty(n, dtype=np.int64)
    for low in range(0, n, 1 << 16):
        rows = np.arange(low, min(n, low + (1 << 16)))
        close = cells.close(rows)
        out[rows] = np.where(close < 0, n, close).min(axis=1)
    return out


def _settle(pdf: pd.DataFrame, slop: int, length: int) -> pd.DataFrame:
    """Leaders of a tile's points, and of the points around it as the tile sees them."""
    pdf = pdf.sort_values("ord", kind="stable").reset_index(drop=True)
    left, right = pdf["l"].to_numpy(), pdf["r"].to_numpy()
    chosen = greedy(left, right, pdf["given"].to_numpy(), slop, length)
    return pdf.assign(leader_l=left[chosen].astype("int32"), leader_r=right[chosen].astype("int32"))


class _Tiling:
    def __init__(self, keys: list[str], slop: int, length: int, geometry: tuple[int, int, int]):
        self.keys, self.slop, self.length, (self.side, self.halo, self.count) = keys, slop, length, geometry
        self.tile_keys = [*keys, "tl", "tr"]

    def _tile(self, position):
        offset = F.pmod(position - 1, F.lit(self.length))
        return F.least(F.floor(offset / self.side), F.lit(self.count - 1)).cast("int")

    def spread(self, points: DataFrame, reach: int) -> DataFrame:
        """Each point in its own tile and in those within ``reach`` of it."""

        def tiles(name):
            return F.array_distinct(F.array(*[self._tile(v) for v in (F.col(name) - reach, F.col(name), F.col(name) + reach)]))

        placed = points.withColumn("tl", F.explode(tiles("l"))).withColumn("tr", F.explode(tiles("r")))
        return placed.withColumn("home", (F.col("tl") == self._tile(F.col("l"))) & (F.col("tr") == self._tile(F.col("r"))))

    def settle(self, placed: DataFrame) -> DataFrame:
        """keys, tl, tr and the fields of ``FIELDS`` for all points of each tile."""
        slop, length = self.slop, self.length
        schema = T.StructType([*[placed.schema[k] for k in self.tile_keys], *T._parse_datatype_string(FIELDS).fields])
        names = schema.names

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return _settle(pdf, slop, length)[names]

        return placed.groupBy(*self.tile_keys).applyInPandas(run, schema)

    def beyond(self, settled: DataFrame) -> DataFrame:
        """Leaders that a tile believed in, within slop of it."""
        lead = settled.filter("not home and l = leader_l and r = leader_r").select(*self.tile_keys, "ord", "l", "r")
        return lead.filter(self._reaches("l", "tl") & self._reaches("r", "tr"))

    def _reaches(self, name: str, tile: str):
        return F.array_contains(F.array(*[self._tile(F.col(name) + d) for d in (-self.slop, 0, self.slop)]), F.col(tile))

    def around(self, settled: DataFrame) -> DataFrame:
        """Leaders as their own tiles have them, in the other tiles within slop."""
        lead = settled.filter("home and l = leader_l and r = leader_r").select(*self.keys, "ord", "l", "r")
        return self.spread(lead, self.slop).filter("not home").drop("home")

    def differing(self, believed: DataFrame, found: DataFrame) -> DataFrame:
        """Tiles in which two lists of leaders differ."""

        def signed(table, sign):
            return table.select(*self.tile_keys, "ord", F.lit(sign).alias("s"))

        both = signed(believed, 1).unionByName(signed(found, -1))
        return both.groupBy(*self.tile_keys, "ord").agg(F.sum("s").alias("s")).filter("s <> 0").select(*self.tile_keys).distinct()


def assign_leaders(
    rows: DataFrame, keys: list[str], left: str, right: str, order: list[str], slop: int, length: int,
    tile_points: int = TILE_POINTS, passes: list[int] | None = None,
) -> DataFrame:
    """(keys, left, right) -> leader_left, leader_right for every distinct coordinate.

    ``order`` names the columns whose smallest tuple decides when a coordinate is first met, nulls first.
    Clusters never cross ``keys``. The leader's coordinate identifies the cluster inside its key.
    ``passes`` takes the number of tiles that ran in each pass.
    """
    if slop <= 0:
        distinct = rows.select(*keys, left, right).distinct()
        return distinct.withColumns({"leader_left": F.col(left), "leader_right": F.col(right)})
    if 4 * slop >= length:
        raise ValueError("slop must be smaller than a quarter of the circle")
    names = [f"o{i}" for i in range(len(order))]
    first = F.min(F.struct(*[F.col(c).alias(o) for c, o in zip(order, names)]))
    distinct = rows.groupBy(*keys, F.col(left).cast("int").alias("l"), F.col(right).cast("int").alias("r")).agg(first.alias("_first"))
    ranked = numbered(distinct.select(*keys, "l", "r", *[F.col("_first")[o].alias(o) for o in names]), [*names, "l", "r"], "ord").drop(*names)
    points = materialize(ranked, "points")
    tiling = _Tiling(keys, slop, length, tile_geometry(length, slop, points.count(), tile_points))
    placed = tiling.spread(points, tiling.halo).withColumn("given", F.lit(False))
    settled = materialize(tiling.settle(placed), "leaders")
    done, believed = settled.filter("home"), tiling.beyond(settled)
    while True:
        found = tiling.around(done)
        again = materialize(tiling.differing(believed, found), "tiles")
        n = again.count()
        if passes is not None:
            passes.append(n)
        if not n:
            break
        own = tiling.spread(points, 0).withColumn("given", F.lit(False)).join(again, tiling.tile_keys, "left_semi")
        given = found.join(again, tiling.tile_keys, "left_semi").withColumns({"home": F.lit(False), "given": F.lit(True)})
        redone = materialize(tiling.settle(own.unionByName(given)), "leaders")
        done = done.join(again, tiling.tile_keys, "left_anti").unionByName(redone.filter("home"))
        believed = found.join(again, tiling.tile_keys, "left_semi").unionByName(believed.join(again, tiling.tile_keys, "left_anti"))
    return done.select(*keys, F.col("l").alias(left), F.col("r").alias(right), F.col("leader_l").alias("leader_left"), F.col("leader_r").alias("leader_right"))
