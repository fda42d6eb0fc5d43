"""Tables of queries, points and cameras: lifting, reprojection, synthetic tracks, resampling of grids, sampled points."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import geometry as g
from tracewright.operators.matching import grid_neighbours
from tracewright.operators.transforms import uniform


def lift_queries(queries: DataFrame, depth: DataFrame, frame: Sequence[str], k: str = "k", w2c: str = "w2c") -> DataFrame:
    """Queries (frame keys, x, y, k, w2c) to world points by the depth (frame keys, u, v, depth) of the nearest pixel (half to even); queries without depth fall away."""
    near = queries.withColumns({"u": F.bround("x").cast("long"), "v": F.bround("y").cast("long")})
    met = near.join(depth.select(*frame, "u", "v", "depth").filter("depth > 0"), [*frame, "u", "v"])
    world = g.apply_extrinsics(g.inverse_se3(F.col(w2c)), g.unproject(F.col(k), F.col("x"), F.col("y"), F.col("depth")))
    return met.withColumns({n: c for n, c in zip(("X", "Y", "Z"), world, strict=True)}).drop("u", "v")


def reproject(points: DataFrame, cameras: DataFrame, key: Sequence[str]) -> DataFrame:
    """Points (X, Y, Z) seen by the camera (k, w2c) of their own frame."""
    u, v, z = g.project_world(F.col("k"), F.col("w2c"), (F.col("X"), F.col("Y"), F.col("Z")))
    return points.join(cameras.select(*key, "k", "w2c"), list(key)).withColumns({"u": u, "v": v, "z": z}).drop("k", "w2c")


def static_tracks(points: DataFrame, cameras: DataFrame, clip: Sequence[str]) -> DataFrame:
    """Still points of a clip in each of its frames; visible where they are in front of the camera."""
    frames = cameras.select(*clip, F.struct("frame", "k", "w2c").alias("c")).groupBy(*clip).agg(F.sort_array(F.collect_list("c")).alias("cs"))  # a clip has some hundred frames
    seen = points.join(frames, list(clip)).select(*points.columns, F.explode("cs").alias("c")).select(*points.columns, "c.*")
    u, v, z = g.project_world(F.col("k"), F.col("w2c"), (F.col("X"), F.col("Y"), F.col("Z")))
    return seen.withColumns({"u": u, "v": v, "z": z}).withColumn("visible", F.col("z") > 0).drop("k", "w2c")


def shrink(cells: DataFrame, by: Sequence[str], u: str, v: str, value: str, factor: int, weight: str | None = None) -> DataFrame:
    """A grid shrunk by a whole factor: means over the valid cells, weighted if asked for."""
    w = F.when(F.col(value).isNotNull(), F.col(weight) if weight else F.lit(1.0))
    return cells.groupBy(*by, F.floor(F.col(u) / factor).alias(u), F.floor(F.col(v) / factor).alias(v)).agg((F.sum(F.col(value) * w) / F.nullif(F.sum(w), F.lit(0.0))).alias(value))


def occlusion_edges(cells: DataFrame, by: Sequence[str], u: str, v: str, value: str, tolerance: float) -> DataFrame:
    """Cells from which the inverse depth falls by more than a share of itself within one step: the near sides of edges."""
    near = cells.withColumn("__d", 1 / F.nullif(F.col(value), F.lit(0.0)))
    return grid_neighbours(near, by, u, v, "__d").withColumn("occludes", (F.col("__d") - F.col("low")) / F.col("__d") > tolerance).select(*by, u, v, "occludes")


def track_points(spark: SparkSession, n: int, width: int, height: int, frames: int, mode: str, seed: int = 0) -> DataFrame:
    """A grid of n x n query points, rounded; at the first frame, at frames one after another, or half and half with frames by hash."""
    i = F.col("id")
    grid = spark.range(n * n).select(i.alias("track"), F.bround(g.grid_point(i % n, n, width)).alias("x"), F.bround(g.grid_point(F.floor(i / n), n, height)).alias("y"))
    by_hash = F.floor(uniform(seed, "track") * frames)
    when = {"first": F.lit(0).cast("long"), "incremental": F.col("track") % frames, "mixed": F.when(F.col("track") % 2 == 0, F.lit(0).cast("long")).otherwise(by_hash)}
    return grid.withColumn("frame", when[mode])


def drop_uncertain(points: DataFrame, by: Sequence[str], certainty: str, limit: float = 0.5, least: int = 20) -> DataFrame:
    """Points of more than the limit's certainty, unless too few of their group would stay."""
    n = points.groupBy(*by).agg(F.count_if(F.col(certainty) > limit).alias("__n"))
    return points.join(n, list(by)).filter((F.col("__n") < least) | (F.col(certainty) > limit)).drop("__n")


def ghost_points(spark: SparkSession, n: int, shape: str, seed: int = 0) -> DataFrame:
    """Points in the cube from -1 to 1, or those of them inside the ball."""
    p = spark.range(n).select(*((uniform(seed + k, "id") * 2 - 1).alias(a) for k, a in enumerate("xyz")))
    if shape not in ("cube", "ball"):
        raise ValueError("shape is cube or ball")
    return p if shape == "cube" else p.filter("x * x + y * y + z * z <= 1")


def focal_and_shift(points: DataFrame, by: Sequence[str], width: int = 200) -> DataFrame:
    """Focal f and depth shift s for which f x / (z + s) is nearest to u (and for y to v), per group. For a shift the best focal is closed, so only the shift is searched: on a grid, then by golden section."""
    keys = list(by)

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        x, y, z, u, v = (p[c].to_numpy(float) for c in ("x", "y", "z", "u", "v"))
        uv = np.concatenate([u, v])

        def at(s: float) -> tuple[float, float]:
            d = np.concatenate([x, y]) / np.concatenate([z + s, z + s])
            f = float(d @ uv / max(d @ d, 1e-300))
            return float(((f * d - uv) ** 2).sum()), f

        low = -z.min() + 1e-3
        grid = low + np.geomspace(1e-3, 100 * (np.ptp(z) + 1), width)
        k = int(np.argmin([at(s)[0] for s in grid]))
        a, b, ratio = grid[max(0, k - 1)], grid[min(width - 1, k + 1)], (5**0.5 - 1) / 2
        for _ in range(80):
            c, d = b - ratio * (b - a), a + ratio * (b - a)
            a, b = (a, d) if at(c)[0] < at(d)[0] else (c, b)
        return p[keys].head(1).assign(focal=at((a + b) / 2)[1], shift=(a + b) / 2)

    schema = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in keys)
    return points.select(*keys, "x", "y", "z", "u", "v").groupBy(*keys).applyInPandas(fit, f"{schema}, focal double, shift double")
