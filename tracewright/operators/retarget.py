"""Arc-length retargeting of tracks: a clip's tracks are resampled together at equal steps of their robust common arc length.

Tracks are rows (clip, track, step, x, y[, z]). The steps of a clip share one length per segment, the mean over its fastest tracks, so the new
sample times are the same for all of them. Everything is a groupBy or a window within a clip; clips are independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-12


def tracks_from_vectors(vectors: DataFrame, clip: str, track: str, values: str, steps: int, dims: Sequence[str] = ("x", "y")) -> DataFrame:
    """A row per step of each vector, whose values hold the coordinates of one step after another."""
    n = len(dims)
    rows = vectors.select(F.col(clip).alias("clip"), F.col(track).alias("track"), F.col(values).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
    return rows.select("clip", "track", "step", *(F.get("v", F.col("step") * n + k).cast("double").alias(d) for k, d in enumerate(dims)))


def guarded_scale(value: Column) -> Column:
    """1 in place of a scale that is nearly zero."""
    return F.when(F.abs(value) < EPS, F.lit(1.0)).otherwise(value)


def normalise(tracks: DataFrame) -> DataFrame:
    """x and y over those of the clip's last track at its first step, clipped to [0, 1]; adds sx and sy."""
    first = tracks.groupBy("clip").agg(F.max(F.struct("track", (-F.col("step")).alias("back"), "x", "y")).alias("last"))
    scales = first.select("clip", guarded_scale(F.col("last.x")).alias("sx"), guarded_scale(F.col("last.y")).alias("sy"))
    unit = lambda c, s: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c) / F.col(s)))
    return tracks.join(scales, "clip").withColumns({"x": unit("x", "sx"), "y": unit("y", "sy")})


def segments(tracks: DataFrame, dims: Sequence[str] = ("x", "y")) -> DataFrame:
    """Each step with the following one (x1, y1, ...) and the length between; a track's last step has none."""
    order = Window.partitionBy("clip", "track").orderBy("step")
    ahead = tracks.withColumns({f"{d}1": F.lead(d).over(order) for d in dims})
    return ahead.filter(F.col(f"{dims[0]}1").isNotNull()).withColumn("length", F.sqrt(sum((F.pow(F.col(f"{d}1") - F.col(d), F.lit(2)) for d in dims), F.lit(0.0))))


def robust_lengths(pieces: DataFrame, top: float) -> DataFrame:
    """Of each clip's step, the mean length of the top share of its tracks (one at least)."""
    by_step = Window.partitionBy("clip", "step")
    ranked = pieces.select("clip", "step", "track", "length", F.row_number().over(by_step.orderBy(F.desc("length"), "track")).alias("rank"), F.count("*").over(by_step).alias("n"))
    return ranked.filter(F.col("rank") <= F.greatest(F.lit(1), F.ceil(F.lit(top) * F.col("n")))).groupBy("clip", "step").agg(F.avg("length").alias("length"))


def cumulative(lengths: DataFrame) -> DataFrame:
    """Begins and ends of the segments along the clip."""
    order = Window.partitionBy("clip").orderBy("step")
    end = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return lengths.withColumn("ends", end).withColumn("begins", F.coalesce(F.lag("ends").over(order), F.lit(0.0)))


def sample_counts(spans: DataFrame, interval: float, most: int) -> DataFrame:
    """Total length and number of samples of each clip."""
    return spans.groupBy("clip").agg(F.max("ends").alias("total")).withColumn("samples", F.least(F.floor(F.col("total") / interval) + 1, F.lit(most)).cast("int"))


def targets(spans: DataFrame, interval: float, most: int) -> DataFrame:
    """Each sample's segment, the last that begins at or before it, and its place alpha in it."""
    counts = sample_counts(spans, interval, most)
    wanted = counts.select("clip", "total", "samples", F.explode(F.sequence(F.lit(0), F.col("samples") - 1)).alias("sample"))
    wanted = wanted.withColumn("target", F.when(F.col("sample") == F.col("samples") - 1, F.least(F.col("sample") * F.lit(interval), F.col("total"))).otherwise(F.col("sample") * F.lit(interval)))
    met = wanted.join(spans, "clip").filter(F.col("begins") <= F.col("target"))
    best = met.groupBy("clip", "sample", "target").agg(F.max(F.struct("step", "begins", "length")).alias("s"))
    return best.select("clip", "sample", F.col("s.step").alias("step"), ((F.col("target") - F.col("s.begins")) / F.greatest(F.col("s.length"), F.lit(EPS))).alias("alpha"))


def retarget(tracks: DataFrame, interval: float = 0.05, most: int = 64, top: float = 0.02, dims: Sequence[str] = ("x", "y")) -> DataFrame:
    """Rows (clip, track, sample, x, y, ...); samples beyond a clip's length are absent. A clip of one step keeps that step."""
    if interval <= 0 or not 0 < top <= 1:
        raise ValueError("interval must be positive and top in (0, 1]")
    unit = normalise(tracks)
    pieces = segments(unit, dims)
    wanted = targets(cumulative(robust_lengths(pieces, top)), interval, most)
    between = pieces.join(wanted, ["clip", "step"])
    back = {"x": "sx", "y": "sy"}
    at = [((F.col(d) + F.col("alpha") * (F.col(f"{d}1") - F.col(d))) * (F.col(back[d]) if d in back else F.lit(1.0))).alias(d) for d in dims]
    moving = between.select("clip", "track", "sample", *at)
    still = tracks.join(tracks.groupBy("clip").agg(F.count_distinct("step").alias("n")).filter("n = 1").select("clip"), "clip", "left_semi")
    return moving.unionByName(still.select("clip", "track", F.lit(0).alias("sample"), *dims))
