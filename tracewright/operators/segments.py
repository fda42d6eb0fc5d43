"""Frames into query segments and windows: strides, caps, ranges, overlaps, carried state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positions(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """Places within a group, from 0."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))


def stride(rows: DataFrame, step: int | Column, pos: str = "pos") -> DataFrame:
    """Every step-th place, renumbered."""
    return rows.filter(F.col(pos) % step == 0).withColumn(pos, F.floor(F.col(pos) / step))


def cap(rows: DataFrame, most: int, pos: str = "pos") -> DataFrame:
    """The first places only."""
    return rows.filter(F.col(pos) < most)


def auto_stride(n: Column, target: int, asked: Column | None = None) -> Column:
    """The asked stride if positive, else one that leaves about target frames."""
    own = F.greatest(F.lit(1), F.ceil(n / max(1, target))).cast("long")
    return own if asked is None else F.when(asked > 0, asked).otherwise(own)


def query_segments(clips: DataFrame, by: Sequence[str], n: str, every: int, ahead: int) -> DataFrame:
    """Query places and the ends of their segments."""
    q = clips.select(*by, n, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(every).cast("long"))).alias("query"))
    return q.select(*by, "query", F.least(F.col("query") + ahead, F.col(n)).alias("ends"))


def frames_of_segments(frames: DataFrame, segments: DataFrame, by: Sequence[str], pos: str = "pos") -> DataFrame:
    """Each segment with its frames; the range is unrolled so that the join is on equality."""
    unrolled = segments.select(*by, "query", F.explode(F.sequence(F.col("query"), F.col("ends") - 1)).alias(pos))
    return unrolled.join(frames, [*by, pos])


def zip_positions(left: DataFrame, right: DataFrame, by: Sequence[str] = (), pos: str = "pos") -> DataFrame:
    """Rows of equal place; the longer side's rest falls away."""
    return left.join(right, [*by, pos])


def zip_checked(left: DataFrame, right: DataFrame, by: Sequence[str], pos: str = "pos") -> DataFrame:
    """For each group the sizes of both sides and whether they agree."""
    a, b = (side.groupBy(*by).agg(F.count("*").alias(name)) for side, name in ((left, "n_left"), (right, "n_right")))
    joined = a.join(b, list(by), "full")
    return joined.select(*by, F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right")).withColumn("agree", F.col("n_left") == F.col("n_right"))


def time_slice(rows: DataFrame, first: int, last: int, pos: str = "pos") -> DataFrame:
    """Steps first..last-1, with the origin moved."""
    return rows.filter(F.col(pos).between(first, last - 1)).withColumn(pos, F.col(pos) - first)


def causal(valid: Column, step: Column, query: Column) -> Column:
    """P20: validity from the query's own frame on."""
    return valid & (step >= query)


def window_starts(length: int, hop: int, n: Column) -> Column:
    """Beginnings of the windows that cover n places, the last one padded."""
    last = F.greatest(F.lit(0), F.ceil((n - length) / hop)).cast("long") * hop
    return F.sequence(F.lit(0).cast("long"), last, F.lit(hop).cast("long"))


def unfold(rows: DataFrame, by: Sequence[str], length: int, hop: int, pos: str = "pos") -> DataFrame:
    """(window, place) for each row in each window that holds it; a window's number is its beginning over the hop.

    A place p lies in windows p // hop and those up to (length - 1) // hop before, so rows are copied rather than joined by range."""
    p = F.col(pos)
    first = F.greatest(F.lit(0), F.floor((p - length) / hop) + 1)
    n = F.count("*").over(Window.partitionBy(*by))
    last = F.least(F.floor(p / hop), F.greatest(F.lit(0), F.ceil((n - length) / hop)))
    return rows.withColumn("__last", last).withColumn("window", F.explode(F.sequence(first.cast("long"), F.col("__last").cast("long")))).withColumn("place", p - F.col("window") * hop).drop("__last")


def last_window_wins(windows: DataFrame, by: Sequence[str], value: str, pos: str = "pos") -> DataFrame:
    """Of overlapping windows the latest decides."""
    return windows.groupBy(*by, pos).agg(F.max_by(value, "window").alias(value), F.max("window").alias("window"))


def pad_tail(rows: DataFrame, by: Sequence[str], length: int, value: str, pos: str = "pos") -> DataFrame:
    """The last row repeated up to whole windows."""
    ends = rows.groupBy(*by).agg(F.max(pos).alias("__last"), F.max_by(value, pos).alias("__value"))
    more = ends.withColumn("__to", (F.ceil((F.col("__last") + 1) / length) * length - 1).cast("long")).filter(F.col("__to") > F.col("__last"))
    added = more.select(*by, F.explode(F.sequence(F.col("__last") + 1, F.col("__to"))).alias(pos), F.col("__value").alias(value))
    return rows.select(*by, pos, value).unionByName(added)


def relative_offsets(rows: DataFrame, by: Sequence[str], value: str, pos: str = "pos") -> DataFrame:
    """Differences to the following and the preceding row, 0 at the ends."""
    order = Window.partitionBy(*by).orderBy(pos)
    return rows.withColumns({"ahead": F.coalesce(F.lead(value).over(order) - F.col(value), F.lit(0.0)), "behind": F.coalesce(F.col(value) - F.lag(value).over(order), F.lit(0.0))})


def nth_visible(rows: DataFrame, by: Sequence[str], visible: Column, n: int, pos: str = "pos") -> DataFrame:
    """The place of the n-th visible row of each group, or -1."""
    ranked = rows.withColumn("__v", F.sum(visible.cast("int")).over(Window.partitionBy(*by).orderBy(pos))).withColumn("__hit", visible & (F.col("__v") == n))
    return ranked.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("__hit"), F.col(pos))), F.lit(-1)).cast("long").alias("at"))


def runs(rows: DataFrame, by: Sequence[str], value: str, pos: str = "pos") -> DataFrame:
    """Runs of equal consecutive values with their first place and size."""
    order = Window.partitionBy(*by).orderBy(pos)
    changed = rows.withColumn("__new", (~F.col(value).eqNullSafe(F.lag(value).over(order)) | (F.row_number().over(order) == 1)).cast("int"))
    return changed.withColumn("run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).groupBy(*by, "run").agg(F.first(value).alias(value), F.min(pos).alias("first"), F.count("*").alias("size"))


def best_of(rows: DataFrame, by: Sequence[str], score: Column, pos: str = "pos", keep: Sequence[str] = ()) -> DataFrame:
    """The row of largest score of each group, the earliest of equals."""
    best = rows.groupBy(*by).agg(F.max(F.struct(score.alias("score"), (-F.col(pos)).alias("back"), *keep)).alias("b"))
    return best.select(*by, F.col("b.score").alias("score"), (-F.col("b.back")).alias(pos), *(F.col(f"b.{c}").alias(c) for c in keep))


def sliding(rows: DataFrame, by: Sequence[str], value: str, reach: int, pos: str = "pos") -> DataFrame:
    """Maximum and mean over the places within reach; nulls are passed over."""
    near = Window.partitionBy(*by).orderBy(pos).rowsBetween(-reach, reach)
    return rows.withColumns({"pooled": F.max(value).over(near), "mean": F.avg(value).over(near)})


def ema(rows: DataFrame, by: Sequence[str], value: str, keep: float, pos: str = "pos") -> DataFrame:
    """The walk v <- keep * v + (1 - keep) * value from 0 along each group, folded over its ordered values."""
    ordered = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(pos, F.col(value).alias("value")))).alias("all"))
    start = F.lit(0.0)
    return ordered.select(*by, F.size("all").cast("long").alias("n"), F.aggregate("all", start, lambda v, one: v * keep + one["value"] * (1 - keep)).alias("walk"))


def rotation_chain(rows: DataFrame, by: Sequence[str], angle: str, pos: str = "pos") -> DataFrame:
    """The product of a group's plane rotations in order, as its first column (c, s)."""
    ordered = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(pos, F.col(angle).alias("angle")))).alias("all"))
    start = F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("s"))

    def turn(m: Column, one: Column) -> Column:
        c, s = F.cos(one["angle"]), F.sin(one["angle"])
        return F.struct((m["c"] * c - m["s"] * s).alias("c"), (m["s"] * c + m["c"] * s).alias("s"))

    return ordered.select(*by, F.aggregate("all", start, turn).alias("m")).select(*by, "m.c", "m.s")


def bidirectional(forward: DataFrame, backward: DataFrame, by: Sequence[str], last: Column, query: Column, value: str, pos: str = "pos") -> DataFrame:
    """Before the query the backward run (whose place 0 is the last frame), from it on the forward one."""
    flipped = backward.withColumn(pos, last - F.col(pos)).withColumnRenamed(value, "__back")
    return forward.join(flipped.select(*by, pos, "__back"), [*by, pos]).withColumn("merged", F.when(F.col(pos) < query, F.col("__back")).otherwise(F.col(value)))
