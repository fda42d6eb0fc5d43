"""Losses, motion rules and masks as columns and aggregates over pixels, points and poses.

Poses are arrays of 16 numbers, row by row. Groups are frames or clips; aggregates fold before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import geometry
from tracewright.operators.matching import k_nearest
from tracewright.operators.transforms import uniform


# losses


def focal(truth: Column, logit: Column, gamma: float = 2.0, alpha: float = 0.25) -> Column:
    """Cross-entropy of a logit, damped where the guess is already good; truth is 0 or 1."""
    log_one, log_zero = -F.log1p(F.exp(-logit)), -F.log1p(F.exp(logit))
    p = F.exp(log_one)
    return -(truth * alpha * F.pow(1 - p, F.lit(gamma)) * log_one + (1 - truth) * (1 - alpha) * F.pow(p, F.lit(gamma)) * log_zero)


def confidence_loss(error: Column, logit: Column, limit: float) -> Column:
    """Cross-entropy between a confidence and whether the error is within the limit."""
    sure = (error < limit).cast("double")
    return sure * F.log1p(F.exp(-logit)) + (1 - sure) * F.log1p(F.exp(logit))


def by_iteration(loss: Column, iteration: Column, iterations: int, gamma: float = 0.8) -> Column:
    """A loss weighted by gamma to the number of iterations that follow, over their number."""
    return loss * F.pow(F.lit(gamma), F.lit(iterations - 1) - iteration) / iterations


def invariant_l1(rows: DataFrame, by: Sequence[str], pred: str, target: str) -> DataFrame:
    """Of each group the mean absolute difference of both depths after each is freed of its median and of its mean deviation from it."""
    keys = list(by)
    centres = rows.groupBy(*keys).agg(F.median(pred).alias("__cp"), F.median(target).alias("__ct"))
    centred = rows.select(*keys, pred, target).join(centres, keys).withColumns({"__p": F.col(pred) - F.col("__cp"), "__t": F.col(target) - F.col("__ct")})
    spreads = centred.groupBy(*keys).agg(F.avg(F.abs("__p")).alias("__sp"), F.avg(F.abs("__t")).alias("__st"))
    unit = lambda x, s: F.col(x) / F.greatest(F.col(s), F.lit(1e-6))
    return centred.join(spreads, keys).groupBy(*keys).agg(F.avg(F.abs(unit("__p", "__sp") - unit("__t", "__st"))).alias("loss"))


def gradient_loss(cells: DataFrame, by: Sequence[str], u: str, v: str, pred: str, target: str, scales: int = 4) -> DataFrame:
    """Of each group the mean over scales 1, 2, 4, ... of the mean absolute steps of the error between neighbours of the grid thinned to every 1st, 2nd, 4th, ... row and column."""
    keys = list(by)
    error = cells.select(*keys, F.col(u).alias("__u"), F.col(v).alias("__v"), (F.col(pred) - F.col(target)).alias("__e"))
    thinned = error.withColumn("__scale", F.explode(F.array(*(F.lit(1 << k) for k in range(scales))))).filter("__u % __scale = 0 AND __v % __scale = 0")
    def step(along: str, across: str) -> Column:
        line = Window.partitionBy(*keys, "__scale", across).orderBy(along)
        return F.when(F.lead(along).over(line) == F.col(along) + F.col("__scale"), F.abs(F.lead("__e").over(line) - F.col("__e")))

    steps = thinned.select(*keys, "__scale", step("__u", "__v").alias("__du"), step("__v", "__u").alias("__dv"))
    each = steps.groupBy(*keys, "__scale").agg(((F.coalesce(F.sum("__du"), F.lit(0.0)) + F.coalesce(F.sum("__dv"), F.lit(0.0))) / F.count("*")).alias("__l"))
    return each.groupBy(*keys).agg((F.sum("__l") / scales).alias("loss"))


def gaussian_weights(rows: DataFrame, by: Sequence[str], residual: str, centre: float = 0.5) -> DataFrame:
    """Weights of residuals about a centre, under their group's deviation."""
    spread = rows.groupBy(*by).agg(F.stddev_samp(residual).alias("__s"))
    return rows.join(spread, list(by)).withColumn("weight", F.exp(-F.pow(F.lit(centre) - F.col(residual), F.lit(2)) / (2 * F.col("__s") * F.col("__s")))).drop("__s")


# poses


def product(a: Column, b: Column) -> Column:
    """Of two poses."""
    return F.array(*(sum((a[4 * i + k] * b[4 * k + j] for k in range(1, 4)), a[4 * i] * b[j]) for i in range(4) for j in range(4)))


def pose_of(rotation: Sequence[Column], shift: Sequence[Column]) -> Column:
    """A pose of nine numbers, row by row, and a translation."""
    return F.array(*(x for i in range(3) for x in (*rotation[3 * i : 3 * i + 3], shift[i])), *(F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)))


def largest_gap(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def transform_errors(rows: DataFrame, by: Sequence[str], pos: str, state: str, delta: str) -> DataFrame:
    """Mean and greatest error, over a group's consecutive poses, of three rules: previous times delta, delta times previous, previous times the inverse of delta."""
    before = F.lag(state).over(Window.partitionBy(*by).orderBy(pos))
    pairs = rows.select(*by, F.col(state).alias("__now"), F.col(delta).alias("__delta"), before.alias("__prev")).filter("__prev IS NOT NULL")
    rules = {"prev_delta": product(F.col("__prev"), F.col("__delta")), "delta_prev": product(F.col("__delta"), F.col("__prev")), "prev_inverse": product(F.col("__prev"), geometry.inverse_se3(F.col("__delta")))}
    errors = pairs.select(*by, *(largest_gap(F.col("__now"), m).alias(n) for n, m in rules.items()))
    return errors.groupBy(*by).agg(*(f(n).alias(f"{kind}_{n}") for n in rules for kind, f in (("mean", F.avg), ("max", F.max))))


def pose_chain(rows: DataFrame, by: Sequence[str], pos: str, relative: str) -> DataFrame:
    """Each pose is the one before times its own relative pose; the first stands as it is. A clip's poses are folded in order, in one row a clip."""
    identity = F.array(*(F.lit(float(i % 5 == 0)) for i in range(16)))
    one = F.struct(F.col(pos).alias("pos"), F.col(relative).alias("m"))
    start = F.struct(identity.alias("last"), F.array().cast("array<struct<pos:bigint,m:array<double>>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        now = F.transform(F.array(product(a["last"], x["m"])), lambda m: F.struct(m.alias("last"), F.concat(a["out"], F.array(F.struct(x["pos"].cast("bigint").alias("pos"), m.alias("m")))).alias("out")))
        return now[0]

    chained = rows.groupBy(*by).agg(F.sort_array(F.collect_list(one)).alias("__all"))
    return chained.select(*by, F.explode(F.aggregate("__all", start, step, lambda a: a["out"])).alias("__p")).select(*by, F.col("__p.pos").alias(pos), F.col("__p.m").alias("pose"))


def random_poses(frames: DataFrame, by: Sequence[str], pos: str, seed: int, turn: float, shift: float, scale: Column | float = 1.0) -> DataFrame:
    """A walk of each clip's camera from the identity: every further frame turns by up to `turn` radians about each axis and moves by up to `shift` times `scale` along it.

    Steps are hashes of the clip, the frame and the seed. Repeated frames count once; an empty table gives an empty result."""
    first = Window.partitionBy(*by).orderBy(pos)
    unit = lambda k: F.when(F.col("__first"), 0.0).otherwise(uniform(seed + k, *by, pos) * 2 - 1)
    each = frames.select(*by, F.col(pos).cast("bigint").alias(pos), (F.lit(shift) * scale).alias("__size")).dropDuplicates([*by, pos])
    # a column for each stage: expressions that are used many times must not be written out many times
    steps = each.withColumn("__first", F.lag(pos).over(first).isNull()).withColumns({"__turn": F.array(*(unit(k) * turn for k in range(3))), "__move": F.array(*(unit(k) * F.col("__size") for k in range(3, 6)))})
    turned = steps.withColumn("__q", F.array(*geometry.quaternion_of_rotvec(*(F.col("__turn")[k] for k in range(3))))).withColumn("__r", geometry.matrix_of_quaternion(*(F.col("__q")[k] for k in range(4))))
    return pose_chain(turned.withColumn("__step", pose_of([F.col("__r")[k] for k in range(9)], [F.col("__move")[k] for k in range(3)])), by, pos, "__step")


def camera_aug(points: DataFrame, by: Sequence[str], pos: str, seed: int, turn: float, shift: float, scale: str | None = None, axes: Sequence[str] = ("x", "y", "z"), flags: str = "flags") -> DataFrame:
    """U03j: points of cameras' own frames (rows flagged `local`) moved along a random walk of the camera, `pose`; `scale` names the clip's size (A43). Other rows, and those with a null key, stay, with no pose."""
    local = F.coalesce(F.array_contains(flags, "local"), F.lit(False))
    frames = points.filter(local).groupBy(*by, pos).agg((F.max(scale) if scale else F.lit(1.0)).alias("__scale"))
    walk = random_poses(frames, by, pos, seed, turn, shift, F.col("__scale"))
    met = points.join(walk, [*by, pos], "left").withColumn("pose", F.when(local, F.col("pose")))
    moved = geometry.apply_extrinsics(F.col("pose"), tuple(F.col(a) for a in axes))
    return met.withColumns({a: F.when(F.col("pose").isNull(), F.col(a)).otherwise(m) for a, m in zip(axes, moved, strict=True)})


# masks


def static_points(probability: Column, visibility: Column, u: Column, v: Column, width: int, height: int) -> Column:
    """Not moving, seen, and inside the image."""
    return (probability < 0.5) & (visibility > 0.5) & (u >= 0) & (u < width) & (v >= 0) & (v < height)


# Shares of the height and width, or pixels, that evaluations of depth crop to (top, bottom, left, right).
CROPS = {"garg": (0.40810811, 0.99189189, 0.03594771, 0.96405229), "eigen_kitti": (0.3324324, 0.91351351, 0.0359477, 0.96405229), "eigen": (45, 471, 41, 601)}


def eval_crop(kind: str, u: Column, v: Column, depth: Column, width: int, height: int, low: float, high: float) -> Column:
    """P25: inside a named crop of the image, with a depth strictly between the ends."""
    sizes = (height, height, width, width)
    top, bottom, left, right = (x if isinstance(x, int) else int(x * n) for x, n in zip(CROPS[kind], sizes, strict=True))
    return (v >= top) & (v < bottom) & (u >= left) & (u < right) & (depth > low) & (depth < high)


def topology_mask(points: DataFrame, by: Sequence[str], key: str, vector: str, depth: str, lifted: str, k: int = 48, least: int = 9, tolerance: float = 0.4) -> DataFrame:
    """Points of which more than `least` of the k nearest in their frame are as far away in depth as they are in lifted depth, within a share."""
    near = k_nearest(points, points, by, key, vector, k).select(*by, "query", "neighbour")
    own = points.select(*by, F.col(key).alias("query"), F.col(depth).alias("__d"), F.col(lifted).alias("__l"))
    other = points.select(*by, F.col(key).alias("neighbour"), F.col(depth).alias("__nd"), F.col(lifted).alias("__nl"))
    met = near.join(own, [*by, "query"]).join(other, [*by, "neighbour"])
    alike = F.abs(F.abs(F.col("__nd") - F.col("__d")) / (F.abs(F.col("__nl") - F.col("__l")) + 1e-8) - 1) < tolerance
    return met.groupBy(*by, F.col("query").alias(key)).agg(F.count_if(alike).alias("alike")).withColumn("kept", F.col("alike") > least)


def dilate(cells: DataFrame, by: Sequence[str], u: str, v: str, mask: str, reach: int = 1) -> DataFrame:
    """True where any cell of the square around is; cells of the grid only."""
    d = F.sequence(F.lit(-reach), F.lit(reach))
    sent = cells.select(*by, F.col(u).alias("__u"), F.col(v).alias("__v"), F.col(mask).cast("int").alias("__m"), F.explode(d).alias("__du")).withColumn("__dv", F.explode(d))
    own = (F.col("__du") == 0) & (F.col("__dv") == 0)
    return sent.groupBy(*by, (F.col("__u") + F.col("__du")).alias(u), (F.col("__v") + F.col("__dv")).alias(v)).agg((F.max("__m") == 1).alias(mask), F.count_if(own).alias("__n")).filter("__n > 0").drop("__n")


def normals(cells: DataFrame, by: Sequence[str], u: str, v: str, axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Unit normals of a grid of points: the sum of the four cross products of neighbouring steps (up, left, down, right in turn) that have all their cells."""
    across, along = Window.partitionBy(*by, v).orderBy(u), Window.partitionBy(*by, u).orderBy(v)

    def side(window, here: str, ahead: int) -> list[Column]:
        move = (F.lead if ahead > 0 else F.lag)
        there = move(here).over(window) == F.col(here) + ahead
        return [F.when(there, move(a).over(window) - F.col(a)) for a in axes]

    sides = {"up": side(along, v, -1), "left": side(across, u, -1), "down": side(along, v, 1), "right": side(across, u, 1)}
    held = cells.withColumns({f"__{n}{k}": c for n, cs in sides.items() for k, c in enumerate(cs)})
    turns = [("up", "left"), ("left", "down"), ("down", "right"), ("right", "up")]

    def cross(a: str, b: str, k: int) -> Column:
        i, j = (k + 1) % 3, (k + 2) % 3
        return F.coalesce(F.col(f"__{a}{i}") * F.col(f"__{b}{j}") - F.col(f"__{a}{j}") * F.col(f"__{b}{i}"), F.lit(0.0))

    total = held.withColumns({f"__n{k}": sum((cross(a, b, k) for a, b in turns[1:]), cross(*turns[0], k)) for k in range(3)})
    size = F.sqrt(F.col("__n0") * F.col("__n0") + F.col("__n1") * F.col("__n1") + F.col("__n2") * F.col("__n2"))
    out = total.withColumn("__size", size)
    return out.select(*cells.columns, *((F.col(f"__n{k}") / F.nullif(F.col("__size"), F.lit(0.0))).alias(f"n{a}") for k, a in enumerate(axes)))


# grids


def view_plane_uv(i: Column, j: Column, width: int, height: int, aspect: float | None = None) -> tuple[Column, Column]:
    """The place of pixel (i, j) on a plane whose corners lie at distance 1 from its middle."""
    a = aspect or width / height
    across, down = a / (1 + a * a) ** 0.5, 1 / (1 + a * a) ** 0.5
    place = lambda k, n, span: (2.0 * k / max(1, n - 1) - 1) * (span * (n - 1) / n)
    return place(i, width, across), place(j, height, down)


def resize_nearest(cells: DataFrame, by: Sequence[str], u: str, v: str, size: tuple[int, int], to: tuple[int, int]) -> DataFrame:
    """Each cell (u', v') of the new grid is the old one at floor((u' + 0.5) * old / new); sizes are (width, height)."""

    def picked(c: str, m: int, n: int) -> Column:
        source = lambda k: F.floor((k + 0.5) * m / n)
        return F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: source(k) == F.col(c))

    wide = cells.withColumn("__u", F.explode(picked(u, size[0], to[0]))).withColumn("__v", F.explode(picked(v, size[1], to[1])))
    return wide.withColumns({u: F.col("__u"), v: F.col("__v")}).drop("__u", "__v")


def resize_bilinear(cells: DataFrame, by: Sequence[str], u: str, v: str, value: str, size: tuple[int, int], to: tuple[int, int]) -> DataFrame:
    """Bilinear by half-pixel centres over the valid cells alone: sums of weighted values over sums of weights; every old cell is sent to the new ones that it touches."""

    def touched(c: str, m: int, n: int) -> Column:
        centre = lambda k: F.greatest(F.lit(0.0), F.least(F.lit(float(m - 1)), (k + 0.5) * (m / n) - 0.5))
        weights = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(k.alias("to"), F.greatest(F.lit(0.0), 1 - F.abs(centre(k) - F.col(c))).alias("w")))
        return F.filter(weights, lambda t: t["w"] > 0)

    valid = cells.filter(F.col(value).isNotNull())
    sent = valid.withColumn("__u", F.explode(touched(u, size[0], to[0]))).withColumn("__v", F.explode(touched(v, size[1], to[1])))
    w = F.col("__u.w") * F.col("__v.w")
    return sent.groupBy(*by, F.col("__u.to").alias(u), F.col("__v.to").alias(v)).agg((F.sum(F.col(value) * w) / F.sum(w)).alias(value))


def blur_depth(cells: DataFrame, by: Sequence[str], u: str, v: str, value: str, reach: int, sigma: float) -> DataFrame:
    """U03e: a Gaussian blur over the grid's cells (weights of absent cells are left out); what was zero stays zero."""
    weights = [(d, math.exp(-d * d / (2 * sigma * sigma))) for d in range(-reach, reach + 1)]
    steps = F.array(*(F.struct(F.lit(d).alias("d"), F.lit(w).alias("w")) for d, w in weights))
    sent = cells.select(*by, F.col(u).alias("__u"), F.col(v).alias("__v"), F.col(value).alias("__x"), F.explode(steps).alias("__a")).withColumn("__b", F.explode(steps))
    own = (F.col("__a.d") == 0) & (F.col("__b.d") == 0)
    w = F.col("__a.w") * F.col("__b.w")
    out = sent.groupBy(*by, (F.col("__u") + F.col("__a.d")).alias(u), (F.col("__v") + F.col("__b.d")).alias(v)).agg((F.sum(F.col("__x") * w) / F.sum(w)).alias("__s"), F.max(F.when(own, F.col("__x"))).alias(value))
    return out.filter(F.col(value).isNotNull()).withColumn(value, F.when(F.col(value) > 0, F.col("__s")).otherwise(F.lit(0.0))).drop("__s")


def radius_weights(points: DataFrame, by: Sequence[str], key: str, axes: Sequence[str], radius: float) -> DataFrame:
    """One over the number of points within the radius, itself included. Points are sent to the cells around their own, so the join is on equality; the work grows with the points of a cell."""
    cell = [F.floor(F.col(a) / radius) for a in axes]
    around = F.sequence(F.lit(-1), F.lit(1))
    sent = points.select(*by, *(F.col(a).alias(f"__o{k}") for k, a in enumerate(axes)), *(c.alias(f"__c{k}") for k, c in enumerate(cell)))
    for k in range(len(axes)):
        sent = sent.withColumn("__step", F.explode(around)).withColumn(f"__c{k}", F.col(f"__c{k}") + F.col("__step")).drop("__step")
    mine = points.select(*by, key, *axes, *(c.alias(f"__c{k}") for k, c in enumerate(cell)))
    far = sum((F.pow(F.col(a) - F.col(f"__o{k}"), F.lit(2)) for k, a in enumerate(axes)), F.lit(0.0))
    met = mine.join(sent, [*by, *(f"__c{k}" for k in range(len(axes)))]).filter(far <= radius * radius)
    return met.groupBy(*by, key).agg((1.0 / F.count("*")).alias("weight"))


def to_local(points: DataFrame, cameras: DataFrame, frame: Sequence[str], axes: Sequence[str] = ("x", "y", "z"), w2c: str = "w2c") -> DataFrame:
    """U03g: world points in the camera of their own frame, whose pose becomes the identity."""
    met = points.join(cameras.select(*frame, w2c), list(frame))
    local = geometry.apply_extrinsics(F.col(w2c), tuple(F.col(a) for a in axes))
    identity = F.array(*(F.lit(float(k % 5 == 0)) for k in range(16)))
    return met.withColumns({**dict(zip(axes, local, strict=True)), w2c: identity})


# records


def action_blocks(rows: DataFrame, actions: str, blocks: dict[str, tuple[int, int]]) -> DataFrame:
    """Of each block of an action's numbers (first, count) the range, mean and population deviation over all of them."""
    each = [F.struct(F.lit(n).alias("block"), F.slice(actions, first + 1, count).alias("v")) for n, (first, count) in blocks.items()]
    flat = rows.select(F.explode(F.array(*each)).alias("b")).select("b.block", F.explode("b.v").alias("v")).withColumn("v", F.col("v").cast("double"))
    return flat.groupBy("block").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def value_counts(rows: DataFrame, value: str) -> DataFrame:
    """Distinct values (of a gripper) and how often each occurs."""
    return rows.groupBy(value).agg(F.count("*").alias("n"))


def all_or_none(value: Column | str) -> Column:
    """Whether an optional field is there in all rows of a group or in none."""
    return F.count(value).isin(0) | (F.count(value) == F.count("*"))


def key_averages(rows: DataFrame, by: Sequence[str], record: str) -> DataFrame:
    """The mean of each key of maps of numbers, keys with dots for nested ones; NaN is passed over."""
    flat = rows.select(*by, F.explode(record).alias("key", "__v")).filter(~F.isnan("__v"))
    return flat.groupBy(*by, "key").agg(F.avg("__v").alias("mean"), F.count("*").alias("n"))
