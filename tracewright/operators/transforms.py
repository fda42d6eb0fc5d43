"""A registry of table transforms, their composition from configurations, and the transforms themselves.

Randomness is a hash of keys and a seed, so results don't depend on partitions or retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Transform = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Callable[..., Transform]] = {}


def register(name: str) -> Callable[[Callable[..., Transform]], Callable[..., Transform]]:
    """A factory of transforms under a name."""

    def add(factory: Callable[..., Transform]) -> Callable[..., Transform]:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered already")
        REGISTRY[name] = factory
        return factory

    return add


def build(config: dict) -> Transform:
    """{"name": ..., other keys as arguments}."""
    return REGISTRY[config["name"]](**{k: v for k, v in config.items() if k != "name"})


def compose(configs: Sequence[dict | Transform]) -> Transform:
    """Transforms one after another."""
    steps = [build(c) if isinstance(c, dict) else c for c in configs]
    return lambda rows: reduce(lambda r, t: r.transform(t), steps, rows)


def uniform(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) for each key."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 52)) / F.lit(float(1 << 52))


@register("choice")
def choice(options: Sequence[Sequence[dict]], seed: int) -> Transform:
    """U03n: one of several pipelines, by the seed."""
    return compose(options[seed * 2654435761 % (1 << 32) % len(options)])


@register("erase")
def erase(boxes: DataFrame, by: Sequence[str] = ("clip", "step"), x: str = "x", y: str = "y") -> Transform:
    """Points inside a box (left, top, right, bottom of the same frame) become invisible. Frames have few boxes, so the join by frame stays small."""
    areas = boxes.select(*by, F.struct("left", "top", "right", "bottom").alias("__box")).groupBy(*by).agg(F.collect_list("__box").alias("__boxes"))

    def run(rows: DataFrame) -> DataFrame:
        inside = F.exists("__boxes", lambda b: (F.col(x) >= b["left"]) & (F.col(x) < b["right"]) & (F.col(y) >= b["top"]) & (F.col(y) < b["bottom"]))
        return rows.join(areas, list(by), "left").withColumn("visible", F.col("visible") & ~F.coalesce(inside, F.lit(False))).drop("__boxes")

    return run


EDGES = ("left", "top", "right", "bottom")


def _boxed(pixels: DataFrame, boxes: DataFrame, on: Sequence[str], u: str, v: str) -> DataFrame:
    """Pixels beside each box that holds them. Frames have few boxes, so the join by frame stays small."""
    inside = (F.col(u) >= F.col("left")) & (F.col(u) < F.col("right")) & (F.col(v) >= F.col("top")) & (F.col(v) < F.col("bottom"))
    return pixels.join(boxes, list(on)).filter(inside)


@register("fill")
def fill(boxes: DataFrame, by: Sequence[str] = ("clip", "step"), u: str = "u", v: str = "v", value: str = "depth") -> Transform:
    """Pixels inside a box (left, top, right, bottom of the same frame) take the mean of the box; where boxes overlap, that of the one with the largest left, then top edge."""

    def run(pixels: DataFrame) -> DataFrame:
        held = _boxed(pixels.select(*by, u, v, value), boxes.select(*by, *EDGES).distinct(), by, u, v)
        means = held.groupBy(*by, *EDGES).agg(F.avg(value).alias("__mean"))
        new = held.join(means, [*by, *EDGES]).groupBy(*by, u, v).agg(F.max_by("__mean", F.struct("left", "top", "right", "bottom")).alias("__mean"))
        return pixels.join(new, [*by, u, v], "left").withColumn(value, F.coalesce("__mean", value)).drop("__mean")

    return run


@register("paste")
def paste(boxes: DataFrame, by: Sequence[str] = ("clip", "step"), u: str = "u", v: str = "v", value: str = "depth", front: float = 0.9) -> Transform:
    """Pixels inside a box take those of the frame `source` of the same clip (the last of `by` names frames), scaled so that the patch's farthest lies at `front` times
    the box's nearest valid depth. Boxes without valid depth on either side change nothing; where boxes overlap, the one with the largest left, then top edge counts."""
    *clip, step = by

    def run(pixels: DataFrame) -> DataFrame:
        areas, known = boxes.select(*by, *EDGES, "source").distinct(), pixels.select(*by, u, v, value)
        valid = F.when(F.col(value) > 0, F.col(value))
        nearest = _boxed(known, areas, by, u, v).groupBy(*by, *EDGES, "source").agg(F.min(valid).alias("__near"))
        patches = _boxed(known.withColumnRenamed(step, "source"), areas, [*clip, "source"], u, v)
        farthest = patches.groupBy(*by, *EDGES, "source").agg(F.max(valid).alias("__far"))
        scaled = patches.join(nearest.join(farthest, [*by, *EDGES, "source"]), [*by, *EDGES, "source"]).withColumn("__new", F.col(value) * F.col("__near") * front / F.col("__far"))
        new = scaled.filter("__new IS NOT NULL").groupBy(*by, u, v).agg(F.max_by("__new", F.struct(*EDGES, "source")).alias("__new"))
        return pixels.join(new, [*by, u, v], "left").withColumn(value, F.coalesce("__new", value)).drop("__new")

    return run


@register("flip")
def flip(width: float, x: str = "x") -> Transform:
    """U03f: mirrored pixels."""
    return lambda rows: rows.withColumn(x, F.lit(width) - 1 - F.col(x))


@register("crop")
def crop(left: float, top: float, scale: float = 1.0, x: str = "x", y: str = "y") -> Transform:
    """U03f, U03k: pixels after a crop and a resize."""
    return lambda rows: rows.withColumns({x: (F.col(x) - left) * scale, y: (F.col(y) - top) * scale})


@register("drift")
def drift(seed: int, size: float, keep: float = 0.8, by: Sequence[str] = ("clip",), pos: str = "step", x: str = "x") -> Transform:
    """U03f, W10: an offset that walks from frame to frame, v <- keep * v + (1 - keep) * noise; folded once over a clip's frames."""

    def run(rows: DataFrame) -> DataFrame:
        frames = rows.select(*by, pos).distinct().groupBy(*by).agg(F.sort_array(F.collect_list(pos)).alias("__p"))
        start = F.struct(F.lit(0.0).alias("v"), F.array().cast(f"array<struct<p:{rows.schema[pos].dataType.simpleString()},v:double>>").alias("out"))

        def step(a: Column, p: Column) -> Column:
            v = a["v"] * keep + (uniform(seed, *by, p) * 2 - 1) * size * (1 - keep)
            return F.struct(v.alias("v"), F.concat(a["out"], F.array(F.struct(p.alias("p"), v.alias("v")))).alias("out"))

        walk = frames.select(*by, F.explode(F.aggregate("__p", start, step)["out"]).alias("o")).select(*by, F.col("o.p").alias(pos), F.col("o.v").alias("__v"))
        return rows.join(walk, [*by, pos]).withColumn(x, F.col(x) + F.col("__v")).drop("__v")

    return run


@register("depth_noise")
def depth_noise(seed: int, share: float, by: Sequence[str] = ("clip", "step"), value: str = "depth", key: Sequence[str] = ("u", "v"), cell: int = 8) -> Transform:
    """U03h: noise of two resolutions in proportion to the frame's deviation; zeros stay, nothing falls below zero."""

    def run(rows: DataFrame) -> DataFrame:
        spread = F.stddev_pop(F.when(F.col(value) > 0, F.col(value))).over(Window.partitionBy(*by))
        coarse = uniform(seed, *by, *(F.floor(F.col(k) / cell) for k in key))
        noise = (uniform(seed + 1, *by, *key) + coarse - 1) * share * spread
        return rows.withColumn(value, F.when(F.col(value) > 0, F.greatest(F.lit(0.0), F.col(value) + noise)).otherwise(F.col(value)))

    return run


@register("delta_depth")
def delta_depth(seed: int, scale: float, shift: float, by: Sequence[str] = ("clip",), value: str = "depth") -> Transform:
    """U03i: depth times a factor and plus a shift of the clip."""
    return lambda rows: rows.withColumn(value, F.when(F.col(value) > 0, F.greatest(F.lit(0.0), F.col(value) * (1 + (uniform(seed, *by) * 2 - 1) * scale) + (uniform(seed + 1, *by) * 2 - 1) * shift)).otherwise(F.col(value)))


@register("add_flag")
def add_flag(flag: str, column: str = "flags") -> Transform:
    """U03m."""
    return lambda rows: rows.withColumn(column, F.array_append(F.coalesce(F.col(column), F.array().cast("array<string>")), flag))


@register("set_roi")
def set_roi(ratio: float = 2.0, by: Sequence[str] = ("clip",), z: str = "z") -> Transform:
    """U03o: the clip's depth range, up to a multiple of the largest valid and visible depth."""

    def run(rows: DataFrame) -> DataFrame:
        most = rows.groupBy(*by).agg((F.max(F.when(F.col("valid") & F.col("visible"), F.col(z))) * ratio).alias("roi_high"))
        return rows.withColumn("roi_low", F.lit(0.0)).join(most, list(by))

    return run


@register("cast_float")
def cast_float(columns: Sequence[str]) -> Transform:
    """U06."""
    return lambda rows: rows.withColumns({c: F.col(c).cast("float") for c in columns})


@register("annotations")
def annotations(mode: str, names: Sequence[str]) -> Transform:
    """The ground-truth or the estimated fields under plain names."""
    if mode not in ("gt", "est"):
        raise ValueError("mode is gt or est")
    return lambda rows: rows.withColumns({n: F.col(f"{mode}_{n}") for n in names})
