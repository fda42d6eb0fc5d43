"""Depth alignment, order statistics and error measures over pixels (frame, known, pred) and other weighted points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positive(value: Column) -> Column:
    """The depth where it is valid, else null."""
    return F.when(value > 0, value)


def frame_scales(pixels: DataFrame, frame: Sequence[str], known: str, pred: str) -> DataFrame:
    """Median of known over median of predicted depth where both are valid."""
    both = pixels.filter((F.col(known) > 0) & (F.col(pred) > 0))
    return both.groupBy(*frame).agg((F.median(known) / F.median(pred)).alias("scale"))


def video_scale(scales: DataFrame, clip: Sequence[str] = ()) -> DataFrame:
    """The mean of a clip's frame scales."""
    return scales.groupBy(*clip).agg(F.avg("scale").alias("scale"))


def align_video(pixels: DataFrame, frame: Sequence[str], known: str, pred: str, clip: Sequence[str] = ()) -> DataFrame:
    """Pixels with pred multiplied by the clip's scale. A clip is one row of the side that is joined; without clips the scale is a scalar."""
    scales = video_scale(frame_scales(pixels, [*clip, *frame], known, pred), clip)
    scaled = pixels.join(scales, list(clip)) if clip else pixels.withColumn("scale", scales.scalar())
    return scaled.withColumn("aligned", F.col(pred) * F.col("scale"))


def kth_values(rows: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """Of each group the value at place int(share * n), counted from 1; null where that is 0."""
    group = Window.partitionBy(*by)
    ranked = rows.select(*by, F.col(value).alias("__v"), F.row_number().over(group.orderBy(value)).alias("__k"), F.count("*").over(group).alias("__n"))
    return ranked.groupBy(*by).agg(*(F.max(F.when(F.col("__k") == F.floor(F.lit(q) * F.col("__n")), F.col("__v"))).alias(f"q{round(q * 100)}") for q in shares))


def depth_roi(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The interval of plausible depths, up to the upper quartile and 1.5 times the interquartile range."""
    q = kth_values(rows.filter(F.col(value) > 0), by, value, (0.25, 0.75))
    return q.select(*by, F.lit(1e-7).alias("low"), (F.col("q75") + 1.5 * (F.col("q75") - F.col("q25"))).alias("high"))


def within_roi(rows: DataFrame, roi: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The value nulled outside its group's interval."""
    return rows.join(roi, list(by)).withColumn(value, F.when(F.col(value).between(F.col("low"), F.col("high")), F.col(value)))


def stretch_uint16(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Valid depths stretched to 0..65535 of their group, truncated; 32767 where all are equal, 0 where invalid."""
    valid = positive(F.col(value))
    ends = rows.groupBy(*by).agg(F.min(valid).alias("__low"), F.max(valid).alias("__high"))
    low, high = F.col("__low"), F.col("__high")
    unit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(value) - low) / F.nullif(high - low, F.lit(0.0))))
    return rows.join(ends, list(by)).withColumn("stretched", F.when(valid.isNull(), 0).when(high == low, 32767).otherwise(F.floor(unit * 65535)).cast("int")).drop("__low", "__high")


def nan_as_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def masked_mean(value: Column, mask: Column, eps: float = 1e-6) -> Column:
    """The mean over a mask, and nothing divided by zero."""
    return F.sum(value * mask) / (F.sum(mask) + eps)


def masked_variance(value: Column, mask: Column) -> Column:
    """Population variance over a mask, at least one count."""
    n = F.greatest(F.sum(mask), F.lit(1.0))
    mean = F.sum(value * mask) / n
    return F.sum(value * value * mask) / n - mean * mean


def weighted_means(value: Column, weight: Column) -> dict[str, Column]:
    """Arithmetic, harmonic and geometric means."""
    total = F.sum(weight)
    return {"arithmetic": F.sum(value * weight) / total, "harmonic": total / F.sum(weight / value), "geometric": F.exp(F.sum(weight * F.ln(value)) / total)}


def weighted_std(value: Column, weight: Column) -> Column:
    """In moment form."""
    mean = F.sum(value * weight) / F.sum(weight)
    return F.sqrt(F.greatest(F.lit(0.0), F.sum(value * value * weight) / F.sum(weight) - mean * mean))


def scale_shift(rows: DataFrame, by: Sequence[str], pred: str, target: str, mask: Column) -> DataFrame:
    """Least-squares scale and shift of pred to target over a mask; both 0 where the system is singular."""
    p, t = F.col(pred), F.col(target)
    s = rows.groupBy(*by).agg(F.sum(mask * p * p).alias("a"), F.sum(mask * p).alias("b"), F.sum(mask).alias("c"), F.sum(mask * p * t).alias("d"), F.sum(mask * t).alias("e"))
    det = F.col("a") * F.col("c") - F.col("b") * F.col("b")
    solved = lambda x: F.when(det > 0, x / F.nullif(det, F.lit(0.0))).otherwise(0.0)
    return s.select(*by, solved(F.col("c") * F.col("d") - F.col("b") * F.col("e")).alias("scale"), solved(F.col("a") * F.col("e") - F.col("b") * F.col("d")).alias("shift"))


def affine_points(rows: DataFrame, by: Sequence[str], source: Sequence[str], target: Sequence[str], weight: str) -> DataFrame:
    """One scale and a shift for each axis that take source points to target points, weighted."""
    w = F.col(weight)
    pairs = list(zip(source, target, strict=True))
    sums = [F.sum(w).alias("w")]
    for k, (x, y) in enumerate(pairs):
        sums += [F.sum(w * F.col(x)).alias(f"x{k}"), F.sum(w * F.col(y)).alias(f"y{k}"), F.sum(w * F.col(x) * F.col(y)).alias(f"xy{k}"), F.sum(w * F.col(x) * F.col(x)).alias(f"xx{k}")]
    s = rows.groupBy(*by).agg(*sums)
    over = sum((F.col(f"xy{k}") - F.col(f"x{k}") * F.col(f"y{k}") / F.col("w") for k in range(len(pairs))), F.lit(0.0))
    under = sum((F.col(f"xx{k}") - F.col(f"x{k}") * F.col(f"x{k}") / F.col("w") for k in range(len(pairs))), F.lit(0.0))
    scaled = s.withColumn("scale", over / F.nullif(under, F.lit(0.0)))
    return scaled.select(*by, "scale", *((F.col(f"y{k}") - F.col("scale") * F.col(f"x{k}")).alias(f"__{k}") for k in range(len(pairs))), "w").select(*by, "scale", *((F.col(f"__{k}") / F.col("w")).alias(f"shift_{t}") for k, t in enumerate(target)))


def l1_scale(rows: DataFrame, by: Sequence[str], x: str, y: str, weight: str, key: str) -> DataFrame:
    """The scale a that minimises the weighted sum of |a x - y|: a weighted median of y / x under the weights w |x|; key breaks ties."""
    ratio = rows.filter(F.col(x) != 0).select(*by, (F.col(y) / F.col(x)).alias("ratio"), (F.col(weight) * F.abs(x)).alias("w"), key)
    order = Window.partitionBy(*by).orderBy("ratio", key)
    running = ratio.withColumns({"run": F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("w").over(Window.partitionBy(*by))})
    return running.filter(F.col("run") * 2 >= F.col("all")).groupBy(*by).agg(F.min("ratio").alias("scale"))


def robust_norm(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Values less the group's median, over their mean absolute deviation."""
    centre = rows.groupBy(*by).agg(F.median(value).alias("centre"))
    centred = rows.join(centre, list(by)).withColumn("centred", F.col(value) - F.col("centre"))
    spread = centred.groupBy(*by).agg(F.avg(F.abs("centred")).alias("spread"))
    return centred.join(spread, list(by)).withColumn("normed", F.col("centred") / F.nullif(F.col("spread"), F.lit(0.0)))


def quantile_norm(value: str, by: Sequence[str], low: float = 0.02, high: float = 0.98) -> tuple[list[str], list[Column]]:
    """Group and aggregates for scaling by exact quantiles."""
    return list(by), [F.percentile(value, F.lit(low)).alias("low"), F.percentile(value, F.lit(high)).alias("high")]


def depth_metrics(truth: Column, pred: Column) -> dict[str, Column]:
    """The usual depth errors as aggregates; both depths positive."""
    ratio = F.greatest(truth / pred, pred / truth)
    apart, logs = truth - pred, F.ln(pred) - F.ln(truth)
    near = lambda limit: F.avg((ratio < limit).cast("double"))
    return {
        "a1": near(1.25), "a2": near(1.25**2), "a3": near(1.25**3),
        "abs_rel": F.avg(F.abs(apart) / truth), "sq_rel": F.avg(apart * apart / truth),
        "rmse": F.sqrt(F.avg(apart * apart)), "rmse_log": F.sqrt(F.avg(logs * logs)),
        "silog": F.sqrt(F.greatest(F.lit(0.0), F.avg(logs * logs) - F.avg(logs) * F.avg(logs))) * 100,
        "log10": F.avg(F.abs(F.log10(truth) - F.log10(pred))),
    }


def clamp_at_quantile(rows: DataFrame, by: Sequence[str], value: str, share: float = 0.01, factor: float = 100.0) -> DataFrame:
    """No value beyond a multiple of its group's low quantile."""
    limit = rows.groupBy(*by).agg((F.percentile(value, F.lit(share)) * factor).alias("limit"))
    return rows.join(limit, list(by)).withColumn("clamped", F.least(F.col(value), F.col("limit")))


def scene_norm(rows: DataFrame, by: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Coordinates less the group's mean over its pooled population deviation."""
    moments = rows.groupBy(*by).agg(*(F.avg(a).alias(f"mean_{a}") for a in axes), *(F.var_pop(a).alias(f"var_{a}") for a in axes))
    pooled = moments.withColumn("spread", F.sqrt(sum((F.col(f"var_{a}") for a in axes), F.lit(0.0)) / len(axes)))
    return rows.join(pooled, list(by)).withColumns({f"norm_{a}": (F.col(a) - F.col(f"mean_{a}")) / F.nullif(F.col("spread"), F.lit(0.0)) for a in axes})
