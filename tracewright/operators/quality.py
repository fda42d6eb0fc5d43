"""Checks, reconciliation, run summaries and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def out_of_bounds(x: Column, y: Column, width: Column | float, height: Column | float) -> Column:
    """A key point outside the image."""
    return (x < 0) | (x >= width) | (y < 0) | (y >= height)


def finite(*values: Column) -> Column:
    """No value is NaN or infinite."""
    out = F.lit(True)
    for v in values:
        out = out & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return out


def near_point(z: Column, most: float = 10.0) -> Column:
    """P10."""
    return finite(z) & (z > 0) & (z < most)


def pixel_kept(u: Column, v: Column, k: int) -> Column:
    """Every k-th row and column."""
    return (u % k == 0) & (v % k == 0)


def keypoint_kept(track: Column, step: int, n: Column, crowd: int = 500) -> Column:
    """Every step-th track, but all of a crowd's."""
    return F.when(n > crowd, True).otherwise(track % step == 0)


def z_in_window(z: Column, low: float = 0.01, high: float = 50.0) -> Column:
    """The depth where it is plausible, else null."""
    return F.when(finite(z) & (z > low) & (z < high), z)


def shape_issues(samples: DataFrame, case: str, checks: dict[str, Column]) -> DataFrame:
    """A row (case, code) for each check that a sample fails."""
    codes = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in checks.items())))
    return samples.select(F.col(case).alias("case"), F.explode(codes).alias("code"))


def reason(*ordered: tuple[str, Column], otherwise: str = "ok") -> Column:
    """The first reason that holds."""
    out = F.lit(otherwise)
    for name, holds in reversed(ordered):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys of both sides with where they are found."""
    a, b = left.select(*key).distinct().withColumn("__l", F.lit(True)), right.select(*key).distinct().withColumn("__r", F.lit(True))
    both = a.join(b, list(key), "full")
    return both.select(*key, reason(("left_only", F.col("__r").isNull()), ("right_only", F.col("__l").isNull()), otherwise="both").alias("found"))


def unprocessed(cases: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Cases without output."""
    return cases.join(done.select(*key).distinct(), list(key), "left_anti")


def any_child(cases: DataFrame, children: DataFrame, key: Sequence[str]) -> DataFrame:
    """Cases with at least one child."""
    return cases.join(children.select(*key).distinct(), list(key), "left_semi")


def union_failed(failed: DataFrame, missing: DataFrame, key: str) -> DataFrame:
    """Distinct ids of both."""
    return failed.select(key).unionByName(missing.select(key)).distinct()


def run_summary(runs: DataFrame, by: Sequence[str], ok: Column, seconds: str) -> DataFrame:
    """Counts, times of the runs that succeeded, and their share."""
    good = F.when(ok, F.col(seconds))
    return runs.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.sum(good).alias("seconds"), F.avg(good).alias("mean_s"), F.min(good).alias("min_s"), F.max(good).alias("max_s"), (F.avg(ok.cast("double")) * 100).alias("success_rate")
    )


def eta(summary: DataFrame, gpus: int) -> DataFrame:
    """Hours and days for all cases at the mean time of those that succeeded, on one device and on several."""
    hours = F.when(F.col("succeeded") > 0, F.col("mean_s") * F.col("total") / 3600)
    return summary.withColumns({"hours": hours, "days": hours / 24, "hours_shared": hours / gpus})


def log_segments(lines: DataFrame, by: Sequence[str], order: Sequence[str], counted: Column, edges: Sequence[int], classes: dict[str, Column]) -> DataFrame:
    """Running number of the counted lines, cut at the edges; counts of each class by part. Streams (by) are independent."""
    running = F.sum(counted.cast("int")).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    part = F.lit(f"over_{edges[-1]}")
    for e in reversed(edges):
        part = F.when(running <= e, F.lit(f"to_{e}")).otherwise(part)
    return lines.withColumn("part", part).groupBy("part").agg(*(F.count_if(c).alias(n) for n, c in classes.items()), F.count("*").alias("lines"))


def log_counts(lines: DataFrame, patterns: dict[str, str], text: str) -> DataFrame:
    """Lines that match each pattern, in any case."""
    return lines.agg(*(F.count_if(F.lower(F.col(text)).rlike(p)).alias(n) for n, p in patterns.items()))


def file_counts(files: DataFrame, by: Sequence[str], size: str) -> DataFrame:
    """A10: files, those with content, and bytes of each folder."""
    return files.groupBy(*by).agg(F.count("*").alias("files"), F.count_if(F.col(size) > 0).alias("filled"), F.sum(size).cast("long").alias("bytes")).withColumn("has_content", F.col("filled") > 0)


def integrity(cases: DataFrame, errors: Column, incomplete: Column) -> DataFrame:
    """Errors count before incompleteness."""
    state = reason(("corrupted", errors), ("incomplete", incomplete), otherwise="complete")
    return cases.withColumn("state", state).groupBy("state").agg(F.count("*").alias("cases"))


def duplicate_files(files: DataFrame, content: Column) -> DataFrame:
    """Contents that occur more than once, by digest."""
    return files.groupBy(F.md5(content).alias("digest")).agg(F.count("*").alias("copies")).filter("copies > 1").withColumn("surplus", F.col("copies") - 1)


def issue_summary(issues: DataFrame, severity: str = "severity") -> DataFrame:
    """Errors, warnings and whether all passed."""
    return issues.agg(F.count_if(F.col(severity) == "ERROR").alias("errors"), F.count_if(F.col(severity) == "WARNING").alias("warnings")).withColumn("passed", F.col("errors") == 0)


def disk_estimate(cases: Column, base_mb: Column | float, overhead_mb: float, every: Column | int) -> Column:
    """MB of so many cases when every so many frames are written."""
    return cases * (F.lit(overhead_mb) + (base_mb - F.lit(overhead_mb)) / every)


def enough_space(need: Column, free: Column, margin: float = 1.1) -> Column:
    return free >= need * margin
