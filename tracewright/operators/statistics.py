"""Dataset statistics, ranking, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def vector_stats(rows: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Extremes, mean and population deviation of each value, and whether it is constant."""
    cols = []
    for v in values:
        cols += [F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max"), F.avg(v).alias(f"{v}_mean"), F.stddev_pop(v).alias(f"{v}_std"), (F.stddev_pop(v) < 1e-6).alias(f"{v}_constant")]
    return rows.groupBy(*by).agg(*cols)


def distinct_rounded(rows: DataFrame, by: Sequence[str], value: str, places: Sequence[int]) -> DataFrame:
    """Numbers of distinct values at several precisions (half to even)."""
    return rows.groupBy(*by).agg(*(F.count_distinct(F.bround(value, p) + F.lit(0.0)).alias(f"distinct_{p}") for p in places))


def distinct_cells(rows: DataFrame, by: Sequence[str], axes: Sequence[str], cell: float) -> DataFrame:
    """Distinct cells of a grid."""
    return rows.groupBy(*by).agg(F.count_distinct(F.struct(*(F.floor(F.col(a) / cell).alias(a) for a in axes))).alias("cells"))


def percentiles(value: str, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> list[Column]:
    """Exact, interpolated."""
    return [F.percentile(value, F.lit(q)).alias(f"p{round(q * 100)}") for q in shares]


def share(predicate: Column) -> Column:
    """Per cent of rows."""
    return F.avg(predicate.cast("double")) * 100


def correlations(rows: DataFrame, by: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Correlation and sample covariance of each pair of axes."""
    pairs = [(a, b) for i, a in enumerate(axes) for b in axes[i + 1 :]]
    return rows.groupBy(*by).agg(*(F.corr(a, b).alias(f"corr_{a}_{b}") for a, b in pairs), *(F.covar_samp(a, b).alias(f"cov_{a}_{b}") for a, b in pairs))


def lag_errors(rows: DataFrame, by: Sequence[str], state: str, delta: str, pos: str) -> DataFrame:
    """How well previous state plus delta foretells the state, and the state alone."""
    order = Window.partitionBy(*by).orderBy(pos)
    before = F.lag(state).over(order)
    e = rows.select(*by, F.abs(F.col(state) - (before + F.col(delta))).alias("sum_err"), F.abs(F.col(state) - before).alias("hold_err"))
    return e.filter("hold_err IS NOT NULL").groupBy(*by).agg(*(f(c).alias(f"{n}_{c}") for c in ("sum_err", "hold_err") for n, f in (("mean", F.avg), ("max", F.max))))


def motion(rows: DataFrame, by: Sequence[str], axes: Sequence[str], pos: str) -> DataFrame:
    """Length of each track over its finite consecutive steps."""
    order = Window.partitionBy(*by).orderBy(pos)
    step = F.sqrt(sum((F.pow(F.col(a) - F.lag(a).over(order), F.lit(2)) for a in axes), F.lit(0.0)))
    good = ~F.isnan(step) & (step < F.lit(float("inf")))
    return rows.select(*by, F.when(good, step).alias("__d")).groupBy(*by).agg(F.coalesce(F.sum("__d"), F.lit(0.0)).alias("motion"))


def ranked(rows: DataFrame, by: Sequence[str], score: str | Column, key: str, name: str = "rank") -> DataFrame:
    """Places by descending score, from 1."""
    s = F.col(score) if isinstance(score, str) else score
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(s.desc(), key)).cast("long"))


def top_share(rows: DataFrame, by: Sequence[str], score: str, key: str, ratio: float, least: int = 10) -> DataFrame:
    """The top max(least, int(n * ratio)) of each group."""
    out = ranked(rows, by, score, key).withColumn("__n", F.count("*").over(Window.partitionBy(*by)))
    return out.filter(F.col("rank") <= F.greatest(F.lit(least), F.floor(F.col("__n") * ratio))).drop("__n")


def top_k(rows: DataFrame, by: Sequence[str], score: str, key: str, k: int, ascending: bool = True) -> DataFrame:
    """The k best of each group."""
    return ranked(rows, by, -F.col(score) if ascending else score, key).filter(F.col("rank") <= k)


def color_rank(rows: DataFrame, by: Sequence[str], axes: Sequence[str], key: str) -> DataFrame:
    """Places by squared norm of the axes scaled to their group's range, over n - 1."""
    group = Window.partitionBy(*by)
    unit = [((F.col(a) - F.min(a).over(group)) / F.coalesce(F.nullif(F.max(a).over(group) - F.min(a).over(group), F.lit(0.0)), F.lit(1.0))) for a in axes]
    out = rows.withColumn("__s", F.round(sum((u * u for u in unit), F.lit(0.0)), 9))
    place = F.row_number().over(group.orderBy("__s", key)) - 1
    return out.withColumn("color", place / F.greatest(F.count("*").over(group) - 1, F.lit(1))).drop("__s")


def even_pick(rows: DataFrame, by: Sequence[str], order: str, n: int = 5) -> DataFrame:
    """The first, the last and evenly spaced rows between; groups of fewer than n rows give none."""
    group = Window.partitionBy(*by)
    out = rows.withColumns({"pos": (F.row_number().over(group.orderBy(order)) - 1).cast("long"), "__n": F.count("*").over(group)})
    places = [F.lit(0), *(F.floor(F.lit(k) * F.col("__n") / (n - 1)) for k in range(1, n - 1)), F.col("__n") - 1]
    return out.filter((F.col("__n") >= n) & F.array_contains(F.array(*(p.cast("long") for p in places)), F.col("pos"))).drop("__n")


def uniform_pick(rows: DataFrame, by: Sequence[str], order: str, n: int) -> DataFrame:
    """Places int(i * (N - 1) / (n - 1)); the first for n = 1, all if there are no more than n."""
    group = Window.partitionBy(*by)
    out = rows.withColumns({"pos": (F.row_number().over(group.orderBy(order)) - 1).cast("long"), "__n": F.count("*").over(group)})
    places = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * (F.col("__n") - 1) / max(1, n - 1)).cast("long")) if n > 1 else F.array(F.lit(0).cast("long"))
    return out.filter((F.col("__n") <= n) | F.array_contains(places, F.col("pos"))).drop("__n")


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows in the order of a seeded digest of their key; the same for any partitioning."""
    return rows.withColumn("__h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)).orderBy("__h", key).limit(n).drop("__h")


def digest_mod(value: Column, modulus: int) -> Column:
    """SHA-256 of a value modulo a number below 2^31, a 32-bit digit at a time."""
    digest = F.sha2(value.cast("string"), 256)
    out = F.lit(0).cast("long")
    for k in range(8):
        digit = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
        out = (out * ((1 << 32) % modulus) + digit) % modulus
    return out


def weighted_choice(draws: DataFrame, unit: str, weights: DataFrame, name: str, weight: str, order: str, cells: int = 1024) -> DataFrame:
    """For each number in [0, 1) the item in whose share of the summed weights it falls. Shares are cut into cells of [0, 1), so that the join is on
    equality; only the running sum over the items (a list of datasets) is in one task."""
    along = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    upto = weights.select(F.col(name), F.col(weight).cast("double").alias("__w"), F.sum(weight).over(along).cast("double").alias("__upto")).withColumn("__sum", weights.agg(F.sum(weight).cast("double")).scalar())
    shares = upto.select(name, ((F.col("__upto") - F.col("__w")) / F.col("__sum")).alias("__from"), (F.col("__upto") / F.col("__sum")).alias("__to"))
    cut = shares.withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__from") * cells), F.least(F.floor(F.col("__to") * cells), F.lit(cells - 1)))))
    at = draws.withColumn("__cell", F.floor(F.col(unit) * cells))
    return at.join(cut, "__cell").filter((F.col(unit) >= F.col("__from")) & (F.col(unit) < F.col("__to"))).drop("__cell", "__from", "__to")


def uniform_choice(drawn: DataFrame, by: str, unit: str, files: DataFrame, name: str) -> DataFrame:
    """E07, second draw: of the chosen set's files in order the one at floor(unit * n)."""
    places = files.groupBy(by).agg(F.count("*").alias("__n"))
    listed = files.withColumn("__pos", F.row_number().over(Window.partitionBy(by).orderBy(name)) - 1)
    return drawn.join(places, by).withColumn("__pos", F.floor(F.col(unit) * F.col("__n")).cast("int")).join(listed, [by, "__pos"]).drop("__n", "__pos")


def round_robin(index: Column, devices: Sequence[str]) -> Column:
    """The device of the index-th case, from 1."""
    return F.element_at(F.array(*map(F.lit, devices)), ((index - 1) % len(devices) + 1).cast("int"))


def latest(rows: DataFrame, order: str, key: str, n: int = 5) -> DataFrame:
    """The n newest."""
    return rows.orderBy(F.desc(order), key).limit(n)
