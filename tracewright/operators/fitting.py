"""Fits and searches without a column form: truncated and affine L1, IRLS, rigid alignment, nearest fill, keyframes.

Each works on one group (a frame, a clip) of bounded size in a grouped Arrow function; what can be summed is summed by Spark first.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.depth import l1_scale
from tracewright.operators.matching import folded_views


def _names(rows: DataFrame, by: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)


def best_truncated_scale(x: np.ndarray, y: np.ndarray, w: np.ndarray, limit: float) -> tuple[float, float]:
    """The scale a of least sum of w * min(|a x - y|, limit), and that sum.

    Each point's loss is flat, falls, rises and is flat again in a; the slopes change at (y - limit) / x, y / x and (y + limit) / x, so the minimum is at one of those places and prefix sums give the loss at all of them."""
    keep = np.abs(x) > 1e-12
    still = float((w[~keep] * np.minimum(np.abs(y[~keep]), limit)).sum())
    x, y, w = x[keep], y[keep], w[keep]
    if not len(x):
        return 0.0, still
    y, x = np.where(x < 0, -y, y), np.abs(x)
    places = np.concatenate([(y - limit) / x, y / x, (y + limit) / x])
    turns = np.concatenate([-w * x, 2 * w * x, -w * x])
    order = np.argsort(places, kind="stable")
    at, slope = places[order], np.cumsum(turns[order])
    loss = (w * limit).sum() + np.concatenate([[0.0], np.cumsum(slope[:-1] * np.diff(at))])
    k = int(np.argmin(loss))
    return float(at[k]), float(loss[k]) + still


def truncated_scale(rows: DataFrame, by: Sequence[str], x: str, y: str, weight: str, limit: float) -> DataFrame:
    """Of each group the scale with the least truncated L1 loss."""
    keys = list(by)

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        a, loss = best_truncated_scale(*(p[c].to_numpy(float) for c in (x, y, weight)), limit)
        return p[keys].head(1).assign(scale=a, loss=loss)

    return rows.select(*keys, x, y, weight).groupBy(*keys).applyInPandas(fit, f"{_names(rows, keys)}, scale double, loss double")


def weighted_median_shift(rows: DataFrame, by: Sequence[str], x: str, y: str, weight: str, key: str) -> DataFrame:
    """The shift b of least sum of w |x + b - y|."""
    return l1_scale(rows.withColumns({"__one": F.lit(1.0), "__gap": F.col(y) - F.col(x)}), by, "__one", "__gap", weight, key).withColumnRenamed("scale", "shift")


def anchored_affine(rows: DataFrame, by: Sequence[str], x: str, y: str, weight: str) -> DataFrame:
    """Scale and shift of least L1 loss; an optimal line passes through some weighted point, so each is tried as the anchor and the best is kept. Groups are samples of a frame; the work grows with their square."""
    keys = list(by)

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        px, py, w = (p[c].to_numpy(float) for c in (x, y, weight))
        best = (np.inf, 0.0, 0.0)
        for k in np.nonzero(w > 0)[0]:
            a, loss = _l1_scale(px - px[k], py - py[k], w)
            best = min(best, (loss, a, py[k] - a * px[k]))
        return p[keys].head(1).assign(scale=best[1], shift=best[2], loss=best[0])

    return rows.select(*keys, x, y, weight).groupBy(*keys).applyInPandas(fit, f"{_names(rows, keys)}, scale double, shift double, loss double")


def _l1_scale(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    keep = np.abs(x) > 1e-12
    if not keep.any():
        return 0.0, float((w * np.abs(y)).sum())
    r, v = y[keep] / x[keep], w[keep] * np.abs(x[keep])
    order = np.argsort(r, kind="stable")
    run = np.cumsum(v[order])
    a = float(r[order][np.searchsorted(2 * run, run[-1])])
    return a, float((w * np.abs(a * x - y)).sum())


def irls_affine(rows: DataFrame, by: Sequence[str], x: str, y: str, weight: str, rounds: int = 20, eps: float = 1e-3) -> DataFrame:
    """Scale and shift by least squares, reweighted by the inverse of the residuals."""
    keys = list(by)

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        px, py, w = (p[c].to_numpy(float) for c in (x, y, weight))
        design, now = np.column_stack([px, np.ones(len(px))]), w
        for _ in range(rounds):
            s = np.sqrt(now)[:, None]
            solved = np.linalg.lstsq(design * s, py * s[:, 0], rcond=None)[0]
            now = w / np.maximum(np.abs(design @ solved - py), eps)
        return p[keys].head(1).assign(scale=solved[0], shift=solved[1])

    return rows.select(*keys, x, y, weight).groupBy(*keys).applyInPandas(fit, f"{_names(rows, keys)}, scale double, shift double")


def rigid_of_moments(cross: np.ndarray) -> np.ndarray:
    """The rotation nearest to a cross-covariance (target by source), without mirroring."""
    u, _, vt = np.linalg.svd(cross)
    return u @ np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt))]) @ vt


def procrustes(rows: DataFrame, by: Sequence[str], source: Sequence[str], target: Sequence[str], weight: str, scaled: bool = True) -> DataFrame:
    """Similarity (or rigid motion) that takes source points to target points. Spark sums the moments; a row per group is solved by SVD."""
    keys, w = list(by), F.col(weight)
    sums = [F.sum(w).alias("w"), *(F.sum(w * F.col(c)).alias(f"s{i}") for i, c in enumerate(source)), *(F.sum(w * F.col(c)).alias(f"t{i}") for i, c in enumerate(target))]
    sums += [F.sum(w * F.col(t) * F.col(s)).alias(f"c{i}{j}") for i, t in enumerate(target) for j, s in enumerate(source)]
    sums.append(F.sum(w * sum((F.col(s) * F.col(s) for s in source[1:]), F.col(source[0]) * F.col(source[0]))).alias("ss"))
    moments = rows.groupBy(*keys).agg(*sums)

    def solve(batches):
        for p in batches:
            out = []
            for row in p.itertuples(index=False):
                s, t = (np.array([getattr(row, f"{n}{i}") for i in range(3)]) / row.w for n in "st")
                cross = np.array([[getattr(row, f"c{i}{j}") for j in range(3)] for i in range(3)]) / row.w - np.outer(t, s)
                r = rigid_of_moments(cross)
                spread = row.ss / row.w - s @ s
                k = float(np.trace(r.T @ cross) / spread) if scaled and spread > 1e-12 else 1.0
                out.append((*(getattr(row, c) for c in keys), k, r.ravel().tolist(), (t - k * r @ s).tolist()))
            yield pd.DataFrame(out, columns=[*keys, "scale", "rotation", "translation"])

    return moments.mapInPandas(solve, f"{_names(rows, keys)}, scale double, rotation array<double>, translation array<double>")


def nearest_fill(cells: DataFrame, by: Sequence[str], u: str, v: str, value: str) -> DataFrame:
    """Each empty cell of a grid gets the value of the nearest filled one of its frame (of equals the first by row and column), with the distance."""
    keys = list(by)

    def fill(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values([v, u], kind="stable").reset_index(drop=True)
        known = p[p[value].notna()]
        out = p.assign(distance=0.0)
        gaps = p[value].isna().to_numpy()
        if known.empty or not gaps.any():
            return out
        at, values = known[[v, u]].to_numpy(float), known[value].to_numpy(float)
        wanted = p.loc[gaps, [v, u]].to_numpy(float)
        filled, far = np.empty(len(wanted)), np.empty(len(wanted))
        block = max(1, (1 << 20) // len(at))
        for k in range(0, len(wanted), block):
            d = ((wanted[k : k + block, None, :] - at[None, :, :]) ** 2).sum(axis=2)
            j = d.argmin(axis=1)  # the first of equals
            filled[k : k + block], far[k : k + block] = values[j], np.sqrt(d[np.arange(len(j)), j])
        out.loc[gaps, value], out.loc[gaps, "distance"] = filled, far
        return out

    return cells.select(*keys, u, v, value).groupBy(*keys).applyInPandas(fill, f"{_names(cells, [*keys, u, v])}, `{value}` double, distance double")


def keyframes(edges: DataFrame, by: Sequence[str], i: str, j: str, weight: str, n: int) -> DataFrame:
    """Frames chosen one at a time, each the least connected to those before; the first is the smallest."""
    keys = list(by)

    def choose(p: pd.DataFrame) -> pd.DataFrame:
        frames = sorted({*p[i], *p[j]})
        place = {f: k for k, f in enumerate(frames)}
        w = np.zeros((len(frames), len(frames)))
        np.add.at(w, ([place[a] for a in p[i]], [place[b] for b in p[j]]), p[weight].to_numpy(float))
        w = w + w.T
        chosen, near = [0], w[0].copy()
        while len(chosen) < min(n, len(frames)):
            near[chosen] = np.inf
            k = int(np.argmin(near))
            chosen.append(k)
            near = np.maximum(near, w[k])
        return pd.concat([p[keys].head(1)] * len(chosen), ignore_index=True).assign(frame=[int(frames[k]) for k in chosen], place=range(len(chosen)))

    return edges.select(*keys, i, j, weight).groupBy(*keys).applyInPandas(choose, f"{_names(edges, keys)}, frame long, place long")


def keyframes_of_views(seen: DataFrame, by: Sequence[str], item: Sequence[str], viewer: str, weight: str, n: int, places: int = 6) -> DataFrame:
    """Keyframes of the graph of covisibility (frames are viewers that share an item with another), whose edges are not listed: each choice reads only the weights of the chosen ones.

    Jobs run while the query is built, one or two for each of the n places, which hand the chosen frames to the driver. Weights are rounded, so that ties go to the smaller frame everywhere; a null weight counts as 0."""
    keys, shared, spark = list(by), [*by, *item], seen.sparkSession
    one = folded_views(seen, shared, viewer, weight)
    several = one.groupBy(*shared).count().filter("count > 1").select(*shared)
    one = one.join(several, shared, "left_semi").repartition(*keys, viewer).persist()
    few = lambda rows, size: F.broadcast(rows) if size <= 50_000 else rows
    try:
        picks = [(*r, 0) for r in one.groupBy(*keys).agg(F.min(viewer).alias("frame")).filter("frame IS NOT NULL").collect()]
        for place in range(1, n if picks else 0):
            chosen = few(spark.createDataFrame([p[:-1] for p in picks], one.select(*keys, viewer).schema), len(picks))
            theirs = one.join(chosen, [*keys, viewer]).select(*shared, F.col(viewer).alias("__c"), F.col("__w").alias("__x"))
            sums = one.join(few(theirs, theirs.count()), shared, "left").groupBy(*keys, viewer, "__c").agg(F.round(F.coalesce(F.sum(F.col("__w") * F.col("__x")), F.lit(0.0)), places).alias("__s"))
            met = sums.groupBy(*keys, viewer).agg(F.max(F.when(F.col("__c").isNotNull(), F.col("__s"))).alias("__s"), F.count("__c").alias("__m"))
            near = F.when(F.col("__m") < place, F.greatest("__s", F.lit(0.0))).otherwise(F.col("__s"))
            left = met.join(chosen, [*keys, viewer], "left_anti").groupBy(*keys).agg(F.min(F.struct(near.alias("near"), F.col(viewer).alias("frame"))).alias("best")).filter("best IS NOT NULL")
            found = [(*r, place) for r in left.select(*keys, "best.frame").collect()]
            if not found:
                break
            picks += found
    finally:
        one.unpersist()
    return spark.createDataFrame([(*p[:-2], int(p[-2]), p[-1]) for p in picks], f"{_names(one, keys)}{', ' if keys else ''}frame long, place long")


def average_motion(pairs: DataFrame, by: Sequence[str], i: str, j: str, rotation: str, shift: str | None = None) -> DataFrame:
    """Absolute rotations (the first frame is the identity) from relative ones R_ij = R_j R_i^T, by the leading eigenvectors of the block matrix of a clip.

    With relative shifts t_ij = t_j - R_ij t_i also the absolute ones, by least squares over all pairs from the averaged rotations (the first frame is at zero). Frames that no pairs tie to the first get the smallest solution."""
    keys = list(by)

    def solve(p: pd.DataFrame) -> pd.DataFrame:
        frames = sorted({*p[i], *p[j]})
        place, n = {f: k for k, f in enumerate(frames)}, len(frames)
        m, degree = np.eye(3 * n), np.ones(n)
        for a, b, r in zip(p[i], p[j], p[rotation], strict=True):
            a, b, r = place[a], place[b], np.array(r).reshape(3, 3)
            m[3 * b : 3 * b + 3, 3 * a : 3 * a + 3] += r
            m[3 * a : 3 * a + 3, 3 * b : 3 * b + 3] += r.T
            degree[[a, b]] += 1
        d = np.repeat(1 / np.sqrt(degree), 3)
        _, vectors = np.linalg.eigh(m * d[:, None] * d[None, :])
        blocks = (vectors[:, -3:] * np.repeat(np.sqrt(degree), 3)[:, None]).reshape(n, 3, 3)
        if np.linalg.det(blocks[0]) < 0:
            blocks = blocks * np.array([1.0, 1.0, -1.0])
        turned = [rigid_of_moments(x @ np.linalg.inv(blocks[0])) for x in blocks]
        out = pd.concat([p[keys].head(1)] * n, ignore_index=True).assign(frame=[int(f) for f in frames], rotation=[r.ravel().tolist() for r in turned])
        if shift:
            # normal equations, so their size goes by the frames, not by the pairs
            lhs, rhs = np.zeros((3 * n, 3 * n)), np.zeros(3 * n)
            for a, b, t in zip(p[i], p[j], p[shift], strict=True):
                a, b, t = place[a], place[b], np.array(t)
                r = turned[b] @ turned[a].T
                sa, sb = slice(3 * a, 3 * a + 3), slice(3 * b, 3 * b + 3)
                lhs[sb, sb] += np.eye(3)
                lhs[sa, sa] += r.T @ r
                lhs[sb, sa] -= r
                lhs[sa, sb] -= r.T
                rhs[sb] += t
                rhs[sa] -= r.T @ t
            free = np.linalg.lstsq(lhs[3:, 3:], rhs[3:], rcond=None)[0]
            out = out.assign(shift=np.concatenate([np.zeros(3), free]).reshape(n, 3).tolist())
        return out

    schema = f"{_names(pairs, keys)}, frame long, rotation array<double>" + (", shift array<double>" if shift else "")
    return pairs.select(*keys, i, j, rotation, *([shift] if shift else [])).groupBy(*keys).applyInPandas(solve, schema)


def axes_meeting(rays: DataFrame, by: Sequence[str], origin: Sequence[str], axis: Sequence[str]) -> DataFrame:
    """The point nearest to all optical axes of a group: the 3x3 normal equations are summed by Spark and solved by their adjugate, in columns."""
    o, d = [F.col(c) for c in origin], [F.col(c) for c in axis]
    norm = d[0] * d[0] + d[1] * d[1] + d[2] * d[2]
    m = {(r, c): F.lit(float(r == c)) - d[r] * d[c] / norm for r in range(3) for c in range(3)}
    sums = rays.groupBy(*by).agg(*(F.sum(m[r, c]).alias(f"m{r}{c}") for r in range(3) for c in range(3)), *(F.sum(sum((m[r, c] * o[c] for c in (1, 2)), m[r, 0] * o[0])).alias(f"b{r}") for r in range(3)))
    a = lambda r, c: F.col(f"m{r % 3}{c % 3}")
    cofactor = lambda r, c: a(r + 1, c + 1) * a(r + 2, c + 2) - a(r + 1, c + 2) * a(r + 2, c + 1)
    det = sum((a(0, c) * cofactor(0, c) for c in (1, 2)), a(0, 0) * cofactor(0, 0))
    solved = [sum((cofactor(r, c) * F.col(f"b{r}") for r in (1, 2)), cofactor(0, c) * F.col("b0")) / F.nullif(det, F.lit(0.0)) for c in range(3)]
    return sums.select(*by, *(s.alias(n) for s, n in zip(solved, origin, strict=True)))


def sampling_weights(points: DataFrame, by: Sequence[str], axes: Sequence[str], cell: float) -> DataFrame:
    """Weights by the inverse of local density, counted in cells of a grid."""
    group = Window.partitionBy(*by, *(F.floor(F.col(a) / cell) for a in axes))
    return points.withColumn("weight", 1.0 / F.count("*").over(group))
