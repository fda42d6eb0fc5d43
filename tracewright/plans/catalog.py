"""Queries over the driver's tables, one for each operator, beside the SQL that gives the same rows.

Analogues: embeddings are tracks (label = clip, vec_id = track, 32 steps of x and y), events are step streams (user_id = track, in order of ts),
lineitem rows are pixels (l_suppkey = frame, l_extendedprice = known depth, l_quantity * p_retailprice = predicted depth), orders and customers are
cases and outputs, conversations are logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import geometry as g
from tracewright.functions import text as x
from tracewright.operators import depth, fitting, matching, measures, projection, quality, retarget, segments, statistics, transforms

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            SQL[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(value: Column | str, places: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, places) + F.lit(0.0)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retarget.tracks_from_vectors(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 32)


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.positions(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("l_suppkey").alias("frame"), "l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("known"), (F.col("l_quantity") * F.col("p_retailprice")).alias("pred"), "l_quantity", "l_discount")


TR = "tr AS MATERIALIZED (SELECT label AS clip, vec_id AS track, s AS step, CAST(embedding[2*s+1] AS DOUBLE) AS x, CAST(embedding[2*s+2] AS DOUBLE) AS y FROM embeddings, range(32) t(s))"
EV = "ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)"
PX = "px AS (SELECT l_suppkey AS frame, l_orderkey, l_partkey, l_linenumber, l_extendedprice AS known, l_quantity * p_retailprice AS pred, l_quantity, l_discount FROM lineitem JOIN part ON l_partkey = p_partkey)"
NORM = f"""{TR}, sc AS MATERIALIZED (SELECT clip, CASE WHEN abs(x) < 1e-12 THEN 1 ELSE x END AS sx, CASE WHEN abs(y) < 1e-12 THEN 1 ELSE y END AS sy
    FROM (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY track DESC) AS back FROM tr WHERE step = 0) WHERE back = 1),
  nm AS (SELECT clip, track, step, greatest(0.0, least(1.0, x / sx)) AS x, greatest(0.0, least(1.0, y / sy)) AS y, sx, sy FROM tr JOIN sc USING (clip)),
  sg AS (SELECT *, lead(x) OVER o AS x1, lead(y) OVER o AS y1 FROM nm WINDOW o AS (PARTITION BY clip, track ORDER BY step)),
  ln AS MATERIALIZED (SELECT *, sqrt((x1 - x) ** 2 + (y1 - y) ** 2) AS length FROM sg WHERE x1 IS NOT NULL)"""
ROBUST = """rk AS (SELECT clip, step, length, row_number() OVER (PARTITION BY clip, step ORDER BY length DESC, track) AS k, count(*) OVER (PARTITION BY clip, step) AS n FROM ln),
  rb AS (SELECT clip, step, avg(length) AS length FROM rk WHERE k <= greatest(1, ceil({top} * n)) GROUP BY clip, step),
  cu AS (SELECT *, sum(length) OVER (PARTITION BY clip ORDER BY step) AS ends FROM rb),
  sp AS MATERIALIZED (SELECT *, coalesce(lag(ends) OVER (PARTITION BY clip ORDER BY step), 0.0) AS begins FROM cu)"""
TARGETS = """tot AS (SELECT clip, max(ends) AS total FROM sp GROUP BY clip),
  cnt AS MATERIALIZED (SELECT *, least(floor(total / {interval}) + 1, {most})::INT AS samples FROM tot),
  tg AS (SELECT clip, sample, CASE WHEN sample = samples - 1 THEN least(sample * {interval}::DOUBLE, total) ELSE sample * {interval}::DOUBLE END AS target FROM (SELECT clip, total, samples, unnest(range(samples)) AS sample FROM cnt)),
  ch AS MATERIALIZED (SELECT clip, sample, target, max(step) AS step FROM tg JOIN sp USING (clip) WHERE begins <= target GROUP BY clip, sample, target),
  al AS (SELECT ch.clip, sample, ch.step, (target - begins) / greatest(length, 1e-12) AS alpha FROM ch JOIN sp ON sp.clip = ch.clip AND sp.step = ch.step)"""


def retarget_sql(interval: float, most: int, top: float) -> str:
    return f"""WITH {NORM}, {ROBUST.format(top=top)}, {TARGETS.format(interval=interval, most=most)}
        SELECT ln.clip, track, CAST(sample AS INT) AS sample, round((x + alpha * (x1 - x)) * sx, 6) + 0.0 AS x, round((y + alpha * (y1 - y)) * sy, 6) + 0.0 AS y
        FROM ln JOIN al ON al.clip = ln.clip AND al.step = ln.step"""


@query(retarget_sql(0.05, 64, 0.02))
def w19_arc_length_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retarget.retarget(tracks(spark, sf_dir)).select("clip", "track", "sample", r("x").alias("x"), r("y").alias("y"))


@query(retarget_sql(0.9, 64, 0.1))
def w19_coarse_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retarget.retarget(tracks(spark, sf_dir), 0.9, 64, 0.1).select("clip", "track", "sample", r("x").alias("x"), r("y").alias("y"))


@query(f"WITH {NORM}, {ROBUST.format(top=0.1)} SELECT clip, CAST(step AS INT) AS step, round(length, 6) + 0.0 AS length FROM rb")
def a05_robust_segment_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = retarget.segments(retarget.normalise(tracks(spark, sf_dir)))
    return retarget.robust_lengths(pieces, 0.1).select("clip", "step", r("length").alias("length"))


@query(f"WITH {NORM}, {ROBUST.format(top=0.02)} SELECT clip, CAST(step AS INT) AS step, round(begins, 6) + 0.0 AS begins, round(ends, 6) + 0.0 AS ends FROM sp")
def w02_cum_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = retarget.robust_lengths(retarget.segments(retarget.normalise(tracks(spark, sf_dir))), 0.02)
    return retarget.cumulative(lengths).select("clip", "step", r("begins").alias("begins"), r("ends").alias("ends"))


@query(f"WITH {NORM}, {ROBUST.format(top=0.02)}, {TARGETS.format(interval=0.9, most=64)} SELECT clip, round(total, 6) + 0.0 AS total, samples FROM cnt")
def a06_total_arc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = retarget.robust_lengths(retarget.segments(retarget.normalise(tracks(spark, sf_dir))), 0.02)
    return retarget.sample_counts(retarget.cumulative(lengths), 0.9, 64).select("clip", r("total").alias("total"), "samples")


@query(f"WITH {NORM}, {ROBUST.format(top=0.02)}, {TARGETS.format(interval=0.9, most=64)} SELECT clip, CAST(sample AS INT) AS sample, CAST(step AS INT) AS step, round(alpha, 6) + 0.0 AS alpha FROM al")
def j11_retarget_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = retarget.robust_lengths(retarget.segments(retarget.normalise(tracks(spark, sf_dir))), 0.02)
    return retarget.targets(retarget.cumulative(lengths), 0.9, 64).select("clip", "sample", "step", r("alpha").alias("alpha"))


@query(f"WITH {NORM} SELECT clip, track, CAST(step AS INT) AS step, round(length, 6) + 0.0 AS length FROM ln")
def w01_step_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retarget.segments(retarget.normalise(tracks(spark, sf_dir))).select("clip", "track", "step", r("length").alias("length"))


# depth


@query(f"WITH {PX} SELECT frame, round(median(known) / median(pred), 6) + 0.0 AS scale FROM px WHERE known > 0 AND pred > 0 GROUP BY frame")
def a01_depth_scale_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.frame_scales(pixels(spark, sf_dir), ["frame"], "known", "pred").select("frame", r("scale").alias("scale"))


@query(f"""WITH {PX}, f AS (SELECT frame, median(known) / median(pred) AS s FROM px WHERE known > 0 AND pred > 0 GROUP BY frame)
    SELECT frame, l_orderkey, l_partkey, l_linenumber, round(pred * (SELECT avg(s) FROM f), 4) + 0.0 AS aligned FROM px""")
def a02_depth_scale_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.align_video(pixels(spark, sf_dir), ["frame"], "known", "pred").select("frame", "l_orderkey", "l_partkey", "l_linenumber", r("aligned", 4).alias("aligned"))


KTH = f"""{PX}, rk AS (SELECT frame, known, row_number() OVER (PARTITION BY frame ORDER BY known) AS k, count(*) OVER (PARTITION BY frame) AS n FROM px WHERE known > 0),
    q AS (SELECT frame, max(known) FILTER (WHERE k = floor(0.25 * n)) AS q25, max(known) FILTER (WHERE k = floor(0.75 * n)) AS q75 FROM rk GROUP BY frame)"""


@query(f"WITH {KTH} SELECT frame, 1e-7::DOUBLE AS low, round(q75 + 1.5 * (q75 - q25), 4) + 0.0 AS high FROM q")
def a03_depth_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.depth_roi(pixels(spark, sf_dir), ["frame"], "known").select("frame", "low", r("high", 4).alias("high"))


@query(f"WITH {KTH} SELECT * FROM q")
def o08_kthvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.kth_values(pixels(spark, sf_dir), ["frame"], "known", (0.25, 0.75))


@query(f"WITH {KTH} SELECT frame, count(*) AS n, count(CASE WHEN known BETWEEN 1e-7 AND q75 + 0.1 * (q75 - q25) THEN 1 END) AS kept FROM px JOIN q USING (frame) GROUP BY frame")
def p23_roi_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pixels(spark, sf_dir)
    q = depth.kth_values(rows.filter("known > 0"), ["frame"], "known", (0.25, 0.75))
    roi = q.select("frame", F.lit(1e-7).alias("low"), (F.col("q75") + 0.1 * (F.col("q75") - F.col("q25"))).alias("high"))
    return depth.within_roi(rows, roi, ["frame"], "known").groupBy("frame").agg(F.count("*").alias("n"), F.count("known").alias("kept"))


@query("""WITH m AS (SELECT o_orderkey, o_totalprice AS v, min(CASE WHEN o_totalprice > 0 THEN o_totalprice END) OVER w AS lo, max(CASE WHEN o_totalprice > 0 THEN o_totalprice END) OVER w AS hi FROM orders WINDOW w AS (PARTITION BY o_orderpriority))
    SELECT o_orderkey, CAST(CASE WHEN v IS NULL OR v <= 0 THEN 0 WHEN lo = hi THEN 32767 ELSE floor(greatest(0.0, least(1.0, (v - lo) / (hi - lo))) * 65535) END AS INT) AS stretched FROM m""")
def a04_depth_minmax_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.stretch_uint16(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice").select("o_orderkey", "stretched")


@query("SELECT c_nationkey, count(*) AS n, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS valid, round(avg(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 4) + 0.0 AS mean FROM customer GROUP BY c_nationkey")
def p06_valid_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = depth.positive(F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count(v).alias("valid"), r(F.avg(v), 4).alias("mean"))


MASK = "CASE WHEN l_discount > 0.03 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


@query(f"""WITH {PX}, m AS (SELECT *, {MASK} AS m FROM px), s AS (SELECT frame, sum(l_quantity * m) AS a, sum(m) AS b, sum(l_quantity * l_quantity * m) AS c FROM m GROUP BY frame)
    SELECT frame, round(a / (b + 1e-6), 6) + 0.0 AS mean, round(c / greatest(b, 1.0) - (a / greatest(b, 1.0)) * (a / greatest(b, 1.0)), 6) + 0.0 AS var FROM s""")
def a25_masked_mean_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.when(F.col("l_discount") > 0.03, 1.0).otherwise(0.0)
    return pixels(spark, sf_dir).groupBy("frame").agg(r(depth.masked_mean(F.col("l_quantity"), mask)).alias("mean"), r(depth.masked_variance(F.col("l_quantity"), mask)).alias("var"))


@query(f"WITH {PX} SELECT frame, round(sum(known * l_quantity) / sum(l_quantity), 3) + 0.0 AS arithmetic, round(sum(l_quantity) / sum(l_quantity / known), 3) + 0.0 AS harmonic, round(exp(sum(l_quantity * ln(known)) / sum(l_quantity)), 3) + 0.0 AS geometric FROM px GROUP BY frame")
def a26_weighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = depth.weighted_means(F.col("known"), F.col("l_quantity"))
    return pixels(spark, sf_dir).groupBy("frame").agg(*(r(c, 3).alias(n) for n, c in means.items()))


@query(f"WITH {PX} SELECT frame, round(sqrt(greatest(0.0, sum(l_discount * l_discount * l_quantity) / sum(l_quantity) - (sum(l_discount * l_quantity) / sum(l_quantity)) ** 2)), 6) + 0.0 AS std FROM px GROUP BY frame")
def a27_weighted_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).groupBy("frame").agg(r(depth.weighted_std(F.col("l_discount"), F.col("l_quantity"))).alias("std"))


@query(f"""WITH {PX}, s AS (SELECT frame, sum(m * l_quantity * l_quantity) AS a, sum(m * l_quantity) AS b, sum(m) AS c, sum(m * l_quantity * l_discount) AS d, sum(m * l_discount) AS e FROM (SELECT *, {MASK} AS m FROM px) GROUP BY frame)
    SELECT frame, round(CASE WHEN a * c - b * b > 0 THEN (c * d - b * e) / (a * c - b * b) ELSE 0.0 END, 6) + 0.0 AS scale, round(CASE WHEN a * c - b * b > 0 THEN (a * e - b * d) / (a * c - b * b) ELSE 0.0 END, 6) + 0.0 AS shift FROM s""")
def a28_lsq_scale_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.when(F.col("l_discount") > 0.03, 1.0).otherwise(0.0)
    return depth.scale_shift(pixels(spark, sf_dir), ["frame"], "l_quantity", "l_discount", mask).select("frame", r("scale").alias("scale"), r("shift").alias("shift"))


@query(f"""WITH {TR}, p AS (SELECT a.clip, a.track, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1, 1.0 + a.track % 3 AS w FROM tr a JOIN tr b ON a.track = b.track AND a.step = 0 AND b.step = 1),
    s AS (SELECT clip, sum(w) AS w, sum(w*x0) AS a0, sum(w*x1) AS b0, sum(w*x0*x1) AS ab0, sum(w*x0*x0) AS aa0, sum(w*y0) AS a1, sum(w*y1) AS b1, sum(w*y0*y1) AS ab1, sum(w*y0*y0) AS aa1 FROM p GROUP BY clip),
    k AS (SELECT *, (ab0 - a0*b0/w + ab1 - a1*b1/w) / (aa0 - a0*a0/w + aa1 - a1*a1/w) AS scale FROM s)
    SELECT clip, round(scale, 6) + 0.0 AS scale, round((b0 - scale*a0)/w, 6) + 0.0 AS shift_x1, round((b1 - scale*a1)/w, 6) + 0.0 AS shift_y1 FROM k""")
def a29_affine_scale_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks(spark, sf_dir).withColumnsRenamed({"x": "x0", "y": "y0"})
    ahead = segments.relative_offsets(t, ["clip", "track"], "x0", "step").withColumnRenamed("ahead", "dx")
    ahead = segments.relative_offsets(ahead.drop("behind"), ["clip", "track"], "y0", "step").withColumnRenamed("ahead", "dy").filter("step = 0")
    both = ahead.select("clip", "x0", "y0", (F.col("x0") + F.col("dx")).alias("x1"), (F.col("y0") + F.col("dy")).alias("y1"), (1.0 + F.col("track") % 3).alias("w"))
    out = depth.affine_points(both, ["clip"], ["x0", "y0"], ["x1", "y1"], "w")
    return out.select("clip", r("scale").alias("scale"), r("shift_x1").alias("shift_x1"), r("shift_y1").alias("shift_y1"))


@query(f"""WITH {PX}, q AS (SELECT frame, known / pred AS ratio, l_quantity * abs(pred) AS w, l_orderkey * 10 + l_linenumber AS k FROM px WHERE pred <> 0),
    c AS (SELECT *, sum(w) OVER (PARTITION BY frame ORDER BY ratio, k ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY frame) AS total FROM q)
    SELECT frame, round(min(ratio), 6) + 0.0 AS scale FROM c WHERE 2 * run >= total GROUP BY frame""")
def a30_l1_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pixels(spark, sf_dir).withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return depth.l1_scale(rows, ["frame"], "pred", "known", "l_quantity", "k").select("frame", r("scale").alias("scale"))


@query("""WITH c AS (SELECT c_nationkey AS n, median(c_acctbal) AS m FROM customer GROUP BY 1), d AS (SELECT c_custkey, n, c_acctbal - m AS v FROM customer JOIN c ON n = c_nationkey), s AS (SELECT n, avg(abs(v)) AS s FROM d GROUP BY n)
    SELECT c_custkey, round(v / s, 6) + 0.0 AS normed FROM d JOIN s USING (n)""")
def a34_robust_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.robust_norm(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal").select("c_custkey", r("normed").alias("normed"))


@query("SELECT c_nationkey, round(quantile_cont(c_acctbal, 0.02), 4) + 0.0 AS low, round(quantile_cont(c_acctbal, 0.98), 4) + 0.0 AS high FROM customer GROUP BY c_nationkey")
def a34_quantile_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    by, aggregates = depth.quantile_norm("c_acctbal", ["c_nationkey"])
    return table(spark, sf_dir, "customer").groupBy(*by).agg(*aggregates).select("c_nationkey", r("low", 4).alias("low"), r("high", 4).alias("high"))


@query(f"""WITH {PX}, e AS (SELECT frame, known AS t, pred AS p, greatest(known / pred, pred / known) AS q, ln(pred) - ln(known) AS l FROM px WHERE known > 0 AND pred > 0)
    SELECT frame, round(avg(CAST(q < 1.25 AS DOUBLE)), 6) + 0.0 AS a1, round(avg(CAST(q < 1.5625 AS DOUBLE)), 6) + 0.0 AS a2, round(avg(CAST(q < 1.953125 AS DOUBLE)), 6) + 0.0 AS a3,
      round(avg(abs(t - p) / t), 6) + 0.0 AS abs_rel, round(avg((t - p) * (t - p) / t), 3) + 0.0 AS sq_rel, round(sqrt(avg((t - p) * (t - p))), 3) + 0.0 AS rmse, round(sqrt(avg(l * l)), 6) + 0.0 AS rmse_log,
      round(sqrt(greatest(0.0, avg(l * l) - avg(l) * avg(l))) * 100, 4) + 0.0 AS silog, round(avg(abs(log10(t) - log10(p))), 6) + 0.0 AS log10 FROM e GROUP BY frame""")
def a35_depth_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = {"sq_rel": 3, "rmse": 3, "silog": 4}
    m = depth.depth_metrics(F.col("known"), F.col("pred"))
    return pixels(spark, sf_dir).filter("known > 0 AND pred > 0").groupBy("frame").agg(*(r(c, places.get(n, 6)).alias(n) for n, c in m.items()))


@query(f"WITH {PX}, l AS (SELECT frame, quantile_cont(l_quantity, 0.01) * 20 AS cap FROM px GROUP BY frame) SELECT frame, round(sum(least(l_quantity, cap)), 4) + 0.0 AS total FROM px JOIN l USING (frame) GROUP BY frame")
def a47_nanquantile_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.clamp_at_quantile(pixels(spark, sf_dir), ["frame"], "l_quantity", 0.01, 20.0).groupBy("frame").agg(r(F.sum("clamped"), 4).alias("total"))


@query(f"""WITH {TR}, m AS (SELECT clip, avg(x) AS mx, avg(y) AS my, sqrt((var_pop(x) + var_pop(y)) / 2) AS s FROM tr GROUP BY clip)
    SELECT clip, track, CAST(step AS INT) AS step, round((x - mx) / s, 6) + 0.0 AS norm_x, round((y - my) / s, 6) + 0.0 AS norm_y FROM tr JOIN m USING (clip)""")
def a24_scene_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = depth.scene_norm(tracks(spark, sf_dir), ["clip"], ["x", "y"])
    return out.select("clip", "track", "step", r("norm_x").alias("norm_x"), r("norm_y").alias("norm_y"))


@query("SELECT event_type, count(value) AS n, round(min(value), 6) + 0.0 AS low, round(avg(value), 6) + 0.0 AS mean, round(var_pop(value), 4) + 0.0 AS var FROM events WHERE value > 20 GROUP BY event_type")
def a23_nan_reductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = depth.nan_as_null(F.when(F.col("value") > 20, F.col("value")).otherwise(F.lit(float("nan"))))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(v).alias("n"), r(F.min(v)).alias("low"), r(F.avg(v)).alias("mean"), r(F.var_pop(v), 4).alias("var"))


# segments and windows


@query(f"WITH {EV} SELECT user_id, event_id, pos // 3 AS pos FROM ev WHERE pos % 3 = 0")
def p01_stride_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.stride(steps(spark, sf_dir), 3).select("user_id", "event_id", "pos")


@query(f"WITH {EV} SELECT user_id, event_id, pos // 2 AS pos FROM ev WHERE pos % 2 = 0 AND pos // 2 < 10")
def p02_cap_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.cap(segments.stride(steps(spark, sf_dir), 2), 10).select("user_id", "event_id", "pos")


@query("SELECT user_id, greatest(1, CAST(ceil(count(*) / 50.0) AS BIGINT)) AS stride FROM events GROUP BY user_id")
def p03_auto_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(segments.auto_stride(F.count("*"), 50).alias("stride"))


SEG = "n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), sg AS (SELECT user_id, query, least(query + 16, n) AS ends FROM (SELECT user_id, n, unnest(range(0, n, 5)) AS query FROM n))"


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.query_segments(table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")), ["user_id"], "n", 5, 16)


@query(f"WITH {SEG} SELECT * FROM sg")
def p04_query_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)


@query(f"WITH {SEG} SELECT user_id, ends - query AS length, count(*) AS segments FROM sg GROUP BY ALL")
def p05_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).groupBy("user_id", (F.col("ends") - F.col("query")).alias("length")).agg(F.count("*").alias("segments"))


@query(f"WITH {EV}, {SEG} SELECT user_id, query, pos, event_id FROM ev JOIN sg USING (user_id) WHERE pos >= query AND pos < ends")
def j03_segment_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.frames_of_segments(steps(spark, sf_dir).select("user_id", "pos", "event_id"), _segments(spark, sf_dir), ["user_id"]).select("user_id", "query", "pos", "event_id")


VP = "a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events WHERE event_type = 'view'), b AS (SELECT user_id, event_id AS other_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events WHERE event_type = 'click')"


def _kind(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return segments.positions(table(spark, sf_dir, "events").filter(F.col("event_type") == kind), ["user_id"], ["ts", "event_id"]).select("user_id", "pos", "event_id")


@query(f"WITH {VP} SELECT user_id, pos, event_id, other_id FROM a JOIN b USING (user_id, pos)")
def j01_rgb_depth_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.zip_positions(_kind(spark, sf_dir, "view"), _kind(spark, sf_dir, "click").withColumnRenamed("event_id", "other_id"), ["user_id"]).select("user_id", "pos", "event_id", "other_id")


@query(f"""WITH {VP}, l AS (SELECT user_id, count(*) AS n FROM a GROUP BY 1), q AS (SELECT user_id, count(*) AS n FROM b GROUP BY 1)
    SELECT user_id, coalesce(l.n, 0) AS n_left, coalesce(q.n, 0) AS n_right, coalesce(l.n, 0) = coalesce(q.n, 0) AS agree FROM l FULL JOIN q USING (user_id)""")
def j02_folder_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.zip_checked(_kind(spark, sf_dir, "view"), _kind(spark, sf_dir, "click"), ["user_id"])


@query(f"WITH {EV} SELECT user_id, pos - 10 AS pos, event_id FROM ev WHERE pos >= 10 AND pos < 30")
def p18_time_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.time_slice(steps(spark, sf_dir), 10, 30).select("user_id", "pos", "event_id")


@query(f"WITH {EV} SELECT user_id, count(*) AS n FROM ev WHERE pos % 4 = 0 AND pos < 100 GROUP BY user_id")
def p19_query_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.time_slice(steps(spark, sf_dir).filter("pos % 4 = 0"), 0, 100).groupBy("user_id").agg(F.count("*").alias("n"))


@query(f"WITH {EV} SELECT user_id, count(CASE WHEN value > 20 AND pos >= user_id % 10 THEN 1 END) AS valid FROM ev GROUP BY user_id")
def p20_causal_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps(spark, sf_dir).groupBy("user_id").agg(F.count_if(segments.causal(F.col("value") > 20, F.col("pos"), F.col("user_id") % 10)).alias("valid"))


UNFOLD = f"{EV}, n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), w AS (SELECT user_id, unnest(range(0, CAST(greatest(0, ceil((n - 16) / 8.0)) AS BIGINT) + 1)) AS win FROM n), uf AS (SELECT user_id, win, pos - win * 8 AS place, pos, event_id, value FROM ev JOIN w USING (user_id) WHERE pos >= win * 8 AND pos < win * 8 + 16)"


@query(f'WITH {UNFOLD} SELECT user_id, win AS "window", place, event_id FROM uf')
def w05_tracker_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.unfold(steps(spark, sf_dir).select("user_id", "pos", "event_id"), ["user_id"], 16, 8).select("user_id", "window", "place", "event_id")


@query(f'WITH {UNFOLD} SELECT user_id, pos, max(win) AS "window", round(max_by(value + win, win), 6) + 0.0 AS value FROM uf GROUP BY user_id, pos')
def w06_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = segments.unfold(steps(spark, sf_dir).select("user_id", "pos", "value"), ["user_id"], 16, 8).withColumn("value", F.col("value") + F.col("window"))
    return segments.last_window_wins(w, ["user_id"], "value").select("user_id", "pos", "window", r("value").alias("value"))


@query(f'WITH {UNFOLD} SELECT user_id, win AS "window", count(*) AS n, round(avg(value), 6) + 0.0 AS mean FROM uf GROUP BY user_id, win')
def w16_unfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = segments.unfold(steps(spark, sf_dir).select("user_id", "pos", "value"), ["user_id"], 16, 8)
    return w.groupBy("user_id", "window").agg(F.count("*").alias("n"), r(F.avg("value")).alias("mean"))


@query(f"""WITH {EV}, e AS (SELECT user_id, max(pos) AS last, max_by(value, pos) AS v FROM ev GROUP BY 1)
    SELECT user_id, pos, value FROM ev UNION ALL SELECT user_id, pos, v FROM (SELECT user_id, v, unnest(range(last + 1, CAST(ceil((last + 1) / 16.0) * 16 AS BIGINT))) AS pos FROM e)""")
def w07_pad_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.pad_tail(steps(spark, sf_dir), ["user_id"], 16, "value")


@query(f"WITH {EV} SELECT user_id, pos, round(coalesce(lead(value) OVER o - value, 0.0), 6) + 0.0 AS ahead, round(coalesce(value - lag(value) OVER o, 0.0), 6) + 0.0 AS behind FROM ev WINDOW o AS (PARTITION BY user_id ORDER BY pos)")
def w08_rel_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.relative_offsets(steps(spark, sf_dir), ["user_id"], "value").select("user_id", "pos", r("ahead").alias("ahead"), r("behind").alias("behind"))


@query(f"""WITH {EV}, v AS (SELECT user_id, pos, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS k FROM ev WHERE event_type = 'purchase')
    SELECT u.user_id, coalesce(v.pos, -1) AS at FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN v ON v.user_id = u.user_id AND k = 5""")
def w11_nth_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.nth_visible(steps(spark, sf_dir), ["user_id"], F.col("event_type") == "purchase", 5)


@query(f"""WITH {EV}, c AS (SELECT user_id, pos, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER o OR row_number() OVER o = 1 THEN 1 ELSE 0 END AS new FROM ev WINDOW o AS (PARTITION BY user_id ORDER BY pos)),
    s AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY pos) AS BIGINT) AS run FROM c) SELECT user_id, run, min(event_type) AS event_type, min(pos) AS first, count(*) AS size FROM s GROUP BY user_id, run""")
def w12_unique_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.runs(steps(spark, sf_dir), ["user_id"], "event_type")


@query(f"WITH {EV} SELECT user_id, pos, max(value) OVER o AS pooled, round(avg(value) OVER o, 6) + 0.0 AS mean FROM ev WINDOW o AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def w13_sliding_window_nd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.sliding(steps(spark, sf_dir), ["user_id"], "value", 2).select("user_id", "pos", "pooled", r("mean").alias("mean"))


@query(f"WITH {EV}, k AS (SELECT user_id, event_type, value, pos, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, pos) AS k FROM ev) SELECT user_id, event_type, value AS score, pos, event_id FROM k WHERE k = 1")
def w14_best_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.best_of(steps(spark, sf_dir), ["user_id", "event_type"], F.col("value"), keep=["event_id"])


@query(f"WITH {EV} SELECT user_id, count(*) AS n, round(sum(value * 0.2 * 0.8 ** (m - pos)), 4) + 0.0 AS walk FROM (SELECT *, max(pos) OVER (PARTITION BY user_id) AS m FROM ev) GROUP BY user_id")
def w10_ema_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.ema(steps(spark, sf_dir), ["user_id"], "value", 0.8).select("user_id", "n", r("walk", 4).alias("walk"))


@query("SELECT user_id, round(cos(sum(value / 100)), 5) + 0.0 AS c, round(sin(sum(value / 100)), 5) + 0.0 AS s FROM events GROUP BY user_id")
def w15_pose_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = steps(spark, sf_dir).withColumn("angle", F.col("value") / 100)
    return segments.rotation_chain(turned, ["user_id"], "angle").select("user_id", r("c", 5).alias("c"), r("s", 5).alias("s"))


@query(f"""WITH {EV}, m AS (SELECT user_id, max(pos) AS last FROM ev GROUP BY 1) SELECT f.user_id, f.pos, CASE WHEN f.pos < 5 THEN b.value ELSE f.value END AS merged
    FROM ev f JOIN m USING (user_id) JOIN ev b ON b.user_id = f.user_id AND b.pos = last - f.pos""")
def m01_bidirectional_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = steps(spark, sf_dir).select("user_id", "pos", "value")
    back = ev.withColumn("last", F.max("pos").over(segments.Window.partitionBy("user_id")))
    return segments.bidirectional(ev, back, ["user_id"], F.col("last"), F.lit(5), "value").select("user_id", "pos", "merged")


CONV = "SELECT *, role = 'user' AS u FROM conversations"


@query("""WITH c AS (SELECT *, sum(CAST(role = 'user' AS INT)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS k FROM conversations)
    SELECT CASE WHEN k <= 1 THEN 'to_1' WHEN k <= 2 THEN 'to_2' WHEN k <= 4 THEN 'to_4' ELSE 'over_4' END AS part, count(CASE WHEN role = 'user' THEN 1 END) AS asked, count(CASE WHEN role = 'assistant' THEN 1 END) AS answered, count(*) AS lines FROM c GROUP BY 1""", "a13_log_segments")
def a13_log_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    return quality.log_segments(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], role == "user", [1, 2, 4], {"asked": role == "user", "answered": role == "assistant"})


@query("SELECT conv_id, turn, role, sum(CAST(role = 'user' AS INT)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM conversations")
def w09_running_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = segments.Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(segments.Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.sum((F.col("role") == "user").cast("int")).over(order).alias("running"))


# quality


@query("SELECT event_type, count(CASE WHEN value < 1 OR value >= 60 OR user_id < 0 OR user_id >= 100 THEN 1 END) AS outside FROM events GROUP BY event_type")
def p08_keypoint_in_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.out_of_bounds(F.col("value") - 1, F.col("user_id"), 59, 100)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(out).alias("outside"))


@query("SELECT event_id, value FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def p09_finite_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 0, F.lit(float("-inf"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").withColumn("v", bad).filter(quality.finite(F.col("v"))).select("event_id", F.col("v").alias("value"))


@query("SELECT event_id FROM events WHERE value > 0 AND value < 10")
def p10_near_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(quality.near_point(F.col("value"))).select("event_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 4 = 0 AND l_linenumber % 4 = 0")
def p11_pixel_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter(quality.pixel_kept(F.col("l_orderkey"), F.col("l_linenumber"), 4)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("WITH n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label) SELECT vec_id FROM embeddings JOIN n USING (label) WHERE n > 48 OR vec_id % 5 = 0")
def p12_keypoint_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    e = e.select("vec_id", "label").join(e.groupBy("label").agg(F.count("*").alias("n")), "label")
    return e.filter(quality.keypoint_kept(F.col("vec_id"), 5, F.col("n"), 48)).select("vec_id")


@query("SELECT event_type, count(CASE WHEN value > 0.01 AND value < 50 THEN 1 END) AS kept FROM events GROUP BY event_type")
def p13_z_valid_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(quality.z_in_window(F.col("value"))).alias("kept"))


@query("SELECT user_id, count(CASE WHEN event_type <> 'view' THEN 1 END) AS valid_steps, count(*) AS steps FROM events GROUP BY user_id")
def p14_valid_steps_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") != "view").alias("valid_steps"), F.count("*").alias("steps"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name > 'm' ORDER BY p_name, p_partkey LIMIT 100")
def p15_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_name") > "m").select("p_partkey", "p_name").orderBy("p_name", "p_partkey").limit(100)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j05_unprocessed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unprocessed(table(spark, sf_dir, "orders").select("o_orderkey"), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def p16_skip_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return quality.unprocessed(table(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def j19_any_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.any_child(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality IS NULL THEN 'no_key' WHEN toxic = 1 THEN 'bad' WHEN quality = 0 THEN 'poor' ELSE 'ok' END AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def j06_output_policy_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("has", F.lit(True))
    status = quality.reason(("missing", F.col("has").isNull()), ("no_key", F.col("quality").isNull()), ("bad", F.col("toxic") == 1), ("poor", F.col("quality") == 0))
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select("doc_id", status.alias("status"))


@query("SELECT CASE WHEN n_chars < 20 THEN 'short' WHEN n_chars > 10000 THEN 'long' WHEN lang <> 'en' THEN 'foreign' ELSE 'ok' END AS reason, count(*) AS cases FROM documents GROUP BY 1")
def p17_is_valid_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = quality.reason(("short", F.col("n_chars") < 20), ("long", F.col("n_chars") > 10000), ("foreign", F.col("lang") != "en"))
    return table(spark, sf_dir, "documents").groupBy(why.alias("reason")).agg(F.count("*").alias("cases"))


@query("""SELECT conv_id, code FROM (SELECT conv_id, count(*) AS n, max(turn) AS m, count(CASE WHEN role = 'system' THEN 1 END) AS s, count(CASE WHEN role = 'assistant' THEN 1 END) AS a FROM conversations GROUP BY conv_id),
    LATERAL (SELECT unnest([CASE WHEN NOT n = m + 1 THEN 'gaps' END, CASE WHEN NOT s <= 1 THEN 'systems' END, CASE WHEN NOT a > 0 THEN 'unanswered' END]) AS code) WHERE code IS NOT NULL""")
def p07_shape_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.max("turn").alias("m"), F.count_if(F.col("role") == "system").alias("s"), F.count_if(F.col("role") == "assistant").alias("a"))
    return quality.shape_issues(c, "conv_id", {"gaps": F.col("n") == F.col("m") + 1, "systems": F.col("s") <= 1, "unanswered": F.col("a") > 0}).withColumnRenamed("case", "conv_id")


@query("""WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders), c AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0)
    SELECT k, CASE WHEN c.k IS NULL THEN 'left_only' WHEN o.k IS NULL THEN 'right_only' ELSE 'both' END AS found FROM (SELECT k FROM o UNION SELECT k FROM c) u(k) LEFT JOIN o USING (k) LEFT JOIN c USING (k)""".replace("c.k IS NULL", "NOT EXISTS (SELECT 1 FROM c WHERE c.k = u.k)").replace("o.k IS NULL", "NOT EXISTS (SELECT 1 FROM o WHERE o.k = u.k)").replace(" LEFT JOIN o USING (k) LEFT JOIN c USING (k)", "").replace("SELECT k, CASE", "SELECT u.k AS k, CASE"))
def j04_image_sample_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"))
    return quality.reconcile(orders, customers, ["k"])


@query("(SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) UNION ALL (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 EXCEPT SELECT o_custkey FROM orders)")
def e02_index_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return j04_image_sample_reconcile(spark, sf_dir).filter("found <> 'both'").select("k")


@query("SELECT DISTINCT k FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))")
def e01_union_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("k"))
    return quality.union_failed(failed, j05_unprocessed_anti(spark, sf_dir).withColumnRenamed("o_orderkey", "k"), "k")


RUNS = "count(*) AS total, count(CASE WHEN event_type <> 'error' THEN 1 END) AS succeeded, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed, round(sum(CASE WHEN event_type <> 'error' THEN value END), 4) + 0.0 AS seconds, round(avg(CASE WHEN event_type <> 'error' THEN value END), 6) + 0.0 AS mean_s, min(CASE WHEN event_type <> 'error' THEN value END) AS min_s, max(CASE WHEN event_type <> 'error' THEN value END) AS max_s, round(avg(CAST(event_type <> 'error' AS DOUBLE)) * 100, 6) + 0.0 AS success_rate"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.run_summary(table(spark, sf_dir, "events"), ["user_id"], F.col("event_type") != "error", "value")
    return out.withColumns({"seconds": r("seconds", 4), "mean_s": r("mean_s"), "success_rate": r("success_rate")})


@query(f"SELECT user_id, {RUNS} FROM events GROUP BY user_id")
def a07_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


@query("SELECT user_id, round(avg(value) FILTER (WHERE event_type <> 'error') * count(*) / 3600, 6) + 0.0 AS hours, round(avg(value) FILTER (WHERE event_type <> 'error') * count(*) / 3600 / 24, 6) + 0.0 AS days, round(avg(value) FILTER (WHERE event_type <> 'error') * count(*) / 3600 / 6, 6) + 0.0 AS hours_shared FROM events GROUP BY user_id")
def a08_eta_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = quality.run_summary(table(spark, sf_dir, "events"), ["user_id"], F.col("event_type") != "error", "value")
    return quality.eta(s, 6).select("user_id", r("hours").alias("hours"), r("days").alias("days"), r("hours_shared").alias("hours_shared"))


@query("SELECT event_type, round(avg(CAST(value > 20 AS DOUBLE)) * 100, 6) + 0.0 AS success_rate FROM events GROUP BY event_type")
def a09_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_summary(table(spark, sf_dir, "events"), ["event_type"], F.col("value") > 20, "value").select("event_type", r("success_rate").alias("success_rate"))


@query("SELECT source, count(*) AS files, count(CASE WHEN n_chars > 500 THEN 1 END) AS filled, CAST(sum(greatest(n_chars - 500, 0)) AS BIGINT) AS bytes, count(CASE WHEN n_chars > 500 THEN 1 END) > 0 AS has_content FROM documents GROUP BY source")
def a10_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.file_counts(table(spark, sf_dir, "documents").withColumn("size", F.greatest(F.col("n_chars") - 500, F.lit(0))), ["source"], "size")


@query("SELECT CASE WHEN l_quantity < 2 THEN 'corrupted' WHEN l_returnflag = 'N' THEN 'incomplete' ELSE 'complete' END AS state, count(*) AS cases FROM lineitem GROUP BY 1")
def a11_integrity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity(table(spark, sf_dir, "lineitem"), F.col("l_quantity") < 2, F.col("l_returnflag") == "N")


@query("SELECT md5(text) AS digest, count(*) AS copies, count(*) - 1 AS surplus FROM documents GROUP BY md5(text) HAVING count(*) > 1")
def a12_duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_files(table(spark, sf_dir, "documents"), F.col("text"))


PATTERNS = {"license": "license|copyright", "token": "token|secret|password", "mail": r"[a-z0-9]+@[a-z0-9]+\.", "shout": "!!"}


@query("SELECT " + ", ".join(f"count(CASE WHEN regexp_matches(lower(text), '{p}') THEN 1 END) AS {n}" for n, p in PATTERNS.items()) + " FROM documents")
def a14_log_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.log_counts(table(spark, sf_dir, "documents"), PATTERNS, "text")


@query("SELECT count(CASE WHEN quality = 0 THEN 1 END) AS errors, count(CASE WHEN quality = 1 AND toxic = 1 THEN 1 END) AS warnings, count(CASE WHEN quality = 0 THEN 1 END) = 0 AS passed FROM labels")
def a45_issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.when(F.col("quality") == 0, "ERROR").when(F.col("toxic") == 1, "WARNING")
    return quality.issue_summary(table(spark, sf_dir, "labels").withColumn("severity", severity))


@query("SELECT o_orderkey, round(2.0 * (1 + (o_totalprice / 1000 - 1) / (o_orderkey % 5 + 1)), 6) + 0.0 AS mb FROM orders")
def a44_disk_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    mb = quality.disk_estimate(F.lit(2.0), F.col("o_totalprice") / 1000, 1.0, F.col("o_orderkey") % 5 + 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", r(mb).alias("mb"))


# statistics, ranking, sampling


@query("SELECT event_type, min(value) AS value_min, max(value) AS value_max, round(avg(value), 6) + 0.0 AS value_mean, round(stddev_pop(value), 6) + 0.0 AS value_std, stddev_pop(value) < 1e-6 AS value_constant FROM events GROUP BY event_type")
def a15_vector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics.vector_stats(table(spark, sf_dir, "events"), ["event_type"], ["value"])
    return out.withColumns({"value_mean": r("value_mean"), "value_std": r("value_std")})


@query("SELECT l_returnflag, count(DISTINCT round_even(l_discount + 0.0, 1)) AS distinct_1, count(DISTINCT round_even(l_discount + 0.0, 2)) AS distinct_2 FROM lineitem GROUP BY l_returnflag")
def a16_distinct_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.distinct_rounded(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_discount", [1, 2])


@query("SELECT l_returnflag, count(DISTINCT (floor(l_quantity / 5.0), floor(l_extendedprice / 5.0))) AS cells FROM lineitem GROUP BY l_returnflag")
def a16_distinct_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.distinct_cells(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice"], 5.0)


@query("SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {q}), 6) + 0.0 AS p{round(q * 100)}" for q in (0.25, 0.5, 0.75)) + " FROM events GROUP BY event_type")
def a17_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(*statistics.percentiles("value")).select("event_type", *(r(p).alias(p) for p in ("p25", "p50", "p75")))


@query("SELECT c_mktsegment, round(avg(CAST(c_acctbal >= 0 AS DOUBLE)) * 100, 6) + 0.0 AS share FROM customer GROUP BY c_mktsegment")
def a18_share_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(r(statistics.share(F.col("c_acctbal") >= 0)).alias("share"))


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) + 0.0 AS corr_l_quantity_l_extendedprice, round(corr(l_quantity, l_tax), 6) + 0.0 AS corr_l_quantity_l_tax, round(corr(l_extendedprice, l_tax), 6) + 0.0 AS corr_l_extendedprice_l_tax, round(covar_samp(l_quantity, l_extendedprice), 2) + 0.0 AS cov_l_quantity_l_extendedprice, round(covar_samp(l_quantity, l_tax), 6) + 0.0 AS cov_l_quantity_l_tax, round(covar_samp(l_extendedprice, l_tax), 4) + 0.0 AS cov_l_extendedprice_l_tax FROM lineitem GROUP BY l_returnflag")
def a19_corr_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics.correlations(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_tax"])
    places = {"cov_l_quantity_l_extendedprice": 2, "cov_l_extendedprice_l_tax": 4}
    return out.select("l_returnflag", *(r(c, places.get(c, 6)).alias(c) for c in out.columns if c != "l_returnflag"))


@query(f"""WITH {EV}, e AS (SELECT user_id, abs(value - (lag(value) OVER o + 0.5 * value)) AS a, abs(value - lag(value) OVER o) AS b FROM ev WINDOW o AS (PARTITION BY user_id ORDER BY pos))
    SELECT user_id, round(avg(a), 6) + 0.0 AS mean_sum_err, round(max(a), 6) + 0.0 AS max_sum_err, round(avg(b), 6) + 0.0 AS mean_hold_err, round(max(b), 6) + 0.0 AS max_hold_err FROM e WHERE b IS NOT NULL GROUP BY user_id""")
def a20_transform_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics.lag_errors(steps(spark, sf_dir).withColumn("delta", F.col("value") * 0.5), ["user_id"], "value", "delta", "pos")
    return out.select("user_id", *(r(c).alias(c) for c in out.columns if c != "user_id"))


@query(f"WITH {EV} SELECT user_id, pos, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY pos) AS before FROM ev")
def j13_consecutive_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = segments.Window.partitionBy("user_id").orderBy("pos")
    return steps(spark, sf_dir).select("user_id", "pos", "event_id", F.lag("event_id").over(order).alias("before"))


@query("SELECT l_shipmode, n FROM (SELECT l_linestatus AS l_shipmode, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1)")
def a22_action_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("l_shipmode")).agg(F.count_distinct("l_returnflag").alias("n"))


@query("SELECT c_nationkey, min(c_acctbal) AS low, min_by(c_custkey, struct_pack(a := c_acctbal, b := c_custkey)) AS at FROM customer GROUP BY c_nationkey")
def a39_scatter_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_acctbal").alias("low"), F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("at"))


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS keys, count(DISTINCT o_orderstatus) = 1 AS uniform FROM orders GROUP BY o_custkey")
def a40_collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"), (F.count_distinct("o_orderstatus") == 1).alias("uniform"))


@query(f"WITH {TR}, m AS (SELECT clip, avg(x) AS mx, avg(y) AS my FROM tr GROUP BY clip) SELECT clip, round(stddev_pop(x - mx), 6) + 0.0 AS sx, round(stddev_pop(y - my), 6) + 0.0 AS sy FROM tr JOIN m USING (clip) GROUP BY clip")
def a43_scene_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.vector_stats(tracks(spark, sf_dir), ["clip"], ["x", "y"]).select("clip", r("x_std").alias("sx"), r("y_std").alias("sy"))


MO = f"{TR}, d AS (SELECT clip, track, sqrt((x - lag(x) OVER o) ** 2 + (y - lag(y) OVER o) ** 2) AS d FROM tr WINDOW o AS (PARTITION BY clip, track ORDER BY step)), mo AS (SELECT clip, track, round(coalesce(sum(d), 0.0), 6) + 0.0 AS motion FROM d GROUP BY clip, track)"


def _motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.motion(tracks(spark, sf_dir), ["clip", "track"], ["x", "y"], "step").withColumn("motion", r("motion"))


@query(f"WITH {MO} SELECT * FROM mo")
def a38_motion_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _motion(spark, sf_dir)


@query(f"WITH {MO} SELECT *, row_number() OVER (PARTITION BY clip ORDER BY motion DESC, track) AS rank FROM mo")
def w03_motion_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.ranked(_motion(spark, sf_dir), ["clip"], "motion", "track")


@query(f"WITH {MO}, k AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY motion DESC, track) AS rank, count(*) OVER (PARTITION BY clip) AS n FROM mo) SELECT clip, track, motion, rank FROM k WHERE rank <= greatest(10, floor(n * 0.3))")
def o05_topk_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.top_share(_motion(spark, sf_dir), ["clip"], "motion", "track", 0.3)


@query(f"WITH {MO}, k AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY -motion DESC, track) AS rank FROM mo) SELECT clip, track, motion, rank FROM k WHERE rank <= 7")
def o04_topk_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.top_k(_motion(spark, sf_dir), ["clip"], "motion", "track", 7)


@query("SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer QUALIFY rank <= 5")
def o06_limit_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.top_k(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", "c_custkey", 5, ascending=False).select("c_nationkey", "c_custkey", "rank")


@query("SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id LIMIT 5")
def o07_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.latest(table(spark, sf_dir, "events"), "ts", "event_id").select("event_id", "user_id")


@query("SELECT DISTINCT l_suppkey FROM lineitem ORDER BY 1")
def o11_sort_unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey").distinct().orderBy("l_suppkey")


@query(f"""WITH {TR}, b AS (SELECT clip, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM tr WHERE step = 0 GROUP BY clip),
    s AS (SELECT clip, track, round(((x - x0) / coalesce(nullif(x1 - x0, 0), 1)) ** 2 + ((y - y0) / coalesce(nullif(y1 - y0, 0), 1)) ** 2, 9) AS s FROM tr JOIN b USING (clip) WHERE step = 0)
    SELECT clip, track, round((row_number() OVER (PARTITION BY clip ORDER BY s, track) - 1) / greatest(count(*) OVER (PARTITION BY clip) - 1, 1), 6) + 0.0 AS color FROM s""")
def w04_color_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.color_rank(tracks(spark, sf_dir).filter("step = 0"), ["clip"], ["x", "y"], "track").select("clip", "track", r("color").alias("color"))


@query(f"WITH {EV}, n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM ev) SELECT user_id, event_id, pos FROM n WHERE n >= 5 AND pos IN (0, n // 4, (2 * n) // 4, (3 * n) // 4, n - 1)")
def w20_even_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.even_pick(table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id")), ["user_id"], "at").select("user_id", "event_id", "pos")


@query(f"WITH {EV}, n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM ev) SELECT user_id, event_id, pos FROM n WHERE n <= 8 OR pos IN (" + ", ".join(f"({i} * (n - 1)) // 7" for i in range(8)) + ")")
def e06_sample_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.uniform_pick(table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id")), ["user_id"], "at", 8).select("user_id", "event_id", "pos")


@query("SELECT p_partkey FROM part ORDER BY sha256('42:' || p_partkey), p_partkey LIMIT 100")
def e05_sample_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.hash_sample(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 100)


@query("SELECT event_id FROM events ORDER BY sha256('7:' || event_id), event_id LIMIT 10")
def o10_shuffle_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.hash_sample(table(spark, sf_dir, "events").select("event_id"), "event_id", 10, seed=7)


HORNER = "0"
for _k in range(8):
    HORNER = f"((({HORNER}) * {(1 << 32) % 1000} + CAST('0x' || substr(h, {8 * _k + 1}, 8) AS BIGINT)) % 1000)"


@query(f"SELECT p_partkey, CAST({HORNER} AS BIGINT) AS draw FROM (SELECT p_partkey, sha256(CAST(p_partkey AS VARCHAR)) AS h FROM part)")
def e08_hash_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", statistics.digest_mod(F.col("p_partkey"), 1000).alias("draw"))


@query("""WITH w AS (SELECT n_name, n_regionkey + 1 AS w, sum(n_regionkey + 1) OVER (ORDER BY n_nationkey) AS upto, sum(n_regionkey + 1) OVER () AS total FROM nation)
    SELECT s_suppkey, n_name FROM supplier, w WHERE (s_suppkey * 37 % 1000) / 1000.0 >= (upto - w) / total AND (s_suppkey * 37 % 1000) / 1000.0 < upto / total""")
def e07_weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = table(spark, sf_dir, "supplier").select("s_suppkey", ((F.col("s_suppkey") * 37 % 1000) / 1000.0).alias("u"))
    weights = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", (F.col("n_regionkey") + 1).alias("w"))
    return statistics.weighted_choice(draws, "u", weights, "n_name", "w", "n_nationkey").select("s_suppkey", "n_name")


@query("SELECT s_suppkey, ['gpu0', 'gpu1', 'gpu2', 'gpu3'][s_suppkey % 4 + 1] AS device FROM supplier")
def e09_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", statistics.round_robin(F.col("s_suppkey") + 1, ["gpu0", "gpu1", "gpu2", "gpu3"]).alias("device"))


@query("SELECT c_custkey AS id, 'user' AS kind FROM customer UNION ALL SELECT s_suppkey, 'support' FROM supplier")
def e03_concat_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return a.withColumn("kind", F.lit("user")).unionByName(b.withColumn("kind", F.lit("support")))


# joins


@query(f"""WITH {EV}, p AS (SELECT user_id, pos FROM ev WHERE event_type = 'purchase'), c AS (SELECT e.user_id, e.pos, p.pos AS q FROM ev e JOIN p USING (user_id) WHERE e.event_type = 'view')
    SELECT user_id, pos, q AS nearest FROM (SELECT *, row_number() OVER (PARTITION BY user_id, pos ORDER BY abs(q - pos), q) AS k FROM c) WHERE k = 1""")
def j07_nearest_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = steps(spark, sf_dir)
    return matching.nearest(ev.filter("event_type = 'view'"), ev.filter("event_type = 'purchase'"), ["user_id"], "pos")


@query(f"WITH {EV} SELECT v.user_id, v.pos, p.event_id FROM (SELECT user_id, pos FROM ev WHERE event_type = 'view') v ASOF LEFT JOIN (SELECT user_id, pos, event_id FROM ev WHERE event_type = 'purchase') p ON v.user_id = p.user_id AND v.pos >= p.pos")
def j11_last_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = steps(spark, sf_dir)
    return matching.as_of(ev.filter("event_type = 'view'"), ev.filter("event_type = 'purchase'"), ["user_id"], "pos", "event_id").select("user_id", "pos", "event_id")


@query("SELECT e.event_id, n_name FROM events e JOIN nation ON n_nationkey = user_id % 25")
def j08_camera_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cameras = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")  # a row per camera
    return table(spark, sf_dir, "events").withColumn("n_nationkey", (F.col("user_id") % 25).cast("int")).join(F.broadcast(cameras), "n_nationkey").select("event_id", "n_name")


@query("""WITH d AS (SELECT a.label, a.vec_id AS query, b.vec_id AS neighbour, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (CAST(a.embedding[i] AS DOUBLE) - b.embedding[i]) ** 2))), 5) AS distance FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
    SELECT label, query, neighbour, distance, row_number() OVER (PARTITION BY label, query ORDER BY distance, neighbour) AS rank FROM d QUALIFY rank <= 5""")
def j10_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return matching.k_nearest(e, e, ["label"], "vec_id", "embedding", 5, places=5)


@query("""WITH s AS (SELECT date_trunc('hour', ts) AS h, user_id, sum(value) AS w FROM events GROUP BY ALL)
    SELECT a.user_id AS i, b.user_id AS j, round(sum(a.w * b.w), 5) + 0.0 AS weight FROM s a JOIN s b ON a.h = b.h AND a.user_id < b.user_id GROUP BY ALL""")
def j14_covisibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").withColumn("h", F.date_trunc("hour", "ts"))
    return matching.covisibility(seen, ["h"], "user_id", "value").select("i", "j", r("weight", 5).alias("weight"))


CELLS = "c AS (SELECT l_suppkey % 10 AS f, l_orderkey % 40 AS u, l_partkey % 40 AS v, round(avg(l_quantity), 6) AS d FROM lineitem GROUP BY ALL)"


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("f"), (F.col("l_orderkey") % 40).alias("u"), (F.col("l_partkey") % 40).alias("v")).agg(F.round(F.avg("l_quantity"), 6).alias("d"))


@query(f"WITH {CELLS} SELECT a.f, a.u, a.v, max(b.d) AS high, min(b.d) AS low, max(CASE WHEN a.u = b.u AND a.v = b.v THEN b.d END) AS d FROM c a JOIN c b ON a.f = b.f AND abs(a.u - b.u) <= 1 AND abs(a.v - b.v) <= 1 GROUP BY a.f, a.u, a.v")
def j18_neighbor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.grid_neighbours(_cells(spark, sf_dir), ["f"], "u", "v", "d")


@query(f"WITH {CELLS}, n AS (SELECT a.f, a.u, a.v, a.d, max(b.d) - min(b.d) AS span FROM c a JOIN c b ON a.f = b.f AND abs(a.u - b.u) <= 1 AND abs(a.v - b.v) <= 1 GROUP BY ALL) SELECT f, u, v, span / d > 0.5 AS edge FROM n")
def g24_depth_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.depth_edges(_cells(spark, sf_dir), ["f"], "u", "v", "d", 0.5).select("f", "u", "v", "edge")


@query("SELECT c_nationkey, c_custkey, o_orderkey, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2")
def j12_colmap_image_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").filter("n_regionkey = 2").select(F.col("n_nationkey").alias("c_nationkey"))
    customers = table(spark, sf_dir, "customer").join(nations, "c_nationkey").select("c_nationkey", F.col("c_custkey"))
    return table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "c_custkey", "o_orderkey", "o_orderstatus")


# geometry

K = [500.0, 0.0, 320.0, 0.0, 480.0, 240.0, 0.0, 0.0, 1.0]
W2C = [0.8, -0.6, 0.0, 0.1, 0.6, 0.8, 0.0, -0.2, 0.0, 0.0, 1.0, 3.0, 0.0, 0.0, 0.0, 1.0]
PT = "p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"
CAM = f"{PT}, cam AS (SELECT *, 0.8 * x - 0.6 * y + 0.1 AS cx, 0.6 * x + 0.8 * y - 0.2 AS cy, z + 3.0 AS cz FROM p)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", *(F.get("embedding", F.lit(k)).cast("double").alias(n) for k, n in enumerate("xyz")))


def _xyz() -> g.Point:
    return F.col("x"), F.col("y"), F.col("z")


@query("SELECT CAST(i * 20 + j AS BIGINT) AS track, round(j * 639 / 19.0, 6) + 0.0 AS x, round(i * 479 / 19.0, 6) + 0.0 AS y FROM range(20) a(i), range(20) b(j)")
def g01_grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(400).select(F.col("id").alias("track"), r(g.grid_point(F.col("id") % 20, 20, 640)).alias("x"), r(g.grid_point(F.floor(F.col("id") / 20), 20, 480)).alias("y"))


@query(f"WITH {CAM} SELECT vec_id, round((500 * cx + 320 * cz) / (cz + 1e-8), 6) + 0.0 AS u, round((480 * cy + 240 * cz) / (cz + 1e-8), 6) + 0.0 AS v, round(cz, 6) + 0.0 AS z FROM cam")
def g04_project_uvz(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, v, z = g.project_world(g.matrix(K), g.matrix(W2C), _xyz())
    return _points(spark, sf_dir).select("vec_id", r(u).alias("u"), r(v).alias("v"), r(z).alias("z"))


@query(f"WITH {PT} SELECT vec_id, round((100 * x - 320) * (abs(z) + 1) / 500, 6) + 0.0 AS cx, round((100 * y - 240) * (abs(z) + 1) / 480, 6) + 0.0 AS cy FROM p")
def g05_unproject_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    cx, cy, _ = g.unproject(g.matrix(K), 100 * F.col("x"), 100 * F.col("y"), F.abs("z") + 1)
    return _points(spark, sf_dir).select("vec_id", r(cx).alias("cx"), r(cy).alias("cy"))


@query(f"WITH {PT} SELECT vec_id, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z FROM p")
def g06_uvz_to_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, w = g.matrix(K), g.matrix(W2C)
    u, v, z = g.project(k, g.apply_extrinsics(w, _xyz()), eps=0.0)
    world = g.apply_extrinsics(g.inverse_se3(w), g.unproject(k, u, v, z))
    return _points(spark, sf_dir).select("vec_id", *(r(c).alias(n) for n, c in zip("xyz", world, strict=True)))


@query(f"WITH {CAM} SELECT vec_id, round(cx, 6) + 0.0 AS x, round(cy, 6) + 0.0 AS y, round(cz, 6) + 0.0 AS z FROM cam")
def g07_apply_extrinsics(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = g.apply_extrinsics(g.matrix(W2C), _xyz())
    return _points(spark, sf_dir).select("vec_id", *(r(c).alias(n) for n, c in zip("xyz", moved, strict=True)))


@query(f"WITH {CAM} SELECT vec_id, round(greatest(-1280.0, least(1280.0, (500 * cx + 320 * cz) / greatest(cz, 1e-6))), 5) + 0.0 AS u FROM cam")
def g10_project_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, _, z = g.apply_extrinsics(g.matrix(W2C), _xyz())
    u = g.clamp_pixel((500.0 * x + 320.0 * z) / F.greatest(z, F.lit(1e-6)), 640.0)
    return _points(spark, sf_dir).select("vec_id", r(u, 5).alias("u"))


@query(f"WITH {PT} SELECT vec_id, round(500 * ln(greatest(z, 1e-6)), 5) + 0.0 AS d FROM p")
def g11_uv_logdepth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("vec_id", r(g.log_depth(*_xyz(), F.lit(500.0))[2], 5).alias("d"))


@query(f"WITH {PT}, q AS (SELECT *, sqrt(((x - 320) / 500) ** 2 + ((y - 240) / 480) ** 2 + 1) AS s FROM p) SELECT vec_id, round(z * s, 6) + 0.0 AS distance, round(z, 6) + 0.0 AS back FROM q")
def g12_distance_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = g.matrix(K)
    d = g.ray_distance(k, *_xyz())
    return _points(spark, sf_dir).select("vec_id", r(d).alias("distance"), r(g.depth_of_distance(k, F.col("x"), F.col("y"), d)).alias("back"))


@query("SELECT CAST(i AS INT) AS i, CASE WHEN i % 4 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v FROM range(9) t(i)")
def g13_inverse_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = g.matrix([500.0, 2.0, 320.0, 0.0, 480.0, 240.0, 0.0, 0.0, 1.0])
    return spark.range(1).select(F.posexplode(g.matmul(g.inverse_k(k), k, 3)).alias("i", "v")).select("i", r("v").alias("v"))


@query("SELECT vec_id, round((500 * 0.5 * x + (320 * 0.5 - 10) * 2) / 2, 5) + 0.0 AS u, round((-500 * x + (640 - 320 - 1) * 2) / 2 + 500 * x, 5) + 0.0 AS f FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings)")
def g14_intrinsics_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = g.edit_k(g.matrix(K), 0.5, 0.5, 10.0, 0.0)
    u = g.project(k, (F.col("x"), F.lit(0.0), F.lit(2.0)), eps=0.0)[0]
    mirrored = g.project(g.flip_k(g.matrix(K), 640.0), (-F.col("x"), F.lit(0.0), F.lit(2.0)), eps=0.0)[0] + 500 * F.col("x")
    return _points(spark, sf_dir).select("vec_id", r(u, 5).alias("u"), r(mirrored, 5).alias("f"))


@query(f"WITH {TR} SELECT clip, track, CAST(step AS INT) AS step, round((x - 0.25) * 2, 6) + 0.0 AS x, round((y + 0.5) * 2, 6) + 0.0 AS y FROM tr")
def g15_crop_traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    x1, y1 = g.crop_point(F.col("x"), F.col("y"), 0.25, -0.5, 2.0)
    return tracks(spark, sf_dir).select("clip", "track", "step", r(x1).alias("x"), r(y1).alias("y"))


@query("SELECT p_partkey, round(2 * atan(640 / (2 * p_retailprice)), 6) + 0.0 AS fov, round(p_retailprice, 4) + 0.0 AS focal, round(p_size * sqrt(640.0 ** 2 + 480 ** 2) / sqrt(36.0 ** 2 + 24 ** 2), 6) + 0.0 AS px FROM part")
def g16_fov_focal(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = g.fov(F.col("p_retailprice"), 640.0)
    return table(spark, sf_dir, "part").select("p_partkey", r(a).alias("fov"), r(g.focal_of_fov(a, 640.0), 4).alias("focal"), r(g.focal_of_35mm(F.col("p_size"), F.lit(640.0), F.lit(480.0))).alias("px"))


@query(f"WITH {PT}, a AS (SELECT *, sqrt(x * x + y * y + z * z) AS t FROM p) SELECT vec_id, round(cos(t / 2), 6) + 0.0 AS w, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z, round(t, 6) + 0.0 AS angle FROM a WHERE t < 3")
def g17_quat_rotvec(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, qx, qy, qz = g.quaternion_of_rotvec(*_xyz())
    back = g.rotvec_of_quaternion(w, qx, qy, qz)
    angle = g.rotation_angle(g.matrix_of_quaternion(w, qx, qy, qz))
    rows = _points(spark, sf_dir).filter("sqrt(x * x + y * y + z * z) < 3")
    return rows.select("vec_id", r(w).alias("w"), *(r(c).alias(n) for n, c in zip("xyz", back, strict=True)), r(angle).alias("angle"))


@query(f"WITH {PT} SELECT a.vec_id, round(acos(greatest(-1.0, least(1.0, (a.x * b.x + a.y * b.y + a.z * b.z) / (sqrt(a.x ** 2 + a.y ** 2 + a.z ** 2) * sqrt(b.x ** 2 + b.y ** 2 + b.z ** 2))))), 5) + 0.0 AS angle FROM p a JOIN p b ON b.vec_id = a.vec_id + 1")
def g35_angle_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _points(spark, sf_dir)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), *(F.col(c).alias(f"{c}1") for c in "xyz"))
    angle = g.angle_between(_xyz(), tuple(F.col(f"{c}1") for c in "xyz"))
    return a.join(b, "vec_id").select("vec_id", r(angle, 5).alias("angle"))


@query("SELECT u, v, half, CASE half WHEN 0 THEN v * 8 + u ELSE v * 8 + u + 1 END AS i0, v * 8 + u + 8 AS i1, CASE half WHEN 0 THEN v * 8 + u + 1 ELSE v * 8 + u + 9 END AS i2 FROM range(7) a(u), range(5) b(v), range(2) c(half)")
def g30_mesh_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.triangles(8, 6, spark)


@query(f"WITH {PT} SELECT vec_id, CAST(i AS INT) AS i, round(CASE WHEN i < 4 THEN sin(x * 2.0 ** i) ELSE cos(x * 2.0 ** (i - 4)) END, 6) + 0.0 AS v FROM p, range(8) t(i)")
def g29_positional_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).select("vec_id", F.posexplode(g.sin_cos(F.col("x"), 4)).alias("i", "v")).select("vec_id", "i", r("v").alias("v"))


# text


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, try_cast(regexp_extract_all(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1'), '[0-9]+')[-1] AS BIGINT) AS number FROM pages")
def x01_basename_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", x.basename(F.col("url")).alias("base"), x.last_number(x.stem(F.col("url"))).alias("number"))


@query("""WITH k AS (SELECT page_id, url, coalesce(try_cast(regexp_extract_all(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1'), '[0-9]+')[-1] AS BIGINT), 0) AS n FROM pages)
    SELECT page_id, row_number() OVER (PARTITION BY page_id % 10 ORDER BY n, url, page_id) AS place FROM k""")
def o01_frame_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = segments.Window.partitionBy(F.col("page_id") % 10).orderBy(*x.frame_order(F.col("url")), "page_id")
    return table(spark, sf_dir, "pages").select("page_id", F.row_number().over(order).cast("long").alias("place"))


@query("SELECT c_custkey, CASE WHEN starts_with(c_name, 'Customer') THEN try_cast(regexp_extract(c_name, '([^_]*)$', 1) AS BIGINT) END AS idx FROM customer")
def x03_index_from_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", x.index_of(F.col("c_name"), "Customer").alias("idx"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name || '  ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') AS snake FROM part")
def x04_to_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", x.snake(F.concat_ws("  ", "p_name", "p_type")).alias("snake"))


@query("SELECT DISTINCT w FROM (SELECT unnest(string_split(p_type, ' ')) AS w FROM part) WHERE lower(w) NOT IN ('small', 'large') AND regexp_matches(w, '[A-Za-z]') AND NOT starts_with(lower(w), 'po')")
def x05_objectish(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("w"))
    return w.filter(x.objectish(F.col("w"), ["small", "large"], ["po"])).distinct()


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def x07_parse_json_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Sure:\n```json\n"), F.col("props"), F.lit("\n```"))).otherwise(F.concat(F.lit("It is "), F.col("props"), F.lit(" indeed")))
    return table(spark, sf_dir, "events").select("event_id", x.lenient_json(wrapped, "k bigint")["k"].alias("k"))


@query("SELECT p_partkey, list_distinct_ordered AS steps FROM (SELECT p_partkey, list_filter(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN list_position(a, a[i]) = i THEN a[i] END), lambda v: v IS NOT NULL)[1:7] AS list_distinct_ordered FROM (SELECT p_partkey, string_split(p_type, ' ') || CASE WHEN len(string_split(p_type, ' ')) < 3 THEN [p_brand, p_name] ELSE [] END AS a FROM part))")
def x08_normalize_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", x.caption_steps(F.split("p_type", " "), F.array("p_brand", "p_name")).alias("steps"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events")
def x09_caption_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit('{"captions": '), F.col("props"), F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", x.caption_part(text, "k", "captions").alias("k"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' ELSE 'application/octet-stream' END AS mime, to_base64(encode(p_name)) AS content FROM part")
def x10_base64_mime(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/a.b/"), F.col("p_name"), F.when(F.col("p_size") % 3 == 0, ".PNG").when(F.col("p_size") % 3 == 1, ".jpg").otherwise(".npz"))
    return table(spark, sf_dir, "part").select("p_partkey", x.mime(path).alias("mime"), F.base64(F.encode("p_name", "UTF-8")).alias("content"))


@query("SELECT doc_id, CASE WHEN p > 0 THEN text[greatest(p - 50, 1):greatest(p - 50, 1) + least(p - 1, 50) + 57 - 1] END AS context FROM (SELECT doc_id, text, strpos(lower(text), 'license') AS p FROM documents) WHERE p > 0")
def x12_keyword_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", x.context(F.col("text"), "license").alias("context")).filter("context IS NOT NULL")


@query("SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'float' WHEN 2 THEN 'bool' ELSE 'str' END AS kind FROM part")
def x14_infer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("p_size") % 4 == 0, F.col("p_size").cast("string")).when(F.col("p_size") % 4 == 1, F.concat(F.col("p_size").cast("string"), F.lit(".5e-3"))).when(F.col("p_size") % 4 == 2, F.lit("True")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", x.inferred(v).alias("kind"))


@query("SELECT p_partkey, md5(p_name) AS md5, sha256(p_name) AS sha FROM part")
def x15_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.md5("p_name").alias("md5"), F.sha2("p_name", 256).alias("sha"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 90000 < 3600 THEN format('{:.1f}min', (o_orderkey % 90000) / 60.0) WHEN o_orderkey % 90000 < 86400 THEN format('{:.1f}h', (o_orderkey % 90000) / 3600.0) ELSE format('{:.1f}d', (o_orderkey % 90000) / 86400.0) END AS elapsed FROM orders")
def x16_elapsed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", x.elapsed(F.col("o_orderkey") % 90000).alias("elapsed"))


@query("SELECT page_id, CASE WHEN trim(html) = '' THEN 0 ELSE len(string_split_regex(trim(html, chr(32)), '\\s+')) END AS words FROM pages")
def x17_word_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", x.words(F.col("html")).alias("words"))


# further operators

@query(f"WITH {TR} SELECT clip, max(abs(x)) > 0.99 OR max(abs(y)) > 0.99 AS world FROM tr GROUP BY clip")
def p27_pixel_format_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks(spark, sf_dir).groupBy("clip").agg((F.max(F.greatest(F.abs("x"), F.abs("y"))) > 0.99).alias("world"))


@query("SELECT s_suppkey, CAST(s_suppkey % 12 AS BIGINT) AS gpu FROM supplier WHERE s_suppkey % 12 < 8")
def p29_gpu_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.explode(F.split(F.concat_ws(",", (F.col("s_suppkey") % 12).cast("string"), F.lit("99"), F.lit("x")), ",")).alias("gpu")
    return table(spark, sf_dir, "supplier").select("s_suppkey", ids).select("s_suppkey", F.col("gpu").try_cast("bigint").alias("gpu")).filter(F.col("gpu").between(0, 7))


@query(f"WITH {TR} SELECT clip, track, CAST(step AS INT) AS step FROM tr WHERE x > 0 AND y > 0 AND x < 0.5 AND y < 0.5")
def p22_static_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = ~quality.out_of_bounds(F.col("x"), F.col("y"), 0.5, 0.5) & (F.col("x") > 0) & (F.col("y") > 0)
    return tracks(spark, sf_dir).filter(inside).select("clip", "track", "step")


@query(f"WITH {EV} SELECT user_id, pos // 16 AS win, count(CASE WHEN event_id % 64 < (pos // 16 + 1) * 16 THEN 1 END) AS active FROM ev GROUP BY ALL")
def p24_track_start_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = steps(spark, sf_dir).withColumn("win", F.floor(F.col("pos") / 16))
    return ev.groupBy("user_id", "win").agg(F.count_if(F.col("event_id") % 64 < (F.col("win") + 1) * 16).alias("active"))


@query("SELECT l_suppkey, count(CASE WHEN l_extendedprice > 1000 AND l_extendedprice < 50000 AND l_linenumber BETWEEN 2 AND 5 THEN 1 END) AS evaluated FROM lineitem GROUP BY l_suppkey")
def p25_eval_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, v = F.col("l_extendedprice"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if((d > 1000) & (d < 50000) & v.between(2, 5)).alias("evaluated"))


@query("SELECT label AS clip, vec_id AS track, CAST(embedding[1] AS DOUBLE) AS gt_x, CAST(embedding[3] AS DOUBLE) AS est_x, CAST(embedding[3] AS DOUBLE) AS x FROM embeddings")
def p21_annot_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), F.col("vec_id").alias("track"), F.get("embedding", F.lit(0)).cast("double").alias("gt_x"), F.get("embedding", F.lit(2)).cast("double").alias("est_x"))
    return rows.transform(transforms.annotations("est", ["x"]))


@query(f"WITH {EV}, q AS (SELECT user_id, pos, value FROM ev WHERE pos % 5 = 0) SELECT e.user_id, e.pos, q.value AS at_query FROM ev e JOIN q ON q.user_id = e.user_id AND q.pos = e.pos - e.pos % 5")
def j09_query_frame_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = steps(spark, sf_dir)
    own = ev.filter("pos % 5 = 0").select("user_id", F.col("pos").alias("query"), F.col("value").alias("at_query"))
    return ev.withColumn("query", F.col("pos") - F.col("pos") % 5).join(own, ["user_id", "query"]).select("user_id", "pos", "at_query")


@query(f"""WITH {UNFOLD}, b AS (SELECT user_id, win, max_by(value, struct_pack(v := value, p := -pos)) AS best FROM uf WHERE place >= 8 GROUP BY ALL)
    SELECT u.user_id, u.win AS "window", u.place, round(u.value - b.best, 6) + 0.0 AS rel FROM uf u JOIN b ON b.user_id = u.user_id AND b.win = u.win - 1""")
def j16_stream_overlap_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = segments.unfold(steps(spark, sf_dir).select("user_id", "pos", "value"), ["user_id"], 16, 8)
    best = segments.best_of(w.filter("place >= 8"), ["user_id", "window"], F.col("value")).select("user_id", (F.col("window") + 1).alias("window"), F.col("score").alias("best"))
    return w.join(best, ["user_id", "window"]).select("user_id", "window", "place", r(F.col("value") - F.col("best")).alias("rel"))


@query("SELECT l_suppkey, round(avg(CASE WHEN abs(l_tax - l_discount) <= 0.05 THEN 0.5 * (l_tax - l_discount) ** 2 ELSE 0.05 * (abs(l_tax - l_discount) - 0.025) END), 8) + 0.0 AS huber, round(avg(greatest(l_tax, 0.0) - l_tax * CAST(l_discount > 0.05 AS DOUBLE) + ln(1 + exp(-abs(l_tax)))), 6) + 0.0 AS bce FROM lineitem GROUP BY l_suppkey")
def a41_track_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = g.huber(F.col("l_tax") - F.col("l_discount"), 0.05)
    b = g.cross_entropy((F.col("l_discount") > 0.05).cast("double"), F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(r(F.avg(h), 8).alias("huber"), r(F.avg(b)).alias("bce"))


@query(f"WITH {CELLS} SELECT f, round(avg(d), 6) + 0.0 AS mean, min(d) AS low FROM c WHERE u BETWEEN 5 AND 14 AND v BETWEEN 10 AND 19 GROUP BY f")
def a42_patch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.col("u").between(5, 14) & F.col("v").between(10, 19)
    return _cells(spark, sf_dir).filter(box).groupBy("f").agg(r(F.avg("d")).alias("mean"), F.min("d").alias("low"))


@query(f"WITH {TR} SELECT clip, track, CAST(step AS INT) AS step, 1.0::DOUBLE / count(*) OVER (PARTITION BY clip, floor(x / 0.1), floor(y / 0.1)) AS weight FROM tr")
def a46_anchor_sampling_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitting.sampling_weights(tracks(spark, sf_dir), ["clip"], ["x", "y"], 0.1).select("clip", "track", "step", "weight")


@query("WITH s AS (SELECT l_suppkey, least(5.0, abs(l_tax - l_discount) * 20) AS rr FROM lineitem), d AS (SELECT *, stddev_samp(rr) OVER (PARTITION BY l_suppkey) AS s FROM s) SELECT l_suppkey, round(avg(exp(-1 * ((0.5 - rr) ** 2) / (2 * s * s))), 6) + 0.0 AS weight FROM d GROUP BY l_suppkey")
def a48_gaussian_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.least(F.lit(5.0), F.abs(F.col("l_tax") - F.col("l_discount")) * 20).alias("rr"))
    return measures.gaussian_weights(rows, ["l_suppkey"], "rr").groupBy("l_suppkey").agg(r(F.avg("weight")).alias("weight"))


@query("SELECT l_suppkey, round(sum(abs(l_tax - l_discount) * CAST(l_quantity > 10 AS DOUBLE)) / nullif(sum(CAST(l_quantity > 10 AS DOUBLE)), 0), 6) + 0.0 AS loss FROM lineitem GROUP BY l_suppkey")
def a49_ssi_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = (F.col("l_quantity") > 10).cast("double")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(r(F.sum(F.abs(F.col("l_tax") - F.col("l_discount")) * m) / F.nullif(F.sum(m), F.lit(0.0))).alias("loss"))


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) + 0.0 AS sum, round(avg(value), 6) + 0.0 AS avg FROM events GROUP BY user_id")
def a36_running_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = depth.nan_as_null(F.col("value"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(v).alias("n"), r(F.sum(v), 4).alias("sum"), r(F.avg(v)).alias("avg"))


@query(f"WITH {PT}, a AS (SELECT *, sqrt(x * x + y * y + z * z) AS t FROM p) SELECT count(*) AS frames, count(*) AS matched, true AS close FROM a WHERE t < 3 AND t > 1e-6")
def a21_rotation_repr_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = g.rotvec_of_quaternion(*g.quaternion_of_rotvec(*_xyz()))
    err = F.greatest(*(F.abs(b - a) for a, b in zip(_xyz(), back, strict=True)))
    rows = _points(spark, sf_dir).withColumn("t", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))).filter("t < 3 AND t > 1e-6")
    return rows.agg(F.count("*").alias("frames"), F.count_if(err < 1e-6).alias("matched"), (F.max(err) < 1e-9).alias("close"))


@query(f"WITH {TR}, n AS (SELECT clip, track, step, x, lead(x) OVER (PARTITION BY clip, track ORDER BY step) AS x1 FROM tr) SELECT clip, track, CAST(k AS INT) AS k, round(CASE WHEN f = 0 THEN x ELSE x + f * (x1 - x) END, 6) + 0.0 AS x FROM (SELECT n.*, k, k * 31 / 20.0 - step AS f FROM n, range(21) t(k) WHERE floor(k * 31 / 20.0) = step)")
def w18_time_embed_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tracks(spark, sf_dir).withColumn("x1", F.lead("x").over(segments.Window.partitionBy("clip", "track").orderBy("step")))
    places = F.filter(F.sequence(F.lit(0), F.lit(20)), lambda k: F.floor(k * 31 / 20) == F.col("step"))
    at = pieces.withColumn("k", F.explode(places)).withColumn("f", F.col("k") * 31 / 20 - F.col("step"))
    return at.select("clip", "track", "k", r(F.when(F.col("f") == 0, F.col("x")).otherwise(F.col("x") + F.col("f") * (F.col("x1") - F.col("x")))).alias("x"))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) - 1 AS sorted, event_id AS id FROM events")
def o09_query_sort_unsort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.positions(table(spark, sf_dir, "events").withColumn("id", F.col("event_id")), ["user_id"], ["value", "event_id"], "sorted").select("event_id", "sorted", "id")


@query(f"WITH {CELLS}, t AS (SELECT c.*, tu, tv FROM c, range(5) a(tu), range(5) b(tv) WHERE u >= tu * 8 - 1 AND u < tu * 8 + 9 AND v >= tv * 8 - 1 AND v < tv * 8 + 9) SELECT f, tu, tv, count(*) AS n, count(CASE WHEN u // 8 = tu AND v // 8 = tv THEN 1 END) AS owned FROM t GROUP BY ALL")
def e10_tile_split_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover = lambda c: F.filter(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long")), lambda t: (F.col(c) >= t * 8 - 1) & (F.col(c) < t * 8 + 9))
    tiles = _cells(spark, sf_dir).withColumn("tu", F.explode(cover("u"))).withColumn("tv", F.explode(cover("v")))
    owned = (F.floor(F.col("u") / 8) == F.col("tu")) & (F.floor(F.col("v") / 8) == F.col("tv"))
    return tiles.groupBy("f", "tu", "tv").agg(F.count("*").alias("n"), F.count_if(owned).alias("owned"))


@query("SELECT o_orderkey, 'F' AS part FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'O' FROM orders WHERE o_orderstatus = 'O'")
def e04_union_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    parts = [o.filter(F.col("o_orderstatus") == s).select("o_orderkey", F.lit(s).alias("part")) for s in ("F", "O")]
    return parts[0].unionByName(parts[1])


@query(f"WITH {CAM} SELECT vec_id, round((500 * cx + 320 * cz) / (cz + 1e-8), 6) + 0.0 AS u, round((480 * cy + 240 * cz) / (cz + 1e-8), 6) + 0.0 AS v FROM cam")
def g03_project_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g04_project_uvz(spark, sf_dir).select("vec_id", "u", "v")


@query(f"WITH {PT}, f AS (SELECT arg_min(x, vec_id) AS x0, arg_min(y, vec_id) AS y0, arg_min(z, vec_id) AS z0 FROM p) SELECT vec_id, round(x - x0, 6) + 0.0 AS x, round(y - y0, 6) + 0.0 AS y, round(z - z0, 6) + 0.0 AS z FROM p, f")
def g08_first_frame_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir)
    first = p.agg(F.min_by(F.struct("x", "y", "z"), "vec_id").alias("o")).scalar()
    m = F.array(*(F.lit(float(i == j)) if j < 3 else (-F.col(f"o.{'xyz'[i]}") if i < 3 else F.lit(1.0)) for i in range(4) for j in range(4)))
    moved = p.withColumn("o", first).withColumn("m", m)
    return moved.select("vec_id", *(r(c).alias(n) for n, c in zip("xyz", g.relative_pose(F.col("m"), _xyz()), strict=True)))


@query("SELECT vec_id, round(a * (1 - fu) * (1 - fv) + b * fu * (1 - fv) + c * (1 - fu) * fv + d * fu * fv, 6) + 0.0 AS value FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c, CAST(embedding[4] AS DOUBLE) AS d, (vec_id % 10) / 10.0 AS fu, (vec_id % 7) / 7.0 AS fv FROM embeddings)")
def g28_bilinear_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = tuple(F.get("embedding", F.lit(k)).cast("double") for k in range(4))
    return table(spark, sf_dir, "embeddings").select("vec_id", r(g.bilinear(corners, (F.col("vec_id") % 10) / 10, (F.col("vec_id") % 7) / 7)).alias("value"))


@query("SELECT p_partkey, CAST(round_even(p_size * 10 * 518 / 640.0 / 14, 0) * 14 AS BIGINT) AS height FROM part")
def m20_resize_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", g.resized_height(F.lit(640), F.col("p_size") * 10).alias("height"))


@query("SELECT CAST(i * 16 + j AS BIGINT) AS track, round(10 + j * (640 - 1 - 20) / 15.0, 6) + 0.0 AS x, round(10 + i * (480 - 1 - 20) / 15.0, 6) + 0.0 AS y FROM range(16) a(i), range(16) b(j)")
def g32_support_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    return spark.range(256).select(i.alias("track"), r(g.support_point(i % 16, 16, 640, 640)).alias("x"), r(g.support_point(F.floor(i / 16), 16, 480, 640)).alias("y"))


@query("SELECT p_partkey, round(p_retailprice * 2 / least(p_size + 100, 120), 6) + 0.0 AS focal, round(-(p_size - 60.0) * 2 / least(p_size + 100, 120), 6) + 0.0 AS principal FROM part")
def g34_ndc_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, w = F.col("p_size") + 100, F.lit(120)
    return table(spark, sf_dir, "part").select("p_partkey", r(g.ndc_focal(F.col("p_retailprice"), h, w)).alias("focal"), r(g.ndc_principal(F.col("p_size"), w, h, w)).alias("principal"))


@query("SELECT event_id, 1 / (1 + exp(-(value - 20))) >= 0.9 AS visible FROM events")
def m02_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", (g.sigmoid(F.col("value") - 20) >= 0.9).alias("visible"))


@query("SELECT doc_id, list_transform(list_filter(range(1, len(a) + 1), lambda i: list_position(a, a[i]) = i), lambda i: a[i]) AS letters FROM (SELECT p_partkey AS doc_id, string_split(p_name || ' ' || p_type || ' ' || p_name, ' ') AS a FROM part)")
def x06_dedupe_keep_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_type", "p_name"), " ")).alias("letters"))


@query("SELECT event_id, 'props.k' AS key, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events UNION ALL SELECT event_id, 'type', event_type FROM events")
def x13_nested_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    nested = e.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("k", "value")).select("event_id", F.concat(F.lit("props."), F.col("k")).alias("key"), "value")
    return nested.unionByName(e.select("event_id", F.lit("type").alias("key"), F.col("event_type").alias("value")))


@query(f"""WITH {TR} SELECT clip, track, CAST(step AS INT) AS step, round((9 - x - 2) * 0.5, 6) + 0.0 AS x, round((y - 1) * 0.5, 6) + 0.0 AS y, ['seen', 'flipped'] AS flags FROM tr""")
def u02_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipeline = transforms.compose([{"name": "flip", "width": 10.0}, {"name": "crop", "left": 2.0, "top": 1.0, "scale": 0.5}, {"name": "add_flag", "flag": "flipped"}])
    return pipeline(tracks(spark, sf_dir).withColumn("flags", F.array(F.lit("seen")))).select("clip", "track", "step", r("x").alias("x"), r("y").alias("y"), "flags")


@query(f"""WITH {TR} SELECT clip, track, CAST(step AS INT) AS step, NOT (step % 2 = 0 AND x >= 0 AND x < 0.3 AND y >= 0 AND y < 0.3) AS visible FROM tr""")
def u03a_erase(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks(spark, sf_dir)
    boxes = t.select("clip", "step").distinct().filter("step % 2 = 0").select("clip", "step", F.lit(0.0).alias("left"), F.lit(0.0).alias("top"), F.lit(0.3).alias("right"), F.lit(0.3).alias("bottom"))
    return t.withColumn("visible", F.lit(True)).transform(transforms.erase(boxes)).select("clip", "track", "step", "visible")


@query(f"WITH {TR} SELECT clip, track, CAST(step AS INT) AS step, 0.0::DOUBLE AS roi_low, round(max(CASE WHEN x > 0 AND y > 0 THEN x END) OVER (PARTITION BY clip) * 2, 6) + 0.0 AS roi_high FROM tr")
def u03o_set_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks(spark, sf_dir).withColumns({"z": F.col("x"), "valid": F.col("x") > 0, "visible": F.col("y") > 0})
    return t.transform(transforms.set_roi(2.0)).select("clip", "track", "step", "roi_low", r("roi_high").alias("roi_high"))


def _fit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), "vec_id", *(F.get("embedding", F.lit(k)).cast("double").alias(n) for k, n in enumerate("abcdef")), (1.0 + F.col("vec_id") % 3).alias("w"))


FIT = "ft AS (SELECT label AS clip, vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c, CAST(embedding[4] AS DOUBLE) AS d, CAST(embedding[5] AS DOUBLE) AS e, CAST(embedding[6] AS DOUBLE) AS f, 1.0 + vec_id % 3 AS w FROM embeddings)"


@query(f"""WITH {FIT}, p AS (SELECT DISTINCT clip, unnest([(b - 0.1) / a, b / a, (b + 0.1) / a]) AS s FROM ft WHERE abs(a) > 1e-12),
    l AS (SELECT p.clip, p.s, sum(w * least(abs(p.s * a - b), 0.1)) AS loss FROM p JOIN ft ON ft.clip = p.clip GROUP BY p.clip, p.s)
    SELECT clip, round(s, 6) + 0.0 AS scale, round(loss, 6) + 0.0 AS loss FROM (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY round(loss, 9), s) AS k FROM l) WHERE k = 1""")
def a31_l1_scale_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitting.truncated_scale(_fit_rows(spark, sf_dir), ["clip"], "a", "b", "w", 0.1).select("clip", r("scale").alias("scale"), r("loss").alias("loss"))


@query(f"""WITH {FIT}, q AS (SELECT o.clip, o.vec_id AS anchor, o.a AS xk, o.b AS yk, (p.b - o.b) / (p.a - o.a) AS ratio, p.w * abs(p.a - o.a) AS v, p.vec_id FROM ft o JOIN ft p ON p.clip = o.clip AND abs(p.a - o.a) > 1e-12),
    u AS (SELECT *, sum(v) OVER (PARTITION BY clip, anchor ORDER BY ratio, vec_id ROWS UNBOUNDED PRECEDING) AS run, sum(v) OVER (PARTITION BY clip, anchor) AS total FROM q),
    m AS (SELECT clip, anchor, min(ratio) AS s, any_value(xk) AS xk, any_value(yk) AS yk FROM u WHERE 2 * run >= total GROUP BY clip, anchor),
    l AS (SELECT m.clip, s, yk - s * xk AS t, sum(w * abs(s * a + (yk - s * xk) - b)) AS loss FROM m JOIN ft ON ft.clip = m.clip GROUP BY m.clip, m.anchor, s, xk, yk)
    SELECT clip, round(s, 6) + 0.0 AS scale, round(t, 6) + 0.0 AS shift, round(loss, 6) + 0.0 AS loss FROM (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY round(loss, 9), s) AS k FROM l) WHERE k = 1""")
def a32_l1_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitting.anchored_affine(_fit_rows(spark, sf_dir), ["clip"], "a", "b", "w").select("clip", r("scale").alias("scale"), r("shift").alias("shift"), r("loss").alias("loss"))


@query("""WITH q AS (SELECT label AS clip, CAST(embedding[2] AS DOUBLE) - CAST(embedding[1] AS DOUBLE) AS g, 1.0 + vec_id % 3 AS w, vec_id FROM embeddings),
    c AS (SELECT *, sum(w) OVER (PARTITION BY clip ORDER BY g, vec_id ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY clip) AS total FROM q) SELECT clip, round(min(g), 6) + 0.0 AS shift FROM c WHERE 2 * run >= total GROUP BY clip""")
def a32_l1_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitting.weighted_median_shift(_fit_rows(spark, sf_dir), ["clip"], "a", "b", "w", "vec_id").select("clip", r("shift").alias("shift"))


@query()
def a33_irls_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitting.irls_affine(_fit_rows(spark, sf_dir), ["clip"], "a", "b", "w").select("clip", r("scale").alias("scale"), r("shift").alias("shift"))


@query()
def a37_procrustes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitting.procrustes(_fit_rows(spark, sf_dir), ["clip"], list("abc"), list("def"), "w")


@query(f"""WITH {CELLS}, e AS (SELECT f, u, v, CASE WHEN (u + v) % 3 <> 0 THEN d END AS d FROM c), n AS (SELECT a.f, a.u, a.v, min((a.u - b.u) ** 2 + (a.v - b.v) ** 2) AS s FROM e a JOIN e b ON a.f = b.f WHERE a.d IS NULL AND b.d IS NOT NULL GROUP BY a.f, a.u, a.v)
    SELECT f, u, v, round(sqrt(s), 6) + 0.0 AS distance FROM n UNION ALL SELECT f, u, v, 0.0 FROM e WHERE d IS NOT NULL""")
def j17_nearest_valid_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).withColumn("d", F.when((F.col("u") + F.col("v")) % 3 != 0, F.col("d")))
    return fitting.nearest_fill(cells, ["f"], "u", "v", "d").select("f", "u", "v", r("distance").alias("distance"))


@query()
def w17_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").select(F.date_trunc("day", "ts").alias("h"), "user_id", "value", F.lit(0).cast("long").alias("clip"))
    return fitting.keyframes_of_views(seen, ["clip"], ["h"], "user_id", "value", 12)


@query(f"""WITH {FIT}, g AS (SELECT *, d * d + e * e + f * f AS n FROM ft),
    s AS (SELECT clip, sum(1 - d * d / n) AS xx, sum(-d * e / n) AS xy, sum(-d * f / n) AS xz, sum(1 - e * e / n) AS yy, sum(-e * f / n) AS yz, sum(1 - f * f / n) AS zz,
      sum(a - d * (d * a + e * b + f * c) / n) AS p, sum(b - e * (d * a + e * b + f * c) / n) AS q, sum(c - f * (d * a + e * b + f * c) / n) AS r FROM g GROUP BY clip),
    t AS (SELECT *, xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz) AS det FROM s)
    SELECT clip, round((p * (yy * zz - yz * yz) - xy * (q * zz - yz * r) + xz * (q * yz - yy * r)) / det, 6) + 0.0 AS a, round((xx * (q * zz - yz * r) - p * (xy * zz - yz * xz) + xz * (xy * r - q * xz)) / det, 6) + 0.0 AS b,
      round((xx * (yy * r - q * yz) - xy * (xy * r - q * xz) + p * (xy * yz - yy * xz)) / det, 6) + 0.0 AS c FROM t""")
def g20_camera_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fitting.axes_meeting(_fit_rows(spark, sf_dir), ["clip"], list("abc"), list("def"))
    return out.select("clip", *(r(c).alias(c) for c in "abc"))


@query(f"WITH {CELLS} SELECT f, u // 4 AS u, v // 4 AS v, round(sum(d * (1 + u % 2)) / sum(1 + u % 2), 9) + 0.0 AS d FROM c GROUP BY ALL")
def g27_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = _cells(spark, sf_dir).withColumn("w", (1 + F.col("u") % 2).cast("double"))
    return projection.shrink(weighted, ["f"], "u", "v", "d", 4, "w").select("f", "u", "v", r("d", 9).alias("d"))


@query(f"WITH {CELLS}, n AS (SELECT a.f, a.u, a.v, 1 / a.d AS d, min(1 / b.d) AS low FROM c a JOIN c b ON a.f = b.f AND abs(a.u - b.u) <= 1 AND abs(a.v - b.v) <= 1 GROUP BY a.f, a.u, a.v, a.d) SELECT f, u, v, (d - low) / d > 0.5 AS occludes FROM n")
def g25_occlusion_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.occlusion_edges(_cells(spark, sf_dir), ["f"], "u", "v", "d", 0.5)


LIFT = f"{CELLS}, q AS (SELECT event_id, user_id % 10 AS f, value AS x, event_id % 40 + 0.25 AS y FROM events WHERE value < 39)"


@query(f"WITH {LIFT}, m AS (SELECT event_id, (x - 320) * d / 500 - 0.1 AS a, (y - 240) * d / 480 + 0.2 AS b, d - 3.0 AS z FROM q JOIN c ON q.f = c.f AND c.u = CAST(round_even(x, 0) AS BIGINT) AND c.v = CAST(round_even(y, 0) AS BIGINT) WHERE d > 0) SELECT event_id, round(0.8 * a + 0.6 * b, 9) + 0.0 AS X, round(-0.6 * a + 0.8 * b, 9) + 0.0 AS Y, round(z, 9) + 0.0 AS Z FROM m")
def g02_unproject_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "events").filter("value < 39").select("event_id", (F.col("user_id") % 10).alias("f"), F.col("value").alias("x"), (F.col("event_id") % 40 + 0.25).alias("y"), g.matrix(K).alias("k"), g.matrix(W2C).alias("w2c"))
    out = projection.lift_queries(q, _cells(spark, sf_dir).withColumnRenamed("d", "depth"), ["f"])
    return out.select("event_id", *(r(c, 9).alias(c) for c in "XYZ"))


@query(f"WITH {CAM} SELECT vec_id, round((500 * cx + 320 * cz) / (cz + 1e-8), 5) + 0.0 AS u, round(cz, 6) + 0.0 AS z FROM cam")
def g09_batch_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir).select("vec_id", (F.col("vec_id") % 4).alias("frame"), *(F.col(c).alias(c.upper()) for c in "xyz"))
    cameras = spark.range(4).select(F.col("id").alias("frame"), g.matrix(K).alias("k"), g.matrix(W2C).alias("w2c"))
    return projection.reproject(p, cameras, ["frame"]).select("vec_id", r("u", 5).alias("u"), r("z").alias("z"))


@query(f"WITH {PT}, t AS (SELECT vec_id, x, y, z, s AS frame FROM p, range(3) f(s)) SELECT vec_id, frame, round((500 * (0.8 * x - 0.6 * y + 0.1 + frame) + 320 * (z + 3.0)) / (z + 3.0 + 1e-8), 5) + 0.0 AS u, z + 3.0 > 0 AS visible FROM t")
def g23_track_from_cam(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir).select((F.col("vec_id") % 10).alias("clip"), "vec_id", *(F.col(c).alias(c.upper()) for c in "xyz"))
    moved = F.transform(g.matrix(W2C), lambda v, i: F.when(i == 3, v + F.col("id") % 3).otherwise(v))
    cameras = spark.range(30).select(F.floor(F.col("id") / 3).alias("clip"), (F.col("id") % 3).alias("frame"), g.matrix(K).alias("k"), moved.alias("w2c"))
    return projection.static_tracks(p, cameras, ["clip"]).select("vec_id", "frame", r("u", 5).alias("u"), "visible")


@query("SELECT CAST(i * 8 + j AS BIGINT) AS track, round_even(j * 639 / 7.0, 0) + 0.0 AS x, round_even(i * 479 / 7.0, 0) + 0.0 AS y, CAST((i * 8 + j) % 12 AS BIGINT) AS frame FROM range(8) a(i), range(8) b(j)")
def g33_track_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.track_points(spark, 8, 640, 480, 12, "incremental")


@query(f"WITH {PT}, a AS (SELECT *, sqrt(x * x + y * y + z * z) AS t FROM p) SELECT vec_id, round(cos(t / 2), 5) + 0.0 AS w, round(2 * atan(480 / (2 * 480.0)), 6) + 0.0 AS fov_h, round(2 * atan(640 / (2 * 500.0)), 6) + 0.0 AS fov_w FROM a WHERE t < 3")
def g18_pose_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _points(spark, sf_dir).filter("sqrt(x * x + y * y + z * z) < 3")
    # a column for each stage: expressions that are used many times must not be written out many times
    rows = rows.withColumn("q", F.array(*g.quaternion_of_rotvec(*_xyz()))).withColumn("m", g.matrix_of_quaternion(*(F.get("q", F.lit(k)) for k in range(4))))
    w2c = F.array(*(g.at(F.col("m"), 3 * i + j) if j < 3 else F.lit(0.0) for i in range(3) for j in range(4)), *(F.lit(float(j == 3)) for j in range(4)))
    rows = rows.withColumns({"w2c": w2c, "k": g.matrix(K)})
    e = g.pose_encoding(F.col("w2c"), F.col("k"), 640.0, 480.0)
    return rows.select("vec_id", r(g.at(e, 3), 5).alias("w"), r(g.at(e, 7)).alias("fov_h"), r(g.at(e, 8)).alias("fov_w"))


@query("SELECT p_partkey, round((p_size / 255.0 - 0.45) / 0.225, 6) + 0.0 AS value FROM part")
def g36_normalize_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", r(g.normalised_colour(F.col("p_size"), 0.45, 0.225)).alias("value"))


@query()
def g31_ghost_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.ghost_points(spark, 2000, "ball", 5)


@query()
def g26_focal_shift_solve(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _fit_rows(spark, sf_dir).select("clip", F.col("a").alias("x"), F.col("b").alias("y"), (F.abs("c") + 0.5).alias("z"))
    seen = p.withColumns({"u": 1.3 * F.col("x") / (F.col("z") + 2), "v": 1.3 * F.col("y") / (F.col("z") + 2)})
    return projection.focal_and_shift(seen, ["clip"]).select("clip", r("focal", 3).alias("focal"), r("shift", 3).alias("shift"))


# measures


MOTION = f"""{EV}, po AS (SELECT user_id, pos, value / 100 AS a, value / 50 AS tx, (pos % 7) * 0.1 AS ty, value / 300 AS d, value / 200 AS dy FROM ev),
    pr AS (SELECT *, lag(a) OVER o AS pa, lag(tx) OVER o AS px, lag(ty) OVER o AS py FROM po WINDOW o AS (PARTITION BY user_id ORDER BY pos))"""


def _poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    def turned(angle: Column, x: Column, y: Column, z: float) -> Column:
        c, s, one, nil = F.cos(angle), F.sin(angle), F.lit(1.0), F.lit(0.0)
        return measures.pose_of([c, -s, nil, s, c, nil, nil, nil, one], [x, y, F.lit(z)])

    v = F.col("value")
    return steps(spark, sf_dir).select("user_id", "pos", turned(v / 100, v / 50, (F.col("pos") % 7) * 0.1, 0.5).alias("state"), turned(v / 300, F.lit(0.1), v / 200, 0.02).alias("delta"))


@query(f"""WITH {MOTION}, e AS (SELECT user_id,
      greatest(abs(cos(a) - cos(pa + d)), abs(sin(a) - sin(pa + d)), abs(tx - (cos(pa) * 0.1 - sin(pa) * dy + px)), abs(ty - (sin(pa) * 0.1 + cos(pa) * dy + py)), 0.02) AS e1,
      greatest(abs(cos(a) - cos(pa + d)), abs(sin(a) - sin(pa + d)), abs(tx - (cos(d) * px - sin(d) * py + 0.1)), abs(ty - (sin(d) * px + cos(d) * py + dy)), 0.02) AS e2,
      greatest(abs(cos(a) - cos(pa - d)), abs(sin(a) - sin(pa - d)), abs(tx - (cos(pa) * ix - sin(pa) * iy + px)), abs(ty - (sin(pa) * ix + cos(pa) * iy + py)), 0.02) AS e3
      FROM (SELECT *, -(cos(d) * 0.1 + sin(d) * dy) AS ix, -(cos(d) * dy - sin(d) * 0.1) AS iy FROM pr WHERE pa IS NOT NULL))
    SELECT user_id, round(avg(e1), 6) + 0.0 AS mean_prev_delta, round(max(e1), 6) + 0.0 AS max_prev_delta, round(avg(e2), 6) + 0.0 AS mean_delta_prev, round(max(e2), 6) + 0.0 AS max_delta_prev,
      round(avg(e3), 6) + 0.0 AS mean_prev_inverse, round(max(e3), 6) + 0.0 AS max_prev_inverse FROM e GROUP BY user_id""")
def a20_pose_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.transform_errors(_poses(spark, sf_dir), ["user_id"], "pos", "state", "delta")
    return out.select("user_id", *(r(c).alias(c) for c in out.columns if c != "user_id"))


@query(f"""WITH {MOTION}, an AS (SELECT *, sum(d) OVER (PARTITION BY user_id ORDER BY pos) AS ang FROM pr)
    SELECT user_id, pos, round(cos(ang), 6) + 0.0 AS c, round(sum(cos(ang - d) * 0.1 - sin(ang - d) * dy) OVER w, 6) + 0.0 AS x, round(sum(sin(ang - d) * 0.1 + cos(ang - d) * dy) OVER w, 6) + 0.0 AS y
    FROM an WINDOW w AS (PARTITION BY user_id ORDER BY pos)""")
def w15_pose_chain_4x4(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = measures.pose_chain(_poses(spark, sf_dir).select("user_id", F.col("pos").cast("bigint").alias("pos"), "delta"), ["user_id"], "pos", "delta")
    return p.select("user_id", "pos", r(F.col("pose")[0]).alias("c"), r(F.col("pose")[3]).alias("x"), r(F.col("pose")[7]).alias("y"))


@query("""WITH v AS (SELECT 'position' AS block, unnest(embedding[1:3]) AS v FROM embeddings UNION ALL SELECT 'rotation', unnest(embedding[4:6]) FROM embeddings)
    SELECT block, min(v)::DOUBLE AS low, max(v)::DOUBLE AS high, round(avg(v::DOUBLE), 6) + 0.0 AS mean, round(stddev_pop(v::DOUBLE), 6) + 0.0 AS std FROM v GROUP BY block""")
def a22_action_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.action_blocks(table(spark, sf_dir, "embeddings"), "embedding", {"position": (0, 3), "rotation": (3, 3)})
    return out.select("block", "low", "high", r("mean").alias("mean"), r("std").alias("std"))


@query("SELECT l_linestatus, count(*) AS n FROM lineitem GROUP BY l_linestatus")
def a22_gripper_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.value_counts(table(spark, sf_dir, "lineitem"), "l_linestatus")


@query("SELECT event_type, 'value' AS key, round(avg(value), 6) + 0.0 AS mean, count(*) AS n FROM events GROUP BY event_type UNION ALL SELECT event_type, 'half.value', round(avg(value / 2), 6) + 0.0, count(*) FROM events GROUP BY event_type")
def a36_key_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", F.create_map(F.lit("value"), F.col("value"), F.lit("half.value"), F.col("value") / 2).alias("m"))
    return measures.key_averages(rows, ["event_type"], "m").select("event_type", "key", r("mean").alias("mean"), "n")


@query("SELECT o_custkey, count(o) IN (0, count(*)) AS whole FROM (SELECT o_custkey, CASE WHEN o_orderkey % 3 > 0 THEN 1 END AS o FROM orders) GROUP BY o_custkey")
def a40_all_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 3 > 0, 1).alias("o"))
    return rows.groupBy("o_custkey").agg(measures.all_or_none("o").alias("whole"))


@query("""WITH q AS (SELECT l_suppkey, l_linenumber, l_tax * 40 - 1 AS z, CAST(l_discount > 0.05 AS DOUBLE) AS t, abs(l_tax - l_discount) AS e FROM lineitem), p AS (SELECT *, 1 / (1 + exp(-z)) AS p FROM q)
    SELECT l_suppkey, round(avg(-(t * 0.25 * (1 - p) ** 2 * ln(p) + (1 - t) * 0.75 * p ** 2 * ln(1 - p))), 6) + 0.0 AS focal,
      round(avg(CASE WHEN e < 0.03 THEN -ln(p) ELSE -ln(1 - p) END), 6) + 0.0 AS confidence, round(avg(e * 0.8 ** (7 - l_linenumber) / 7), 6) + 0.0 AS iterated FROM p GROUP BY l_suppkey""")
def a41_focal_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, e = F.col("l_tax") * 40 - 1, F.abs(F.col("l_tax") - F.col("l_discount"))
    focal = measures.focal((F.col("l_discount") > 0.05).cast("double"), z)
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(r(F.avg(focal)).alias("focal"), r(F.avg(measures.confidence_loss(e, z, 0.03))).alias("confidence"), r(F.avg(measures.by_iteration(e, F.col("l_linenumber") - 1, 7))).alias("iterated"))


@query(f"""WITH {TR}, p AS (SELECT clip, track, step FROM tr WHERE step = 0), q AS (SELECT clip, track, x, y FROM tr WHERE step = 0)
    SELECT a.clip, a.track, 1.0::DOUBLE / count(*) AS weight FROM q a JOIN q b ON a.clip = b.clip AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 0.04 GROUP BY a.clip, a.track""")
def a46_radius_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.radius_weights(tracks(spark, sf_dir).filter("step = 0"), ["clip"], "track", ["x", "y"], 0.2).select("clip", "track", "weight")


@query("""WITH c AS (SELECT *, median(l_tax) OVER w AS cp, median(l_discount) OVER w AS ct FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)),
    s AS (SELECT l_suppkey, l_tax - cp AS p, l_discount - ct AS t, greatest(avg(abs(l_tax - cp)) OVER w, 1e-6) AS sp, greatest(avg(abs(l_discount - ct)) OVER w, 1e-6) AS st FROM c WINDOW w AS (PARTITION BY l_suppkey))
    SELECT l_suppkey, round(avg(abs(p / sp - t / st)), 6) + 0.0 AS loss FROM s GROUP BY l_suppkey""")
def a49_invariant_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.invariant_l1(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_tax", "l_discount").select("l_suppkey", r("loss").alias("loss"))


@query(f"""WITH {CELLS}, e AS (SELECT f, u, v, d - (u + v) / 10.0 AS e, s FROM c, (VALUES (1), (2), (4)) t(s) WHERE u % s = 0 AND v % s = 0),
    g AS (SELECT a.f, a.s, coalesce(abs(b.e - a.e), 0) + coalesce(abs(d.e - a.e), 0) AS g FROM e a LEFT JOIN e b ON b.f = a.f AND b.s = a.s AND b.v = a.v AND b.u = a.u + a.s LEFT JOIN e d ON d.f = a.f AND d.s = a.s AND d.u = a.u AND d.v = a.v + a.s),
    m AS (SELECT f, s, avg(g) AS l FROM g GROUP BY f, s) SELECT f, round(sum(l) / 3, 6) + 0.0 AS loss FROM m GROUP BY f""")
def a49_gradient_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).withColumn("t", (F.col("u") + F.col("v")) / 10.0)
    return measures.gradient_loss(cells, ["f"], "u", "v", "d", "t", 3).select("f", r("loss").alias("loss"))


@query(f"WITH {TR} SELECT clip, track, CAST(step AS INT) AS step FROM tr WHERE abs(x) < 0.5 AND abs(y) + 0.4 > 0.5 AND x * 100 >= 0 AND x * 100 < 64 AND y * 100 >= 0 AND y * 100 < 48")
def p22_static_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    still = measures.static_points(F.abs("x"), F.abs("y") + 0.4, F.col("x") * 100, F.col("y") * 100, 64, 48)
    return tracks(spark, sf_dir).filter(still).select("clip", "track", "step")


@query(f"""WITH {CELLS} SELECT f, count(CASE WHEN v >= {int(0.40810811 * 40)} AND v < {int(0.99189189 * 40)} AND u >= {int(0.03594771 * 40)} AND u < {int(0.96405229 * 40)} AND d > 5 AND d < 45 THEN 1 END) AS garg,
    count(CASE WHEN v >= {int(0.3324324 * 40)} AND v < {int(0.91351351 * 40)} AND u >= {int(0.0359477 * 40)} AND u < {int(0.96405229 * 40)} AND d > 5 AND d < 45 THEN 1 END) AS eigen FROM c GROUP BY f""")
def p25_eval_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = lambda kind: F.count_if(measures.eval_crop(kind, F.col("u"), F.col("v"), F.col("d"), 40, 40, 5, 45))
    return _cells(spark, sf_dir).groupBy("f").agg(inside("garg").alias("garg"), inside("eigen_kitti").alias("eigen"))


@query("""WITH p AS (SELECT label, vec_id, embedding[1:3] AS e, CAST(embedding[3] AS DOUBLE) AS d, CAST(embedding[3] AS DOUBLE) * 1.2 + CAST(embedding[4] AS DOUBLE) * 0.5 AS l FROM embeddings),
    n AS (SELECT a.label, a.vec_id, abs(abs(b.d - a.d) / (abs(b.l - a.l) + 1e-8) - 1) < 0.4 AS ok, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(sqrt((a.e[1] - b.e[1])::DOUBLE ** 2 + (a.e[2] - b.e[2])::DOUBLE ** 2 + (a.e[3] - b.e[3])::DOUBLE ** 2), 6), b.vec_id) AS k FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id)
    SELECT label, vec_id, count(CASE WHEN ok THEN 1 END) AS alike, count(CASE WHEN ok THEN 1 END) > 9 AS kept FROM n WHERE k <= 48 GROUP BY label, vec_id""")
def p26_topo_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = [F.get("embedding", F.lit(k)) for k in range(4)]
    points = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.array(*(x.cast("double") for x in e[:3])).alias("e"), e[2].cast("double").alias("d"), (e[2].cast("double") * 1.2 + e[3].cast("double") * 0.5).alias("l"))
    return measures.topology_mask(points, ["label"], "vec_id", "e", "d", "l")


@query(f"""WITH {CELLS}, p AS (SELECT f, u, v, u * 0.1 AS x, v * 0.1 AS y, d AS z FROM c),
    s AS (SELECT p.f, p.u, p.v, u1.x - p.x AS ux, u1.y - p.y AS uy, u1.z - p.z AS uz, l1.x - p.x AS lx, l1.y - p.y AS ly, l1.z - p.z AS lz, d1.x - p.x AS dx, d1.y - p.y AS dy, d1.z - p.z AS dz, r1.x - p.x AS rx, r1.y - p.y AS ry, r1.z - p.z AS rz
      FROM p LEFT JOIN p u1 ON u1.f = p.f AND u1.u = p.u AND u1.v = p.v - 1 LEFT JOIN p l1 ON l1.f = p.f AND l1.v = p.v AND l1.u = p.u - 1 LEFT JOIN p d1 ON d1.f = p.f AND d1.u = p.u AND d1.v = p.v + 1 LEFT JOIN p r1 ON r1.f = p.f AND r1.v = p.v AND r1.u = p.u + 1),
    n AS (SELECT f, u, v, coalesce(uy*lz-uz*ly,0)+coalesce(ly*dz-lz*dy,0)+coalesce(dy*rz-dz*ry,0)+coalesce(ry*uz-rz*uy,0) AS nx, coalesce(uz*lx-ux*lz,0)+coalesce(lz*dx-lx*dz,0)+coalesce(dz*rx-dx*rz,0)+coalesce(rz*ux-rx*uz,0) AS ny,
      coalesce(ux*ly-uy*lx,0)+coalesce(lx*dy-ly*dx,0)+coalesce(dx*ry-dy*rx,0)+coalesce(rx*uy-ry*ux,0) AS nz FROM s)
    SELECT f, u, v, round(nx / nullif(sqrt(nx*nx+ny*ny+nz*nz), 0), 5) + 0.0 AS nx, round(ny / nullif(sqrt(nx*nx+ny*ny+nz*nz), 0), 5) + 0.0 AS ny, round(nz / nullif(sqrt(nx*nx+ny*ny+nz*nz), 0), 5) + 0.0 AS nz FROM n""")
def g24_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _cells(spark, sf_dir).select("f", "u", "v", (F.col("u") * 0.1).alias("x"), (F.col("v") * 0.1).alias("y"), F.col("d").alias("z"))
    return measures.normals(p, ["f"], "u", "v").select("f", "u", "v", *(r(c, 5).alias(c) for c in ("nx", "ny", "nz")))


@query(f"WITH {CELLS} SELECT a.f, a.u, a.v, max(CAST(b.d > 40 AS INT)) = 1 AS hot FROM c a JOIN c b ON a.f = b.f AND abs(a.u - b.u) <= 1 AND abs(a.v - b.v) <= 1 GROUP BY a.f, a.u, a.v")
def g25_dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.dilate(_cells(spark, sf_dir).withColumn("hot", F.col("d") > 40), ["f"], "u", "v", "hot")


@query(f"WITH {CELLS} SELECT f, CAST(i AS INT) AS u, CAST(j AS INT) AS v, d FROM c, range(15) a(i), range(25) b(j) WHERE u = floor((i + 0.5) * 40 / 15) AND v = floor((j + 0.5) * 40 / 25)")
def g27_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.resize_nearest(_cells(spark, sf_dir), ["f"], "u", "v", (40, 40), (15, 25)).select("f", "u", "v", "d")


@query(f"""WITH {CELLS}, w AS (SELECT f, i, j, d, greatest(0, 1 - abs(greatest(0, least(39, (i + 0.5) * (40 / 64.0) - 0.5)) - u)) * greatest(0, 1 - abs(greatest(0, least(39, (j + 0.5) * (40 / 20.0) - 0.5)) - v)) AS w FROM c, range(64) a(i), range(20) b(j)
      WHERE abs((i + 0.5) * (40 / 64.0) - 0.5 - u) < 2 AND abs((j + 0.5) * 2 - 0.5 - v) < 2)
    SELECT f, CAST(i AS INT) AS u, CAST(j AS INT) AS v, round(sum(d * w) / sum(w), 12) + 0.0 AS d FROM w WHERE w > 0 GROUP BY f, i, j""")
def g27_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.resize_bilinear(_cells(spark, sf_dir), ["f"], "u", "v", "d", (40, 40), (64, 20)).select("f", "u", "v", r("d", 12).alias("d"))


@query("SELECT p_partkey, round((2.0 * (p_partkey % 64) / 63 - 1) * ((64 / 48.0) / sqrt(1 + (64 / 48.0) ** 2) * 63 / 64), 6) + 0.0 AS u, round((2.0 * (p_partkey % 48) / 47 - 1) * (1 / sqrt(1 + (64 / 48.0) ** 2) * 47 / 48), 6) + 0.0 AS v FROM part")
def g35_view_plane_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, v = measures.view_plane_uv(F.col("p_partkey") % 64, F.col("p_partkey") % 48, 64, 48)
    return table(spark, sf_dir, "part").select("p_partkey", r(u).alias("u"), r(v).alias("v"))


@query(f"""WITH {CELLS}, z AS (SELECT f, u, v, CASE WHEN (u + v) % 5 = 0 THEN 0.0 ELSE d END AS d FROM c),
    b AS (SELECT a.f, a.u, a.v, a.d AS own, sum(b.d * exp(-((a.u - b.u) ** 2 + (a.v - b.v) ** 2) / 2.0)) / sum(exp(-((a.u - b.u) ** 2 + (a.v - b.v) ** 2) / 2.0)) AS s FROM z a JOIN z b ON a.f = b.f AND abs(a.u - b.u) <= 2 AND abs(a.v - b.v) <= 2 GROUP BY a.f, a.u, a.v, a.d)
    SELECT f, u, v, round(CASE WHEN own > 0 THEN s ELSE 0.0 END, 5) + 0.0 AS d FROM b""")
def u03e_blur_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).withColumn("d", F.when((F.col("u") + F.col("v")) % 5 == 0, 0.0).otherwise(F.col("d")))
    return measures.blur_depth(cells, ["f"], "u", "v", "d", 2, 1.0).select("f", "u", "v", r("d", 5).alias("d"))


@query(f"WITH {CELLS} SELECT a.f, a.u, a.v FROM c a JOIN c b ON a.f = b.f AND abs(a.u - b.u) <= 1 AND abs(a.v - b.v) <= 1 GROUP BY a.f, a.u, a.v, a.d HAVING NOT (max(b.d) - min(b.d)) / a.d > 0.5")
def u03l_filter_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.depth_edges(_cells(spark, sf_dir), ["f"], "u", "v", "d", 0.5).filter("NOT edge").select("f", "u", "v")


@query(f"WITH {CAM} SELECT vec_id, round(cx, 6) + 0.0 AS x, round(cy, 6) + 0.0 AS y, round(cz, 6) + 0.0 AS z, 1.0::DOUBLE AS scale FROM cam")
def u03g_to_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir).withColumn("frame", F.col("vec_id") % 10)
    cameras = spark.range(10).select(F.col("id").alias("frame"), g.matrix(W2C).alias("w2c"))
    return measures.to_local(points, cameras, ["frame"]).select("vec_id", r("x").alias("x"), r("y").alias("y"), r("z").alias("z"), F.col("w2c")[0].alias("scale"))


@query("""WITH d AS (SELECT s_suppkey, s_suppkey % 5 AS set, (s_suppkey * 53 % 997) / 997.0 AS u FROM supplier), f AS (SELECT n_regionkey AS set, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS pos, count(*) OVER (PARTITION BY n_regionkey) AS n FROM nation)
    SELECT s_suppkey, n_name FROM d JOIN f ON f.set = d.set AND f.pos = floor(d.u * f.n)""")
def e07_file_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 5).cast("int").alias("set"), ((F.col("s_suppkey") * 53 % 997) / 997.0).alias("u"))
    files = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("set"), "n_name")
    return statistics.uniform_choice(drawn, "set", "u", files, "n_name").select("s_suppkey", "n_name")


@query("SELECT s_suppkey, [CAST(s_suppkey AS DOUBLE), 1.0, NULL, 0.5] AS items FROM supplier")
def x14_parse_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(F.lit("["), F.col("s_suppkey").cast("string"), F.lit(", true, x, 0.5]"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", x.parsed_list(written).alias("items"))


@query()
def g19_random_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = tracks(spark, sf_dir).select("clip", "step").distinct()
    return measures.random_poses(frames, ["clip"], "step", 3, 0.05, 0.1).select("clip", "step", F.transform("pose", lambda v: F.round(v, 6) + F.lit(0.0)).alias("pose"))


@query(f"""WITH {PT}, c AS (SELECT vec_id % 4 AS clip, vec_id % 40 AS frame, avg(x) AS ax, avg(y) AS ay, avg(z) AS az FROM p GROUP BY ALL)
    SELECT clip, frame, count(*) AS n, round(avg((x - ax) ** 2 + (y - ay) ** 2 + (z - az) ** 2), 6) + 0.0 AS spread FROM p JOIN c ON c.frame = p.vec_id % 40 GROUP BY clip, frame""")
def u03j_camera_aug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The walk itself is drawn by hash; what a rigid motion leaves alone, the mean square distance from a frame's centre, is what SQL holds it to."""
    p = _points(spark, sf_dir).select((F.col("vec_id") % 4).alias("clip"), (F.col("vec_id") % 40).alias("frame"), "vec_id", "x", "y", "z", F.array(F.lit("local")).alias("flags"))
    moved = measures.camera_aug(p, ["clip"], "frame", 5, 0.05, 0.2)
    spread = sum((F.var_pop(c) for c in "yz"), F.var_pop("x"))
    return moved.groupBy("clip", "frame").agg(F.count("*").alias("n"), r(spread).alias("spread"))


BOXES = "b AS (SELECT f, 5 + f AS l, 10 AS t, 15 + f AS r, 20 AS b FROM range(10) x(f))"


def _boxes(spark: SparkSession) -> DataFrame:
    f = F.col("id").alias("f")
    return spark.range(10).select(f, (F.col("id") + 5).alias("left"), F.lit(10).alias("top"), (F.col("id") + 15).alias("right"), F.lit(20).alias("bottom"), ((F.col("id") + 1) % 10).alias("source"))


@query(f"""WITH {CELLS}, {BOXES}, i AS (SELECT c.*, c.u >= l AND c.u < r AND c.v >= t AND c.v < b.b AS inside FROM c JOIN b ON b.f = c.f)
    SELECT f, u, v, round(CASE WHEN inside THEN avg(d) OVER (PARTITION BY f, inside) ELSE d END, 6) + 0.0 AS d FROM i""")
def u03a_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).transform(transforms.fill(_boxes(spark), ["f"], value="d")).select("f", "u", "v", r("d").alias("d"))


@query(f"""WITH {CELLS}, {BOXES}, i AS (SELECT b.f, c.u, c.v, c.d FROM c JOIN b ON b.f = c.f AND c.u >= l AND c.u < r AND c.v >= t AND c.v < b.b),
    p AS (SELECT b.f, c.u, c.v, c.d FROM c JOIN b ON c.f = (b.f + 1) % 10 AND c.u >= l AND c.u < r AND c.v >= t AND c.v < b.b),
    s AS (SELECT f, n * 0.9 / m AS k FROM (SELECT f, min(d) AS n FROM i WHERE d > 0 GROUP BY f) JOIN (SELECT f, max(d) AS m FROM p WHERE d > 0 GROUP BY f) USING (f))
    SELECT c.f, c.u, c.v, round(coalesce(p.d * k, c.d), 6) + 0.0 AS d FROM c LEFT JOIN s ON s.f = c.f LEFT JOIN p ON p.f = c.f AND p.u = c.u AND p.v = c.v""")
def u03b_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).transform(transforms.paste(_boxes(spark), ["f"], value="d")).select("f", "u", "v", r("d").alias("d"))
