import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.functions import geometry as g
from tracewright.functions import text as x
from tracewright.operators import depth, fitting, matching, measures, quality, retarget, segments, statistics, transforms
from tracewright.streaming import tracks as stream


def track_rows(spark, clips, dims=2):
    names = "xyz"[:dims]
    rows = [(c, n, h, *map(float, p)) for c, t in clips.items() for n, track in enumerate(t) for h, p in enumerate(track)]
    return spark.createDataFrame(rows, "clip long, track long, step int, " + ", ".join(f"{d} double" for d in names))


def brute_retarget(t, interval, most, top):
    """In numpy, step by step."""
    scale = np.ones(t.shape[2])
    for a in (0, 1):
        scale[a] = t[-1, 0, a] if abs(t[-1, 0, a]) >= 1e-12 else 1.0
    unit = t / scale
    unit[:, :, :2] = unit[:, :, :2].clip(0, 1)
    length = np.sqrt((np.diff(unit, axis=1) ** 2).sum(axis=2))
    k = max(1, int(np.ceil(top * len(t))))
    robust = np.sort(length, axis=0)[len(t) - k :].mean(axis=0)
    total, ends = robust.sum(), np.concatenate([[0], np.cumsum(robust)])
    out = {}
    n = min(int(total // interval) + 1, most)
    for i in range(n):
        target = i * interval if i < n - 1 else min(i * interval, total)
        s = min(max(int((ends <= target).sum()) - 1, 0), len(robust) - 1)
        alpha = (target - ends[s]) / max(robust[s], 1e-12)
        for track in range(len(t)):
            out[track, i] = (unit[track, s] + alpha * (unit[track, s + 1] - unit[track, s])) * scale
    return out


@pytest.mark.parametrize(("interval", "top", "dims"), [(0.05, 0.02, 2), (0.3, 0.5, 2), (0.21, 0.3, 3)])
def test_retarget_is_brute_force(spark, interval, top, dims):
    rng = np.random.default_rng(dims)
    clips = {c: rng.normal(0.4, 0.3, (n, h, dims)) for c, n, h in ((1, 5, 7), (2, 1, 4), (3, 3, 2))}
    clips[3][-1, 0, :2] = 0  # scale guard
    names = "xyz"[:dims]
    got = {(r.clip, r.track, r["sample"]): np.array([r[d] for d in names]) for r in retarget.retarget(track_rows(spark, clips, dims), interval, 64, top, names).collect()}
    want = {(c, *k): v for c, t in clips.items() for k, v in brute_retarget(t, interval, 64, top).items()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k], atol=1e-9) for k in want)


def test_retarget_of_one_step(spark):
    got = retarget.retarget(track_rows(spark, {1: np.array([[[3.0, 4.0]], [[5.0, 6.0]]])})).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 3.0, 4.0), (1, 1, 0, 5.0, 6.0)]
    with pytest.raises(ValueError):
        retarget.retarget(track_rows(spark, {1: np.ones((1, 1, 2))}), interval=0)


def test_depth_golden_numbers(spark):
    known, pred = (0.5, 1, 1.5, 1, 2, 2.5, 1.5, 2.5, 3), (0.1, 0.2, 0.3, 0.2, 0.4, 0.5, 0.3, 0.5, 0.6)
    rows = spark.createDataFrame([(0, float(k), float(p)) for k, p in zip(known, pred, strict=True)] + [(1, 0.0, 1.0), (1, 2.0, 0.0)], "frame long, known double, pred double")
    got = depth.frame_scales(rows, ["frame"], "known", "pred").collect()
    assert [r.frame for r in got] == [0] and got[0].scale == pytest.approx(5.0)
    flat = spark.createDataFrame([(0, 2.0), (0, 2.0), (1, 0.0), (2, 1.0), (2, 3.0), (2, None)], "frame long, d double")
    got = sorted((r.frame, r.stretched) for r in depth.stretch_uint16(flat, ["frame"], "d").collect())
    assert got == [(0, 32767), (0, 32767), (1, 0), (2, 0), (2, 0), (2, 65535)]
    few = depth.kth_values(spark.createDataFrame([(0, 1.0), (0, 2.0), (0, 3.0)], "f long, d double"), ["f"], "d", (0.25, 0.75)).first()
    assert few.q25 is None and few.q75 == 2.0
    assert depth.scale_shift(spark.createDataFrame([(0, 1.0, 2.0)], "f long, p double, t double"), ["f"], "p", "t", F.lit(1.0)).first()[1:] == (0.0, 0.0)


def test_segments_golden_numbers(spark):
    clips = spark.createDataFrame([("a", 13)], "clip string, n long")
    got = segments.query_segments(clips, ["clip"], "n", 5, 4).orderBy("query").collect()
    assert [(r["query"], r.ends) for r in got] == [(0, 4), (5, 9), (10, 13)]
    assert spark.range(1).select(segments.auto_stride(F.lit(120), 50)).first()[0] == 3
    rows = spark.createDataFrame([("a", k, float(k)) for k in range(12)], "g string, pos long, v double")
    assert [r.pos for r in statistics.even_pick(rows.select("g", F.col("pos").alias("o")), ["g"], "o").orderBy("pos").collect()] == [0, 3, 6, 9, 11]
    assert [r.pos for r in statistics.uniform_pick(rows.filter("pos < 10").select("g", F.col("pos").alias("o")), ["g"], "o", 4).orderBy("pos").collect()] == [0, 3, 6, 9]
    assert spark.range(1, 7).select(statistics.round_robin(F.col("id"), list("0123"))).toPandas().iloc[:, 0].tolist() == list("012301")
    windows = segments.unfold(rows, ["g"], 8, 4)
    assert sorted((r.window, r.place) for r in windows.filter("pos = 5").collect()) == [(0, 5), (1, 1)]
    assert segments.pad_tail(rows, ["g"], 8, "v").count() == 16


def test_disk_estimate(spark):
    r = spark.range(1).select(quality.disk_estimate(F.lit(1), F.lit(884.0), 1.0, 5).alias("a"), quality.disk_estimate(F.lit(1), F.lit(426.0), 1.0, 5).alias("b")).first()
    assert (r.a, r.b) == (pytest.approx(177.6), pytest.approx(86.0))


def test_reconcile_and_reasons(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k long"), spark.createDataFrame([(2,), (3,)], "k long")
    assert {tuple(r) for r in quality.reconcile(a, b, ["k"]).collect()} == {(1, "left_only"), (2, "both"), (3, "right_only")}
    s = spark.createDataFrame([("a", 3, None), ("b", 2, 5)], "case string, n long, m long")
    assert {tuple(r) for r in quality.shape_issues(s, "case", {"n": F.col("n") == 2, "m": F.col("m") > 1}).collect()} == {("a", "n"), ("a", "m")}


@pytest.mark.parametrize("seed", range(3))
def test_nearest_and_interval_join(spark, seed):
    rng = np.random.default_rng(seed)
    asks, has = rng.integers(0, 60, 30).tolist(), rng.integers(0, 60, 12).tolist()
    a, h = (spark.createDataFrame([(1, int(p)) for p in v], "g long, pos long") for v in (asks, has))
    got = {(r.pos, r.nearest) for r in matching.nearest(a, h, ["g"], "pos").collect()}
    assert got == {(p, min(has, key=lambda q: (abs(q - p), q))) for p in asks}
    spans = [(int(s), int(s + w)) for s, w in zip(rng.integers(0, 50, 8), rng.integers(1, 25, 8), strict=True)]
    sp = spark.createDataFrame([(1, *s) for s in spans], "g long, first long, last long")
    got = sorted((r.pos, r.first, r.last) for r in matching.interval_join(a, sp, ["g"], "pos", "first", "last", 7).collect())
    assert got == sorted((p, *s) for p in asks for s in spans if s[0] <= p < s[1])


def test_geometry_inverses(spark):
    k, w = g.matrix([500, 3, 320, 0, 480, 240, 0, 0, 1]), g.matrix([0.8, -0.6, 0, 0.1, 0.6, 0.8, 0, -0.2, 0, 0, 1, 3, 0, 0, 0, 1])
    row = spark.range(1).select(g.matmul(g.inverse_se3(w), w, 4).alias("i"), g.matmul(g.inverse_k(k), k, 3).alias("j"), F.array(*g.rotvec_of_quaternion(*g.quaternion_of_rotvec(F.lit(0.3), F.lit(-2.0), F.lit(1.0)))).alias("v"), F.array(*g.euler_of_matrix(g.matrix_of_quaternion(*g.quaternion_of_rotvec(F.lit(0.4), F.lit(0.0), F.lit(0.0))))).alias("e")).first()
    assert np.allclose(np.reshape(row.i, (4, 4)), np.eye(4)) and np.allclose(np.reshape(row.j, (3, 3)), np.eye(3))
    assert np.allclose(row.v, [0.3, -2, 1]) and np.allclose(row.e, [0.4, 0, 0])
    r = spark.range(1).select(g.resized_height(F.lit(640), F.lit(480))).first()[0]
    assert r == 392


def test_fits_are_brute_force(spark):
    rng = np.random.default_rng(1)
    px, py, w = rng.normal(1, 1, 40), rng.normal(1, 2, 40), rng.random(40)
    a, loss = fitting.best_truncated_scale(px, py, w, 0.7)
    grid = np.concatenate([(py + d) / px for d in (-0.7, 0, 0.7)])
    losses = [(w * np.minimum(np.abs(s * px - py), 0.7)).sum() for s in grid]
    assert loss == pytest.approx(min(losses)) and (w * np.minimum(np.abs(a * px - py), 0.7)).sum() == pytest.approx(loss)
    rows = spark.createDataFrame([(0, *map(float, v)) for v in zip(px, py, w, strict=True)], "f long, a double, b double, w double")
    got = fitting.anchored_affine(rows, ["f"], "a", "b", "w").first()
    best = min((w * np.abs((py[j] - py[i]) / (px[j] - px[i]) * (px - px[i]) + py[i] - py)).sum() for i in range(40) for j in range(i))
    assert got.loss == pytest.approx(best)
    exact = rows.withColumn("b", 3 * F.col("a") - 2)
    assert np.allclose(fitting.irls_affine(exact, ["f"], "a", "b", "w").first()[1:], [3, -2], atol=1e-6)


def test_procrustes_finds_the_motion(spark):
    rng = np.random.default_rng(2)
    p = rng.normal(0, 1, (30, 3))
    c, s = np.cos(0.7), np.sin(0.7)
    r = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    q = 2.5 * p @ r.T + [1, -2, 3]
    rows = spark.createDataFrame([(0, *map(float, [*a, *b, 1.0])) for a, b in zip(p, q, strict=True)], "f long, a double, b double, c double, d double, e double, g double, w double")
    got = fitting.procrustes(rows, ["f"], list("abc"), list("deg"), "w").first()
    assert got.scale == pytest.approx(2.5) and np.allclose(np.reshape(got.rotation, (3, 3)), r) and np.allclose(got.translation, [1, -2, 3])


def test_motion_averaging(spark):
    rng = np.random.default_rng(3)
    turn = [np.eye(3)] + [np.linalg.qr(rng.normal(0, 1, (3, 3)))[0] for _ in range(4)]
    turn = [t * np.sign(np.linalg.det(t)) for t in turn]
    pairs = [(0, i, j, (turn[j] @ turn[i].T).ravel().tolist()) for i in range(5) for j in range(i + 1, 5)]
    got = fitting.average_motion(spark.createDataFrame(pairs, "f long, i long, j long, r array<double>"), ["f"], "i", "j", "r").orderBy("frame").collect()
    assert all(np.allclose(np.reshape(x.rotation, (3, 3)), t, atol=1e-6) for x, t in zip(got, turn, strict=True))


def test_nearest_fill(spark):
    cells = [(0, u, v, None if (u + v) % 4 else float(10 * u + v)) for u in range(5) for v in range(5)]
    got = {(r.u, r.v): (r.d, r.distance) for r in fitting.nearest_fill(spark.createDataFrame(cells, "f long, u long, v long, d double"), ["f"], "u", "v", "d").collect()}
    full = {(u, v): d for _, u, v, d in cells if d is not None}
    for (u, v), (d, distance) in got.items():
        best = min(np.hypot(a - u, b - v) for a, b in full)
        assert distance == pytest.approx(best) and any(full[k] == d and np.hypot(k[0] - u, k[1] - v) == pytest.approx(best) for k in full)


def test_axes_meet(spark):
    rays = [(0, 1.0, 0.0, 0.0, -1.0, 0.0, 0.0), (0, 0.0, 5.0, 0.0, 0.0, 2.0, 0.0), (0, 0.0, 0.0, -3.0, 0.0, 0.0, 1.0)]
    got = fitting.axes_meeting(spark.createDataFrame(rays, "f long, a double, b double, c double, d double, e double, g double"), ["f"], list("abc"), list("deg")).first()
    assert np.allclose(got[1:], [0, 0, 0])


def test_lenient_json_and_names(spark):
    texts = ['{"k": 1}', 'Sure\n```json\n{"k": 2}\n```', 'so {"k": 3} it is', "none", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(x.lenient_json(F.col("t"), "k int")["k"]).collect()]
    assert got == [1, 2, 3, None, None]
    names = ["noindex.png", "im_2.png", "a1_b3.png", "im_10.png", "00100.png"]
    rows = spark.createDataFrame([(n,) for n in reversed(names)], "p string")
    assert [r.p for r in rows.orderBy(*x.frame_order(F.col("p"))).collect()] == names


def test_transforms_don_t_depend_on_partitions(spark):
    rows = spark.createDataFrame([(c, s, s % 3, 1.0 * s, float(s % 5)) for c in range(3) for s in range(20)], "clip long, step int, u int, x double, depth double").withColumn("v", F.col("u"))
    chain = transforms.compose([{"name": "drift", "seed": 3, "size": 2.0}, {"name": "depth_noise", "seed": 4, "share": 0.2}, {"name": "delta_depth", "seed": 5, "scale": 0.1, "shift": 0.1}, {"name": "cast_float", "columns": ["x"]}])
    one, many = (sorted(map(tuple, chain(rows.repartition(n)).select("clip", "step", "x", "depth").collect())) for n in (1, 7))
    assert one == many
    assert all(d == 0 for _, s, _, d in one if s % 5 == 0)
    with pytest.raises(ValueError):
        transforms.register("flip")(transforms.flip)


def test_stream_state_equals_batch(spark, tmp_path):
    rows = [(c, t, s, float(c + 2 * t + s * s)) for s in range(9) for c in range(2) for t in range(3)]
    schema = "clip long, track long, step long, value double"
    for k in range(3):
        spark.createDataFrame([r for r in rows if r[2] // 3 == k], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{k}"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("latestFirst", "false").parquet(str(tmp_path / "in"))
    run = stream.track_stream(source).writeStream.format("memory").queryName("tracked").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = sorted(map(tuple, spark.table("tracked").collect()))
    assert got == sorted(map(tuple, stream.track_batch(spark.createDataFrame(rows, schema)).collect()))


def test_progress_monitor(spark, tmp_path):
    for p in ("a/1.npz", "a/2.npz", "b/1.npz", "b/x.txt"):
        (tmp_path / "out" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "out" / p).write_bytes(b"123")
    run = stream.progress(spark, str(tmp_path / "out")).writeStream.format("memory").queryName("progress").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    assert {tuple(r) for r in spark.table("progress").collect()} == {("a", 2, 6), ("b", 1, 3)}


def test_pose_encoding_round_trip(spark):
    from tracewright.operators import projection

    turns = [(0.0, 0.0, 0.0), (3.1, 0.0, 0.0), (0.0, 3.1, 0.1), (0.2, -0.1, 3.1), (0.5, -1.0, 0.7)]
    rows = spark.createDataFrame(turns, "x double, y double, z double")
    rows = rows.withColumn("q", F.array(*g.quaternion_of_rotvec(F.col("x"), F.col("y"), F.col("z")))).withColumn("m", g.matrix_of_quaternion(*(F.get("q", F.lit(k)) for k in range(4))))
    w2c = F.array(*(g.at(F.col("m"), 3 * i + j) if j < 3 else F.lit(float(i)) for i in range(3) for j in range(4)), *(F.lit(float(j == 3)) for j in range(4)))
    rows = rows.withColumns({"a": w2c, "k": g.matrix([500, 0, 320, 0, 480, 240, 0, 0, 1])})
    rows = rows.withColumn("e", g.pose_encoding(F.col("a"), F.col("k"), 640.0, 480.0))
    for r in rows.select("a", F.array(*g.pose_of_encoding(F.col("e"), 640.0, 480.0)).alias("b")).collect():
        assert np.allclose(r.a, r.b[0]) and np.allclose(r.b[1], [500, 0, 320, 0, 480, 240, 0, 0, 1])
    rng = np.random.default_rng(0)
    p = rng.normal(0, 1, (50, 3)) + [0, 0, 4]
    seen = [(0, *map(float, q), 1.7 * q[0] / (q[2] + 0.8), 1.7 * q[1] / (q[2] + 0.8)) for q in p.tolist()]
    got = projection.focal_and_shift(spark.createDataFrame(seen, "f long, x double, y double, z double, u double, v double"), ["f"]).first()
    assert got.focal == pytest.approx(1.7, abs=1e-4) and got.shift == pytest.approx(0.8, abs=1e-3)
    c = spark.createDataFrame([(k % 2, k, 0.4 if k < 15 else 0.9) for k in range(60)], "f long, id long, c double")
    assert projection.drop_uncertain(c, ["f"], "c").count() == 45 and projection.drop_uncertain(c, ["f"], "c", least=30).count() == 60


@pytest.mark.parametrize("block", [3, 1000])
def test_k_nearest_in_blocks(spark, block):
    rng = np.random.default_rng(5)
    rows = [(int(k % 2), k, [float(x) for x in rng.integers(0, 4, 3)]) for k in range(40)]
    points = spark.createDataFrame(rows, "frame int, id long, v array<double>")
    got = {(r.query, r["rank"]): (r.neighbour, r.distance) for r in matching.k_nearest(points, points, ["frame"], "id", "v", 4, block=block).collect()}
    want = {}
    for f, k, v in rows:
        near = sorted((round(float(np.linalg.norm(np.subtract(v, w))), 9), j) for g, j, w in rows if g == f and j != k)[:4]
        want |= {(k, n + 1): (j, d) for n, (d, j) in enumerate(near)}
    assert got == want


def test_random_poses_and_camera_aug(spark):
    """The walk: the identity first, rotations throughout, steps within their bounds, the same from any partitions; the points: moved by the pose of their frame."""
    frames = spark.createDataFrame([(c, s) for c in (1, 2) for s in (4, 7, 9, 9, 12)] + [(None, 0)], "clip long, step long")
    poses = lambda df: {(r.clip, r.step): np.array(r.pose).reshape(4, 4) for r in measures.random_poses(df, ["clip"], "step", 5, 0.1, 0.2).collect()}
    got = poses(frames)
    again = poses(frames.repartition(5))
    assert got.keys() == {(c, s) for c in (1, 2) for s in (4, 7, 9, 12)} | {(None, 0)} and all((got[k] == again[k]).all() for k in got)
    for c in (1, 2):
        assert (got[c, 4] == np.eye(4)).all() and not np.allclose(got[1, 7], got[2, 7])
        for a, b in ((4, 7), (7, 9), (9, 12)):
            step = np.linalg.inv(got[c, a]) @ got[c, b]
            assert np.allclose(step[:3, :3] @ step[:3, :3].T, np.eye(3)) and (abs(step[:3, 3]) <= 0.2).all() and 0 < np.arccos((np.trace(step[:3, :3]) - 1) / 2) <= 0.1 * 3**0.5
    assert not poses(frames.limit(0))
    points = spark.createDataFrame([(1, s, float(s), 1.0, 2.0, f) for s in (4, 7, 9) for f in (["local"], None, ["x"])], "clip long, step long, x double, y double, z double, flags array<string>")
    for r in measures.camera_aug(points, ["clip"], "step", 5, 0.1, 0.2).collect():
        own = np.array([r.step, 1.0, 2.0, 1.0])
        if r.flags == ["local"]:
            own = got[1, r.step] @ own if r.step == 4 else np.array(r.pose).reshape(4, 4) @ own
        else:
            assert r.pose is None
        assert np.allclose([r.x, r.y, r.z], own[:3])


def test_average_motion_with_shifts(spark):
    """Frames and their pairs planted exactly: rotations and translations relative to frame 0 come back; a lone pair and a table without pairs work too."""
    rng = np.random.default_rng(8)
    turns = [np.linalg.qr(rng.normal(size=(3, 3)))[0] for _ in range(6)]
    turns = [t * np.sign(np.linalg.det(t)) for t in turns]
    moves = rng.normal(size=(6, 3))
    rows = []
    for clip, n in ((1, 6), (2, 2)):
        for a in range(n):
            for b in range(a + 1, n):
                r = turns[b] @ turns[a].T
                rows.append((clip, a, b, r.ravel().tolist(), (moves[b] - r @ moves[a]).tolist()))
    pairs = spark.createDataFrame(rows, "clip long, i long, j long, r array<double>, t array<double>")
    got = {(x.clip, x.frame): x for x in fitting.average_motion(pairs, ["clip"], "i", "j", "r", "t").collect()}
    assert len(got) == 8
    for (_, f), x in got.items():
        assert np.allclose(np.array(x.rotation).reshape(3, 3), turns[f] @ turns[0].T, atol=1e-8)
        assert np.allclose(x.shift, moves[f] - turns[f] @ turns[0].T @ moves[0], atol=1e-8)
    assert fitting.average_motion(pairs.limit(0), ["clip"], "i", "j", "r", "t").count() == 0


def brute_covisibility(rows):
    folded, out = {}, {}
    for h, u, w in rows:
        if h is not None and u is not None:
            folded.setdefault(h, {}).setdefault(u, []).append(w)
    for seen in folded.values():
        sums = {u: sum(w for w in ws if w is not None) if any(w is not None for w in ws) else None for u, ws in seen.items()}
        for a in sums:
            for b in sums:
                if a < b:
                    out.setdefault((a, b), []).append(None if sums[a] is None or sums[b] is None else sums[a] * sums[b])
    return {k: sum(p for p in ps if p is not None) if any(p is not None for p in ps) else None for k, ps in out.items()}


def odd_views(users=30):
    rng = np.random.default_rng(4)
    rows = [(int(h), int(u), float(np.round(w, 2))) for h, u, w in zip(rng.integers(0, 12, 200), rng.integers(0, users, 200), rng.normal(3, 2, 200), strict=True)]
    return rows + [(99, 77, 1.0), (None, 3, 1.0), (2, None, 1.0), (50, 1, None), (50, 2, 4.0), (51, 1, 0.0), (51, 80, 5.0), (52, 81, 1e300), (52, 82, None), (52, 82, float("inf"))]


@pytest.mark.parametrize(("block", "entries", "strip"), [(8192, 1 << 20, 1 << 19), (5, 1 << 20, 7), (1, 1 << 20, 1), (8192, 20, 50)])
def test_covisibility_is_brute_force(spark, block, entries, strip):
    seen = spark.createDataFrame(odd_views(), "h int, u long, w double")
    got = matching.covisibility(seen, ["h"], "u", "w", block, entries, strip)
    want = brute_covisibility(odd_views())
    rows = {(r.i, r.j): r.weight for r in got.collect()}
    assert got.dtypes == [("i", "bigint"), ("j", "bigint"), ("weight", "double")] and got.count() == len(want) and rows.keys() == want.keys()
    assert all((rows[k] is None) == (want[k] is None) and (want[k] is None or np.isclose(rows[k], want[k], rtol=1e-12, atol=1e-12)) for k in want)
    named = spark.createDataFrame([(h, None if h is None else f"x{h % 3}", None if u is None else f"\u00e9{u}", w) for h, u, w in odd_views()], "h int, g string, u string, w double")
    assert {(r.i, r.j) for r in matching.covisibility(named, ["g", "h"], "u", "w", block, entries, strip).collect()} == {tuple(sorted((f"\u00e9{a}", f"\u00e9{b}"))) for a, b in want}


def test_covisibility_shuffles_no_pairs(spark):
    """400 viewers of the same 20 items: 79,800 pairs and 1,596,000 products from 8,000 rows."""
    seen = spark.range(8000).select((F.col("id") % 20).alias("h"), F.floor(F.col("id") / 20).alias("u"), F.lit(0.0).alias("w"))
    pairs = matching.covisibility(seen, ["h"], "u", "w")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and pairs.count() == 400 * 399 // 2


def test_covisibility_sends_few_bytes(spark):
    """100,000 views with weights of two decimals by 9,000 viewers (eight blocks or more): bytes that the query's tasks write for all its shuffles."""
    sc = spark.sparkContext
    seen = spark.range(100000).select((F.xxhash64("id") % 400).alias("h"), (F.col("id") % 9000).alias("u"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20000)) / 100).alias("w"))

    def written():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(sc._jvm.java.util.ArrayList(), False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return {(stages.apply(k).stageId(), stages.apply(k).attemptId()): stages.apply(k).shuffleWriteBytes() for k in range(stages.size())}

    before = written()
    matching.covisibility(seen, ["h"], "u", "w").write.format("noop").mode("overwrite").save()
    sent = sum(size for stage, size in written().items() if stage not in before)
    assert 0 < sent < 5_500_000, sent


@pytest.mark.parametrize("n", [1, 5, 60])
def test_keyframes_are_brute_force(spark, n):
    rows = [(c, h, u, w) for c in (0, 1) for h, u, w in odd_views(30 + 7 * c) if w is None or w < 1e299] + [(2, 1, 5, 1.0)]
    got = fitting.keyframes_of_views(spark.createDataFrame(rows, "clip int, h int, u long, w double"), ["clip"], ["h"], "u", "w", n)
    assert got.dtypes == [("clip", "int"), ("frame", "bigint"), ("place", "bigint")]
    for clip in (0, 1, 2):
        pairs = {k: round(w or 0.0, 6) for k, w in brute_covisibility([r[1:] for r in rows if r[0] == clip]).items()}
        frames = sorted({u for k in pairs for u in k})
        want = frames[:1]
        while frames and len(want) < min(n, len(frames)):
            want.append(min((f for f in frames if f not in want), key=lambda f: (max(pairs.get((min(f, c), max(f, c)), 0.0) for c in want), f)))
        assert [r.frame for r in got.filter(F.col("clip") == clip).orderBy("place").collect()] == want
    assert fitting.keyframes_of_views(spark.createDataFrame([], "h int, u long, w double"), [], ["h"], "u", "w", 3).count() == 0


def test_keyframes_list_no_pairs(spark):
    """3,000 viewers of one item have 4,498,500 pairs; the choice of 3 reads three rows of them."""
    seen = spark.range(3000).select(F.lit(0).alias("h"), F.col("id").alias("u"), (F.lit(1.0) + (F.col("id") % 7)).alias("w"))
    assert [r.frame for r in fitting.keyframes_of_views(seen, [], ["h"], "u", "w", 3).orderBy("place").collect()] == [0, 7, 14]
