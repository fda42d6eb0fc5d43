import json
import os
import pickle
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.sources import arrays, colmap, listing, tables


def touch(root, *paths):
    for p in paths:
        full = os.path.join(root, p)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(b"x")


def listed(spark, *paths):
    return spark.createDataFrame([(p, p, 1, k) for k, p in enumerate(paths)], "path string, relative string, length long, modified long")


def test_listing_of_a_folder(spark, tmp_path):
    touch(tmp_path, "a/images/im_2.png", "a/images/im_10.png", "a/samples/a_0.npz", "b/notes.txt")
    files = listing.list_files(spark, str(tmp_path))
    assert sorted(r.relative for r in files.collect()) == ["a/images/im_10.png", "a/images/im_2.png", "a/samples/a_0.npz", "b/notes.txt"]
    assert [tuple(r) for r in listing.list_cases(files).collect()] == [("a", 2, 1), ("b", 0, 0)]
    frames = listing.list_frames(files, F.lit("a")).orderBy("pos").collect()
    assert [r.relative for r in frames] == ["a/images/im_2.png", "a/images/im_10.png"]


def test_clips_by_depth(spark):
    files = listed(spark, "x/1.png", "x/y/1.png", "x/y/v.mp4", "v.mp4", "x/y/z/1.jpg", "x/t.txt")
    assert sorted(r.clip for r in listing.scan_clips(files, 1).collect()) == ["v.mp4", "x"]
    assert sorted(r.clip for r in listing.scan_clips(files, 2).collect()) == ["x/y"]


def test_trajectory_layouts(spark):
    files = listed(
        spark,
        "t1/cam0/images0/1.png", "t1/cam0/depth_images0/1.png",
        "t2/images0/1.png", "t2/depth_images0/1.png",
        "t3/cam0/images0/.keep", "t3/images0/1.png", "t3/depth_images0/1.png",  # an empty cam0/images0: no way back to images0
        "t4/images0/1.png",
    )
    assert {tuple(r) for r in listing.scan_trajectories(files).collect()} == {("t1", "cam0/images0"), ("t2", "images0")}


def test_cameras_episodes_snapshots(spark):
    files = listed(spark, "t/images2/1.png", "t/depth_images2/1.png", "t/images0/1.png", "u/images7/1.png", "u/depth_images7/1.png")
    assert [tuple(r) for r in listing.scan_cameras(files).collect()] == [("t", 2)]
    files = listed(spark, "rgb/1.png", "e1/rgb/1.png", "e2/other/1.png")
    assert sorted(r.episode for r in listing.scan_episodes(files, "rgb").collect()) == ["", "e1"]
    files = listed(spark, "m/snapshots/old/a", "m/snapshots/new/a", "m/snapshots/new/b")
    assert [tuple(r) for r in listing.newest_snapshot(files).collect()] == [("m", "new", 2, 2)]


def test_natural_order_puts_last_last(spark):
    files = listed(spark, "f/a10.png", "f/a2.png", "f/a1_last.png", "f/b.png")
    got = [r.relative for r in listing.list_images(files, F.lit("f")).orderBy("pos").collect()]
    assert got == ["f/a2.png", "f/a10.png", "f/b.png", "f/a1_last.png"]


def test_npz_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s_0", [[1.0, 2.0]], [[[0.5, 1.0, 2.0]]], [True, False])], "name string, keypoints array<array<float>>, traj array<array<array<float>>>, valid_steps array<boolean>")
    rows = rows.withColumn("traj", F.transform("traj", lambda t: arrays.padded_trace(t.cast("array<array<double>>"), 2, 3)))
    arrays.write_npz(rows, str(tmp_path / "out"), "name", {"keypoints": "f4", "traj": "f4", "valid_steps": "?"})
    back = arrays.read_npz(spark, str(tmp_path / "out"), arrays.SAMPLE)
    one = back.collect()[0]
    assert one.keypoints == [[1.0, 2.0]] and one.valid_steps == [True, False] and one.traj_2d is None
    assert one.traj[0][1] == [float("-inf")] * 3
    assert [tuple(r) for r in arrays.long_tracks(back, ["path"]).select("track", "step", "x", "y", "z").collect()] == [(0, 0, 0.5, 1.0, 2.0)]


def test_depth_png(spark, tmp_path):
    d = np.array([[0, 1500], [65535, 1]], dtype=np.uint16)
    (tmp_path / "d.png").write_bytes(arrays.png16(d))
    assert (arrays.decode_png(arrays.png16(d)) == d).all()
    got = {(r.v, r.u): r.depth for r in arrays.read_depth(spark, str(tmp_path)).collect()}
    assert got == {(0, 1): 1.5, (1, 0): 65.535, (1, 1): 0.001}
    with pytest.raises(ValueError):
        arrays.decode_png(b"GIF89a")


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    import zlib

    rng = np.random.default_rng(kind)
    pixels = rng.integers(0, 256, (5, 4, 3)).astype(np.int64)
    stride, unit, raw = 12, 3, b""
    flat = pixels.reshape(5, stride)
    for y in range(5):
        line = []
        for i in range(stride):
            left, up = flat[y, i - unit] if i >= unit else 0, flat[y - 1, i] if y else 0
            corner = flat[y - 1, i - unit] if y and i >= unit else 0
            p = left + up - corner
            near = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            line.append((flat[y, i] - (0, left, up, (left + up) // 2, near)[kind]) % 256)
        raw += bytes([kind]) + bytes(int(v) for v in line)
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    png = arrays.PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    assert (arrays.decode_png(png) == pixels).all()


def test_policy_and_profile(spark, tmp_path):
    good = [{"actions": np.arange(7.0), "new_robot_transform": np.eye(4), "delta_robot_transform": np.eye(4)}, {"actions": [1.0] * 7}]
    for name, value in {"good": good, "none": [], "evil": os.path.join}.items():
        (tmp_path / f"{name}.pkl").write_bytes(pickle.dumps(value))
    rows = arrays.read_policy(spark, str(tmp_path)).collect()
    by = {}
    for r in rows:
        by.setdefault(os.path.basename(r.path), []).append(r)
    assert [r.actions for r in by["good.pkl"]] == [list(map(float, range(7))), [1.0] * 7] and by["good.pkl"][1].new_tf is None
    assert by["none.pkl"][0].error == "empty" and "not allowed" in by["evil.pkl"][0].error
    assert arrays.profile_record({"a": {"b": np.array([1, 3])}, "c": 2}) == [("a.b", "ndarray", "(2,)", "int64", 1.0, 3.0), ("c", "int", "", "", 2.0, 2.0)]


CAMERAS = "# header\n1 PINHOLE 640 480 500 480 320 240\n2 SIMPLE_PINHOLE 320 240 250 160 120\n"
IMAGES = "# header\n1 1 0 0 0 0.5 0 0 1 a.png\n1.5 2.5 7 3.5 4.5 -1\n2 1 0 0 0 0 0 1 2 b.png\n\n"
POINTS = "7 0.1 0.2 0.3 10 20 30 0.5 1 0 2 4\n"


def test_colmap_text_and_binary_agree(spark, tmp_path):
    for name, text in {"cameras": CAMERAS, "images": IMAGES, "points3D": POINTS}.items():
        (tmp_path / f"{name}.txt").write_text(text)
    pack = lambda kinds, *v: struct.pack("<" + kinds, *v)
    (tmp_path / "cameras.bin").write_bytes(pack("Q", 2) + pack("iiQQdddd", 1, 1, 640, 480, 500, 480, 320, 240) + pack("iiQQddd", 2, 0, 320, 240, 250, 160, 120))
    (tmp_path / "images.bin").write_bytes(pack("Q", 2) + pack("idddddddi", 1, 1, 0, 0, 0, 0.5, 0, 0, 1) + b"a.png\0" + pack("Qddqddq", 2, 1.5, 2.5, 7, 3.5, 4.5, -1) + pack("idddddddi", 2, 1, 0, 0, 0, 0, 0, 1, 2) + b"b.png\0" + pack("Q", 0))
    (tmp_path / "points3D.bin").write_bytes(pack("Q", 1) + pack("QdddBBBd", 7, 0.1, 0.2, 0.3, 10, 20, 30, 0.5) + pack("Qiiii", 2, 1, 0, 2, 4))
    for text, binary, name in ((colmap.read_cameras_text, colmap.read_cameras_binary, "cameras"), (colmap.read_images_text, colmap.read_images_binary, "images"), (colmap.read_points_text, colmap.read_points_binary, "points3D")):
        a, b = (sorted(map(tuple, f(spark, str(tmp_path / f"{name}.{end}")).collect())) for f, end in ((text, "txt"), (binary, "bin")))
        assert a == b and a
    k = {r.camera_id: (r.fx, r.fy, r.cx, r.cy) for r in colmap.pinhole(colmap.read_cameras_text(spark, str(tmp_path / "cameras.txt"))).collect()}
    assert k == {1: (500, 480, 320, 240), 2: (250, 250, 160, 120)}
    with pytest.raises(Exception, match="not supported"):
        colmap.pinhole(spark.createDataFrame([(1, "OPENCV", 1, 1, [1.0] * 8)], colmap.CAMERAS)).collect()


def test_line_files(spark, tmp_path):
    (tmp_path / "lang.txt").write_text("pick up the cup\nconfidence: 0.75\n")
    (tmp_path / "one.txt").write_text("open it\n")
    got = {os.path.basename(r.path): (r.text, r.confidence) for r in tables.read_instructions(spark, str(tmp_path / "*.txt")).collect()}
    assert got == {"lang.txt": ("pick up the cup", 0.75), "one.txt": ("open it", None)}
    (tmp_path / "run.log").write_text("traj 1 success\ntraj 2 failed: CUDA out of memory\nSSL error\n")
    r = tables.read_log(spark, str(tmp_path / "run.log")).agg(*(F.count_if(n).alias(n) for n in tables.LOG_CLASSES)).first()
    assert (r.succeeded, r.failed, r.cuda, r.ssl) == (1, 2, 1, 1)
    (tmp_path / "r.json").write_text(json.dumps([{"a": 1}, {"a": 2, "b": "x"}]))
    assert sorted(map(tuple, tables.read_records(spark, str(tmp_path / "r.json"), "a long, b string").collect()), key=str) == [(1, None), (2, "x")]
    tables.write_lines(spark.range(3), str(tmp_path / "lines"))
    assert tables.read_lines(spark, str(tmp_path / "lines"), "id long").count() == 3
    tables.write_id_list(spark.createDataFrame([("b",), ("a",), ("b",)], "id string"), str(tmp_path / "ids"))
    assert [r.value for r in spark.read.text(str(tmp_path / "ids")).collect()] == ["a", "b"]
    (tmp_path / ".index.txt").write_text("x/1\nx/2\n\n")
    assert tables.read_index(spark, {str(tmp_path): 2.0}).count() == 2
    told = json.loads(tables.report({"grid": "80"}, spark.range(1).select(F.lit(3).alias("total"))).first().report)
    assert told == {"config": {"grid": "80"}, "execution": {"total": 3}}
