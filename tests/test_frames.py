"""Images, masks, depth and cameras as tables and back."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.operators import depth as depth_operators
from tracewright.sources import arrays, frames


@pytest.fixture()
def image():
    return np.random.default_rng(1).integers(0, 256, (6, 9, 3)).astype(np.uint8)


def test_rgb_round_trip(spark, tmp_path, image):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.png").write_bytes(arrays.png(image))
    rows = frames.read_rgb(spark, str(tmp_path / "a"))
    assert rows.count() == 54
    out = str(tmp_path / "out")
    files = frames.rgb_images(rows.withColumn("name", F.lit("y.png")), "name")
    frames.write_files(files, out, "name", "content", only_absent=True)
    assert (arrays.decode_png((tmp_path / "out" / "y.png").read_bytes()) == image).all()
    (tmp_path / "out" / "y.png").write_bytes(b"kept")
    frames.write_files(files, out, "name", "content", only_absent=True)
    assert (tmp_path / "out" / "y.png").read_bytes() == b"kept" and os.listdir(out) == ["y.png"]


def test_masks_by_the_nearest_pixel(spark, tmp_path):
    mask = np.zeros((4, 4), np.uint16)
    mask[0, 0] = mask[3, 2] = 7
    (tmp_path / "m.png").write_bytes(arrays.png16(mask))
    got = {(r.v, r.u) for r in frames.read_masks(spark, str(tmp_path), (8, 2)).collect()}
    assert got == {(v, u) for v in range(8) for u in range(2) if mask[v * 4 // 8, u * 4 // 2]}


def test_depth_files(spark, tmp_path):
    rows = spark.createDataFrame([("f", v, u, float(v * 3 + u)) for v in range(2) for u in range(3)], "name string, v long, u long, depth double")
    frames.write_files(frames.raw_depth_files(rows, "name").withColumn("name", F.concat("name", F.lit("_raw.npz"))), str(tmp_path), "name", "content")
    got = {(r.v, r.u): r.depth for r in frames.read_raw_depth(spark, str(tmp_path)).collect()}
    assert got == {(v, u): float(v * 3 + u) for v in range(2) for u in range(3)}
    np.savez(tmp_path / "bad_raw.npz", other=np.zeros(2))
    assert frames.read_raw_depth(spark, str(tmp_path)).filter("v IS NULL").count() == 1
    stretched = depth_operators.stretch_uint16(rows, ["name"], "depth")
    frames.write_files(frames.depth_images(stretched, "name").withColumn("name", F.lit("d.png")), str(tmp_path), "name", "content")
    want = {(r.v, r.u): r.stretched for r in stretched.collect()}
    read = arrays.decode_png((tmp_path / "d.png").read_bytes())
    assert {(v, u): int(read[v, u]) for v in range(2) for u in range(3)} == want
    assert {(r.v, r.u) for r in frames.thinned(rows, 2).collect()} == {(0, 0), (0, 1)}


def test_cameras(spark):
    queries = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "clip string, frame long")
    cameras = spark.createDataFrame([("a", 0, [1.0] * 9, [2.0] * 16, 10, 20)], "clip string, frame long, k array<double>, w2c array<double>, height int, width int")
    got = {(r.clip, r.frame): (r.k[0], r.height) for r in frames.with_cameras(queries, cameras, ["clip", "frame"]).collect()}
    assert got == {("a", 0): (1.0, 10), ("a", 1): (257.91296, 322), ("b", 0): (257.91296, 322)}
    depth = spark.createDataFrame([("a", 0, 0, 0, 1.5), ("a", 0, 0, 1, 2.5), ("b", 0, 0, 0, 3.5)], "clip string, frame long, v long, u long, depth double")
    rows = frames.dense_frames(queries, depth, cameras, ["clip", "frame"]).collect()
    assert sorted((r.clip, r.frame, r.depth) for r in rows if r.depth is not None) == [("a", 0, 1.5), ("a", 0, 2.5)]
    assert {(r.clip, r.frame) for r in rows if r.depth is None} == {("a", 1), ("b", 0)}


def test_instances(spark):
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    depth = spark.createDataFrame([("a", 1.0), ("b", float("nan"))], "path string, depth double")
    meta = spark.createDataFrame([("a", "k"), ("b", "k")], "path string, camera string")
    got = {r.path: (r.valid, r.fault, r.depth) for r in frames.checked_instances(images, depth, meta, "path").collect()}
    assert got == {"a": (True, None, 1.0), "b": (True, "nan", None), "c": (False, None, None)}


def test_search(spark):
    rows = spark.createDataFrame([("x/robot.URDF", None), ("a.b", "see wx250.urdf"), ("c", "no")], "path string, value string")
    assert {r.path for r in frames.search(rows, "path", "value", r"urdf").collect()} == {"x/robot.URDF", "a.b"}


def test_copies(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "f").write_text(name)
    (tmp_path / "in" / "meta.json").write_text("{}")
    (tmp_path / "out" / "one").mkdir(parents=True)
    (tmp_path / "out" / "one" / "old").write_text("gone")
    assert frames.copy_tree(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["one", "meta.json", "absent"]) == ["one", "meta.json"]
    assert sorted(x for x in os.listdir(tmp_path / "out" / "one") if not x.startswith(".")) == ["f"]
    assert frames.copy_tree(spark, str(tmp_path / "in"), str(tmp_path / "all")) == ["meta.json", "one", "two"]


@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4])
def test_every_filter_of_png(kind):
    """Lines written under each filter, by its definition."""
    import struct
    import zlib

    image = np.random.default_rng(kind).integers(0, 256, (5, 7, 3))
    flat = image.reshape(5, 21)
    body = b""
    for y in range(5):
        line = bytearray()
        for x in range(21):
            a, b, c = (flat[y, x - 3] if x >= 3 else 0), (flat[y - 1, x] if y else 0), (flat[y - 1, x - 3] if y and x >= 3 else 0)
            p = a + b - c
            paeth = min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]
            line.append(int(flat[y, x] - (0, a, b, (a + b) // 2, paeth)[kind]) & 255)
        body += bytes([kind]) + bytes(line)
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    packed = zlib.compress(body)
    content = arrays.PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", 7, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", packed[:9]) + chunk(b"IDAT", packed[9:]) + chunk(b"IEND", b"")
    assert (arrays.decode_png(content) == image).all()
