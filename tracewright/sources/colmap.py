"""Camera models, images and points of structure-from-motion projects, in their text and binary forms (a public format)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Model numbers, names and numbers of parameters.
MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8), 5: ("OPENCV_FISHEYE", 8), 6: ("FULL_OPENCV", 12), 7: ("FOV", 5), 8: ("SIMPLE_RADIAL_FISHEYE", 4), 9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12)}

CAMERAS = "camera_id long, model string, width long, height long, params array<double>"
IMAGES = "image_id long, qvec array<double>, tvec array<double>, camera_id long, name string, xys array<array<double>>, point_ids array<long>"
POINTS = "point_id long, xyz array<double>, rgb array<int>, error double, image_ids array<long>, places array<long>"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(~F.col("value").startswith("#"))


def read_cameras_text(spark: SparkSession, path: str) -> DataFrame:
    """S21."""
    p = F.split(F.trim("value"), r"\s+")
    rows = _lines(spark, path).filter(F.trim("value") != "")
    return rows.select(p[0].cast("long").alias("camera_id"), p[1].alias("model"), p[2].cast("long").alias("width"), p[3].cast("long").alias("height"), F.slice(p, F.lit(5), F.size(p)).cast("array<double>").alias("params"))


def read_points_text(spark: SparkSession, path: str) -> DataFrame:
    """S21."""
    p = F.split(F.trim("value"), r"\s+")
    pairs = F.slice(p, F.lit(9), F.size(p)).cast("array<long>")
    every = lambda odd: F.filter(pairs, lambda _, i: i % 2 == odd)
    rows = _lines(spark, path).filter(F.trim("value") != "")
    return rows.select(p[0].cast("long").alias("point_id"), F.slice(p, 2, 3).cast("array<double>").alias("xyz"), F.slice(p, 5, 3).cast("array<int>").alias("rgb"), p[7].cast("double").alias("error"), every(0).alias("image_ids"), every(1).alias("places"))


def read_images_text(spark: SparkSession, path: str) -> DataFrame:
    """An image has two lines, so a file is read whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["value"]:
                lines = [x for x in text.split("\n") if not x.startswith("#")]
                for head, points in zip(lines[::2], [*lines[1::2], ""], strict=False):
                    if not head.strip():
                        continue
                    h, p = head.split(), points.split()
                    rows.append((int(h[0]), list(map(float, h[1:5])), list(map(float, h[5:8])), int(h[8]), h[9], [[float(a), float(b)] for a, b in zip(p[::3], p[1::3], strict=True)], list(map(int, p[2::3]))))
            yield pd.DataFrame(rows, columns=["image_id", "qvec", "tvec", "camera_id", "name", "xys", "point_ids"])

    return spark.read.text(path, wholetext=True).mapInPandas(run, IMAGES)


class Bytes:
    def __init__(self, content: bytes):
        self.content, self.at = content, 0

    def take(self, kinds: str) -> tuple:
        out = struct.unpack_from("<" + kinds, self.content, self.at)
        self.at += struct.calcsize("<" + kinds)
        return out

    def word(self) -> str:
        end = self.content.index(b"\0", self.at)
        out = self.content[self.at : end].decode()
        self.at = end + 1
        return out


def _cameras(b: Bytes) -> list[tuple]:
    rows = []
    for _ in range(b.take("Q")[0]):
        camera, model, width, height = b.take("iiQQ")
        name, n = MODELS[model]
        rows.append((camera, name, width, height, list(b.take("d" * n))))
    return rows


def _images(b: Bytes) -> list[tuple]:
    rows = []
    for _ in range(b.take("Q")[0]):
        image, *pose, camera = b.take("idddddddi")
        name = b.word()
        flat = b.take("ddq" * b.take("Q")[0])
        rows.append((image, pose[:4], pose[4:], camera, name, [[x, y] for x, y in zip(flat[::3], flat[1::3], strict=True)], list(flat[2::3])))
    return rows


def _points(b: Bytes) -> list[tuple]:
    rows = []
    for _ in range(b.take("Q")[0]):
        point, x, y, z, red, green, blue, error = b.take("QdddBBBd")
        flat = b.take("ii" * b.take("Q")[0])
        rows.append((point, [x, y, z], [red, green, blue], error, list(flat[::2]), list(flat[1::2])))
    return rows


def _binary(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield pd.DataFrame(parse(Bytes(content)), columns=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def read_cameras_binary(spark: SparkSession, path: str) -> DataFrame:
    """S22."""
    return _binary(spark, path, _cameras, CAMERAS)


def read_images_binary(spark: SparkSession, path: str) -> DataFrame:
    """S22."""
    return _binary(spark, path, _images, IMAGES)


def read_points_binary(spark: SparkSession, path: str) -> DataFrame:
    """S22."""
    return _binary(spark, path, _points, POINTS)


def pinhole(cameras: DataFrame) -> DataFrame:
    """Focal lengths and principal points; models with distortion raise."""
    p = F.col("params")
    simple = F.col("model") == "SIMPLE_PINHOLE"
    known = F.when(simple | (F.col("model") == "PINHOLE"), True).otherwise(F.raise_error(F.concat(F.lit("camera model not supported: "), F.col("model"))).cast("boolean"))
    k = F.when(simple, F.struct(p[0].alias("fx"), p[0].alias("fy"), p[1].alias("cx"), p[2].alias("cy"))).otherwise(F.struct(p[0].alias("fx"), p[1].alias("fy"), p[2].alias("cx"), F.get(p, F.lit(3)).alias("cy")))
    return cameras.filter(known).select("camera_id", "width", "height", k.alias("k")).select("camera_id", "width", "height", "k.*")
