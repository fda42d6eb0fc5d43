"""Images, masks, depth and cameras of frames as tables, and the sinks that write them back.

Images are rows of pixels; files are read with Spark's binaryFile reader. Sinks write one file a row into a folder that all executors share, whole or
not at all, so a task that runs again does no harm.
"""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.sources.arrays import decode_png, png, png16

# The camera that stands in where a clip has none (row by row), and its image size.
FALLBACK_K = (257.91296, 0.0, 259.0, 0.0, 261.4576, 161.0, 0.0, 0.0, 1.0)
FALLBACK_W2C = (1.0, 4.0706014e-05, 8.9567264e-05, 9.0881156e-05, -4.0680898e-05, 0.99999994, -2.8039535e-04, 3.5203320e-05, -8.9578680e-05, 2.8039169e-04, 0.99999994, -2.7687754e-04, 0.0, 0.0, 0.0, 1.0)
FALLBACK_SIZE = (322, 518)  # height, width


def _decoded(spark: SparkSession, path: str, glob: str, frame: Callable[[str, bytes], pd.DataFrame], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                yield frame(p, content)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, schema)


def read_rgb(spark: SparkSession, path: str) -> DataFrame:
    """(path, v, u, r, g, b) of PNG files, in 0 to 1; grey images have three equal channels, an alpha channel is left out."""

    def frame(p: str, content: bytes) -> pd.DataFrame:
        image = decode_png(content)
        image = image[..., None] if image.ndim == 2 else image
        colour = image[..., :3] if image.shape[-1] >= 3 else np.repeat(image[..., :1], 3, axis=2)
        v, u = np.indices(image.shape[:2]).reshape(2, -1)
        unit = colour.reshape(-1, 3) / (255.0 if image.dtype == np.uint8 else 65535.0)
        return pd.DataFrame({"path": p, "v": v, "u": u, "r": unit[:, 0], "g": unit[:, 1], "b": unit[:, 2]})

    return _decoded(spark, path, "*.png", frame, "path string, v long, u long, r double, g double, b double")


def read_masks(spark: SparkSession, path: str, size: tuple[int, int]) -> DataFrame:
    """(path, v, u) of the set pixels of PNG masks, brought to (height, width) by the nearest pixel."""
    height, width = size

    def frame(p: str, content: bytes) -> pd.DataFrame:
        image = decode_png(content)
        mask = (image if image.ndim == 2 else image.max(axis=2)) > 0
        rows, columns = np.arange(height) * mask.shape[0] // height, np.arange(width) * mask.shape[1] // width
        v, u = np.nonzero(mask[rows][:, columns])
        return pd.DataFrame({"path": p, "v": v, "u": u})

    return _decoded(spark, path, "*.png", frame, "path string, v long, u long")


def read_raw_depth(spark: SparkSession, path: str) -> DataFrame:
    """(path, v, u, depth) of the `depth` member of raw NPZ files; a file without it gives one row with null places."""

    def frame(p: str, content: bytes) -> pd.DataFrame:
        with np.load(io.BytesIO(content), allow_pickle=False) as z:
            if "depth" not in z.files:
                return pd.DataFrame({"path": [p], "v": [None], "u": [None], "depth": [None]}, dtype=object)
            depth = z["depth"]
        v, u = np.indices(depth.shape).reshape(2, -1)
        return pd.DataFrame({"path": p, "v": v, "u": u, "depth": depth.ravel().astype(float)})

    return _decoded(spark, path, "*_raw.npz", frame, "path string, v long, u long, depth double")


def thinned(pixels: DataFrame, factor: int, u: str = "u", v: str = "v") -> DataFrame:
    """Every factor-th row and column, renumbered."""
    return pixels.filter((F.col(u) % factor == 0) & (F.col(v) % factor == 0)).withColumns({u: F.floor(F.col(u) / factor), v: F.floor(F.col(v) / factor)})


def with_cameras(frames: DataFrame, cameras: DataFrame, key: Sequence[str]) -> DataFrame:
    """Frames with the camera (k, w2c, height, width) of their key, or the fixed one where there is none."""
    given = frames.join(cameras.select(*key, "k", "w2c", "height", "width"), list(key), "left")
    numbers = lambda values: F.array(*(F.lit(float(x)) for x in values))
    other = {"k": numbers(FALLBACK_K), "w2c": numbers(FALLBACK_W2C), "height": F.lit(FALLBACK_SIZE[0]), "width": F.lit(FALLBACK_SIZE[1])}
    return given.withColumns({c: F.coalesce(F.col(c), x) for c, x in other.items()})


def dense_frames(queries: DataFrame, depth: DataFrame, cameras: DataFrame, key: Sequence[str]) -> DataFrame:
    """For each query frame its depth pixels with the frame's camera; a query whose depth or camera is missing gives one row with nulls."""
    whole = depth.join(cameras.select(*key, "k", "w2c"), list(key))
    return queries.join(whole, list(key), "left")


def checked_instances(images: DataFrame, depth: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """One row per image with depth and meta joined by path; depth that is NaN or infinite becomes null with its kind told, and an image that lacks a part is marked invalid in place of failing."""
    both = images.join(depth, key, "left").join(meta, key, "left")
    kind = F.when(F.isnan("depth"), "nan").when(F.abs("depth") == F.lit(float("inf")), "inf")
    parts = [c for c in (*depth.columns, *meta.columns) if c != key]
    return both.withColumn("fault", kind).withColumn("depth", F.when(kind.isNull(), F.col("depth"))).withColumn("valid", F.lit(True) if not parts else ~F.exists(F.array(*(F.col(c).isNull() & (F.lit(c) != "depth") for c in parts)), lambda x: x))


def search(rows: DataFrame, path: str, value: str, pattern: str) -> DataFrame:
    """Rows whose path or value has the pattern, in any case; with flattened records or listings this is the recursive search."""
    return rows.filter(F.col(path).rlike(f"(?i){pattern}") | F.coalesce(F.col(value).rlike(f"(?i){pattern}"), F.lit(False)))


def write_files(rows: DataFrame, folder: str, name: str, content: str, only_absent: bool = False) -> None:
    """A file per row, named by a column, from a column of bytes; with only_absent files that exist are left."""

    def run(part) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in part:
            target = os.path.join(folder, row[name])
            if only_absent and os.path.exists(target):
                continue
            temporary = os.path.join(folder, f".{row[name]}.{os.getpid()}")
            with open(temporary, "wb") as f:
                f.write(row[content])
            os.replace(temporary, target)

    rows.select(name, content).foreachPartition(run)


def _images(pixels: DataFrame, key: str, values: Sequence[str], encode: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(key, content): the pixels (v, u, values) of each key as one encoded image; a frame is a unit of work."""
    names = list(values)

    def build(p: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((int(p["v"].max()) + 1, int(p["u"].max()) + 1, len(names)))
        image[p["v"], p["u"]] = p[names].to_numpy(float)
        return pd.DataFrame({key: [p[key].iat[0]], "content": [encode(image)]})

    return pixels.select(key, "v", "u", *names).groupBy(key).applyInPandas(build, f"`{key}` {pixels.schema[key].dataType.simpleString()}, content binary")


def rgb_images(pixels: DataFrame, key: str) -> DataFrame:
    """PNG files from pixels (v, u, r, g, b) in 0 to 1; write them with write_files(only_absent=True)."""
    return _images(pixels, key, "rgb", lambda x: png((x * 255).round().clip(0, 255).astype(np.uint8)))


def depth_images(pixels: DataFrame, key: str, value: str = "stretched") -> DataFrame:
    """16-bit PNG files from pixels (v, u, value), the value as depth.stretch_uint16 gives it."""
    return _images(pixels, key, [value], lambda x: png16(x[..., 0]))


def raw_depth_files(pixels: DataFrame, key: str, value: str = "depth") -> DataFrame:
    """NPZ files with the member `depth`."""

    def encode(x: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, depth=x[..., 0].astype(np.float32))
        return out.getvalue()

    return _images(pixels, key, [value], encode)


def copy_tree(spark: SparkSession, source: str, target: str, names: Sequence[str] | None = None) -> list[str]:
    """Files or folders below source copied below target through the file system of each path, a destination that exists replaced; absent names are passed over. All entries without names."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    here, there = path(source), path(target)
    a, b = here.getFileSystem(conf), there.getFileSystem(conf)
    b.mkdirs(there)
    done = []
    for name in names if names is not None else sorted(s.getPath().getName() for s in a.listStatus(here)):
        one, to = path(here, name), path(there, name)
        if a.exists(one):
            b.delete(to, True)
            jvm.org.apache.hadoop.fs.FileUtil.copy(a, one, b, to, False, True, conf)
            done.append(name)
    return done

