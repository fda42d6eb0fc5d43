"""Binary arrays: NPZ samples, 16-bit depth PNG, pickled records of plain values.

Files are read with Spark's binaryFile reader and decoded in Arrow batches, so any store that Spark reads will do. Decoders use the standard library
and numpy alone.
"""

from __future__ import annotations

import io
import os
import pickle
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of a sample file and their Spark types; a key that a file lacks is null.
SAMPLE = {"image_path": "array<string>", "frame_index": "array<bigint>", "keypoints": "array<array<float>>", "traj_2d": "array<array<array<float>>>", "traj": "array<array<array<float>>>", "valid_steps": "array<boolean>"}
EPISODE = {"coords": "array<array<array<float>>>", "extrinsics": "array<array<array<double>>>", "intrinsics": "array<array<array<double>>>", "height": "bigint", "width": "bigint", "depths": "array<array<array<float>>>", "visibs": "array<array<array<boolean>>>"}
PNG = b"\x89PNG\r\n\x1a\n"


def read_npz(spark: SparkSession, path: str, keys: dict[str, str]) -> DataFrame:
    """(path, key columns) of NPZ files; only the members of the keys are decoded."""
    kinds = {k: t for k, t in keys.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p, content in zip(batch["path"], batch["content"], strict=True):
                row = {"path": p}
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    for k, kind in kinds.items():
                        row[k] = None if k not in z.files else z[k].tolist()
                        if row[k] is not None and kind.startswith("array") and not isinstance(row[k], list):
                            row[k] = [row[k]]
                rows.append(row)
            yield pd.DataFrame(rows, columns=["path", *kinds], dtype=object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, " + ", ".join(f"{k} {t}" for k, t in kinds.items()))


def write_npz(rows: DataFrame, folder: str, name: str, arrays: dict[str, str]) -> None:
    """A file per row, named by a column; arrays gives the columns' numpy types. The folder must be one that all executors share."""
    kinds = dict(arrays)

    def run(part) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in part:
            values = {k: np.array(row[k], dtype=t) for k, t in kinds.items() if row[k] is not None}
            temporary = os.path.join(folder, f".{row[name]}.{os.getpid()}.npz")
            np.savez(temporary, **values)
            os.replace(temporary, os.path.join(folder, f"{row[name]}.npz"))  # a task that runs again replaces the file whole

    rows.select(name, *kinds).foreachPartition(run)


def padded_trace(points: Column, steps: int, dims: int) -> Column:
    """a track's points followed by -inf up to the length of the array."""
    return F.concat(points, F.array_repeat(F.array_repeat(F.lit(float("-inf")), dims), F.greatest(F.lit(0), F.lit(steps) - F.size(points))))


def _png(lines: bytes, height: int, width: int, bits: int, colour: int) -> bytes:
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def png16(depth: np.ndarray) -> bytes:
    """A grey 16-bit PNG."""
    return _png(b"".join(b"\0" + row.astype(">u2").tobytes() for row in depth), *depth.shape, 16, 0)


def png(image: np.ndarray) -> bytes:
    """An 8-bit RGB PNG."""
    return _png(b"".join(b"\0" + row.tobytes() for row in image), *image.shape[:2], 8, 2)


def _unfiltered(raw: bytes, height: int, stride: int, unit: int) -> np.ndarray:
    out = np.zeros((height + 1, stride + unit), np.int64)  # a line above and a pixel to the left of zeros
    for y in range(height):
        kind, line = raw[y * (stride + 1)], np.frombuffer(raw, np.uint8, stride, y * (stride + 1) + 1)
        above, now = out[y], out[y + 1]
        if kind in (0, 2):
            now[unit:] = line if kind == 0 else (line + above[unit:]) & 255
            continue
        if kind == 1:  # sums along the line, a byte of the pixel at a time
            now[unit:] = (np.cumsum(line.reshape(-1, unit).astype(np.int64), axis=0) & 255).ravel()
            continue
        for x in range(stride):
            left, up, corner = int(now[x]), int(above[x + unit]), int(above[x])
            if kind == 3:
                guess = (left + up) // 2
            else:
                p = left + up - corner
                a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                guess = left if a <= b and a <= c else up if b <= c else corner
            now[x + unit] = (int(line[x]) + guess) & 255
    return out[1:, unit:].astype(np.uint8)


def decode_png(content: bytes) -> np.ndarray:
    """(H, W) or (H, W, channels) of a PNG of 8 or 16 bits, grey, RGB or with alpha, not interlaced."""
    if not content.startswith(PNG):
        raise ValueError("not a PNG")
    at, data, head = len(PNG), [], b""
    while at < len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = body
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    width, height, bits, colour, _, _, interlaced = struct.unpack(">IIBBBBB", head)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if bits not in (8, 16) or channels is None or interlaced:
        raise ValueError(f"PNG of {bits} bits, colour type {colour}, interlace {interlaced} is not read")
    unit = channels * bits // 8
    flat = _unfiltered(zlib.decompress(b"".join(data)), height, width * unit, unit)
    pixels = flat.reshape(-1).view(">u2").astype(np.uint16) if bits == 16 else flat.reshape(-1)
    return pixels.reshape((height, width) if channels == 1 else (height, width, channels))


def read_depth(spark: SparkSession, path: str, unit: float = 0.001) -> DataFrame:
    """(path, v, u, depth) of depth PNG files, in metres; invalid pixels (0) are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                d = decode_png(content).astype(np.float64) * unit
                v, u = np.nonzero(d > 0)
                yield pd.DataFrame({"path": p, "v": v, "u": u, "depth": d[v, u]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, v long, u long, depth double")


def raw_depth_path(path: Column) -> Column:
    """The file of raw depth beside a depth image; images themselves are stretched and not read back."""
    return F.when(path.endswith("_raw.npz"), path).when(path.endswith(".png"), F.regexp_replace(path, r"\.png$", "_raw.npz"))


class PlainUnpickler(pickle.Unpickler):
    """Builtin containers and numpy arrays only; any other class is refused."""

    ALLOWED = frozenset({("numpy", "ndarray"), ("numpy", "dtype"), ("numpy.core.multiarray", "_reconstruct"), ("numpy._core.multiarray", "_reconstruct"), ("numpy.core.multiarray", "scalar"), ("numpy._core.multiarray", "scalar"), ("numpy._core.numeric", "_frombuffer"), ("numpy.core.numeric", "_frombuffer"), ("collections", "OrderedDict")})

    def find_class(self, module: str, name: str):
        if (module, name) in self.ALLOWED:
            return super().find_class(module, name)
        raise pickle.UnpicklingError(f"{module}.{name} is not allowed")


def read_policy(spark: SparkSession, path: str) -> DataFrame:
    """(path, frame, actions, new_tf, delta_tf, error) of pickled lists of records; a file that can't be read gives one row with the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    for k, one in enumerate(PlainUnpickler(io.BytesIO(content)).load()):
                        flat = lambda name, one=one: np.asarray(one[name], float).ravel().tolist() if name in one else None
                        rows.append((p, k, flat("actions"), flat("new_robot_transform"), flat("delta_robot_transform"), None))
                    if not rows:
                        rows.append((p, None, None, None, None, "empty"))
                except Exception as e:  # a bad file becomes a row of issues
                    rows = [(p, None, None, None, None, str(e)[:200])]
                yield pd.DataFrame(rows, columns=["path", "frame", "actions", "new_tf", "delta_tf", "error"], dtype=object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pkl").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, frame long, actions array<double>, new_tf array<double>, delta_tf array<double>, error string")


def profile_record(value: object, name: str = "") -> list[tuple[str, str, str, str, float | None, float | None]]:
    """(key, type, shape, dtype, min, max) of everything in a nested record."""
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in profile_record(v, f"{name}.{k}" if name else str(k))]
    if isinstance(value, np.ndarray) and value.dtype.kind in "biuf":
        return [(name, "ndarray", str(value.shape), str(value.dtype), float(value.min()) if value.size else None, float(value.max()) if value.size else None)]
    if isinstance(value, (list, tuple)):
        return [(name, type(value).__name__, str((len(value),)), "", None, None)]
    number = float(value) if isinstance(value, (int, float)) else None
    return [(name, type(value).__name__, "", "", number, number)]


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Structure of pickled observations."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *x) for p, content in zip(batch["path"], batch["content"], strict=True) for x in profile_record(PlainUnpickler(io.BytesIO(content)).load())]
            yield pd.DataFrame(rows, columns=["path", "key", "type", "shape", "dtype", "low", "high"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pkl").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, key string, type string, shape string, dtype string, low double, high double")


def long_tracks(samples: DataFrame, key: Sequence[str], column: str = "traj") -> DataFrame:
    """Rows (key, track, step, x, y, z) of sample arrays; padded steps are left out."""
    t = samples.select(*key, F.posexplode(column).alias("track", "__steps")).select(*key, "track", F.posexplode("__steps").alias("step", "p"))
    out = t.select(*key, "track", "step", *(F.get("p", F.lit(k)).cast("double").alias(n) for k, n in enumerate("xyz")))
    return out.filter(F.col("x") > float("-inf"))
