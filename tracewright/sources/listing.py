"""Folders as tables: clips, trajectories, episodes, frames and cases from a listing of files.

A listing has a path for each file and never reads contents (only the columns of the path are asked for). Folders exist as far as files lie in them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions import text

IMAGES = (".jpg", ".jpeg", ".png", ".bmp")
VIDEOS = (".mp4", ".mov", ".avi", ".mkv", ".webm")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path, relative (to the root), length and modified time of every file below the root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = root.rstrip("/") + "/"
    relative = F.substring_index(F.concat(F.lit("\x00"), F.regexp_replace("path", "^file:(//)?(?=/)", "")), prefix.removeprefix("file://").removeprefix("file:"), -1)
    return files.select("path", relative.alias("relative"), "length", F.col("modificationTime").alias("modified"))


def parts(path: Column) -> Column:
    return F.split(path, "/")


def is_image(path: Column) -> Column:
    return text.suffix(path).isin(*IMAGES)


def _folder(path: Column, depth: int) -> Column:
    return F.array_join(F.slice(parts(path), 1, depth), "/")


def scan_clips(files: DataFrame, depth: int) -> DataFrame:
    """Folders exactly so deep that hold images, and video files that lie so deep."""
    deep = F.size(parts(F.col("relative")))
    folders = files.filter(is_image(F.col("relative")) & (deep == depth + 1)).select(_folder(F.col("relative"), depth).alias("clip"), F.lit(False).alias("video"))
    videos = files.filter(text.suffix(F.col("relative")).isin(*VIDEOS) & (deep == max(1, depth))).select(F.col("relative").alias("clip"), F.lit(True).alias("video"))
    return folders.unionByName(videos).distinct()


def scan_trajectories(files: DataFrame) -> DataFrame:
    """Trajectories with frames and depth: in cam0 if it has a folder of frames (even one without images), else at the top."""
    top, rest = F.split_part("relative", F.lit("/"), F.lit(1)), F.regexp_replace("relative", "^[^/]*/", "")

    def has(folder: str, images: bool) -> Column:
        inside = rest.startswith(folder + "/")
        return F.max((inside & is_image(F.col("relative")) if images else inside).cast("int")) == 1

    found = files.filter(F.col("relative").contains("/")).groupBy(top.alias("trajectory")).agg(
        has("cam0/images0", False).alias("camera"), (has("cam0/images0", True) & has("cam0/depth_images0", True)).alias("inner"), (has("images0", True) & has("depth_images0", True)).alias("outer")
    )
    return found.filter((F.col("camera") & F.col("inner")) | (~F.col("camera") & F.col("outer"))).select("trajectory", F.when(F.col("camera"), "cam0/images0").otherwise("images0").alias("frames"))


def scan_cameras(files: DataFrame, cameras: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """(trajectory, camera) with both frames and depth."""
    top = F.split_part("relative", F.lit("/"), F.lit(1))
    second = F.split_part("relative", F.lit("/"), F.lit(2))
    seen = files.filter(is_image(F.col("relative")) & second.rlike(r"^(depth_)?images[0-9]+$")).select(top.alias("trajectory"), F.regexp_extract(second, "([0-9]+)$", 1).cast("int").alias("camera"), second.startswith("depth_").alias("depth"))
    return seen.filter(F.col("camera").isin(*cameras)).groupBy("trajectory", "camera").agg(F.count_distinct("depth").alias("n")).filter("n = 2").select("trajectory", "camera")


def scan_episodes(files: DataFrame, images: str) -> DataFrame:
    """The root itself ('' ) or its direct children with images in the named folder."""
    deep = F.size(parts(F.col("relative")))
    inside = files.filter(is_image(F.col("relative")))
    own = inside.filter((deep == 2) & (F.split_part("relative", F.lit("/"), F.lit(1)) == images)).select(F.lit("").alias("episode"))
    children = inside.filter((deep == 3) & (F.split_part("relative", F.lit("/"), F.lit(2)) == images)).select(F.split_part("relative", F.lit("/"), F.lit(1)).alias("episode"))
    return own.unionByName(children).distinct()


def list_frames(files: DataFrame, folder: Column) -> DataFrame:
    """Images with their folder and place, by the last number of the name."""
    order = Window.partitionBy("folder").orderBy(*text.frame_order(F.col("relative")))
    return files.filter(is_image(F.col("relative"))).withColumn("folder", folder).withColumn("pos", (F.row_number().over(order) - 1).cast("long"))


def list_images(files: DataFrame, folder: Column) -> DataFrame:
    """Images in natural order of their names."""
    order = Window.partitionBy("folder").orderBy(text.natural_key(text.stem(F.col("relative"))), "relative")
    return files.filter(is_image(F.col("relative"))).withColumn("folder", folder).withColumn("pos", (F.row_number().over(order) - 1).cast("long"))


def list_cases(files: DataFrame) -> DataFrame:
    """Child folders in order, with their numbers of images and samples."""
    top, second = F.split_part("relative", F.lit("/"), F.lit(1)), F.split_part("relative", F.lit("/"), F.lit(2))
    return files.filter(F.col("relative").contains("/")).groupBy(top.alias("case")).agg(F.count_if((second == "images") & is_image(F.col("relative"))).alias("images"), F.count_if((second == "samples") & (text.suffix(F.col("relative")) == ".npz")).alias("samples")).orderBy("case")


def newest_snapshot(files: DataFrame) -> DataFrame:
    """Of each model the newest folder of snapshots, with its files and bytes; paths are model/snapshots/name/..."""
    p = parts(F.col("relative"))
    seen = files.filter(F.get(p, F.lit(1)) == "snapshots").select(F.get(p, F.lit(0)).alias("model"), F.get(p, F.lit(2)).alias("snapshot"), "length", "modified")
    each = seen.groupBy("model", "snapshot").agg(F.max("modified").alias("modified"), F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return each.groupBy("model").agg(F.max(F.struct("modified", "snapshot", "files", "bytes")).alias("s")).select("model", "s.snapshot", "s.files", "s.bytes")
