"""Streams of frames: windows with carried state, running state of tracks, and a monitor of an output folder."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "track long, step long, value double, velocity double"
OUT = "clip long, track long, step long, value double, velocity double"


def carry(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows (clip, track, step, value) of one clip in order of step; each gets its difference to the track's last value, which is kept for the next batch."""
    held = {t: (s, v, w) for t, s, v, w in zip(*state.get, strict=True)} if state.exists else {}
    rows = pd.concat(list(parts), ignore_index=True).sort_values(["step", "track"], kind="stable")
    speeds = []
    for track, step, value in zip(rows["track"], rows["step"], rows["value"], strict=True):
        before = held.get(track)
        speeds.append(0.0 if before is None else value - before[1])
        held[track] = (step, value, speeds[-1])
    state.update(([*held], [h[0] for h in held.values()], [h[1] for h in held.values()], [h[2] for h in held.values()]))
    yield rows.assign(clip=key[0], velocity=speeds)[["clip", "track", "step", "value", "velocity"]]


def track_stream(rows: DataFrame) -> DataFrame:
    """State by clip, across micro-batches; the batch result is the same for rows that come in order."""
    state = "tracks array<long>, steps array<long>, values array<double>, velocities array<double>"
    return rows.groupBy("clip").applyInPandasWithState(carry, OUT, state, "append", GroupStateTimeout.NoTimeout)


def track_batch(rows: DataFrame) -> DataFrame:
    """The same over a table at rest, by a window."""
    from pyspark.sql import Window

    order = Window.partitionBy("clip", "track").orderBy("step")
    return rows.withColumn("velocity", F.coalesce(F.col("value") - F.lag("value").over(order), F.lit(0.0))).select("clip", "track", "step", "value", "velocity")


def progress(spark: SparkSession, folder: str, pattern: str = "*.npz") -> DataFrame:
    """A running count of an output folder's files by their parent, as a stream; contents are not read."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("case"), "length").groupBy("case").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def last_iteration(rows: DataFrame, *by: str, value: str) -> DataFrame:
    """Of each key the value of the last iteration."""
    return rows.groupBy(*by).agg(F.max_by(value, "iter_idx").alias(value), F.max("iter_idx").alias("iter_idx"))
