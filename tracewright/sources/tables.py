"""Line and JSON files: records, instructions, run logs, dataset indexes, captions, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of records a file, with a fixed schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON record a line."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """S23."""
    rows.write.json(path)


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """The instruction of a file and its confidence (null if not told)."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    text = F.trim(F.regexp_replace(F.regexp_replace("value", r"(?m)^confidence:.*$", ""), r"\s+$", ""))
    return files.select("path", text.alias("text"), F.regexp_extract("value", r"(?m)^confidence:\s*([0-9.eE+-]+)", 1).try_cast("double").alias("confidence"))


# What lines of run logs tell.
LOG_CLASSES = {"succeeded": r"success|completed|✓", "failed": r"fail|error|✗", "conda": "conda", "cuda": r"cuda|out of memory", "ssl": "ssl"}


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of run logs with their file and classes. Lines keep no order across splits; number them in the file if it matters."""
    lines = spark.read.text(path).withColumn("path", F.col("_metadata.file_path"))
    return lines.select("path", F.col("value").alias("line"), *(F.lower("value").rlike(p).alias(n) for n, p in LOG_CLASSES.items()))


def read_index(spark: SparkSession, weights: dict[str, float], name: str = ".index.txt") -> DataFrame:
    """The entries of weighted datasets; weights are keyed by the folder that holds the index. Spark's readers pass over hidden names, so the index is opened through the same file system by hand."""
    rows = []
    for folder, weight in sorted(weights.items()):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        rows += [(folder, entry.strip(), float(weight)) for entry in text.split("\n") if entry.strip()]
    return spark.createDataFrame(rows, "dataset string, entry string, weight double")


def write_id_list(ids: DataFrame, path: str) -> None:
    """One file of sorted ids, a line each."""
    ids.select(F.col(ids.columns[0]).cast("string").alias("id")).distinct().sort("id").coalesce(1).write.text(path)


def caption_json(*keys: str) -> Column:
    """K09."""
    return F.to_json(F.struct(*keys))


def report(config: dict[str, str], summary: DataFrame) -> DataFrame:
    """One row of JSON with the configuration and the summary."""
    told = F.create_map(*(F.lit(x) for kv in sorted(config.items()) for x in kv))
    return summary.select(F.to_json(F.struct(told.alias("config"), F.struct(*summary.columns).alias("execution"))).alias("report"))
