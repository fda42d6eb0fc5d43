"""Paths, names, captions, JSON and log lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """X01."""
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(basename(path), r"(?<=.)(\.[^.]*)$", 1))


def last_number(name: Column) -> Column:
    """The last run of digits, or null."""
    return F.try_element_at(F.regexp_extract_all(name, F.lit(r"([0-9]+)"), F.lit(1)), F.lit(-1)).try_cast("bigint")


def frame_order(path: Column) -> list[Column]:
    """Order of frames: by the last number of the stem (0 if it has none), then by path."""
    return [F.coalesce(last_number(stem(path)), F.lit(0)), path]


def natural_key(name: Column) -> Column:
    """Order of names in which runs of digits count as numbers; names that end in _last go to the end."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    keyed = F.transform(parts, lambda p: F.struct(F.when(p.rlike("^[0-9]"), p.try_cast("decimal(38,0)")).alias("n"), F.when(~p.rlike("^[0-9]"), p).alias("s")))
    return F.struct(name.endswith("_last").alias("late"), keyed.alias("parts"), name.alias("name"))


def index_of(name: Column, prefix: str) -> Column:
    """The number after the last underscore of a name with the prefix, else null."""
    return F.when(name.startswith(prefix), F.substring_index(name, "_", -1).try_cast("bigint"))


def snake(text: Column) -> Column:
    """X04."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))


def objectish(word: Column, stop: list[str], prefixes: list[str]) -> Column:
    """A word that may name an object: no stop word, no such prefix, and some letter."""
    out = ~F.lower(word).isin(*stop) & word.rlike("[A-Za-z]")
    for p in prefixes:
        out = out & ~F.lower(word).startswith(p)
    return out


def lenient_json(text: Column, schema: str) -> Column:
    """The text as JSON, else its fenced block, else what stands from the first brace to the last."""
    inside = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    read = lambda t: F.from_json(F.when(F.trim(t).startswith("{"), t), schema, {"mode": "PERMISSIVE"})
    return F.coalesce(read(text), read(inside), read(braces))


def caption_part(text: Column, key: str, wrapper: str) -> Column:
    """A key of a JSON object, or of the object in its wrapper."""
    return F.coalesce(F.get_json_object(text, f"$.{wrapper}.{key}"), F.get_json_object(text, f"$.{key}"))


def caption_steps(steps: Column, keywords: Column, least: int = 3, most: int = 7) -> Column:
    """Non-empty trimmed steps, filled up from keywords if few, without repeats and at most so many."""
    clean = F.filter(F.transform(steps, F.trim), lambda s: s != "")
    return F.slice(F.array_distinct(F.when(F.size(clean) < least, F.concat(clean, keywords)).otherwise(clean)), 1, most)


def words(text: Column) -> Column:
    """Number of words."""
    return F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(text), r"\s+"))).cast("long")


def context(text: Column, word: str, reach: int = 50) -> Column:
    """The surroundings of the first occurrence of a word, in any case; null without one."""
    p = F.locate(word.lower(), F.lower(text))
    return F.when(p > 0, F.substring(text, F.greatest(p - reach, F.lit(1)), F.least(p - 1, F.lit(reach)) + len(word) + reach))


def elapsed(seconds: Column) -> Column:
    """With the unit that fits."""
    return F.when(seconds < 3600, F.concat(F.format_number(seconds / 60, 1), F.lit("min"))).when(seconds < 86400, F.concat(F.format_number(seconds / 3600, 1), F.lit("h"))).otherwise(F.concat(F.format_number(seconds / 86400, 1), F.lit("d")))


def inferred(value: Column) -> Column:
    """What a command-line word is: int, float, bool or str."""
    return F.when(value.try_cast("bigint").isNotNull() & value.rlike(r"^\s*[+-]?[0-9]+\s*$"), "int").when(value.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), "float").when(F.lower(value).isin("true", "false"), "bool").otherwise("str")


def parsed_list(value: Column) -> Column:
    """The numbers of a written list, with or without brackets; true and false count as 1 and 0, other words as null."""
    items = F.split(F.regexp_replace(value, r"[\[\]() ]", ""), ",")
    number = lambda t: F.when(F.lower(t) == "true", 1.0).when(F.lower(t) == "false", 0.0).otherwise(t.try_cast("double"))
    return F.transform(items, number)


def mime(path: Column) -> Column:
    """X10."""
    return F.when(suffix(path) == ".png", "image/png").when(suffix(path).isin(".jpg", ".jpeg"), "image/jpeg").when(suffix(path) == ".bmp", "image/bmp").otherwise("application/octet-stream")
