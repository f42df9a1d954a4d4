"""Images: their size and their metadata as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions.names import file_name, file_type
from gleanwork.functions.text import flat_lower, type_tagged_text


def image_sizes(spark: SparkSession, path: str | list[str], drop_invalid: bool = False) -> DataFrame:
    """``(origin, height, width, nChannels)`` of every file below ``path``; a height below 0 if it is no image."""
    return (
        spark.read.format("image")
        .option("dropInvalid", drop_invalid)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("image.origin", "image.height", "image.width", "image.nChannels")
    )


def read_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(origin, height, width, nChannels)``, one row per readable image below ``path``.

    The pixels are dropped in the scan's own stage. :func:`image_rejects` lists the other files.
    """
    return image_sizes(spark, path, True)


def unreadable_images(sizes: DataFrame) -> DataFrame:
    """``(key, reason)`` of the files of :func:`image_sizes` that are no readable image."""
    unreadable = sizes.where("height < 0")
    return unreadable.select(F.col("origin").alias("key"), F.lit("no readable image").alias("reason"))


def image_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(key, reason)`` of the files below ``path`` that are no readable image."""
    return unreadable_images(image_sizes(spark, path))


def image_text(images: DataFrame) -> DataFrame:
    """``(filename, text)``: the detected type and the metadata values on one lower-case line."""
    name = file_name("origin")
    values = F.concat_ws("\n", *[F.col(c).cast("string") for c in ("height", "width", "nChannels")])
    tagged = type_tagged_text(name, file_type(name), F.concat(F.lit("\n"), values, F.lit("\n")))
    return images.select(name.alias("filename"), flat_lower(tagged).alias("text"))
