"""Images to text."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from gleanwork.sinks.tables import rejects_path, run_day, write_rejects, write_snapshot
from gleanwork.sources.images import image_sizes, image_text, read_images, unreadable_images
from gleanwork.workspace import materialise


def images_text(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """``(filename, text)`` of every image below ``source``; see ``sinks.preview`` for a look."""
    return image_text(read_images(spark, source))


def run_images(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    run_date: str | datetime.date | None = None,
    rejects_target: str | None = None,
    keep_rejects: bool = True,
    lossless: bool = False,
    max_records_per_file: int = 0,
    atomic: bool = False,
) -> str:
    """Write a dated snapshot of the metadata text of all images below ``source``.

    Files that are no readable image are listed in ``rejects_target``, by default a folder
    ``_rejects`` in the target, unless ``keep_rejects`` is off. Sizes are staged for that, a few numbers a file, so
    each image is decoded once.
    """
    run_date = run_day(run_date)
    images = read_images(spark, source)
    if keep_rejects:
        sizes = materialise(image_sizes(spark, source), "images")
        write_rejects(unreadable_images(sizes), rejects_path(target, rejects_target, True), "images", run_date)
        images = sizes.where("height >= 0")
    return write_snapshot(
        image_text(images),
        target,
        run_date,
        lossless=lossless,
        max_records_per_file=max_records_per_file,
        atomic=atomic,
    )
