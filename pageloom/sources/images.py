"""Image files: listing, metadata, pixels and hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import fixed
from pageloom.functions.hashes import average_hash, perceptual_hash
from pageloom.functions.labels import dims_label, extension, has_suffix, size_kb
from pageloom.operators.dedup import dedup
from pageloom.operators.ranking import with_row_number
from pageloom.sources.scratch import materialise


def keep_images(files: DataFrame, path: str = "path", suffixes: tuple[str, ...] = fixed.DEDUP_EXTENSIONS) -> DataFrame:
    """Files whose lower-cased name ends in one of ``suffixes``."""
    return files.filter(has_suffix(F.col(path), suffixes))


def keep_images_ext(files: DataFrame, path: str = "path", suffixes: tuple[str, ...] = fixed.INFERENCE_EXTENSIONS) -> DataFrame:
    """Files whose lower-cased extension is one of ``suffixes``; a bare ``.jpg`` has none."""
    return files.filter(extension(F.col(path)).isin(*suffixes))


def plain_path(path: Column) -> Column:
    """One spelling for ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, "^file:/+", "/")


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length, content)`` of the images of a flat folder."""
    return keep_images(_files(spark, folder))


def scan_images_ext(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the extensions inference takes."""
    return keep_images_ext(_files(spark, folder))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(folder)
    return files.select(plain_path(F.col("path")).alias("path"), "length", "content")


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, width, height, channels, data)``; a broken file has width -1."""
    image = spark.read.format("image").load(folder).select("image.*")
    return keep_images(image.select(
        plain_path(F.col("origin")).alias("path"), "width", "height", F.col("nChannels").alias("channels"), "data"))


def skip_broken(images: DataFrame) -> DataFrame:
    """Images that could be decoded."""
    return images.filter(F.col("width") > 0)


def broken(images: DataFrame) -> DataFrame:
    return images.filter(~F.coalesce(F.col("width") > 0, F.lit(False)))


def image_metadata(images: DataFrame) -> DataFrame:
    """Add ``size_kb`` and ``dims`` from ``size_bytes``, ``width`` and ``height``."""
    return images.withColumn("size_kb", size_kb(F.col("size_bytes"))).withColumn(
        "dims", dims_label(F.col("width"), F.col("height")))


def _shares(source: int, target: int) -> np.ndarray:
    """``target`` x ``source`` weights of an area mean."""
    edge = np.arange(target + 1) * (source / target)
    cell = np.arange(source)
    overlap = np.minimum(edge[1:, None], cell + 1) - np.maximum(edge[:-1, None], cell)
    return np.clip(overlap, 0, None) / (source / target)


def shrink(images: DataFrame, sides: tuple[int, ...] = (8, 32), keep_broken: bool = False) -> DataFrame:
    """Add ``px{side}``: grey values of the image shrunk to ``side`` x ``side``.

    With ``keep_broken`` an image that could not be decoded stays, without values.

    The image source gives blue, green, red bytes; the grey value weighs them
    as broadcast luma does.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"path": list(frame["path"]), "width": list(frame["width"]), "height": list(frame["height"])}
            for side in sides:
                out[f"px{side}"] = []
            for h, w, c, data in zip(frame["height"], frame["width"], frame["channels"], frame["data"]):
                if w <= 0:
                    for side in sides:
                        out[f"px{side}"].append(None)
                    continue
                raw = np.frombuffer(data, dtype="uint8").reshape(h, w, c).astype("float64")
                grey = raw[:, :, 0] if c == 1 else raw[:, :, :3] @ np.array([0.114, 0.587, 0.299])
                for side in sides:
                    small = _shares(h, side) @ grey @ _shares(w, side).T
                    out[f"px{side}"].append(small.ravel().tolist())
            yield pd.DataFrame(out)

    schema = "path string, width int, height int" + "".join(f", px{side} array<double>" for side in sides)
    rows = images if keep_broken else skip_broken(images)
    return rows.select("path", "width", "height", "channels", "data").mapInPandas(run, schema)


def _hashed_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, size_bytes, width, height, phash, ahash)`` of all image files; hashes of broken ones are null."""
    sizes = scan_images(spark, folder).select("path", F.col("length").alias("size_bytes"))
    small = shrink(decoded(spark, folder), keep_broken=True)
    hashes = small.select("path", "width", "height",
                          perceptual_hash(F.col("px32"), 32).alias("phash"), average_hash(F.col("px8")).alias("ahash"))
    return sizes.join(hashes, "path")


def image_items(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed images of a folder that can be read, in no order; ``dedup_folder`` numbers and groups them."""
    return skip_broken(_hashed_files(spark, folder))


@dataclass(frozen=True)
class DedupedFolder:
    """Images to keep and to drop, the report of all groups, and files that could not be read."""

    keep: DataFrame
    drop: DataFrame
    groups: DataFrame
    rejects: DataFrame


def dedup_folder(
    spark: SparkSession, folder: str, t: int = fixed.SIMILARITY_THRESHOLD, quality: str = "size_bytes",
) -> DedupedFolder:
    """Group the images of a flat folder and choose the best of each group.

    Every file is decoded once.  Images arrive in the order of their paths
    (``ord``, from 1).  ``rejects`` has ``(path, size_bytes, reason)``.  No file
    is touched.  Files of no bytes are in none of the tables: Spark's readers
    pass over them.
    """
    files = materialise(_hashed_files(spark, folder), "image-files")
    items = with_row_number(skip_broken(files), [], ["path"], "ord")
    groups = materialise(dedup(items, t, quality), "image-groups")
    return DedupedFolder(
        keep=groups.filter("action = 'Retained'"), drop=groups.filter("action = 'Deleted'"), groups=groups,
        rejects=broken(files).select("path", "size_bytes", F.lit("not a readable image").alias("reason")))
