"""Batch inference over images with a function the user supplies."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed

# Takes a batch of images, returns for each a list of vectors (maybe empty).
PredictFn = Callable[[Sequence], Sequence[Sequence[Sequence[float]]]]


# The model this Python worker holds, by the call that asked for it.
_LOADED: dict[str, PredictFn] = {}


def _loaded(key: str, load_model: Callable[[], PredictFn]) -> PredictFn:
    """The model of ``key``, loaded once per worker process; another call's model goes first."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = load_model()
    return _LOADED[key]


def _batches(frames: Iterator[pd.DataFrame], path: str, content: str, size: int) -> Iterator[tuple[list, list]]:
    """Paths and images, ``size`` at a time across the borders of frames; the last batch of a task may be smaller."""
    paths, values = [], []
    for frame in frames:
        for name, value in zip(frame[path], frame[content], strict=True):
            paths.append(name)
            values.append(value)
            if len(values) == size:
                yield paths, values
                paths, values = [], []
    if values:
        yield paths, values


def embed_images(images: DataFrame, predict_fn: PredictFn | None = None, batch_size: int = fixed.INFERENCE_BATCH,
                 path: str = "image_path", content: str = "content", *,
                 load_model: Callable[[], PredictFn] | None = None) -> DataFrame:
    """``(image_path, faces, error)``: vectors of every image.

    The function is called with ``batch_size`` images at a time.  When a batch
    fails its images are tried one by one; an image that fails alone keeps its
    message in ``error`` and has no vectors.  A model that is dear to load comes
    as ``load_model`` instead, a function without arguments that returns the
    function to call: each Python worker loads it once and keeps it for its
    later tasks.  A model that cannot be loaded fails the job.
    """
    if batch_size < 1:
        raise ValueError("batch size must be positive")
    if (predict_fn is None) == (load_model is None):
        raise ValueError("give either predict_fn or load_model")
    key = uuid.uuid4().hex

    def predict(model: PredictFn, values: list) -> list[tuple[list | None, str | None]]:
        try:
            found = list(model(values))
            if len(found) != len(values):
                raise ValueError(f"{len(found)} results for {len(values)} images")
            return [([list(map(float, v)) for v in faces], None) for faces in found]
        except Exception as e:
            if len(values) == 1:
                return [(None, f"{type(e).__name__}: {e}")]
            return [predict(model, [v])[0] for v in values]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for paths, values in _batches(frames, path, content, batch_size):
            model = model or predict_fn or _loaded(key, load_model)
            done = predict(model, values)
            yield pd.DataFrame({
                "image_path": paths,
                "faces": [faces for faces, _ in done],
                "error": [error for _, error in done],
            })

    return images.select(path, content).mapInPandas(run, "image_path string, faces array<array<float>>, error string")


def rejected_images(embedded: DataFrame) -> DataFrame:
    return embedded.filter("error is not null").select("image_path", "error")


def explode_faces(embedded: DataFrame) -> DataFrame:
    """One row per vector; images without vectors give none."""
    return embedded.select("image_path", F.posexplode("faces").alias("face_index", "embedding"))


def embedding_json(rows: DataFrame) -> DataFrame:
    """Vectors as JSON array text, each number written as a double."""
    return rows.withColumn("embedding", F.to_json(F.col("embedding").cast("array<double>")))


def embedding_array(rows: DataFrame) -> DataFrame:
    """The inverse of :func:`embedding_json`."""
    return rows.withColumn("embedding", F.from_json("embedding", "array<float>"))


def extend_results(*parts: DataFrame) -> DataFrame:
    """Bag union of results."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def face_counts(rows: DataFrame) -> DataFrame:
    """Vectors per image, with the run's totals in a row of null path."""
    per_image = rows.groupBy("image_path").agg(F.count("*").alias("n_faces"))
    return per_image.rollup("image_path").agg(
        F.sum("n_faces").alias("n_faces"), F.count("*").alias("n_images"))
