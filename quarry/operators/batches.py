"""Detection in batches of images of one shape (O-86)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.functions.names import unused
from quarry.operators.models import BOX, NO_IMAGE, _arrow
from quarry.sources.files import MOST_BYTES, held_together, with_contents

#: Images in one call of a detector.
MOST_IMAGES = 32


def _settle(detect: Callable, images: list, labels: list) -> list[tuple]:
    """(boxes, error) for each image. A call that fails is made again for each half, until the broken image is alone."""
    try:
        boxes = detect(images, labels)
        if len(boxes) != len(images):
            raise ValueError(f"{len(boxes)} answers for {len(images)} images")
        return [(b, None) for b in boxes]
    except Exception as e:
        if len(images) == 1:
            return [(None, str(e))]
        half = len(images) // 2
        return _settle(detect, images[:half], labels[:half]) + _settle(detect, images[half:], labels[half:])


def detected_in_batches(
    images: DataFrame,
    make_detector: Callable,
    content: str = "content",
    labels: str = "labels",
    shape: tuple[str, ...] = ("height", "width"),
    most_images: int = MOST_IMAGES,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """images with columns boxes and error, as of models.detected(), from a detector of many images at once.

    The detector gets a list of contents and one of lists of labels, of images of equal shape, at most most_images and
    most_bytes of contents or one image, and gives a list of boxes for each. Batches are formed inside the batches of
    rows that Spark hands on, and results stand at their own rows. A null content is that row's error, null labels are none,
    null sides are a shape of their own. Wrap make_detector in pacing.once_a_worker() to load a model once a worker.
    """
    name, error = unused(images, "boxes", "error")
    out = T.StructType([*images.schema.fields, *T.StructType.fromDDL(f"{name} array<{BOX}>, {error} string").fields])
    at, asked, sides = images.columns.index(content), images.columns.index(labels), [images.columns.index(c) for c in shape]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detect = make_detector()
        for b in batches:
            found: list[tuple] = [(None, NO_IMAGE)] * b.num_rows
            sizes = pc.binary_length(b.column(at)).to_pylist()
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(*(b.column(i).to_pylist() for i in sides)) if sides else [()] * b.num_rows):
                if sizes[k] is not None:
                    groups.setdefault(key, []).append(k)
            for rows in groups.values():
                for first, end in held_together([sizes[k] for k in rows], most_bytes):
                    for i in range(first, end, most_images):
                        part = rows[i : min(end, i + most_images)]
                        told = _settle(detect, [b.column(at)[k].as_py() for k in part], [b.column(asked)[k].as_py() or [] for k in part])
                        for k, x in zip(part, told):
                            found[k] = x
            new = [pa.array([x[k] for x in found], t) for k, t in enumerate((_arrow(f"array<{BOX}>"), pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], out.fieldNames())

    return images.mapInArrow(run, out)


def detected_in_files(images: DataFrame, make_detector: Callable, path: str = "path", **options) -> DataFrame:
    """detected_in_batches() of images(path, labels, ...) whose files are read inside the tasks and go no further."""
    (content,) = unused(images, "_content")
    return detected_in_batches(with_contents(images, {path: content}), make_detector, content, **options).drop(content)
