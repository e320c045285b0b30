"""Pixel work: crops, tightening on ink, and the detector's input. Images are arrays (height, width, 3), red first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.sources.writers import png

#: The detector's input side and the darkness of ink.
SIDE = 800
INK = 200


def from_spark(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """A decoded Spark image, which has blue first."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return a[:, :, 2::-1] if channels >= 3 else np.repeat(a, 3, axis=2)


def rectangle(box: tuple[float, float, float, float], width: int, height: int) -> tuple[int, int, int, int]:
    """(x, y, w, h) in whole pixels: corners in any order, clamped to the image, one pixel at least; halves go up."""

    def edge(v: float, size: int) -> int:
        return int(np.floor(min(max(v, 0.0), float(size)) + 0.5))

    x0, x1 = sorted((box[0], box[2]))
    y0, y1 = sorted((box[1], box[3]))
    left, right, top, bottom = edge(x0, width), edge(x1, width), edge(y0, height), edge(y1, height)
    x, y = min(left, max(width - 1, 0)), min(top, max(height - 1, 0))
    return x, y, max(1, min(right - left, width - x)), max(1, min(bottom - top, height - y))


def crop(image: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    x, y, w, h = rectangle(box, image.shape[1], image.shape[0])
    return image[y : y + h, x : x + w]


def tighten(image: np.ndarray) -> np.ndarray:
    """The image cut to its ink: contrast stretched to the full range, dark pixels bounded.

    A flat image, one without ink, and one whose ink is two pixels or less across stay whole.
    """
    gray = np.floor(image.astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32) + np.float32(0.5))
    lo, hi = gray.min(), gray.max()
    if lo == hi:
        return image
    dark = np.floor((gray - lo) / (hi - lo) * np.float32(255) + np.float32(0.5)) <= INK
    ys, xs = np.nonzero(dark.any(axis=1))[0], np.nonzero(dark.any(axis=0))[0]
    if not len(ys) or ys[-1] - ys[0] < 2 or xs[-1] - xs[0] < 2:
        return image
    return image[ys[0] : ys[-1] + 1, xs[0] : xs[-1] + 1]


def wants_tight(kind: Column) -> Column:
    return F.contains(kind, F.lit("formula")) & (kind != "formula_number")


def crop_for_class(image: np.ndarray, box: tuple[float, float, float, float], kind: str) -> np.ndarray:
    part = crop(image, box)
    return tighten(part) if "formula" in kind and kind != "formula_number" else part


def _weights(size: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``to`` positions the source positions and weights of a cubic filter with a = -1/2, widened when shrinking."""
    scale = size / to
    reach = 2.0 * max(scale, 1.0)
    centre = (np.arange(to) + 0.5) * scale
    first = np.floor(centre - reach).astype(int)
    at = first[:, None] + np.arange(int(np.ceil(2 * reach)) + 2)[None, :]
    t = np.abs((at + 0.5 - centre[:, None]) / max(scale, 1.0))
    w = np.where(t < 1, 1.5 * t**3 - 2.5 * t**2 + 1, np.where(t < 2, -0.5 * t**3 + 2.5 * t**2 - 4 * t + 2, 0.0))
    w[(at < 0) | (at >= size)] = 0
    return np.clip(at, 0, size - 1), w / w.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    ry, wy = _weights(image.shape[0], height)
    rows = np.einsum("ok,okwc->owc", wy, image.astype(np.float64)[ry])
    rx, wx = _weights(image.shape[1], width)
    out = np.einsum("ok,hokc->hoc", wx, rows[:, rx])
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def detector_input(image: np.ndarray) -> np.ndarray:
    """float32 (1, 3, 800, 800): resized without keeping the shape, blue first, 0 to 1."""
    x = resize(image, SIDE, SIDE)[:, :, ::-1].astype(np.float32) / np.float32(255)
    return np.ascontiguousarray(x.transpose(2, 0, 1))[None]


def cut_crops(regions: DataFrame, images: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, ordinal, class, crop, png, error): a PNG for every region; without an image, or one that can be read, an ``error`` instead.

    ``images`` has (page, data, height, width, nChannels). Regions come to their image as one list, so an
    image is decoded and moved once. No region is lost: one that cannot be cut keeps its row.
    """
    lists = regions.groupBy(page).agg(F.collect_list(F.struct("ordinal", "class", "crop", "x0", "y0", "x1", "y1")).alias("rs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, data, h, w, n, rs in zip(b[page], b["data"], b["height"], b["width"], b["nChannels"], b["rs"]):
                out, image, why = [], None, None
                try:
                    if data is None:
                        raise FileNotFoundError("no image of this page")
                    image = from_spark(bytes(data), int(h), int(w), int(n))
                except Exception as e:  # one bad page must not end the run
                    why = f"{type(e).__name__}: {e}"
                for r in rs:
                    part, error = None, why
                    if image is not None:
                        try:
                            part = png(np.ascontiguousarray(crop_for_class(image, (r["x0"], r["y0"], r["x1"], r["y1"]), r["class"] or "")))
                        except Exception as e:
                            error = f"{type(e).__name__}: {e}"
                    out.append((p, r["ordinal"], r["class"], r["crop"], part, error))
                yield pd.DataFrame(out, columns=[page, "ordinal", "class", "crop", "png", "error"])

    kind = regions.schema[page].dataType.simpleString()
    return lists.join(images.select(page, "data", "height", "width", "nChannels"), page, "left").mapInPandas(run, f"{page} {kind}, ordinal int, class string, crop string, png binary, error string")
