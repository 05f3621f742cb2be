"""Record pipelines: tile, resize, normalise and score."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import columns

# Fixed values of the image preparation.
INPUT_SIZE = 448
MIN_TILES, MAX_TILES = 1, 6
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


def grids(lowest: int = MIN_TILES, highest: int = MAX_TILES) -> list[tuple[int, int]]:
    """Tile grids (columns, rows) with an allowed number of tiles, smallest first."""
    pairs = [(i, j) for i in range(1, highest + 1) for j in range(1, highest + 1) if lowest <= i * j <= highest]
    return sorted(pairs, key=lambda p: (p[0] * p[1], p))


def plan_tiles(df: DataFrame, width: str, height: str, size: int = INPUT_SIZE, highest: int = MAX_TILES) -> DataFrame:
    """Add the grid ``tiles_x, tiles_y`` closest in aspect ratio, ``blocks`` and the target size.

    Among grids at the same distance a larger one is taken only if the image has more than half of its
    pixels.  The grids are a constant array, so a row is planned on its own.
    """
    w, h = F.col(width).cast("double"), F.col(height).cast("double")

    def option(i: int, j: int) -> Column:
        roomy = w * h > F.lit(0.5 * size * size * i * j)
        return F.struct(F.abs(w / h - F.lit(i / j)).alias("gap"),
                        F.when(roomy, F.lit(-i * j)).otherwise(F.lit(i * j)).alias("rank"),
                        F.lit(i).alias("x"), F.lit(j).alias("y"))

    # Least (gap, rank): the largest grid with room among equal gaps, else the smallest.
    df = df.withColumn("_pick", F.array_min(F.array(*[option(i, j) for i, j in grids(MIN_TILES, highest)])))
    return df.withColumns({"tiles_x": F.col("_pick.x"), "tiles_y": F.col("_pick.y"),
                           "blocks": F.col("_pick.x") * F.col("_pick.y"), "target_width": F.col("_pick.x") * size,
                           "target_height": F.col("_pick.y") * size}).drop("_pick")


def tile_boxes(planned: DataFrame, size: int = INPUT_SIZE, thumbnail: bool = False) -> DataFrame:
    """One row per tile, row by row: ``tile, x0, y0, x1, y1``; optionally a last row for the whole image."""
    last = F.col("blocks") - 1 + (F.when(F.col("blocks") > 1, 1).otherwise(0) if thumbnail else 0)
    tiles = planned.withColumn("tile", F.explode_outer(F.sequence(F.lit(0), last)))
    extra = F.col("tile") == F.col("blocks")
    x, y = F.col("tile") % F.col("tiles_x"), F.floor(F.col("tile") / F.col("tiles_x")).cast("int")
    return tiles.withColumns({
        "is_thumbnail": extra, "x0": F.when(extra, 0).otherwise(x * size), "y0": F.when(extra, 0).otherwise(y * size),
        "x1": F.when(extra, size).otherwise((x + 1) * size), "y1": F.when(extra, size).otherwise((y + 1) * size)})


def normalize_array(df: DataFrame, name: str, mean: float, std: float, out: str) -> DataFrame:
    return df.withColumn(out, columns.normalize_array(name, mean, std))


def _cubic(x: np.ndarray) -> np.ndarray:
    """Cubic convolution kernel with a = -0.5; 0 beyond a distance of 2."""
    x = np.abs(x)
    near = (1.5 * x - 2.5) * x * x + 1
    far = ((-0.5 * x + 2.5) * x - 4) * x + 2
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def _linear(x: np.ndarray) -> np.ndarray:
    return np.maximum(1 - np.abs(x), 0.0)


KERNELS = {"bicubic": (_cubic, 2.0), "bilinear": (_linear, 1.0)}


@lru_cache(maxsize=64)
def resampling(old: int, new: int, method: str = "bicubic") -> tuple[np.ndarray, np.ndarray]:
    """Places and weights (new x taps) of one axis, with half-pixel centres.

    The kernel is widened by the factor of shrinking, so every input pixel counts; weights sum to 1 at the borders, too.
    """
    kernel, reach = KERNELS[method]
    scale = max(old / new, 1.0)
    centre = (np.arange(new) + 0.5) * old / new
    first = np.floor(centre - reach * scale).astype(int)
    at = first[:, None] + np.arange(int(np.ceil(2 * reach * scale)) + 2)[None, :]
    weight = kernel((at + 0.5 - centre[:, None]) / scale) * ((at >= 0) & (at < old))
    return np.clip(at, 0, old - 1), weight / weight.sum(axis=1, keepdims=True)


def resample(image: np.ndarray, width: int, height: int, method: str = "bicubic") -> np.ndarray:
    """Resize rows x columns x channels of 0 to 255, columns first; both steps round to whole values, as for 8-bit images."""
    def along(rows: np.ndarray, new: int) -> np.ndarray:
        if len(rows) == new:
            return rows
        at, weight = resampling(len(rows), new, method)
        out = np.zeros((new, *rows.shape[1:]))
        for tap in range(at.shape[1]):
            out += weight[:, tap, None, None] * rows[at[:, tap]]
        return np.clip(np.floor(out + 0.5), 0, 255)

    wide = along(image.swapaxes(0, 1), width).swapaxes(0, 1)
    return along(wide, height)


def _tiles(row, size: int, thumbnail: bool, method: str) -> list[np.ndarray]:
    """Normalised tiles of one planned image, channel first; the whole image last if asked for."""
    if row.pixels is None:
        return []
    raw = np.frombuffer(row.pixels, np.uint8).reshape(row.height, row.width, row.channels)
    rgb = (np.repeat(raw, 3, axis=2) if row.channels == 1 else raw[:, :, 2::-1]).astype(float)
    whole = resample(rgb, row.target_width, row.target_height, method)
    cut = [whole[y:y + size, x:x + size] for y in range(0, row.target_height, size)
           for x in range(0, row.target_width, size)]
    if thumbnail and len(cut) > 1:
        cut.append(resample(rgb, size, size, method))
    mean, std = np.asarray(CHANNEL_MEAN), np.asarray(CHANNEL_STD)
    return [((t / 255.0 - mean) / std).astype(np.float32).transpose(2, 0, 1) for t in cut]


def _map_images(images: DataFrame, size: int, make: Callable[[object], pd.DataFrame], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):  # an image at a time: its tiles are megabytes
                yield make(row)

    needed = ["path", "height", "width", "channels", "pixels", "target_width", "target_height"]
    return plan_tiles(images, "width", "height", size).select(*needed).mapInPandas(run, schema)


def resize(images: DataFrame, thumbnail: bool = False, size: int = INPUT_SIZE, method: str = "bicubic") -> DataFrame:
    """Decoded images to ``path, tile, is_thumbnail, pixel_values``: one row per tile, 3 x size x size floats.

    An image without pixels keeps one row with nulls.
    """
    def make(row) -> pd.DataFrame:
        tiles = _tiles(row, size, thumbnail, method)
        if not tiles:
            return pd.DataFrame({"path": [row.path], "tile": [None], "pixel_values": [None], "is_thumbnail": [None]}, dtype=object)
        blocks = (row.target_width // size) * (row.target_height // size)
        return pd.DataFrame({"path": row.path, "tile": range(len(tiles)), "pixel_values": [t.ravel() for t in tiles],
                             "is_thumbnail": [i >= blocks for i in range(len(tiles))]})

    return _map_images(images, size, make, "path string, tile int, is_thumbnail boolean, pixel_values array<float>")


def pack_tiles(images: DataFrame, thumbnail: bool = False, size: int = INPUT_SIZE, method: str = "bicubic") -> DataFrame:
    """Decoded images to ``path, num_tiles, pixel_values``: the stacked tiles of an image in one row.

    Packed where the image is decoded, so tiles are never shuffled. An image without pixels has 0 tiles and null values.
    """
    def make(row) -> pd.DataFrame:
        tiles = _tiles(row, size, thumbnail, method)
        pixels = np.stack(tiles).ravel() if tiles else None
        return pd.DataFrame({"path": [row.path], "num_tiles": [len(tiles)], "pixel_values": [pixels]})

    return _map_images(images, size, make, "path string, num_tiles int, pixel_values array<float>")


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Row function of a class that is built once per task, not once per row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for batch in batches:
            yield pd.DataFrame([call(row) for row in batch.to_dict("records")])

    return df.mapInPandas(run, schema)


def score(df: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str,
          batch_size: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Batch function of a class that is built once per task; batches have at most ``batch_size`` rows.

    ``num_partitions`` is for heavy scorers on few large files; without it the scan's partitions are kept.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for batch in batches:
            step = batch_size or max(len(batch), 1)
            for start in range(0, len(batch), step):
                yield call(batch.iloc[start:start + step])

    source = df.repartition(num_partitions) if num_partitions else df
    return source.mapInPandas(run, schema)


def as_column(make: Callable[[], Callable[[pd.Series], pd.Series]], kind: str = "string") -> Callable[..., Column]:
    """A column function from a class: built once per task, output in input order."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = make()
        for batch in batches:
            yield call(batch)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind)


def pipeline(df: DataFrame, stages: Sequence[Callable[[DataFrame], DataFrame]], drop: Sequence[str] = ()) -> DataFrame:
    """Chained record stages in one job; heavy columns are dropped before the sink."""
    for stage in stages:
        df = stage(df)
    return df.drop(*drop)
