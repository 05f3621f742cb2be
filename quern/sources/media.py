"""Image and audio files as rows."""

from __future__ import annotations

import io
import struct
import wave
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.tables import read_binary

IMAGE_SCHEMA = "height int, width int, channels int, pixels binary, error string"
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}  # by colour type
AUDIO_SCHEMA = "path string, frame_rate int, channels int, array array<float>"


def read_images(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    """Decoded images: ``path, height, width, channels, pixels, error`` (bytes, rows of BGR triples).

    A file that cannot be decoded keeps its row, with nulls and a text in ``error``.
    """
    frame = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True)
    image = frame.load([folders] if isinstance(folders, str) else list(folders))
    good = F.col("image.nChannels") > 0
    return image.select(
        F.col("image.origin").alias("path"), F.when(good, F.col("image.height")).alias("height"),
        F.when(good, F.col("image.width")).alias("width"), F.when(good, F.col("image.nChannels")).alias("channels"),
        F.when(good, F.col("image.data")).alias("pixels"), F.when(~good, F.lit("not a readable image")).alias("error"))


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """One PNG row without its filter; sums are taken modulo 256."""
    if kind == 0:
        return line
    if kind == 1:
        return line.reshape(-1, step).cumsum(axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    if kind not in (3, 4):
        raise ValueError("unknown row filter")
    out, up = line.tolist(), above.tolist()
    for i, value in enumerate(out):
        left = out[i - step] if i >= step else 0
        if kind == 3:
            near = (left + up[i]) // 2
        else:
            corner = up[i - step] if i >= step else 0
            guess = left + up[i] - corner
            near = min((left, up[i], corner), key=lambda v: abs(guess - v))  # the first of equally near ones
        out[i] = (value + near) % 256
    return np.array(out, np.uint8)


def decode_png(content: bytes) -> np.ndarray:
    """8-bit PNG without interlacing to height x width x channels: grey, or RGB; transparency is left out."""
    if content[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG file")
    at, packed, palette, head = 8, [], None, None
    while at + 8 <= len(content):
        size, kind = struct.unpack(">I4s", content[at:at + 8])
        body = content[at + 8:at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        at += size + 12
    if head is None or head[2] != 8 or head[6] or head[3] not in PNG_CHANNELS:
        raise ValueError("only 8-bit PNG files without interlacing are read")
    width, height, step = head[0], head[1], PNG_CHANNELS[head[3]]
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * step)
    out, above = np.empty((height, width * step), np.uint8), np.zeros(width * step, np.uint8)
    for y, row in enumerate(rows):
        above = out[y] = _unfilter(int(row[0]), row[1:], above, step)
    out = out.reshape(height, width, step)
    if head[3] == 3:
        return palette[out[:, :, 0]]
    return out[:, :, :1] if step < 3 else out[:, :, :3]


def decode_images(files: DataFrame, content: str = "content", decode: Callable[[bytes], np.ndarray] = decode_png) -> DataFrame:
    """Replace the bytes of image files in a column by ``height, width, channels, pixels, error`` as of ``read_images``.

    ``decode`` turns the bytes of a file into rows of grey values or RGB triples; the built-in one reads PNG, others
    wrap any image library of the workers. Null and unreadable contents keep their row, with a text in ``error``.
    """
    def one(raw) -> tuple:
        if raw is None:
            return None, None, None, None, "no content"
        try:
            image = decode(bytes(raw))
        except Exception as error:  # whatever a decoder raises belongs to its row
            return None, None, None, None, f"not a readable image: {error}"
        return (*image.shape, np.ascontiguousarray(image[:, :, ::-1]).tobytes(), None)

    names = [part.split()[0] for part in IMAGE_SCHEMA.split(", ")]

    @F.pandas_udf(IMAGE_SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(raw) for raw in batch], columns=names, dtype=object)

    kept = [c for c in files.columns if c != content and c not in names]
    return files.select(*kept, run(content).alias("_image")).select(*kept, "_image.*")


def _samples(content: bytes) -> tuple[int, int, np.ndarray]:
    with wave.open(io.BytesIO(content)) as audio:
        if audio.getsampwidth() != 2:
            raise ValueError("only 16-bit PCM is supported")
        raw = np.frombuffer(audio.readframes(audio.getnframes()), dtype="<i2")
        return audio.getframerate(), audio.getnchannels(), raw.astype(np.float32) / np.float32(2 ** 15)


def decode_wav(files: DataFrame) -> DataFrame:
    """16-bit PCM files (``path, content``) to floats in [-1, 1); channels stay interleaved in ``array``."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_samples(content) for content in batch["content"]]
            yield pd.DataFrame({"path": batch["path"], "frame_rate": [r[0] for r in rows],
                                "channels": [r[1] for r in rows], "array": [r[2] for r in rows]})

    return files.select("path", "content").mapInPandas(decode, AUDIO_SCHEMA)


def read_wav(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    return decode_wav(read_binary(spark, folders, "*.wav"))


def channel(array: str, channels: str, index: int):
    """One channel of an interleaved array column."""
    return F.filter(F.col(array), lambda _, i: i % F.col(channels) == F.lit(index))
