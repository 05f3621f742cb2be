import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators import inference
from quern.sources import media
from tests.test_sources import png

SIZES = [(w, h) for w in (100, 317, 448, 632, 634, 900, 1344, 1500) for h in (90, 448, 632, 633, 634, 700, 1200)]


def plan(width, height, size=448, most=6):
    """The closest shape; of several, the last one of which the image fills more than half, else the smallest."""
    grids = sorted(((i, j) for i in range(1, most + 1) for j in range(1, most // i + 1)), key=lambda g: (g[0] * g[1], g[0]))
    gaps = [abs(width / height - i / j) for i, j in grids]
    tied = [g for g, gap in zip(grids, gaps) if gap == min(gaps)]
    filled = [(i, j) for i, j in tied if 2 * width * height > size * size * i * j]
    return (filled or tied[:1])[-1]


@pytest.fixture(scope="module")
def planned(spark):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(SIZES)], "i int, w int, h int")
    return inference.plan_tiles(df, "w", "h")


def test_plan_matches_a_walk(planned):
    for r in planned.collect():
        assert (r["tiles_x"], r["tiles_y"]) == plan(r["w"], r["h"])
        assert (r["target_width"], r["target_height"]) == (448 * r["tiles_x"], 448 * r["tiles_y"])


def test_boxes_cover_the_target_once(planned):
    areas = {}
    for r in inference.tile_boxes(planned, thumbnail=True).collect():
        key = r["i"]
        if r["is_thumbnail"]:
            assert r["blocks"] > 1 and (r["x0"], r["y0"], r["x1"], r["y1"]) == (0, 0, 448, 448)
            continue
        assert 0 <= r["x0"] < r["x1"] <= r["target_width"] and 0 <= r["y0"] < r["y1"] <= r["target_height"]
        areas.setdefault(key, set()).add((r["x0"], r["y0"], r["x1"], r["y1"]))
    for r in planned.collect():
        assert sum((b[2] - b[0]) * (b[3] - b[1]) for b in areas[r["i"]]) == r["target_width"] * r["target_height"]
    assert inference.tile_boxes(planned).where("is_thumbnail").count() == 0


def test_images_to_packed_tiles(spark, tmp_path):
    png(tmp_path / "wide.png", 30, 20, (255, 0, 0))
    png(tmp_path / "tall.png", 10, 40, (0, 0, 255))
    images = media.read_images(spark, str(tmp_path))
    tiles = inference.resize(images, thumbnail=True, size=16).collect()
    packed = {r["path"].rsplit("/", 1)[-1]: r for r in inference.pack_tiles(images, thumbnail=True, size=16).collect()}
    assert sum(r["is_thumbnail"] for r in tiles) == sum(r["num_tiles"] > 1 for r in packed.values())
    for name, (w, h), colour in (("wide.png", (30, 20), (1, 0, 0)), ("tall.png", (10, 40), (0, 0, 1))):
        x, y = plan(w, h, 16)
        count = x * y + (1 if x * y > 1 else 0)
        assert packed[name]["num_tiles"] == count
        pixels = np.asarray(packed[name]["pixel_values"]).reshape(count, 3, 16, 16)
        mine = sorted((r["tile"], r["pixel_values"]) for r in tiles if r["path"].endswith(name))
        assert np.array_equal(np.asarray([p for _, p in mine]).ravel(), pixels.ravel())
        for c in range(3):
            want = (colour[c] - inference.CHANNEL_MEAN[c]) / inference.CHANNEL_STD[c]
            np.testing.assert_allclose(pixels[:, c], want, atol=1e-5)


def test_resampling_by_hand():
    ramp = np.tile(np.arange(8.0)[None, :, None] * 30, (4, 1, 3))
    for method in inference.KERNELS:
        out = inference.resample(ramp, 16, 4, method)
        assert out.shape == (4, 16, 3) and np.all(np.diff(out[0, :, 0]) >= 0)
        np.testing.assert_array_equal(inference.resample(ramp, 8, 4, method), ramp)
        np.testing.assert_array_equal(inference.resample(np.full((5, 7, 1), 9.0), 3, 11, method), np.full((11, 3, 1), 9.0))
    # Halving four pixels: the kernel is twice as wide, weights at distances 0.25, 0.75, 1.25 (and 1.75, cut off at the border).
    at, weight = inference.resampling(4, 2)
    near = [1.5 * d ** 3 - 2.5 * d ** 2 + 1 for d in (0.25, 0.75)]
    far = -0.5 * 1.25 ** 3 + 2.5 * 1.25 ** 2 - 4 * 1.25 + 2
    want = np.array([near[0], near[0], near[1], far])
    got = np.zeros(4)
    np.add.at(got, at[0], weight[0])
    np.testing.assert_allclose(got, want / want.sum(), atol=1e-12)
    row = np.array([0.0, 100.0, 200.0, 40.0])[None, :, None]
    assert inference.resample(row, 2, 1)[0, 0, 0] == np.floor(want @ row[0, :, 0] / want.sum() + 0.5)


def test_shrinking_averages_and_clips():
    stripes = np.tile(np.array([0.0, 255.0] * 32)[None, :, None], (2, 1, 1))
    inner = inference.resample(stripes, 8, 2)[:, 1:-1]
    assert np.all(np.abs(inner - 127.5) < 2)  # two-point interpolation would hit 0 or 255
    step = np.repeat([0.0, 255.0], 4)[None, :, None]
    grown = inference.resample(step, 32, 1)
    assert grown.min() == 0 and grown.max() == 255


def test_an_image_without_pixels_keeps_its_row(spark):
    rows = [("a", None, None, None, None), ("b", 2, 2, 1, bytes([1, 2, 3, 4]))]
    images = spark.createDataFrame(rows, "path string, height int, width int, channels int, pixels binary")
    sizes = {r["path"]: (r["tile"], r["pixel_values"] and len(r["pixel_values"])) for r in inference.resize(images, size=4).collect()}
    assert sizes == {"a": (None, None), "b": (0, 48)}
    packed = {r["path"]: r["num_tiles"] for r in inference.pack_tiles(images, size=4).collect()}
    assert packed == {"a": 0, "b": 1}


class Counter:
    built = 0

    def __init__(self):
        Counter.built += 1
        self.serial = Counter.built

    def __call__(self, row):
        return {"id": row["id"], "twice": row["id"] * 2, "serial": self.serial}


def test_row_class_is_built_once_per_task(spark):
    out = inference.map_rows(spark.range(0, 100, 1, 2), Counter, "id bigint, twice bigint, serial int").collect()
    assert sorted(r["twice"] for r in out) == [2 * i for i in range(100)]
    assert len({r["serial"] for r in out}) <= 2


def test_batches_have_the_asked_size(spark):
    def make():
        return lambda batch: pd.DataFrame({"n": [len(batch)], "total": [int(batch["id"].sum())]})

    out = inference.score(spark.range(0, 100, 1, 1), make, "n bigint, total bigint", batch_size=12).collect()
    assert sum(r["n"] for r in out) == 100 and max(r["n"] for r in out) == 12 and sum(r["total"] for r in out) == 4950
    assert inference.score(spark.range(10), make, "n bigint, total bigint", num_partitions=3).rdd.getNumPartitions() == 3


def test_column_function_keeps_order_and_length(spark):
    upper = inference.as_column(lambda: lambda s: s.str.upper())
    rows = spark.createDataFrame([(c,) for c in "abcxyz"], "c string").select("c", upper("c").alias("u")).collect()
    assert all(r["u"] == r["c"].upper() for r in rows)


def test_pipeline_is_one_stage(spark):
    shout = inference.as_column(lambda: lambda s: s + "!")
    out = inference.pipeline(spark.createDataFrame([("a", b"xx")], "t string, content binary"),
                             [lambda d: d.withColumn("n", F.length("content")), lambda d: d.withColumn("t", shout("t"))],
                             drop=["content"])
    assert tuple(out.first()) == ("a!", 2)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
