import datetime
import struct
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import clean
from quern.sources import media, synth, tables
from quern.streaming.ingest import ingest_files


def png(path, width, height, colour):
    """An RGB PNG of one colour."""
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + bytes(colour) * width for _ in range(height))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
                     + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def wav(path, samples, channels):
    with wave.open(str(path), "wb") as out:
        out.setnchannels(channels)
        out.setsampwidth(2)
        out.setframerate(22050)
        out.writeframes(np.asarray(samples, "<i2").tobytes())


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("39.0, State-gov ,77516.0\n50.0, ?,83311.0\n")
    df = clean.trim_strings(tables.read_csv(spark, str(tmp_path), "age double, workclass string, fnlwgt double"), "?")
    assert [tuple(r) for r in df.orderBy("age").collect()] == [(39.0, "State-gov", 77516.0), (50.0, None, 83311.0)]


def test_csv_with_header_and_bad_number(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,q\nx,3\ny,oops\n")
    df = tables.read_csv_typed(spark, str(tmp_path), {"q": "int"})
    assert sorted((r["id"], r["q"]) for r in df.collect()) == [("x", 3), ("y", None)]
    assert tables.read_csv_typed(spark, str(tmp_path)).schema["q"].dataType.typeName() == "string"


def test_binary_folders_and_listing(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / f"{folder}.bin").write_bytes(folder.encode() * 3)
    (tmp_path / "a" / "note.txt").write_text("x")
    both = [str(tmp_path / "a"), str(tmp_path / "b")]
    df = tables.read_binary(spark, both, "*.bin")
    assert df.columns == ["path", "modificationTime", "length", "content"]
    assert sorted(bytes(r["content"]) for r in df.collect()) == [b"aaa", b"bbb"]
    listed = tables.list_files(spark, both)
    assert sorted(r["name"] for r in listed.collect()) == ["a.bin", "b.bin", "note.txt"]
    assert all(r["file_path"].startswith("/") and ":" not in r["file_path"] for r in listed.collect())


def test_empty_frame_and_append_all(spark):
    empty = tables.empty_like(spark, tables.BINARY_FILE_SCHEMA)
    assert empty.count() == 0
    out = tables.append_all([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string")])
    assert sorted((r["a"], r["b"]) for r in out.collect()) == [(1, None), (2, "x")]


def test_namespace_tables_and_modes(spark):
    tables.ensure_namespace(spark, "shop")
    tables.ensure_namespace(spark, "shop")
    name = "shop.items"
    tables.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), name)
    tables.save_table(spark.createDataFrame([(3, "c", 9)], "id int, v string, w int"), name, "append", merge_schema=True)
    assert spark.table(name).where("id = 1").first()["w"] is None and spark.table(name).count() == 3
    tables.save_table(spark.createDataFrame([(4, "d", 1)], "id int, v string, w int"), name, "append")
    tables.save_table(spark.createDataFrame([(1, "z", 7), (5, "e", 8)], "id int, v string, w int"), name, "merge", key="id")
    assert sorted((r["id"], r["v"]) for r in spark.table(name).collect()) == [
        (1, "z"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    tables.save_table(spark.createDataFrame([("only",)], "s string"), name)
    assert spark.table(name).columns == ["s"]
    found = tables.sql(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE s = :s", t=name, s="only")
    assert found.first()["n"] == 1
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_feature_table_checks_its_key(spark):
    tables.ensure_namespace(spark, "shop")
    with pytest.raises(ValueError):
        tables.check_key(spark.createDataFrame([(1,), (1,)], "id int"), "id")
    with pytest.raises(ValueError):
        tables.check_key(spark.createDataFrame([(None,), (1,)], "id int"), "id")
    tables.create_feature_table(spark.createDataFrame([(1,), (2,)], "id int"), "shop.features", "id")
    with pytest.raises(ValueError):
        tables.create_feature_table(spark.createDataFrame([(1,)], "id int"), "shop.features", "id")
    tables.drop_table(spark, "shop.features")


def test_upsert_hot_key_keeps_newest(spark):
    base = spark.createDataFrame([(1, 0), (2, 0)], "k int, v int")
    changes = spark.range(500).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("v"))
    out = tables.upsert(base, changes, "k", [F.col("v").desc()])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 499), (2, 0)]


def test_dedup_limits_rows_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    out = clean.dedup_by_key(df, ["k"], [F.col("id").desc()])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 998), (1, 999)]
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_keys(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (2, "x")], "a int, b string")
    ids = [r["id"] for r in clean.add_key(df).collect()]
    assert len(set(ids)) == 3 and ids == [r["id"] for r in clean.add_key(df.repartition(3)).orderBy("a", F.col("b").asc_nulls_first()).collect()]
    assert len({r["id"] for r in clean.add_key(df, cols=[]).collect()}) == 3


def test_parse_dates(spark):
    df = clean.parse_dates(spark.createDataFrame([("2011-01-29",)], "d string"), "d")
    assert df.first()["d"] == datetime.date(2011, 1, 29)


def test_synthetic_spec_and_rows(spark):
    df = spark.createDataFrame([(17.0, "a", "p"), (95.0, "b", "q"), (20.0, None, "r")], "age double, job string, place string")
    spec = synth.synth_spec_from(df, max_literal=2)
    assert spec["age"] == {"min": 17.0, "max": 95.0, "step": 1} and spec["job"] == {"values": ["a", "b"]}
    assert "domain" in spec["place"]
    out = synth.synth_table(spark, 4000, spec)
    rows = out.collect()
    assert len(rows) == 4000 and sorted(r["row_id"] for r in rows) == list(range(4000))
    ages = {r["age"] for r in rows}
    assert ages == {float(a) for a in range(17, 96)}
    assert {r["place"] for r in rows} == {"p", "q", "r"} and {r["job"] for r in rows} == {"a", "b"}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, synth.synth_table(spark, 4000, spec, partitions=3).collect()))


def test_synthetic_whole_numbers_and_days_keep_their_type(spark):
    df = spark.sql("SELECT * FROM VALUES (3L, 1, DATE '2020-02-27', TIMESTAMP '2020-01-01 10:00:00'), "
                   "(5L, 2, DATE '2020-03-01', TIMESTAMP '2020-01-02 00:00:00'), (null, null, null, null) t(a, b, day, at)")
    out = synth.synth_table(spark, 400, synth.synth_spec_from(df))
    assert [f.dataType for f in out.schema.fields[1:]] == [f.dataType for f in df.schema.fields]
    rows = out.collect()
    assert {r["a"] for r in rows} == {3, 4, 5} and {r["b"] for r in rows} == {1, 2}
    assert {r["day"] for r in rows} == {datetime.date(2020, 2, d) for d in (27, 28, 29)} | {datetime.date(2020, 3, 1)}
    assert {r["at"] for r in rows} == {datetime.datetime(2020, 1, d) for d in (1, 2)}
    empty = synth.synth_spec_from(df.where("a is null"))
    assert all(v["values"] == [None] for v in empty.values())
    assert synth.synth_table(spark, 2, empty).schema["day"].dataType == df.schema["day"].dataType


def test_wav_mono_and_stereo(spark, tmp_path):
    wav(tmp_path / "mono.wav", [0, 16384, -32768, 32767], 1)
    wav(tmp_path / "stereo.wav", [0, 16384, -32768, 32767], 2)
    df = media.read_wav(spark, str(tmp_path))
    rows = {r["channels"]: r for r in df.withColumn("right", media.channel("array", "channels", 1)).collect()}
    assert rows[1]["array"] == pytest.approx([0, 0.5, -1, 0.99997], abs=1e-5)
    assert rows[2]["right"] == pytest.approx([0.5, 0.99997], abs=1e-5) and rows[2]["frame_rate"] == 22050


def test_images(spark, tmp_path):
    png(tmp_path / "a.png", 30, 20, (255, 0, 0))
    (tmp_path / "broken.png").write_bytes(b"no image")
    rows = media.read_images(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r["width"], r["height"], r["channels"]) for r in rows] == [(30, 20, 3), (None, None, None)]
    assert bytes(rows[0]["pixels"][:3]) == bytes((0, 0, 255)) and rows[0]["error"] is None
    assert rows[1]["path"].endswith("broken.png") and rows[1]["pixels"] is None and rows[1]["error"]


def filtered_png(pixels, colour_type):
    """A PNG whose rows go through all five filters in turn."""
    height, width, step = pixels.shape
    raw, above = b"", np.zeros(width * step, int)
    for y in range(height):
        line = pixels[y].ravel().astype(int)
        left = np.concatenate([np.zeros(step, int), line[:-step]])
        corner = np.concatenate([np.zeros(step, int), above[:-step]])
        guess = left + above - corner
        gaps = [abs(guess - left), abs(guess - above), abs(guess - corner)]
        paeth = np.where((gaps[0] <= gaps[1]) & (gaps[0] <= gaps[2]), left, np.where(gaps[1] <= gaps[2], above, corner))
        minus = [np.zeros_like(line), left, above, (left + above) // 2, paeth][y % 5]
        raw += bytes([y % 5]) + ((line - minus) % 256).astype(np.uint8).tobytes()
        above = line

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, colour_type, 0, 0, 0)
    return media.PNG_SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images_of_a_content_column(spark, tmp_path):
    random = np.random.default_rng(7)
    (tmp_path / "rgb.png").write_bytes(filtered_png(random.integers(0, 256, (11, 6, 3)), 2))
    (tmp_path / "grey.png").write_bytes(filtered_png(random.integers(0, 256, (10, 9, 1)), 0))
    (tmp_path / "broken.png").write_bytes(b"no image")
    files = tables.read_binary(spark, str(tmp_path), "*.png").select("path", "length", "content", F.lit(1).alias("width"))
    got = {r["path"].rsplit("/", 1)[-1]: r for r in media.decode_images(files).collect()}
    assert list(got["rgb.png"].asDict()) == ["path", "length", "height", "width", "channels", "pixels", "error"]
    for r in media.read_images(spark, str(tmp_path)).collect():
        mine = got[r["path"].rsplit("/", 1)[-1]]
        assert [mine[c] for c in ("height", "width", "channels", "pixels")] == [r[c] for c in ("height", "width", "channels", "pixels")]
        assert bool(mine["error"]) == bool(r["error"])
    more = spark.createDataFrame([(1, None), (2, b""), (3, filtered_png(random.integers(0, 256, (3, 2, 4)), 6))], "id int, body binary")
    rows = {r["id"]: r for r in media.decode_images(more, "body").collect()}
    assert rows[1]["error"] == "no content" and rows[2]["pixels"] is None and rows[2]["error"]
    assert (rows[3]["channels"], len(rows[3]["pixels"])) == (3, 18)
    own = media.decode_images(more, "body", decode=lambda raw: np.full((1, 2, 1), len(raw), np.uint8))
    assert [(r["width"], r["error"]) for r in own.sort("id").collect()] == [(None, "no content"), (2, None), (2, None)]
    assert media.decode_images(more.limit(0), "body").count() == 0


def test_merge_rewrites_touched_partitions_only(spark, tmp_path):
    rows = [(i, i * 10, "p'" + str(i % 4)) for i in range(40)] + [(100, 0, None), (101, 1, "gone")]
    tables.save_table(spark.createDataFrame(rows, "id int, v int, part string"), "merged", partition_by=["part"])
    place = spark.table("merged").select(F.input_file_name().alias("f"), "part")
    before = {(r["part"], r["f"]) for r in place.distinct().collect()}
    changes = [(1, -1, "p'1"), (101, -2, "p'1"), (100, -3, "new"), (500, -4, "new")]
    tables.merge_partitions("merged", spark.createDataFrame(changes, "id int, v int, part string"), "id")
    spark.catalog.refreshTable("merged")
    want = {i: (v, p) for i, v, p in rows} | {i: (v, p) for i, v, p in changes}
    found = spark.table("merged").collect()
    assert len(found) == len(want) and {r["id"]: (r["v"], r["part"]) for r in found} == want
    after = {(r["part"], r["f"]) for r in place.distinct().collect()}
    assert {x for x in before if x[0] in ("p'0", "p'2", "p'3")} == {x for x in after if x[0] in ("p'0", "p'2", "p'3")}
    assert {p for p, _ in after} == {"p'0", "p'1", "p'2", "p'3", "new"}
    tables.merge_partitions("merged", spark.createDataFrame([], "id int, v int, part string"), "id")
    assert spark.table("merged").count() == len(want)
    with pytest.raises(ValueError):
        tables.save_table(spark.range(2), "flat")
        tables.merge_partitions("flat", spark.range(1), "id")
    for name in ("merged", "flat"):
        tables.drop_table(spark, name)


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, mark = (tmp_path / n for n in ("in", "out", "mark"))
    source.mkdir()
    for i in range(3):
        (source / f"{i}.bin").write_bytes(bytes([i]) * (i + 1))
    for extra in (None, 7):
        if extra:
            (source / "late.bin").write_bytes(b"late")
        query = ingest_files(spark, str(source), str(target), str(mark), "*.bin", max_files=2)
        query.awaitTermination(120)
    out = spark.read.parquet(str(target))
    assert out.count() == 4 and out.select("path").distinct().count() == 4
    assert out.where(F.col("path").endswith("late.bin")).first()["length"] == 4


def test_columns_of_nulls_are_synthesised(spark):
    from quern.sources import synth
    frame = spark.createDataFrame([(None, None, 1.0)], "a string, b double, c double")
    rows = synth.synth_table(spark, 3, synth.synth_spec_from(frame)).collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [(None, None, 1.0)] * 3
