"""Sharding and quality rules against plain Python."""

import collections
import math
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quern.llm import quality, queries, sharding
from tests.llm.conftest import TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards_have_equal_rows_and_the_mixture(spark, tiny):
    out = queries.QUERIES["op1_sharding"](spark, tiny).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    assert len(out) == len(docs) and {r.law for r in out} == {"rows"}
    shards = collections.defaultdict(list)
    for r in out:
        data = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(data) + 16, zlib.crc32(data), None)
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(40))
    counts = [len(v) for v in shards.values()]
    assert max(counts) - min(counts) <= 1
    for rows in shards.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_hot_source_is_spread(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 2000, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    out = sharding.shard(frame, shards=10, buckets=16)
    counts = {(r.source, r.shard): r["count"] for r in out.groupBy("source", "shard").count().collect()}
    # a cut is off by less than one row for each source
    assert all(abs(counts["hot", s] - 200) <= 8 for s in range(10))
    assert all(abs(counts[f"s{k}", s] - 1000 / 70) <= 2 for k in range(7) for s in range(10))
    again = sharding.shard(frame.repartition(5), shards=10, buckets=16)
    assert out.exceptAll(again).isEmpty()


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    frame = spark.range(6000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.greatest(F.col("id"), F.lit(2000))).alias("text"),
        F.lit("s").alias("source"))
    keys = []

    class Recorder(sharding.Window):
        @staticmethod
        def partitionBy(*cols):
            keys.append(cols)
            return sharding.Window.__mro__[1].partitionBy(*cols)

    monkeypatch.setattr(sharding, "Window", Recorder)
    rows = sharding.shard(frame, shards=7).collect()
    expected = sorted((zlib.crc32(r.text.encode()), len(r.text) + 16) for r in frame.collect())
    assert [g[2:] for g in sorted((r.shard, r.slot, r.text_crc32, r.size) for r in rows)] == expected
    assert ("_source", "_key", "doc_id", "_cell") in keys  # the rows' own window
    assert max(collections.Counter(c >> sharding.CELL_SHIFT for c, _ in set(expected)).values()) < 20


def test_shard_odd_rows(odd, none):
    rows = sharding.shard(odd, shards=3).collect()
    assert len(rows) == len(TEXTS) and sum(r.doc_id is None for r in rows) == 2
    assert {r.size for r in rows if r.doc_id == 5} == {16} and {r.text_crc32 for r in rows if r.doc_id == 5} == {0}
    assert sorted(r.slot for r in rows if r.shard == 1) == list(range(sum(r.shard == 1 for r in rows)))
    assert sharding.shard(none).count() == 0


def base(text):
    words = WORD.findall(text)
    seen = collections.defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i:i + 3])].append(i)
    held = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(held) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(held), failed)


def grams(text, features):
    words = [w.encode() for w in WORD.findall(text)]
    hashed = lambda *w: _chain(w)
    return [hashed(w) % features for w in words] + [hashed(a, b) % features for a, b in zip(words, words[1:])]


def _chain(parts):
    """Spark's xxhash64 of several columns: each hash is the seed of the next, read as signed at the end."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def half(text):
    return _chain([text.encode(), b"half"]) % 2


def brute(docs, trusted, features):
    """Scores by the counts of the half that a text is not in."""
    raw, good = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]
    for i, text in docs:
        own = grams(text or "", features)
        raw[half(text or "")].update(own)
        if i in trusted:
            good[half(text or "")].update(own)
    for i, text in docs:
        own = grams(text or "", features)
        r, t = raw[1 - half(text or "")], good[1 - half(text or "")]
        n_r, n_t = sum(r.values()) + features, sum(t.values()) + features
        llr = sum(math.log((t[g] + 1) / n_t) - math.log((r[g] + 1) / n_r) for g in own) / max(len(own), 1)
        yield i, *base(text or ""), llr


def same(rows, expected):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                  r.base_failed, round(r.llr, 6)) for r in rows)
    want = sorted((e[0] is not None, e[0] or 0, *e[1:7], round(e[7], 6)) for e in expected)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert all(abs(g[-1] - w[-1]) < 2e-6 for g, w in zip(got, want))


def test_quality_like_brute_force(spark, tiny, given):
    labels = spark.read.parquet(f"{tiny}/labels.parquet").where("quality = 1")
    rows = queries.QUERIES["op8_quality"](spark, tiny).collect()
    trusted = {r.doc_id for r in labels.collect()}
    expected = list(brute(given, trusted, quality.FEATURES))
    same(rows, expected)
    low, high = np.percentile([round(r.llr, 4) for r in rows if r.doc_id in trusted and not r.base_failed], [25, 75])
    for r in rows:
        assert r.kept == (not r.base_failed and r.llr >= low - quality.FENCE * (high - low) - 1e-12)


def test_quality_odd_rows(spark, odd, none):
    trusted = spark.createDataFrame([(1,), (1,), (None,), (9,)], "doc_id long")
    rows = quality.quality_rules(odd, trusted, features=512).collect()
    same(rows, list(brute(TEXTS, {1, 9}, 512)))
    assert quality.quality_rules(none, trusted, features=64).count() == 0
    assert quality.quality_rules(odd, trusted.limit(0), features=64).count() == len(TEXTS)
    kept = quality.keep_good(odd, trusted, threshold=-9.0, features=512)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 9, 14]


def test_native_plans_run_no_python(spark, tiny):
    docs, labels = (spark.read.parquet(f"{tiny}/{name}.parquet") for name in ("documents", "labels"))
    frames = [queries.QUERIES["op1_sharding"](spark, tiny), queries.QUERIES["op8_quality"](spark, tiny),
              quality.gram_counts(docs, labels), quality.score(docs, [0.0] * 128, features=64)]
    for frame in frames:
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


def test_clean_documents_stay_whether_labelled_or_not(spark, tiny):
    """Per language unlabelled documents are rejected about as often as labelled ones, at two sizes; junk goes."""
    for size in ("sf0.01", "sf0.1"):
        folder = tiny.replace("sf0.001", size)
        docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
        rows = quality.quality_rules(docs, labels.where("quality = 1")).where("not base_failed") \
            .join(docs.select("doc_id", "lang"), "doc_id").join(labels, "doc_id", "left").collect()
        good = [r for r in rows if r.quality == 1]
        junk = [r for r in rows if r.quality == 0]
        assert sum(not r.kept for r in good) <= 0.02 * len(good) and sum(r.kept for r in junk) <= 0.1 * len(junk) + 1
        for lang in {r.lang for r in rows}:
            known, other = ([r for r in rows if r.lang == lang and (r.quality is None) == new] for new in (False, True))
            rate = sum(not r.kept for r in known) / max(len(known), 1)
            assert sum(not r.kept for r in other) <= (rate + 0.03) * len(other) + 3


def test_quality_without_trusted_rows(spark, odd):
    rows = quality.quality_rules(odd, odd.select("doc_id").limit(0), features=64).collect()
    assert all(r.kept == (not r.base_failed) for r in rows) and any(r.kept for r in rows)


def test_filter_on_the_verdict_is_no_copy_of_it(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    trusted = spark.read.parquet(f"{tiny}/labels.parquet").where("quality = 1")
    judged = quality.quality_rules(docs, trusted)
    size = lambda frame: len(frame._jdf.queryExecution().optimizedPlan().toString())
    for condition in ("kept", "base_failed", "not base_failed and llr < 0"):
        assert size(judged.where(condition)) < 1.1 * size(judged) + 1000
    kept = {r.doc_id for r in judged.where("kept").select("doc_id").collect()}
    assert kept == {r.doc_id for r in judged.collect() if r.kept}
