"""Whitening, phrase mining and url verdicts against plain recomputations."""

import collections
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quern.llm import phrases, queries, urls, whitening


def spread(rows, dims, seed=5):
    draw = np.random.default_rng(seed)
    return draw.standard_normal((rows, dims)) @ draw.standard_normal((dims, dims)) / 4


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("row", T.StringType()), T.StructField("vector", T.IntegerType()), T.StructField("deviation", T.LongType())])


def vector_frame(spark, vectors):
    return spark.createDataFrame([(k, v, "r", 3, 4) for k, v in enumerate(vectors)], VECTORS).repartition(3)


class TestEigenvectors:
    @pytest.mark.parametrize("values", [
        np.arange(40, 0, -1.0), np.ones(12), np.r_[np.ones(30) + 1e-11 * np.arange(30), np.arange(1, 11) * 1e-3],
        10.0 ** -np.arange(0, 9, 0.5), np.r_[5.0, 5.0, 2.0, 0.0, 0.0], np.array([3.0]), np.array([3.0, 1.0])])
    def test_against_numpy(self, values):
        basis = np.linalg.qr(np.random.default_rng(2).standard_normal((len(values), len(values))))[0]
        matrix = basis @ np.diag(values) @ basis.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = whitening.leading_components(matrix, 32)
        expected = np.linalg.eigvalsh(matrix)[::-1]
        expected = expected[expected > 1e-13 * expected[0]][:32]
        assert np.allclose(found, expected, rtol=1e-9, atol=1e-14)
        assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-13
        assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-13 * max(values)

    def test_sturm_counts(self):
        diag, off = np.array([2.0, 1.0, -1.0, 0.5]), np.array([0.3, 0.0, 0.7])
        exact = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
        at = np.linspace(-3, 4, 50)
        assert whitening.counts_below(diag, off, at).tolist() == [(exact < x).sum() for x in at]

    def test_nothing_varies(self):
        assert len(whitening.leading_components(np.zeros((3, 3)), 2)[0]) == 0


class TestWhitening:
    def check(self, frame, vectors, components=32):
        kept = {k: v for k, v in enumerate(vectors) if v is not None and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)}
        x = np.floor(np.array([np.float32(v) for v in kept.values()], float) * 64).astype(int) + 1_000_000
        y = x - x.mean(axis=0)
        covariance = y.T @ y / len(x)
        values, basis = np.linalg.eigh(covariance)
        values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
        expected = dict(zip(kept, y @ basis / np.sqrt(values)))
        model = whitening.fit(frame, components=components)
        rows = {r.vec_id: r for r in whitening.whiten(frame, model).collect()}
        assert model.n == len(kept) and rows.keys() == kept.keys()
        got = np.array([rows[k].whitened for k in kept])
        want = np.array([expected[k] for k in kept])
        assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-8)
        exact = [sum((len(x) * int(c) - int(s)) ** 2 for c, s in zip(row, x.sum(axis=0))) for row in x]
        assert [rows[k].deviation for k in kept] == exact
        assert np.allclose(model.values / model.trace, values / np.trace(covariance))
        assert whitening.identity_error(frame, model) < 1e-9
        return rows

    def test_odd_rows(self, spark):
        vectors = [v.tolist() for v in spread(300, 6)]
        vectors += [None, [], [1.0] * 5, [None] + [1.0] * 5, [float("nan")] * 6, [float("inf")] + [0.0] * 5, vectors[0], vectors[0]]
        rows = self.check(vector_frame(spark, vectors), vectors)
        assert rows[0].row.row == "r" and rows[0].row.deviation == 4 and rows[0].whitened == rows[306].whitened

    def test_fewer_components(self, spark):
        vectors = [v.tolist() for v in spread(80, 6, 3)]
        self.check(vector_frame(spark, vectors), vectors, 2)

    def test_empty_and_equal(self, spark):
        for vectors in ([], [None], [[1.0, 2.0]] * 5, [[]]):
            frame = vector_frame(spark, vectors)
            model = whitening.fit(frame)
            assert len(model.values) == 0 and whitening.identity_error(frame, model) == 0.0
            assert [r.whitened for r in whitening.whiten(frame, model).collect()] == [[] for v in vectors if v and len(v) == model.dims]

    def test_huge_entries(self, spark):
        vectors = [[3e30, 1.0], [1e15, 2.0], [-1e15, 0.5], [0.0, 7.0]]
        frame = vector_frame(spark, vectors)
        model = whitening.fit(frame)
        rows = {r.vec_id: r.deviation for r in whitening.whiten(frame, model).collect()}
        # 3e30 has no place on the grid; the entries of the first dimension sum up to nothing
        assert model.n == 3 and rows == {1: None, 2: None, 3: sum((3 * int(64 * c) - int(64 * s)) ** 2 for c, s in ((0.0, 0.0), (7.0, 9.5)))}

    def test_long_sums_are_exact(self):
        model = whitening.Whitening(3, (10 ** 13 + 1, 2), np.zeros(0), np.zeros((0, 2)), 0.0, 64.0, 0)
        x = np.array([[10 ** 12 // 3, 1]])
        d = 3 * (10 ** 12 // 3) - 10 ** 13 - 1
        assert model.deviations(x) == [None if d * d + 1 >= 1 << 63 else d * d + 1]

    def test_query(self, spark, tiny):
        rows = queries.op11_whitening(spark, tiny).collect()
        given = spark.read.parquet(f"{tiny}/embeddings.parquet").collect()
        x = np.floor(np.array([r.embedding for r in given], float) * 64) + 1_000_000
        y = x - x.mean(axis=0)
        values, basis = np.linalg.eigh(y.T @ y / len(x))
        values = values[::-1]
        assert len(rows) == len(given) * 32 and {r.n for r in rows} == {len(given)} and max(r.identity_error for r in rows) < 1e-9
        place = {r.vec_id: k for k, r in enumerate(given)}
        got = np.zeros((len(given), 32))
        for r in rows:
            got[place[r.vec_id], r.component - 1] = r.whitened
            assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
        want = y @ basis[:, ::-1][:, :32] / np.sqrt(values[:32])
        assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-7)


def plain_phrases(rows, least, cover=50, top=2000):
    """Rows of (lang, text) to the ranked phrases, by counting everything."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    for (lang, w), a in f.items():
        if a < least or len(w) < 2:
            continue
        score, _, l, r = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        if len(w) == 2 and any(100 * b >= cover * a for (o, x), b in f.items() if o == lang and len(x) == 3 and b >= least and w in (x[:2], x[1:])):
            continue
        found[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, all_of in found.items()
            for rank, (s, a, p, l, r) in enumerate(sorted(all_of)[:top], 1)}


def frame_of(spark, rows):
    return spark.createDataFrame([(k, t, lang, 1) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, score int").repartition(3)


ODD = [(None, "A b c. A b c! a B c"), ("und", "a b  c\ta b"), ("en", None), ("en", ""), ("fr", " \t\n;.,"), ("en", "x" * 5000),
       ("en", "to be or not to be, " * 30), ("en", "TO BE\x0bor\x0cnot\rto be"), ("zh", "中文 字 中文 字 中文 字 É É É é é é 😀 😀"), ("en", "same same same same same"),
       ("en", "same same same same same"), ("l\u2028", "no\u00a0break here no\u00a0break here no\u00a0break here")]


class TestPhrases:
    def test_odd_rows(self, spark):
        for least in (2, 3, 10):
            got = {tuple(r) for r in phrases.top_phrases(frame_of(spark, ODD), least).collect()}
            assert got == plain_phrases(ODD, least)

    def test_small_slices_filters_and_lists(self, spark):
        got = {tuple(r) for r in phrases.top_phrases(frame_of(spark, ODD), 2, cover=70, top=3, size=64, part_bytes=200, filter_bits=3).collect()}
        assert got == plain_phrases(ODD, 2, 70, 3)

    def test_given_texts(self, spark, tiny):
        rows = [(r.lang, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
        got = {tuple(r) for r in queries.op12_phrases(spark, tiny).collect()}
        assert got == plain_phrases(rows, 10) and len(got) > 100

    def test_one_long_text(self, spark):
        rows = [("en", " ".join(f"w{k * k % 89}" for k in range(40_000)) + "." + "y" * 3000 + " z")]
        got = {tuple(r) for r in phrases.top_phrases(frame_of(spark, rows), size=5000).collect()}
        assert got == plain_phrases(rows, 10)

    def test_empty_table(self, spark):
        assert phrases.top_phrases(frame_of(spark, []).where("false")).collect() == []

    @settings(max_examples=60, deadline=None)
    @drawn(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 30)), max_size=40), max_size=12), st.integers(2, 12))
    def test_summary_keeps_all_frequent(self, batches, least):
        total = collections.Counter()
        for batch in batches:
            for key, many in batch:
                total[key] += many
        summary = phrases.Summary(sum(total.values()) // least + 1)
        for batch in batches:
            one = collections.Counter()
            for key, many in batch:
                one[key] += many
            summary.add(np.array(sorted(one), np.uint64), np.array([one[k] for k in sorted(one)], np.int64))
            summary._merge()
        keys, counts = summary.counters()
        found = dict(zip(keys.tolist(), counts.tolist()))
        assert summary.taken < least and len(found) <= summary.capacity
        for key, many in total.items():
            assert found.get(key, 0) <= many <= found.get(key, 0) + summary.taken
            assert many < least or key in found

    def test_summary_is_bounded(self):
        summary = phrases.Summary(1000)
        tracemalloc.start()
        for k in range(40):
            summary.add(np.arange(k * 100_000, (k + 1) * 100_000, dtype=np.uint64), np.ones(100_000, np.int64))
        assert len(summary.counters()[0]) <= 1000 and tracemalloc.get_traced_memory()[1] < 40e6
        tracemalloc.stop()

    def test_scores_beyond_64_bits(self, spark):
        a, l, r = 3_000_000_000, 4_000_000_000, 3_500_000_000
        counts = spark.createDataFrame([("en", "a b", 2, a), ("en", "a", 1, l), ("en", "b", 1, r)], "lang string, phrase string, length int, f long")
        assert phrases.scored(counts).first().score == 10 ** 6 * a * a // (l * r)

    def test_slices_cut_no_word(self):
        text = b"ab cd.ef " * 50 + b"q" * 400 + b" end"
        parts = list(phrases._slices(text, 64))
        assert b"".join(parts) == text and all(len(p) <= 64 or b"q" * 400 in p for p in parts)
        assert all(p[:1] in b" ." for p in parts[1:])


ENTRIES = [*queries.URL_ENTRIES, ("block", "spam.org", ""), ("allow", "spam.org", ""), ("allow", "org", "/a/b/c/d"), ("block", "b.org", "/a/"),
           ("allow", "", "/free"), ("block", "UPPER.de", "/x"), ("block", "de", "/x/y"), ("allow", "q.de", "/x/")]
URLS = [None, "", "no scheme", "http://example.com/en/1", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://a.example.com/fr/", "x://net/es/",
        "x://anet/es/", "x://deep.a.b.net/fr/q://other.com/", "http://com/", "http://com", "http://spam.org", "http://x.spam.org?q", "http://b.org/a/b/c/dd",
        "http://b.org/a/b/c", "http://c.b.org/a/", "http://zz/free", "http://zz/freedom", "http://upper.de/xy", "http://upper.de/x/y/z", "http://q.de/x/y",
        "http://é.COM/É?\n", "http://ÀB.com\n/en/", "://", ":///en/", "http://user@example.com:80/en/", "http://example.com:80/en/", "http://example.com./en/",
        "http://" + "a." * 2000 + "com/" + "/" * 5000, "http://example.com/en", "http://example.com/EN/", "http://example.com//en/"]


def plain_verdict(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for verdict, h, p in ENTRIES:
        h = h.lower()
        if (host == h or host.endswith("." + h) or not h) and path.startswith(p):
            best = max(best or (), (len(h + p), len(h), verdict, h + p))
    return host, path, best[3] if best else None, best[2] if best else "allow"


class TestUrls:
    @pytest.mark.parametrize("limits", [{}, {"broadcast_entries": 2}, {"broadcast_bytes": 10}])
    def test_against_all_entries(self, spark, limits):
        schema = "page_id long, url string, host string, rule int, row string"
        pages = spark.createDataFrame([(k, u, "other", 1, "r") for k, u in enumerate(URLS + URLS[:5])] + [(None, URLS[3], None, None, None)], schema).repartition(3)
        entries = spark.createDataFrame(ENTRIES, "verdict string, host string, path string")
        rows = urls.judge(pages, entries, **limits).collect()
        assert len(rows) == len(URLS) + 6 and sum(r.page_id is None for r in rows) == 1
        for r in rows:
            url = URLS[3] if r.page_id is None else (URLS + URLS[:5])[r.page_id]
            assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(url), url
            assert r.row.row == (None if r.page_id is None else "r")

    def test_empty_tables(self, spark):
        pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
        entries = spark.createDataFrame(ENTRIES, "verdict string, host string, path string")
        assert urls.judge(pages.where("false"), entries).collect() == []
        for limit in (10, -1):
            row = urls.judge(pages, entries.where("false"), default="block", broadcast_entries=limit).first()
            assert (row.rule, row.verdict) == (None, "block")

    def test_odd_verdicts_raise(self, spark):
        pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
        with pytest.raises(ValueError):
            urls.judge(pages, spark.createDataFrame([("maybe", "a", "b")], "verdict string, host string, path string"))

    def test_deep_trie(self):
        deep = "/".join(["", *["s"] * 3000, ""])
        trie = urls.Trie([("block", "a.b", deep)])
        assert trie.match("c.a.b", deep + "x") == ("a.b" + deep, "block") and trie.match("c.a.b", deep[:-1]) is None
