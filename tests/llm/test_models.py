"""Pages, toxicity, and the pipeline."""

import random
import re
import time
import zlib

import numpy as np
import pytest

import corpus_pipeline
from quern.llm import html_text, jaccard, quality, queries, toxicity
from tests.llm.conftest import SCHEMA, TEXTS
from tests.oracle import compare, connect


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<!-- x", ""), ("<script>if(a<b){}</script>", ""),
    ("<article><h1>T&amp;t</h1><p>a\n  <b>b</b>c&nbsp;&#100; &lt;p&gt;<p>next<script>'</article>'</script> line</article><footer>f</footer>",
     "T&t\na bc d <p>\nnext line"),
    ("<nav><a>menu</a></nav><main><p>first</p><form>name</form><aside>side</aside><ul><li>item</ul></main><p>below", "first\nitem"),
    ("<article><p>cut off here", "cut off here"), ("<article><p>one<br>line</p><div class='comments'><p>reader says</p></div>", "one line"),
    ("<div class=\"a>b\"><article title='x>y'>quoted</article></div>", "quoted"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<head><title>t</title><body><article><p>a</article>", "a"), ("<head><title>t <b>u</b></title><article><p>a</article>", "a"),
    ("<head><script>'<div>'</script><style>p{}</style><title>t</title></head><body><article>a</article>", "a"),
    ("<article><p>a <svg class='x>y' /> b</p><p>c</p></article><svg><text>no</text></svg>", "a b\nc"),
    ("<article><p>a <svg><text>no</text> <p>b</p></article>", "a\nb"), ("<article><p>a<svg><foreignObject><p>no</p></foreignObject></svg>b</p>", "ab"),
    ("<article><p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p><math/><p>b</article>", "if x=1 then\nb"),
    ("<article><p>a<object data=x /></p><p>b</p></article>", "a\nb"), ("<article><p>a<select><option>no<p>b</p></article>", "a\nb"),
    ("<article><p>a<script>no <p>no", "a"),
])
def test_pages_with_open_raw_elements(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<div class='layout has-sidebar'><article><p>a</p></article><div class=sidebar><p>no</p></div></div>", "a"),
    ("<body><div id='page' class='with-sidebar'><article><p>a</article></div>", "a"),
    ("<div class='sticky-header'><p>no</p><main><p>a</p></main></div>", "a"), ("<div class=widget><div role='main'><p>a</div></div>", "a"),
    ("<article><p>a</p><section id='related-work'><p>b</p></section></article>", "a\nb"),
    ("<article><div class='article-header'><h1>a</h1></div><p>b</article>", "a\nb"),
    ("<article><p>a</p><div class='gdpr-overlay'>we use cookies accept all</div><aside><a>no</a></aside><p><a>b</a></p></article>", "a\nb"),
    ("<form id=f><div class='search'><article><p>a</article></div></form>", "a"),
    ("<article><p>a</p></article><div class='related-posts'><article><p>no</p></article></div>", "a"),
    ("<article><p>a</p><ol class='comment-list'><li><article class=comment-body><p>no</p></article></ol></article>", "a"),
    ("<aside><article><p>no</p></article></aside><main><p>a</main>", "a"),
])
def test_pages_with_names_of_side_parts(page, text):
    assert html_text.main_text(page) == text


def test_tree_learns_its_table():
    x, y = html_text.labelled_table()
    assert len(y) < 5000 and (html_text.tree().predict(x).round() == y).mean() > 0.999


def test_tree_without_names():
    """On pages that it has not seen, in which nothing is named, words and links of a block and its neighbours decide."""
    draw = random.Random(99)
    found = [html_text.blocks(html_text.plain_page(draw)) for _ in range(200)]
    x, y = np.concatenate([html_text.features(f) for f in found]), np.array([b.text[0] == "+" for f in found for b in f])
    said = html_text.tree().predict(x) >= 0.5
    assert (said == y).mean() > 0.99
    names = [html_text.FEATURES.index(n) for n in ("in_side", "in_main", "main_on_page", "in_main_hint")]
    plain = x[:, html_text.FEATURES.index("main_on_page")] == 0
    assert (x[plain][:, names] == 0).all() and (said[plain] == y[plain]).mean() > 0.98
    for n in ("words_before", "link_density_after", "words_after"):
        mixed = x.copy()
        mixed[:, html_text.FEATURES.index(n)] = np.random.default_rng(1).permutation(mixed[:, html_text.FEATURES.index(n)])
        assert ((html_text.tree().predict(mixed) >= 0.5) != said).any()


@pytest.mark.parametrize("page", [
    "<article><p>" + "x <y and " * 120_000, "<a " * 300_000, "<div>" * 100_000 + "x", "<svg><foreignobject>" * 50_000, '<a "x" ' * 120_000 + "'",
    "<a" * 300_000 + ' ">', "<div>" * 50_000 + "</section>x" * 50_000, "<!-" * 300_000, "<p>" + "&" * 1_000_000])
def test_long_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 8


def test_given_pages(spark, tiny):
    pages = {r.page_id: r for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    rows = queries.QUERIES["op2_html"](spark, tiny).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r.page_id].html
        article = page[page.index("<article>"):page.index("</article>")]
        words = re.sub("<[^>]*>", " ", article).replace("&amp;", "&").replace("&quot;", '"').split()
        assert r.text.split() == words and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_pages(spark):
    frame = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<article>a</article>", None), (1, None, None, "x")],
                                  "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(frame).collect()) == [(0, "a", 1), (1, "", 0), (1, "", 0)]
    assert html_text.extract(frame.limit(0)).count() == 0


def sentences(n, seed):
    draw = np.random.default_rng(seed)
    plain = [f"w{k}" for k in range(300)]
    bad = ["vilestone", "vilemark", "vileness", "rotgut", "rotten"]
    texts, labels = [], []
    for k in range(n):
        words = [plain[j] for j in draw.integers(0, 300, draw.integers(5, 120))]
        label = k % 3 == 0
        if label:
            for _ in range(3):
                words.insert(int(draw.integers(0, len(words))), bad[int(draw.integers(0, 5))])
        texts.append(" ".join(words))
        labels.append(int(label))
    return texts, labels


@pytest.fixture(scope="module")
def network():
    return toxicity.train(*sentences(400, 1))


def test_gradients_match_differences():
    texts, labels = sentences(12, 2)
    lexicon, windows, owner = toxicity.number_texts(texts)
    keep, y = np.ones(len(lexicon.rows), np.float32), np.array(labels, np.float32)[owner]

    def loss(n):
        p = toxicity.logistic(n.logits(lexicon, windows).astype(float))
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    for name in ("x", "u0", "u1", "a", "v", "w", "word", "letter"):
        n = toxicity.Network(3)
        before = {k: v.copy() for k, v in n.p.items()}
        n.step(lexicon, windows, y, np.ones(len(y), np.float32), keep)
        grad = n.m[name] * 10  # the first moment is a tenth of the gradient
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        n.p = {k: v.copy() for k, v in before.items()}
        step = 2e-2
        n.p[name][at] += step
        up = loss(n)
        n.p[name][at] -= 2 * step
        assert abs((up - loss(n)) / (2 * step) - grad[at]) < 0.1 * abs(grad[at]) + 2e-4


def test_held_out_accuracy(network):
    texts, labels = sentences(300, 9)
    score = toxicity.score_texts(network, texts)
    assert ((score >= 0.7) == np.array(labels)).mean() > 0.95


def test_every_window_counts(network):
    quiet = " ".join(f"w{k % 300}" for k in range(3000))
    loud = quiet + " vilestone rotgut vilemark"
    low, high = toxicity.score_texts(network, [quiet, loud])
    assert low < 0.7 <= high
    for n in (0, 1, 31, 32, 33, 48, 49, 100):
        _, windows, _ = toxicity.number_texts([" ".join(["w"] * n)])
        assert (windows >= 0).sum() >= n and windows.shape[1] == toxicity.WINDOW


def test_odd_rows(spark, odd, none, network):
    rows = toxicity.toxicity(odd, network).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 3 == 1)
    assert toxicity.toxicity(none, network).count() == 0 and toxicity.toxicity(odd, None).where("score != 0").count() == 0
    kept = toxicity.keep_harmless(odd, network)
    assert kept.schema == odd.schema and kept.count() > 0
    labels = spark.createDataFrame([(1, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(odd, labels) is None and toxicity.train([], []) is None


def test_training_never_sees_held_out_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, seed: seen.extend(zip(texts, labels)))
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, sample=30)
    ids = [int(t.split()[1]) for t, _ in seen]
    assert len(ids) == 60 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids) and all(i % 2 == y for i, (_, y) in zip(ids, seen))


def test_pipeline_stages(spark, tiny, tmp_path):
    """Every stage on the stored rows of the one before; its decisions are those of its operator."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    names = docs.columns
    stored = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, tiny)
        assert k == 4 or out.columns == names
        out.write.parquet(str(tmp_path / str(k)))
        stored.append((docs, spark.read.parquet(str(tmp_path / str(k)))))
        docs = stored[-1][1]
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    labels = spark.read.parquet(f"{tiny}/labels.parquet").where("quality = 1")
    before, after = stored[1]
    assert ids(after) == ids(quality.quality_rules(before, labels).where("kept"))
    before, after = stored[2]
    assert ids(after) == {r.class_id for r in jaccard.join_classes(before).collect()} and after.count() == len(ids(after))
    assert ids(stored[3][1]) == ids(stored[3][0]) == ids(stored[4][1])
    assert stored[4][1].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).where("`sum(length)` != `max(doc_tokens)`").isEmpty()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, tiny, name):
    assert compare(spark, connect(tiny), tiny, name, queries.QUERIES[name], queries.ORACLE[name]) == []


def test_queries_of_all_operators():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
