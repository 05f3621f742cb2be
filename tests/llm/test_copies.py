"""Near copies, chunks and repeated strings against brute force."""

import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quern.llm import chunking, jaccard, queries, suffixes
from quern.llm.components import components
from tests.llm.conftest import TEXTS, row, SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_links(docs, threshold=0.8):
    sets = [shingles(t) for _, t in docs]
    posted = collections.defaultdict(list)
    links, up = [0] * len(docs), list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        common = collections.Counter(j for g in s for j in posted[g])
        if not s:
            common = collections.Counter({j: 0 for j in range(i) if not sets[j]})
        for j, n in common.items():
            if not s or n / (len(s) + len(sets[j]) - n) >= threshold:
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
        for g in s:
            posted[g].append(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, least.get(top(i)), links[i]) for i, (d, _) in enumerate(docs)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r))


def near_copies(n):
    words = [f"w{k}" for k in range(120)]
    out = []
    for i in range(n):
        own = list(words)
        own[i % 100] = f"edit{i}"
        out.append((i, " ".join(own)))
    return out + [(n + i, " ".join(words)) for i in range(5)]


def test_jaccard_given(spark, tiny, given):
    rows = [tuple(r) for r in queries.QUERIES["op5_jaccard"](spark, tiny).select("doc_id", "class_id", "n_links").collect()]
    assert ordered(rows) == ordered(brute_links(given))


def test_jaccard_large_group_in_blocks(spark):
    docs = near_copies(40)
    frame = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    for block in (7, 4096):
        rows = [(r.doc_id, r.class_id, r.n_links) for r in jaccard.join_classes(frame, block=block).collect()]
        assert ordered(rows) == ordered(brute_links(docs))


def test_jaccard_odd_rows(odd, none):
    rows = [(r.doc_id, r.class_id, r.n_links) for r in jaccard.join_classes(odd).collect()]
    assert ordered(rows) == ordered(brute_links(TEXTS))
    assert jaccard.join_classes(none).count() == 0
    kept = jaccard.keep_firsts(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({c if c is not None else ("none", d) for d, c, _ in brute_links(TEXTS)}) and {1, 6, 9, 13} <= set(ids)


def test_bands_meet_the_recall():
    for threshold, recall in ((0.8, 0.9995), (0.5, 0.95)):
        bands, rows = jaccard.choose_bands(threshold, recall)
        assert bands * rows <= jaccard.MAX_HASHES and 1 - (1 - threshold ** rows) ** bands >= recall
    draw = np.random.default_rng(1)
    shared = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    hits = 0
    for k in range(60):
        a, b = (np.concatenate([shared[:320], draw.integers(0, 1 << 63, 40, dtype=np.uint64)]) for _ in range(2))
        hits += bool(np.intersect1d(jaccard.band_hashes(a, 33, 7, k), jaccard.band_hashes(b, 33, 7, k)).size)
    assert hits == 60


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_strings(texts, length=200):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for k in range(len(d) - length + 1):
            if count[d[k:k + length]] > 1:
                gone[k + 1:k + 1 + length] = True
        kept = bytes(b for b, g in zip(d, gone[1:]) if not g)
        out.append((len(d), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def digest(rows):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def test_suffixes_given(spark, tiny, given):
    rows = queries.QUERIES["op10_suffixes"](spark, tiny).collect()
    assert len(rows) == len(given) and digest(rows) == sorted(brute_strings([t for _, t in given]))


def test_suffixes_odd_rows(odd, none):
    texts = [t for _, t in TEXTS]
    assert digest(suffixes.dedup_suffixes(odd).collect()) == sorted(brute_strings(texts))
    assert suffixes.dedup_suffixes(none).count() == 0


def test_suffixes_split_groups(spark):
    common = "".join(chr(97 + k * k % 26) for k in range(260))
    texts = [f"{k} begins {k * 7} " + common + f" ends {k % 9} {k}" for k in range(60)] + [common * 3]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for split in (5, 1000):
        assert digest(suffixes.dedup_suffixes(frame, split=split).collect()) == sorted(brute_strings(texts))


def edges_of_a_passage(n):
    """Documents that share a passage and nothing around it; the strings over its edges share grams inside."""
    draw = np.random.default_rng(n)
    own = lambda k: bytes(draw.integers(97, 123, k).tolist()).decode()
    common = own(230)
    return [own(150) + common + own(150) for _ in range(n)]


def test_suffixes_hot_gram_grows_with_its_runs(spark):
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return store.executorSummary("driver").totalShuffleWrite()

    grown = []
    for n in (300, 600):
        texts = edges_of_a_passage(n)
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        before = shuffled()
        rows = suffixes.dedup_suffixes(frame, split=4).collect()
        assert digest(rows) == sorted(brute_strings(texts)) and all(r.n_removed >= 230 for r in rows)
        grown.append(shuffled() - before)
    assert grown[1] < 2.5 * grown[0]


def test_index_family_merges():
    draw = np.random.default_rng(4)
    text = np.frombuffer(bytes(draw.integers(97, 99, 3000).tolist()), np.uint8)
    for batch in (50, 700, 5000):
        family = suffixes.IndexFamily(text, 12, batch)
        places = np.arange(len(text) - 11)
        family.add(draw.permutation(places))
        count = collections.Counter(bytes(text[k:k + 12]) for k in places)
        assert family.finish()[places].tolist() == [count[bytes(text[k:k + 12])] > 1 for k in places]


def test_chunks_resist_insertions():
    words = [f"v{k * 7919 % 5003}" for k in range(600)]
    a, b = " ".join(words).encode(), ("one more " + " ".join(words[:300] + ["inserted", "here"] + words[300:])).encode()
    sets = [{t[x:y] for x, y in zip(c, c[1:])} for t, c in zip((a, b), chunking.boundaries([a, b]))]
    assert len(sets[0] - sets[1]) <= 6 and len(sets[0]) > 40
    for text in (b"", b"x", "é".encode() * 3000, b" ", " ".join(words).encode()):
        cuts = chunking.boundaries([b"before", text, b"after"])[1]
        assert b"".join(text[x:y] for x, y in zip(cuts, cuts[1:])) == text
        for x, y in zip(cuts, cuts[1:]):
            text[x:y].decode()


def brute_chunks(docs):
    """The same rule in plain Python: first of equal chunks stays, runs of 100 bytes go."""
    first, cuts = {}, {}
    for i, t in sorted(docs):
        data = t.encode()
        cuts[i] = chunking.boundaries([data])[0]
        for x, y in zip(cuts[i], cuts[i][1:]):
            first.setdefault(data[x:y], (i, x))
    out = {}
    for i, t in docs:
        data, gone = t.encode(), []
        for x, y in zip(cuts[i], cuts[i][1:]):
            if first[data[x:y]] != (i, x):
                gone = gone[:-1] + [(gone[-1][0], y)] if gone and gone[-1][1] == x else gone + [(x, y)]
        gone = [(x, y) for x, y in gone if y - x >= chunking.MIN_RUN]
        kept, at = b"", 0
        for x, y in gone:
            kept, at = kept + data[at:x], y
        out[i] = ((kept + data[at:]).decode(), len(gone))
    return out


def test_chunks_given(spark, tiny, given):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_chunking"](spark, tiny).collect()}
    expected = brute_chunks(given)
    assert {i: (r.text, r.n_spans) for i, r in rows.items()} == expected
    assert sum(r.n_removed for r in rows.values()) > 0


def test_passages_go_and_clean_texts_stay(spark):
    passage = " ".join(f"common{k}" for k in range(60))
    docs = [(k, " ".join(f"own{k}n{j}" for j in range(50)) + " " + passage + " " + " ".join(f"end{k}n{j}" for j in range(50)))
            for k in range(10)] + [(99, " ".join(f"clean{j}" for j in range(100)))]
    rows = {r.doc_id: r for r in chunking.dedup_chunks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[0].n_removed == rows[99].n_removed == 0
    for k in range(1, 10):
        assert 0.6 * len(passage) < rows[k].n_removed <= len(passage) + 10
        assert f"own{k}n49" in rows[k].text and f"end{k}n10" in rows[k].text


def test_chunks_odd_rows(odd, none):
    out = chunking.without_repeats(odd)
    assert out.columns == odd.columns
    rows = collections.defaultdict(list)
    for r in out.collect():
        rows[r.doc_id].append(r)
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert rows[1][0].text == TEXTS[0][1] and rows[2][0].text == "" and rows[2][0].n_chars == 0
    assert [r.text for r in rows[13]] == ["same row"] * 2 and rows[5][0].text == "" and rows[9][0].lang == "en"
    assert chunking.dedup_chunks(none).count() == 0


def test_rows_of_one_id_with_like_hashes(spark):
    """Two texts without an id whose hashes share 32 bits lose what two documents with ids of their own would lose."""
    passage = " ".join(f"passage{k}" for k in range(60))
    seen, pair = {}, None
    for k in range(600_000):
        text = f"first {k} " * 3 + passage if k % 2 else passage + f" last {k}" * 9
        high = xxhash.xxh64_intdigest(text.encode(), 42) >> 32
        if high in seen and seen[high][1] % 2 != k % 2:
            pair = [seen[high][0], text]
            break
        seen.setdefault(high, (text, k))
    assert pair is not None
    for find in (suffixes.dedup_suffixes, chunking.dedup_chunks):
        kept = []
        for ids in ([None, None], [1, 2]):
            docs = spark.createDataFrame(list(zip(ids, pair)), "doc_id long, text string")
            kept.append(sorted(r.n_removed for r in find(docs).collect()))
        assert kept[0] == kept[1] and kept[0][1] > 0
