"""Encoding, packing and fingerprints."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from quern.llm import bpe, fingerprint, packing, queries
from quern.llm.words import shingle_sets
from tests.llm.conftest import TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def expected(text):
    ids = ids_of(text)
    back = TOKENIZER.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_given_documents(spark, tiny, given):
    rows = {r.doc_id: r for r in queries.QUERIES["op7_bpe"](spark, tiny).collect()}
    assert len(rows) == len(given)
    for i, text in given:
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == expected(text)


def test_odd_rows(odd, none):
    rows = bpe.encode_decode(odd, PATH).collect()
    got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    assert got == sorted(expected(t) for _, t in TEXTS)
    assert all(r.ids == ids_of(t) for r in rows for i, t in TEXTS if i == r.doc_id == 10)
    assert bpe.encode_decode(none, PATH).count() == 0


def test_any_string():
    coder, draw = bpe.PrefixEncoder(PATH), random.Random(3)
    signs = list("abcdefghi ABC\t\n\x1c\x85\xa0'stredmvl0123²Ⅷéèñß中文İΣςͅ😀…—“” ﬁ!?.") + ["<|endoftext|>", "<|startoftext|>", "'re", "the", "ing"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 50))) for _ in range(3000)]
    texts += ["".join(draw.choice("abcdetionsr") for _ in range(draw.randint(1, 30))) for _ in range(3000)]
    texts += ["a" * k for k in range(150)] + ["!" * k for k in range(40)]
    for text, found in zip(texts, TOKENIZER.encode_batch(texts, add_special_tokens=False)):
        assert coder.encode(text) == found.ids
        assert coder.decode(found.ids) == TOKENIZER.decode(found.ids, skip_special_tokens=False)


def test_memory_bound_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 7)
    coder = bpe.PrefixEncoder(PATH)
    text = "many different words that do not fit into seven places and come again: many different words"
    assert coder.encode(text) == ids_of(text) and coder.encode(text) == ids_of(text)


def test_many_texts_at_once(monkeypatch):
    draw, single = random.Random(5), []
    signs = list("abcdefghi ABC\t\n\x1c\x85\xa0'stredmvl0123²Ⅷéèñß中文İΣςͅ😀…—“” ﬁ!?.") + ["<|endoftext|>", "<|startoftext|>", "'re", "the", "ing"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 50))) for _ in range(2000)]
    texts += ["".join(draw.choice("abcdetionsr") for _ in range(draw.randint(1, 90))) for _ in range(2000)]
    texts += ["a" * k for k in range(150)] + ["!" * k for k in range(80)] + ["", "\t\n"]
    ids = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    wanted = [np.array(i, "<u4").tobytes() for i in ids]
    one_by_one = bpe.PairEncoder.word_ids
    monkeypatch.setattr(bpe.PairEncoder, "word_ids", lambda self, word: single.append(word) or one_by_one(self, word))
    plain = [k for k, t in enumerate(texts) if "<|" not in t and all(len(w.encode()) <= 32 for w in t.split())]
    assert len(plain) > 1000
    coder = bpe.PairEncoder(PATH)
    assert list(coder.ids_of_texts([texts[k] for k in plain])) == [wanted[k] for k in plain] and not single
    assert list(coder.ids_of_texts(texts)) == wanted and single
    few = bpe.PairEncoder(PATH, kept=7)
    assert [b for t in texts for b in few.ids_of_texts([t])] == wanted and list(few.ids_of_texts([])) == []
    assert list(few.ids_of_texts([None, "the"])) == [b"", np.array(ids_of("the"), "<u4").tobytes()]


def test_slices_of_a_batch():
    texts = ["x" * 10, None, "", "y" * 50, "z" * 3, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    for size in (1, 12, 1000):
        parts = list(packing.parts_of(batch, size))
        assert [t for p in parts for t in p.column(1).to_pylist()] == texts and (len(parts) == 1) == (size == 1000)
    assert list(packing.parts_of(batch.slice(0, 0))) == []


def check_pieces(rows, texts, capacity=2048):
    """Every id once, gapless sequences; returns the padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in texts:
        ids = [*ids_of(text), 1]
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing(spark, tiny, given):
    rows = queries.QUERIES["op4_packing"](spark, tiny).collect()
    assert check_pieces(rows, given) < 0.005 * sum(r.length for r in rows)


def test_packing_odd_rows(odd, none):
    own = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.pack(own, PATH, with_ids=True).collect(), dict([t for t in TEXTS if t[0]]).items())
    everything = packing.pack(odd, PATH).collect()
    assert sum(r.length for r in everything) == sum(len(ids_of(t)) + 1 for _, t in TEXTS)
    assert packing.pack(none, PATH).count() == 0


def test_forgetting_changes_nothing(odd):
    assert sorted(map(str, packing.pack(odd, PATH, remember=False).collect())) == sorted(map(str, packing.pack(odd, PATH).collect()))
    before = dict(bpe._ENCODERS)
    packing.pack(odd, PATH, remember=False).count()
    assert bpe._ENCODERS == before


def test_bins_hold_a_fixed_count():
    bins, closed = packing.Bins(64, 2), []
    for k in range(1000):
        closed += bins.add((k, 0, 1 + k * 37 % 150))
    left = list(bins.close())
    for sequence in closed:
        total = sum(p[2] for p in sequence)
        assert 62 <= total <= 64 and len({64 // p[2] for p in sequence}) == 1 and len(sequence) == 64 // sequence[0][2]
    assert all(sum(p[2] for p in s) in (1, 2, 4, 8, 16, 32, 64) for s in left)
    assert sum(p[2] for s in closed + left for p in s) == sum(1 + k * 37 % 150 for k in range(1000))


def jaccard(a, b):
    return 1.0 if not len(a) + len(b) else len(np.intersect1d(a, b)) / len(np.union1d(a, b))


def test_fingerprints(spark, tiny, given):
    rows = {r.doc_id: r for r in queries.QUERIES["op3_fingerprint"](spark, tiny).collect()}
    assert len(rows) == len(given)
    for k, (i, text) in enumerate(given):
        after = given[(k + 1) % len(given)][1]
        edited = fingerprint.edit(text, after)
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = shingle_sets([text, edited, after])
        assert abs(r.near_edited - jaccard(a, b)) < 0.15 and abs(r.near_next - jaccard(a, c)) < 0.15
        assert abs(r.n_shingles - len(a)) <= 0.3 * len(a)


def test_fingerprint_parts_and_odd_rows(odd, none):
    for parts in (1, 2, 5):
        rows = fingerprint.near_edited(odd, parts=parts).collect()
        assert len(rows) == len(TEXTS)
        by = {r.doc_id: r for r in rows}
        assert by[1].near_next == 1.0 and by[1].fingerprint == by[2].fingerprint and by[4].near_next == 1.0
        assert by[4].n_chars == by[5].n_chars == 0 and by[12].n_chars == 3000
    assert fingerprint.near_edited(none).count() == 0
    one = odd.where("doc_id = 6")
    assert fingerprint.near_edited(one).first().near_next == 1.0


def test_sketches_merge(odd):
    k = 64
    a, b = (np.sort(np.random.default_rng(s).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)) for s in (1, 2))
    both = np.union1d(a, b)
    assert (fingerprint.merge(a[:k], b[:k], k) == both[:k]).all()
    assert abs(fingerprint.distinct_count(both[:256], 256) - len(both)) < 0.25 * len(both)
    half = np.union1d(a[::2], b)
    assert abs(fingerprint.containment(a[::2][:256], half[:256], 256) - 1) < 0.25
    prints = fingerprint.fingerprint(odd, k=k)
    merged = fingerprint.merge_by(prints.selectExpr("'all' as part", "fingerprint"), "part", k=k).collect()
    whole = np.unique(np.concatenate(list(shingle_sets([t for _, t in TEXTS]))))[:k]
    assert [int(h, 16) for h in merged[0].hashes] == whole.tolist()
