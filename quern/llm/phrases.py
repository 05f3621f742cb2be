"""Collocations: phrases of two and three words that occur often and whose parts seldom occur apart.

Texts are lower-cased (A-Z only) and cut at ``. , ; : ! ?`` and line ends into pieces, pieces at spaces and tabs into
words; nothing else is white space.  A null text is empty, a null language is ``und``; empty texts have no words.  Rows
count one by one, repeated rows too.  A table without words gives no rows.

**First pass.**  Every task counts the phrases of one to three words of some megabytes of text, in numbers of one
dictionary, and sends each hash partition one summary of its counts.  A summary is ``mass`` and 48 bits of a hash with a
count for each phrase.  The partition adds up the masses first, which are sorted in front, and then merges summaries by the rule of
Misra and Gries with ``mass // least + 1`` counters: beyond that many, the largest counter that does not fit is taken off all.  What
is taken off in all is below ``least``, so every phrase that occurs ``least`` times survives, in memory that does not
depend on the number of different phrases.

**Second pass.**  The survivors' hashes become a table of bits of bounded size, made slice by slice by the partitions
and broadcast.  Phrases whose bit is not set are left out where they stand; all others are counted exactly, by their
words and not by a hash, in a plain aggregation.  A table that is too small for its survivors costs shuffle, not rows.

Long texts are worked on in slices; the last two words of a slice are carried over, and each phrase is counted in the
slice in which it ends.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.words import mix
from quern.session import ensure_checkpoint_dir

LEAST, COVER, TOP = 10, 50, 2000
#: Bytes of text that are counted at once.  Words of more than two bytes and their spaces keep numbers below 2 ** 21.
SLICE = 6 << 20
#: Bytes of text for which there is a hash partition, at least.
PART_BYTES = 128 << 20
#: The bits of the broadcast table, as a power of two, at most.
FILTER_BITS = 28

ID_BITS, HASH_BITS = 21, 48
BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"."
_TABLE = bytes(ord(".") if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MASK = np.int64((1 << ID_BITS) - 1)
_GAP = np.zeros(2, np.int64)


class _Numbers(dict):
    """Words by the order in which they are first met; the break has the number 0."""

    def __init__(self) -> None:
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """Stretches of about ``size`` bytes, cut in front of spaces and breaks; a word is never cut."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(c, start + 1, start + size) for c in (b" ", _BREAK))
        if cut < 0:
            cut = min((at for at in (text.find(c, start + size) for c in (b" ", _BREAK)) if at >= 0), default=-1)
            if cut < 0:
                break
        yield text[start:cut]
        start = cut
    yield text[start:]


def count_slice(ids: np.ndarray) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """Words behind the first two, and per length the phrases that end there as packed numbers, with their counts."""
    last, before, first = ids[2:], ids[1:-1], ids[:-2]
    out = []
    whole = last > 0
    packed = last
    for length, other in ((1, None), (2, before), (3, first)):
        if other is not None:
            whole = whole & (other > 0)
            packed = other << (length - 1) * ID_BITS | packed
        out.append(np.unique(packed[whole], return_counts=True))
    return int(np.count_nonzero(last)), out


def counted(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple[str, list[bytes], int, list[tuple[np.ndarray, np.ndarray]]]]]:
    """For stretches of texts: language, words by number, number of words, and phrases with counts of each language."""
    waiting: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    held = 0

    def numbers(words: _Numbers, text: bytes) -> np.ndarray:
        tokens = text.replace(b".", b" . ").split()
        return np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))

    def count(lang: str, words: _Numbers, ids: list[np.ndarray]):
        if len(words) > 1 << ID_BITS:
            raise ValueError("a slice has too many different words")
        return (lang, list(words), *count_slice(np.concatenate(ids)))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = (text or "").encode().translate(_TABLE)
            if len(data) > size:
                carried = [_BREAK, _BREAK]
                for part in _slices(data, size):
                    words = _Numbers()
                    ids = [np.array([words[w] for w in carried], np.int64), numbers(words, part)]
                    names = list(words)
                    carried = [names[k] for k in np.concatenate(ids)[-2:]]
                    yield [count(lang, words, ids)]
                continue
            if held + len(data) > size:
                yield [count(name, *rest) for name, rest in waiting.items()]
                waiting, held = {}, 0
            if lang not in waiting:
                waiting[lang] = _Numbers(), [_GAP]
            words, ids = waiting[lang]
            ids += [numbers(words, data), _GAP[:1]]
            held += len(data) + 1
    if waiting:
        yield [count(name, *rest) for name, rest in waiting.items()]


def _seed(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def hashes(lang: str, words: list[bytes], found: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """48 bits for every phrase, the same in every task."""
    each = np.array([_seed(w) for w in words], np.uint64)
    out = []
    for length, (packed, _) in enumerate(found, 1):
        h = np.full(len(packed), np.uint64(_seed(lang.encode())) + np.uint64(length))
        for k in range(length - 1, -1, -1):
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + each[packed >> k * ID_BITS & _MASK])
        out.append(h >> np.uint64(64 - HASH_BITS))
    return out


def _edges(parts: int) -> np.ndarray:
    """First hash of every part, and the end."""
    return np.array([-(-(p << HASH_BITS) // parts) for p in range(parts + 1)], np.uint64)


def _packed(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :HASH_BITS // 8].tobytes()


def _unpacked(data: pa.Buffer) -> np.ndarray:
    out = np.zeros((data.size // (HASH_BITS // 8), 8), np.uint8)
    out[:, :HASH_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, HASH_BITS // 8)
    return out.view(np.uint64).ravel()


class Summary:
    """Misra-Gries counters for hashes; ``taken`` is what each true count may be above its counter, at most."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.taken = 0
        self._keys, self._counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._held += len(keys)
        if self._held > max(self.capacity, 1 << 18):
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([self._keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self._counts, *(c for _, c in self._waiting)])
        self._waiting, self._held = [], 0
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0) if len(keys) else np.zeros(0, int)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        over = len(keys) - self.capacity
        if over > 0:
            off = np.partition(counts, over - 1)[over - 1]
            self.taken += int(off)
            counts = counts - off
            keys, counts = keys[counts > 0], counts[counts > 0]
        self._keys, self._counts = keys, counts

    def counters(self) -> tuple[np.ndarray, np.ndarray]:
        if self._waiting:
            self._merge()
        return self._keys, self._counts


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))


def survivors(texts: DataFrame, least: int, parts: int, bits: int, size: int = SLICE) -> bytes:
    """The table of bits: bit i is set if a surviving phrase's hash starts with the ``bits`` bits of i."""
    edges = _edges(parts)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stretch in counted(batches, size):
            h = np.concatenate([h for lang, words, _, found in stretch for h in hashes(lang, words, found)])
            c = np.concatenate([counts for *_, found in stretch for _, counts in found])
            order = np.argsort(h)
            h, c = h[order], c[order]
            at = np.searchsorted(h, edges)
            rows = [(p, at[p], at[p + 1]) for p in np.flatnonzero(np.diff(at)).tolist()]
            part = pa.array([p for p, _, _ in rows], pa.int32())
            mass = pa.array([int(c[a:b].sum()) for _, a, b in rows], pa.int64())
            names, none = ["part", "mass", "keys", "counts"], pa.nulls(len(rows), pa.binary())
            yield pa.RecordBatch.from_arrays([part, mass, none, none], names)
            yield pa.RecordBatch.from_arrays(
                [part, pa.nulls(len(rows), pa.int64()), pa.array([_packed(h[a:b]) for _, a, b in rows], pa.binary()),
                 pa.array([c[a:b].astype(np.uint32).tobytes() for _, a, b in rows], pa.binary())], names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary = -1, 0, None

        def slices() -> pa.RecordBatch:
            keys, counts = summary.counters()
            places = (keys[counts + summary.taken >= least] >> np.uint64(HASH_BITS - bits)).astype(np.int64)
            first = (int(edges[now]) >> HASH_BITS - bits) // 8
            last = (int(edges[now + 1]) - 1 >> HASH_BITS - bits) // 8
            flags = np.zeros((last + 1 - first) * 8, bool)
            flags[places - first * 8] = True
            return pa.RecordBatch.from_pydict({"first": pa.array([first], pa.int64()), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

        for batch in batches:
            for part, weight, keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if part != now:
                    if summary is not None:
                        yield slices()
                    now, mass, summary = part, 0, None
                if weight is not None:
                    mass += weight
                    continue
                if summary is None:
                    summary = Summary(mass // least + 1)
                summary.add(_unpacked(keys.as_buffer()), np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64))
        if summary is not None:
            yield slices()

    found = (texts.mapInArrow(summaries, "part int, mass long, keys binary, counts binary").repartitionById(parts, "part")
             .sortWithinPartitions("part", F.col("mass").isNull()).mapInArrow(merged, "first long, bits binary"))
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in found.collect():  # the table's bytes once, whatever the input
        piece = np.frombuffer(row["bits"], np.uint8)
        table[row["first"]:row["first"] + len(piece)] |= piece
    return table.tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang",
                  size: int = SLICE, part_bytes: int = PART_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, phrase, length, f``: every phrase of up to three words with ``f >= least`` occurrences, exactly.

    The empty phrase, of length 0, has the number of all words of the language.
    """
    texts = _texts(docs, text_col, lang_col)
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-volume // part_bytes))
    bits = min(filter_bits, max(16, math.ceil(math.log2(volume + 1))))
    table = docs.sparkSession.sparkContext.broadcast(survivors(texts, least, parts, bits, size))

    def rows(lang: str, found: list[bytes], length: int, counts) -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(n, int))), pa.array(found, pa.binary()).cast(pa.string()),
                                           pa.array(np.full(n, length), pa.int32()), pa.array(counts, pa.int64())], ["lang", "phrase", "length", "f"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(table.value, np.uint8)
        for lang, words, total, found in (x for stretch in counted(batches, size) for x in stretch):
            yield rows(lang, [b""], 0, [total])
            for length, (h, (packed, many)) in enumerate(zip(hashes(lang, words, found), found), 1):
                place = (h >> np.uint64(HASH_BITS - bits)).astype(np.int64)
                kept = np.flatnonzero(flags[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                for k in range(0, len(kept), 1 << 16):
                    some = kept[k:k + (1 << 16)]
                    numbers = [(packed[some] >> j * ID_BITS & _MASK).tolist() for j in range(length - 1, -1, -1)]
                    yield rows(lang, [b" ".join([words[n] for n in row]) for row in zip(*numbers)], length, many[some])

    each = texts.mapInArrow(exact, "lang string, phrase string, length int, f long")
    return each.groupBy("lang", "phrase", "length").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("length") == 0))


def scored(counts: DataFrame, cover: int = COVER) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer one covers; ``counts`` is read several times.

    A cut's score is floor(10**6 * a * a / (l * r)) in decimal whole numbers, exact up to 10**15 occurrences.  The
    lowest cut counts, of equal ones the first.
    """
    candidates = counts.where("length >= 2").select("lang", "phrase", F.col("f").alias("a"), "length", F.split("phrase", " ").alias("w"))
    cuts = F.transform(F.sequence(F.lit(1), F.col("length") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice("w", k + 1, F.col("length") - k), " ").alias("right")))
    known = counts.where("length > 0")
    each = candidates.select("lang", "phrase", "length", "a", F.inline(cuts))
    each = each.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    each = each.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    a, l, r = (f"CAST({x} AS DECIMAL(16, 0))" for x in "alr")
    each = each.withColumn("score", F.expr(f"({a} * {a} * CAST(1000000 AS DECIMAL(7, 0))) DIV ({l} * {r})"))
    best = each.groupBy("lang", "phrase", "length", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.array(*[F.array_join(F.slice("w", k, 2), " ") for k in (1, 2)])
    longer = (candidates.where("length = 3").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    free = best.join(longer, ["lang", "phrase"], "left").where(
        (F.col("length") == 3) | F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover))
    return free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def top_phrases(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP, text_col: str = "text",
                lang_col: str = "lang", buckets: int = 256, **counting: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by score, a, phrase."""
    ensure_checkpoint_dir(docs.sparkSession)
    counts = phrase_counts(docs, least, text_col, lang_col, **counting).checkpoint()
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = scored(counts, cover).withColumn("_bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    # the best of each bucket first, so that no task sorts a whole language
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*order))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("length = 0").select("lang", F.col("f").alias("n"))
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
