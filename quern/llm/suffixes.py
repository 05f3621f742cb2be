"""Exact substring deduplication with suffix arrays in a logarithmic index family.

A string of ``LENGTH`` bytes that starts at two places is repeated; every byte it covers is removed, at all
its places.  Equal strings have the same least hash among their ``SEED``-byte grams, so a text is cut into
runs of neighbouring strings that share that gram, and only runs with the same hash can hold equal strings.
Equal runs are counted once; runs are equal if the hash of their gram and a digest of theirs, 128 bits together,
are.  Runs that share a hash with other runs bring their bytes to one task, which
works on them in batches: each batch gets a suffix array, arrays of equal size are merged geometrically,
and each merge scan marks the strings that are neighbours and equal.  The strings of hashes with very many
runs are not brought together: they are counted by 128 bits of their BLAKE2b digests, which stand for their
bytes, in an aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.spans import cut_out, keyed, union
from quern.llm.words import chunks, prefix_sums, spans
from quern.session import ensure_checkpoint_dir

LENGTH = 200
SEED = 64
#: Strings in a new suffix array, and in a block of a merge scan.
BATCH, BLOCK = 8192, 16384
#: Runs with one least hash beyond which their strings are counted one by one.
SPLIT = 16384
#: Bits of a number that hold how many strings a run has; the bits above hold where it starts.
RUN_BITS = 20
HALF = 0xFFFFFFFF


class IndexFamily:
    """Suffix arrays of strings of one length that start at places of ``text``; ``hit`` marks the repeated ones."""

    def __init__(self, text: np.ndarray, length: int = LENGTH, batch: int = BATCH):
        self.view = np.lib.stride_tricks.sliding_window_view(text, length)
        self.length, self.batch = length, batch
        self.hit = np.zeros(len(text), bool)
        self.levels: list[np.ndarray | None] = []

    def strings(self, places: np.ndarray) -> np.ndarray:
        """Fixed-length strings; numpy compares them byte by byte, and trailing zeros cannot hide at equal length."""
        return np.ascontiguousarray(self.view[places]).view(f"S{self.length}").ravel()

    def mark(self, strings: np.ndarray, places: np.ndarray) -> None:
        same = strings[1:] == strings[:-1]
        self.hit[places[1:][same]] = True
        self.hit[places[:-1][same]] = True

    def add(self, places: np.ndarray) -> None:
        for at in range(0, len(places), self.batch):
            part = places[at:at + self.batch]
            strings = self.strings(part)
            order = np.argsort(strings, kind="stable")
            carry = part[order]
            self.mark(strings[order], carry)
            level = 0
            while level < len(self.levels) and self.levels[level] is not None:
                carry = self.merge(self.levels[level], carry)
                self.levels[level] = None
                level += 1
            if level == len(self.levels):
                self.levels.append(None)
            self.levels[level] = carry

    def finish(self) -> np.ndarray:
        """Merge what is left, small to large; the marks."""
        carry = None
        for level in self.levels:
            if level is not None:
                carry = level if carry is None else self.merge(level, carry)
        self.levels = []
        return self.hit

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Both arrays as one, a block at a time; equal neighbours are marked."""
        out, i, j, last = [], 0, 0, None
        while i < len(a) or j < len(b):
            x, y = self.strings(a[i:i + BLOCK]), self.strings(b[j:j + BLOCK])
            bound = min(s[-1] for s in (x, y) if len(s))
            m, n = np.searchsorted(x, bound, "right"), np.searchsorted(y, bound, "right")
            strings = np.concatenate([x[:m], y[:n]])
            places = np.concatenate([a[i:i + m], b[j:j + n]])
            order = np.argsort(strings, kind="stable")
            strings, places = strings[order], places[order]
            self.mark(strings, places)
            if last is not None and last[0] == strings[0]:
                self.hit[[last[1], places[0]]] = True
            last = strings[-1], places[-1]
            out.append(places)
            i, j = i + m, j + n
        return np.concatenate(out)


def least_grams(data: np.ndarray, sums: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For every place the place of the least gram, the first of equals, in the string that starts there; all hashes.

    Grams are compared by the upper half of their hashes, so that a place fits into the lower half.
    """
    n = len(data)
    at = np.arange(n - seed + 1)
    hashes = spans(sums, at, at + seed)
    least = (hashes & ~np.uint64(HALF)) | at.astype(np.uint64)
    width, want = 1, length - seed + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = want - width
    least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
    return (least & np.uint64(HALF)).astype(np.int64), hashes


def runs(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """``value, digest, doc_id, mark, start, n``: runs of ``n`` neighbouring strings that share their least gram.

    ``value`` is the gram's hash.  Runs end where the gram's place changes, so equal strings of one text are in
    different runs, and a run has ``length - seed + 1`` strings at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for group in chunks(t.encode() for t in batch.column(2).to_pylist()):
                data = np.frombuffer(b"".join(group), np.uint8)
                which, starts, ends, bases = [], [], [], []
                if len(data) >= length:
                    sums = prefix_sums(data)
                    least, hashes = least_grams(data, sums, length, seed)
                at = 0
                for k, text in enumerate(group):
                    n = len(text) - length + 1
                    if n > 0:
                        own = least[at:at + n]
                        cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
                        begin = np.concatenate([[0], cuts])
                        starts.append(begin + at)
                        ends.append(np.concatenate([cuts, [n]]) + at)
                        bases.append(np.full(len(begin), at))
                        which.append(np.full(len(begin), first + k))
                    at += len(text)
                first += len(group)
                if not starts:
                    continue
                a, b, base = np.concatenate(starts), np.concatenate(ends), np.concatenate(bases)
                index = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[least[a]].view(np.int64)), pa.array(spans(sums, a, b - 1 + length).view(np.int64)),
                     batch.column(0).take(index), batch.column(1).take(index), pa.array((a - base).astype(np.int64)),
                     pa.array((b - a).astype(np.int64))], ["value", "digest", "doc_id", "mark", "start", "n"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"value bigint, digest bigint, doc_id {kind}, mark bigint, start bigint, n bigint")


def marked(group: list[tuple[int, bytes]], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """For runs of one least hash, ``(digest, bytes)``: the digest and stretches of repeated strings."""
    text = np.frombuffer(b"".join(g[1] for g in group), np.uint8)
    ends = np.cumsum([len(g[1]) for g in group])
    begins = ends - [len(g[1]) for g in group]
    places = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(begins, ends)])
    family = IndexFamily(text, length)
    family.add(places)
    hit = family.finish()
    out = []
    for (digest, data), a in zip(group, begins):
        flags = np.concatenate([[0], hit[a:a + len(data) - length + 1].view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(flags))
        if len(edges):
            out.append((digest, list(zip(edges[0::2].tolist(), edges[1::2].tolist()))))
    return out


def strings_of(pieces: DataFrame, length: int) -> DataFrame:
    """``high, low, value, digest, at``: a row for each string of the runs ``value, digest, bytes``, without its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                sums, counts = [], []
                for data in part.column(2).to_pylist():
                    n = len(data) - length + 1
                    counts.append(n)
                    sums += [hashlib.blake2b(data[k:k + length], digest_size=16).digest() for k in range(n)]
                both = np.frombuffer(b"".join(sums), np.int64).reshape(-1, 2)
                index = pa.array(np.repeat(np.arange(len(counts)), counts))
                at = np.concatenate([np.arange(n, dtype=np.int64) for n in counts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])),
                     part.column(0).take(index), part.column(1).take(index), pa.array(at)],
                    ["high", "low", "value", "digest", "at"])

    return pieces.select("value", "digest", "bytes").mapInArrow(
        run, "high bigint, low bigint, value bigint, digest bigint, at bigint")


def stretches(places: Column) -> Column:
    """Sorted distinct numbers as an array of ``a, b``: neighbours from ``a`` to ``b - 1``."""
    edge = lambda step: F.filter(places, lambda x, i: F.coalesce(F.get(places, i + step) != x + step, F.lit(True)))
    return F.zip_with(edge(-1), edge(1), lambda x, y: F.struct(x.alias("a"), (y + 1).alias("b")))


def counted(pieces: DataFrame, length: int) -> DataFrame:
    """``value, digest, a, b``: stretches of the strings that are in two of the runs ``value, digest, bytes`` or more.

    Strings of one run differ, and the runs differ, so a string that is there twice is repeated.
    """
    strings = strings_of(pieces, length)
    repeated = strings.groupBy("high", "low").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("high", "low").checkpoint()
    return (strings.join(repeated, ["high", "low"]).groupBy("value", "digest")
            .agg(stretches(F.sort_array(F.collect_list("at"))).alias("found"))
            .select("value", "digest", F.inline("found").alias("a", "b")))


def dedup_suffixes(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id",
                   text_col: str = "text", split: int = SPLIT) -> DataFrame:
    """``doc_id, row, text, n_bytes, n_removed, n_spans, kept_sha256``: every row without repeated strings.

    Texts are UTF-8 bytes, strings never cross documents, and all places are judged on the input.  Every row
    is a document, so a repeated row of ``length`` bytes or more loses all its text.  A null text counts as
    empty; null ids are ids.  ``text`` is null where the rest is not UTF-8.  An empty table gives an empty one.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    # where a run starts and how many strings it has in one number, which is one column less to move
    found = runs(rows, length, seed).select(
        "value", "digest", "doc_id", "mark", (F.shiftleft("start", RUN_BITS) + F.col("n")).alias("at"))
    start, many = F.shiftright("at", RUN_BITS), F.col("at").bitwiseAND(F.lit((1 << RUN_BITS) - 1))
    # runs are worked out twice, which is cheaper than storing them all; the narrow sides of the joins are
    # stored, so that a hash with very many runs is split in the join
    often = found.groupBy("value").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("value").checkpoint()
    again = found.join(often, "value").checkpoint()
    distinct = again.groupBy("value", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max(many).alias("n"), F.min(F.struct("doc_id", "mark", "at")).alias("rep"))
    distinct = distinct.checkpoint()
    groups = distinct.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where("members > 1").checkpoint()
    wanted = distinct.join(groups, "value").select(
        F.col("rep.doc_id").alias("doc_id"), F.col("rep.mark").alias("mark"),
        F.struct("value", "digest", F.shiftright("rep.at", RUN_BITS).alias("start"), "n",
                 (F.col("members") > split).alias("hot")).alias("run"))
    lists = wanted.groupBy("doc_id", "mark").agg(F.collect_list("run").alias("runs")) \
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "runs")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode()
                for r in own:
                    piece = data[r["start"]:r["start"] + r["n"] - 1 + length]
                    out.append((r["value"], r["digest"], r["hot"], piece))
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          ["value", "digest", "hot", "bytes"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, {}, []  # runs of one least hash follow each other
        for batch in batches:
            for value, digest, data in zip(*(c.to_pylist() for c in batch.columns)):
                if value != key:
                    if len(held) > 1:
                        out += [(key, d, s) for d, s in marked(list(held.values()), length)]
                    key, held = value, {}
                    if len(out) > 20_000:
                        yield spans_of(out)
                        out = []
                held[digest] = (digest, data)
        if len(held) > 1:
            out += [(key, d, s) for d, s in marked(list(held.values()), length)]
        if out:
            yield spans_of(out)

    def spans_of(out: list[tuple]) -> pa.RecordBatch:
        flat = [(v, d, a, b) for v, d, s in out for a, b in s]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat)], ["value", "digest", "a", "b"])

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    pieces = rows.join(lists, same).select("text", "runs").mapInArrow(
        fetch, "value bigint, digest bigint, hot boolean, bytes binary")
    hot = not groups.where(F.col("members") > split).isEmpty()
    pieces = pieces.checkpoint() if hot else pieces  # read three times
    partly = (pieces.where("not hot").select("value", "digest", "bytes").repartition("value").sortWithinPartitions("value")
              .mapInArrow(index, "value bigint, digest bigint, a bigint, b bigint"))
    if hot:
        partly = partly.unionByName(counted(pieces.where("hot"), length))
    whole = distinct.where("copies > 1").select("value", "digest", F.lit(0).cast("long").alias("a"), F.col("n").cast("long").alias("b"))
    hits = partly.unionByName(whole).groupBy("value", "digest").agg(F.collect_list(F.struct("a", "b")).alias("hits")).checkpoint()
    spots = (again.join(hits, ["value", "digest"])
             .select("doc_id", "mark", start.alias("start"), F.explode("hits").alias("h"))
             .select("doc_id", "mark", F.struct((F.col("start") + F.col("h.a")).alias("a"),
                                                (F.col("start") + F.col("h.b") - 1 + length).alias("b")).alias("spot"))
             .groupBy("doc_id", "mark").agg(F.collect_set("spot").alias("spots")))
    return cut_out(rows, spots, lambda data, found: union([(s["a"], s["b"]) for s in found]),
                   "array<struct<a:bigint,b:bigint>>")
