"""N-gram Jaccard join by MinHash banding, with verification on full n-gram sets.

Documents with the same set of word n-grams form one class; the join runs between classes.  Each class has
a MinHash signature in bands, whose count and height follow from the wanted recall at the threshold.  Band
hashes are shuffled; classes that share one are candidates.  Candidates are gathered into connected groups
(stars around the least class of each band hash, never pairs), and every pair inside a group is verified on
the full sets: groups are cut into blocks, pairs of blocks are dealt to tasks, and a task counts common
n-grams of all its pairs with matrix products.  No pair is ever a row, and no group needs one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.components import components
from quern.llm.words import SHINGLE, mix, shingle_sets
from quern.session import ensure_checkpoint_dir

THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 256
#: Classes in a block, and in a tile of one matrix product.
BLOCK, TILE, COLUMNS = 4096, 512, 4096
SEED = 5


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the tallest bands that meet ``recall`` at ``threshold`` within ``max_hashes``.

    A pair of likeness s shares a band with probability 1 - (1 - s**rows)**bands.
    """
    best = (max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))), 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def band_hashes(hashes: np.ndarray, bands: int, rows: int, seed: int = SEED) -> np.ndarray:
    """One hash per band of the MinHash signature of a set, different for different bands."""
    random = np.random.default_rng(seed)
    xors = random.integers(0, 1 << 64, (bands * rows, 1), dtype=np.uint64)
    odds = random.integers(0, 1 << 63, (bands * rows, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(bands * rows, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, ((hashes[None, at:at + 1024] ^ xors) * odds).min(axis=1), out=least)
    weights = random.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    place = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix((mix(least.reshape(bands, rows)) * weights).sum(axis=1, dtype=np.uint64) + place).view(np.int64)


def set_key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def with_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` and ``text_key``, which tells rows with one id and different texts apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def signatures(rows: DataFrame, bands: int, height: int, width: int) -> DataFrame:
    """``doc_id, text_key, node, bands``; ``node`` stands for the set of n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1).to_pylist(), width))
            signs = [band_hashes(s, bands, height) if len(s) else s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(map(set_key, sets), pa.binary()),
                 pa.array(signs, pa.list_(pa.int64()))], ["doc_id", "text_key", "node", "bands"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, node binary, bands array<bigint>")


class Tiles:
    """Links between the sets of two blocks."""

    def __init__(self, sets: list[np.ndarray], threshold: float):
        self.sets, self.threshold = sets, threshold
        self.sizes = np.array([len(s) for s in sets], np.float64)

    def incidence(self, which: range, columns: np.ndarray) -> np.ndarray:
        out = np.zeros((len(which), len(columns)), np.float32)
        for row, i in enumerate(which):
            at = np.searchsorted(columns, self.sets[i])
            at[at == len(columns)] = 0
            out[row, at[columns[at] == self.sets[i]]] = 1
        return out

    def linked(self, left: range, right: range) -> tuple[np.ndarray, np.ndarray]:
        """Places of linked pairs, one of ``left`` and one of ``right``."""
        a = np.unique(np.concatenate([self.sets[i] for i in left]))
        b = np.unique(np.concatenate([self.sets[i] for i in right])) if left != right else a
        shared = np.intersect1d(a, b, assume_unique=True)
        common = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, len(shared), COLUMNS):
            columns = shared[at:at + COLUMNS]
            one = self.incidence(left, columns)
            common += one @ (one if left == right else self.incidence(right, columns)).T
        sums = self.sizes[left.start:left.stop, None] + self.sizes[None, right.start:right.stop]
        x, y = np.nonzero(common.astype(np.float64) * (1 + self.threshold) >= self.threshold * sums - 1e-9)
        return x + left.start, y + right.start


def block_links(nodes: list[bytes], copies: list[int], sides: list[int], sets: list[np.ndarray],
                threshold: float) -> list[tuple[bytes, int, bytes]]:
    """Per class: how many documents of other classes it is linked to here, and the least class it reaches here.

    ``sides`` tells the two blocks apart; if both are there, only links across count.
    """
    order = sorted(range(len(nodes)), key=lambda i: (sides[i], nodes[i]))
    nodes, copies, sides, sets = ([v[i] for i in order] for v in (nodes, copies, sides, sets))
    n, cut = len(nodes), sides.count(0)
    tiles, weight = Tiles(sets, threshold), np.array(copies, np.int64)
    links, up = np.zeros(n, np.int64), list(range(n))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    one_side = cut in (0, n)
    spans = [range(i, min(i + TILE, e)) for s, e in ((0, cut), (cut, n)) for i in range(s, e, TILE)]
    for p, left in enumerate(spans):
        for right in spans[p:]:
            if not one_side and (left.start < cut) == (right.start < cut):
                continue
            x, y = tiles.linked(left, right)
            if left == right:
                x, y = x[x != y], y[x != y]
            np.add.at(links, x, weight[y])
            if left != right:
                np.add.at(links, y, weight[x])
            for i, j in zip(*(v.tolist() for v in _forest(x, y, n))):
                up[top(i)] = top(j)
    least: dict[int, bytes] = {}
    for i in range(n):
        t = top(i)
        least[t] = min(least.get(t, nodes[i]), nodes[i])
    return [(nodes[i], int(links[i]), least[top(i)]) for i in range(n)]


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer pairs with the same connected parts: each place with its least one, and the least ones of each pair."""
    if not len(x):
        return x, y
    least = np.arange(n)
    np.minimum.at(least, x, y)
    np.minimum.at(least, y, x)
    a = np.concatenate([x, y, least[x]])
    b = np.concatenate([least[x], least[y], least[y]])
    keys = np.unique(a * n + b)
    return keys // n, keys % n


def join_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, width: int = SHINGLE,
                 id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, text_key, class_id, n_links, node, class_node, first``: one row per row of ``docs``.

    Two documents are linked if their sets of ``width``-word n-grams have a Jaccard likeness of ``threshold``
    or more; a text of fewer words has one n-gram of all of them.  ``n_links`` counts the linked documents,
    ``class_id`` is the least id of the documents reached by links (null if all have none), and ``first``
    marks the row that stands for its class.  Texts without words are linked to each other and to nothing
    else; null counts as empty.  Repeated rows are documents of their own that are linked, and all of them
    are ``first`` if one is.  Other columns are not looked at; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    bands, height = choose_bands(threshold, recall)
    rows = with_keys(docs, id_col, text_col)
    signed = signatures(rows, bands, height, width).checkpoint()
    ids = F.struct(F.coalesce(F.col("doc_id").isNull().cast("int"), F.lit(0)).alias("n"), "doc_id", "text_key")
    nodes = signed.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(ids).alias("rep"))
    keys = signed.select("node", F.explode("bands").alias("band")).distinct()
    stars = keys.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("other")).where("center != other")
    stars = stars.select("band", "center").checkpoint()  # stored, so that a band hash with very many classes is split
    edges = keys.join(stars, "band").where("node != center").select("node", "center")
    groups = components(edges, "node", "center").checkpoint()
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column(0).to_pylist(), width))
            keep = [i for i, (s, node) in enumerate(zip(found, batch.column(1).to_pylist())) if set_key(s) == node]
            rest = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns[1:], pa.array([found[i].tobytes() for i in keep], pa.binary())],
                ["node", "copies", "component", "blocks", "grams"])

    # the least place of a text is looked for among the rows of the class only, by id and text
    wanted = (groups.join(nodes, "node").join(sizes, "component")
              .select("node", "copies", "component", "blocks", F.col("rep.n").alias("_n"),
                      F.col("rep.doc_id").alias("_id"), F.col("rep.text_key").alias("_key")))
    reps = rows.withColumn("_n", F.col("doc_id").isNull().cast("int")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    grams = reps.select("text", "node", "copies", "component", "blocks").mapInArrow(
        sets, "node binary, copies bigint, component binary, blocks int, grams binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (grams.withColumn("_own", own)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("_lo", F.least("_own", "_other")).withColumn("_hi", F.greatest("_own", "_other")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, {}  # rows of one pair of blocks follow each other; copies of a class count once

        def flush() -> pa.RecordBatch:
            rows = list(held.values())
            found = block_links(list(held), [r[0] for r in rows], [r[1] for r in rows],
                                [np.frombuffer(r[2], np.uint64) for r in rows], threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.binary())], ["node", "links", "root"])

        for batch in batches:
            for component, lo, hi, own, node, copies, grams in zip(*(c.to_pylist() for c in batch.columns)):
                if (component, lo, hi) != pair:
                    if held:
                        yield flush()
                    pair, held = (component, lo, hi), {}
                held.setdefault(node, (copies, int(own != lo), grams))
        if held:
            yield flush()

    found = (dealt.select("component", "_lo", "_hi", "_own", "node", "copies", "grams")
             .repartition("component", "_lo", "_hi").sortWithinPartitions("component", "_lo", "_hi")
             .mapInArrow(verify, "node binary, links bigint, root binary").checkpoint())
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found, "node", "root").withColumnRenamed("component", "class_node")
    about = (nodes.join(links, "node", "left").join(classes, "node", "left")
             .select("node", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("class_node", "node").alias("class_node")))
    about = about.checkpoint()
    firsts = about.groupBy("class_node").agg(F.min("rep").alias("first_rep"))
    named = about.join(firsts, "class_node").select("node", "n_links", "class_node", "first_rep")
    first = F.col("doc_id").eqNullSafe(F.col("first_rep.doc_id")) & (F.col("text_key") == F.col("first_rep.text_key"))
    return signed.select("doc_id", "text_key", "node").join(named, "node").select(
        "doc_id", "text_key", F.col("first_rep.doc_id").alias("class_id"), "n_links", "node", "class_node",
        first.alias("first"))


def keep_firsts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each class, the one with the least id."""
    found = join_classes(docs, id_col=id_col, text_col=text_col, **options).where("first")
    keys = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    own = docs.withColumn("_text_key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    kept = own.join(keys, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left_semi")
    return kept.dropDuplicates([id_col, "_text_key"]).select(*docs.columns)
