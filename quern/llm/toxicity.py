"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word is read twice: as itself (a hashed embedding) and as its characters (the mean of hashed embeddings of
its letter triples).  Two gated recurrent layers walk a window of words in both directions, an attention
layer pools their states, and a logistic unit scores the window.  A document is scored by its highest
window; windows overlap by half and cover the whole text.  Training labels belong to documents, so each
round trains on the windows that the network of the round before scores highest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.7
#: Labelled documents of each class that are trained on, at most; chosen by hash of the id.
SAMPLE = 1500
WINDOW, STRIDE = 32, 16
WORD_ROWS, LETTER_ROWS, WIDTH = 1 << 14, 1 << 13, 12
HIDDEN, ATTENTION = 12, 8
ROUNDS, BATCH, RATE = 10, 256, 0.01
SEED = 11
EDGES = ".,;:!?*#$%&|\"'()[]{}<>-_"
#: Windows that are walked together, and characters of text whose words are numbered together.
TOGETHER, CHUNK = 2048, 1 << 21


def words_of(text: str | None) -> list[str]:
    """Lower-case words without punctuation at their edges."""
    return [w.strip(EDGES) for w in (text or "").lower().split()]


class Lexicon:
    """Distinct words of some texts: rows of the word embedding, and of the letter embedding per word."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {"": 0}

    def number(self, words: list[str]) -> np.ndarray:
        ids = self.ids
        return np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, len(words))

    def close(self) -> None:
        encoded = [b"^" + w.encode() + b"$" for w in self.ids]
        data = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint64)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ends = np.cumsum(lengths)
        self.starts = ends - lengths
        odd = np.uint64(0x9E3779B97F4A7C15)
        last = np.concatenate([data, np.zeros(2, np.uint64)])
        triple = ((last[:-2] * np.uint64(65537) + last[1:-1] * np.uint64(257) + last[2:]) * odd) >> np.uint64(51)
        inside = np.ones(len(data), bool)  # triples do not run over the end of a word
        inside[ends - 1] = False
        inside[np.maximum(ends - 2, 0)] = False
        self.triples = triple[inside].astype(np.int64) % LETTER_ROWS
        count = np.maximum(lengths - 2, 0)
        self.offsets = np.concatenate([[0], np.cumsum(count)[:-1]])
        self.count = count
        power = np.uint64(1)
        value = np.zeros(len(encoded), np.uint64)
        for k in range(int(lengths.max())):  # the whole word's hash, letter by letter
            here = lengths > k
            value[here] = value[here] * odd + data[self.starts[here] + k] + power
        self.rows = ((value * odd) >> np.uint64(40)).astype(np.int64) % WORD_ROWS


def windows_of(n: int) -> list[int]:
    """Where the windows of a text of ``n`` words start; a text without words has one empty window."""
    return list(range(0, max(n - WINDOW, 0) + STRIDE, STRIDE)) if n > WINDOW else [0]


def number_texts(texts: Sequence[str | None]) -> tuple[Lexicon, np.ndarray, np.ndarray]:
    """The lexicon, the word numbers of all windows (-1 behind the end), and each window's text."""
    lexicon, rows, owner = Lexicon(), [], []
    for k, text in enumerate(texts):
        ids = lexicon.number(words_of(text))
        starts = [s for s in windows_of(len(ids)) if s == 0 or s + STRIDE < len(ids)]
        padded = np.full(starts[-1] + WINDOW, -1, np.int64)
        padded[:len(ids)] = ids[:len(padded)]
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts])
        owner.append(np.full(len(starts), k))
    lexicon.close()
    return lexicon, np.concatenate(rows), np.concatenate(owner)


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        draw = lambda scale, *shape: (r.standard_normal(shape) * scale).astype(np.float32)
        h, k = HIDDEN, ATTENTION
        self.p = {"word": draw(0.1, WORD_ROWS, WIDTH), "letter": draw(0.3, LETTER_ROWS, WIDTH),
                  "x": draw(1 / math.sqrt(2 * WIDTH), 2 * WIDTH, 6 * h), "xb": np.zeros(6 * h, np.float32),
                  "u0": draw(1 / math.sqrt(h), h, 3 * h), "u1": draw(1 / math.sqrt(h), h, 3 * h),
                  "a": draw(1 / math.sqrt(2 * h), 2 * h, k), "ab": np.zeros(k, np.float32), "v": draw(1 / math.sqrt(k), k),
                  "w": draw(1 / math.sqrt(2 * h), 2 * h), "b": np.full(1, -1.0, np.float32)}
        self.m = {n: np.zeros_like(x) for n, x in self.p.items()}
        self.s = {n: np.zeros_like(x) for n, x in self.p.items()}
        self.t = 0

    def inputs(self, lexicon: Lexicon, keep: np.ndarray | None = None) -> np.ndarray:
        """One row per distinct word; ``keep`` is 0 for words whose own embedding is left out."""
        letters = np.zeros((len(lexicon.count), WIDTH), np.float32)
        some = lexicon.count > 0
        if some.any():
            sums = np.add.reduceat(self.p["letter"][lexicon.triples], lexicon.offsets[some], axis=0)
            letters[some] = sums / np.sqrt(lexicon.count[some, None]).astype(np.float32)
        word = self.p["word"][lexicon.rows]
        return np.concatenate([letters, word if keep is None else word * keep[:, None]], axis=1)

    def walk(self, x: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, store: list | None = None) -> np.ndarray:
        """States of one direction; ``x`` is time, window, 3 gates."""
        t, n, _ = x.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((t, n, HIDDEN), np.float32)
        for i in (range(t - 1, -1, -1) if back else range(t)):
            hu = h @ u
            g = logistic(x[i, :, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            new = np.tanh(x[i, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
            nxt = h + mask[i, :, None] * (1 - z) * (new - h)
            if store is not None:
                store.append((i, h, z, r, new, hu[:, 2 * HIDDEN:]))
            out[i] = h = nxt
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        hidden = np.tanh(states @ self.p["a"] + self.p["ab"])
        e = np.exp(hidden @ self.p["v"]) * mask
        share = e / np.maximum(e.sum(axis=0), 1e-9)
        context = (share[:, :, None] * states).sum(axis=0)
        return context @ self.p["w"] + self.p["b"][0], hidden, share, context

    def logits(self, lexicon: Lexicon, windows: np.ndarray) -> np.ndarray:
        gates = self.inputs(lexicon) @ self.p["x"] + self.p["xb"]
        out = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), TOGETHER):
            part = windows[at:at + TOGETHER].T
            mask = (part >= 0).astype(np.float32)
            x = gates[part]
            states = np.concatenate([self.walk(x[:, :, :3 * HIDDEN], mask, self.p["u0"], False),
                                     self.walk(x[:, :, 3 * HIDDEN:], mask, self.p["u1"], True)], axis=2)
            out[at:at + TOGETHER] = self.pool(states, mask)[0]
        return out

    def step(self, lexicon: Lexicon, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray, keep: np.ndarray) -> None:
        """One step of gradient descent on some windows."""
        p, h3 = self.p, 3 * HIDDEN
        distinct = self.inputs(lexicon, keep)
        part = windows.T
        mask = (part >= 0).astype(np.float32)
        x = distinct[part]
        gates = x @ p["x"] + p["xb"]
        stores: tuple[list, list] = ([], [])
        states = np.concatenate([self.walk(gates[:, :, :h3], mask, p["u0"], False, stores[0]),
                                 self.walk(gates[:, :, h3:], mask, p["u1"], True, stores[1])], axis=2)
        logit, hidden, share, context = self.pool(states, mask)
        g: dict[str, np.ndarray] = {}
        d = ((logistic(logit) - labels) * weights).astype(np.float32) / len(labels)
        g["w"], g["b"] = context.T @ d, d.sum(keepdims=True)
        to_context = d[:, None] * p["w"]
        to_states = share[:, :, None] * to_context
        to_share = (states * to_context).sum(axis=2)
        to_e = share * (to_share - (share * to_share).sum(axis=0))
        g["v"] = np.tensordot(to_e, hidden, ((0, 1), (0, 1)))
        to_hidden = to_e[:, :, None] * p["v"] * (1 - hidden ** 2)
        g["a"], g["ab"] = np.tensordot(states, to_hidden, ((0, 1), (0, 1))), to_hidden.sum(axis=(0, 1))
        to_states += to_hidden @ p["a"].T
        to_gates = np.zeros_like(gates)
        for side, name in enumerate(("u0", "u1")):
            grad = np.zeros_like(p[name])
            carry = np.zeros((len(labels), HIDDEN), np.float32)
            for i, before, z, r, new, hn in reversed(stores[side]):
                total = to_states[i, :, side * HIDDEN:(side + 1) * HIDDEN] + carry
                m = mask[i, :, None]
                to_new = m * total * (1 - z) * (1 - new ** 2)
                to_z = m * total * (before - new) * z * (1 - z)
                to_r = to_new * hn * r * (1 - r)
                to_gates[i, :, side * h3:(side + 1) * h3] = np.concatenate([to_z, to_r, to_new], axis=1)
                to_hu = np.concatenate([to_z, to_r, to_new * r], axis=1)
                grad += before.T @ to_hu
                carry = total * (1 - m * (1 - z)) + to_hu @ p[name].T
            g[name] = grad
        g["x"], g["xb"] = np.tensordot(x, to_gates, ((0, 1), (0, 1))), to_gates.sum(axis=(0, 1))
        to_x = (to_gates @ p["x"].T) * mask[:, :, None]
        per_word = np.zeros_like(distinct)
        np.add.at(per_word, part.ravel(), to_x.reshape(-1, 2 * WIDTH))
        used = np.unique(part[part >= 0])
        g["word"], g["letter"] = np.zeros_like(p["word"]), np.zeros_like(p["letter"])
        np.add.at(g["word"], lexicon.rows[used], per_word[used, WIDTH:] * keep[used, None])
        some = used[lexicon.count[used] > 0]
        count = lexicon.count[some]
        which = np.repeat(lexicon.offsets[some] - np.cumsum(count) + count, count) + np.arange(count.sum())
        np.add.at(g["letter"], lexicon.triples[which],
                  np.repeat(per_word[some, :WIDTH] / np.sqrt(count)[:, None], count, axis=0))
        self.t += 1
        rate = RATE * math.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for n, grad in g.items():
            grad = np.clip(grad, -1, 1).astype(np.float32)
            self.m[n] += 0.1 * (grad - self.m[n])
            self.s[n] += 0.001 * (grad * grad - self.s[n])
            p[n] -= rate * self.m[n] / (np.sqrt(self.s[n]) + 1e-8)


def train(texts: Sequence[str | None], labels: Sequence[int], rounds: int = ROUNDS, seed: int = SEED) -> Network | None:
    """A network for labelled texts; None if one of the classes is missing."""
    y = np.array(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return None
    lexicon, windows, owner = number_texts(texts)
    network, r = Network(seed), np.random.default_rng(seed)
    first = np.searchsorted(owner, np.arange(len(y)))
    for turn in range(rounds):
        if turn == 0:
            score = r.random(len(windows))
        else:
            score = network.logits(lexicon, windows)
        order = np.lexsort((-score, owner))  # windows of a text by score
        top = order[first]
        # of a toxic text its highest window; of another one its highest and random ones
        some = r.integers(0, len(windows), len(y) * (4 if turn == 0 else 2))
        wanted = some if turn == 0 else np.concatenate([top, some[y[owner[some]] == 0]])
        epochs = max(1, math.ceil(40 * BATCH / (rounds * len(wanted))))
        for _ in range(epochs):
            mixed = r.permutation(wanted)
            for at in range(0, len(mixed), BATCH):
                pick = mixed[at:at + BATCH]
                target = y[owner[pick]].astype(np.float32)
                keep = (r.random(len(lexicon.rows)) < 0.5).astype(np.float32) * 2
                network.step(lexicon, windows[pick], target, np.ones(len(pick), np.float32), keep)
    network.m = network.s = {}
    return network


def score_texts(network: Network | None, texts: Sequence[str | None] | pa.Array) -> np.ndarray:
    """The highest window score of every text; 0 without a network.  A column is read as strings a chunk at a time."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    out = np.zeros(len(column))
    if network is None:
        return out
    at, length = 0, pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    while at < len(column):
        end, size = at, 0
        while end < len(column) and (end == at or size + length[end] <= CHUNK):
            size += length[end]
            end += 1
        lexicon, windows, owner = number_texts(column.slice(at, end - at).to_pylist())
        logits = network.logits(lexicon, windows)
        out[at:end] = logistic(np.maximum.reduceat(logits, np.searchsorted(owner, np.arange(end - at))).astype(float))
        at = end
    return out


def held_out(doc_id) -> "F.Column":
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = SEED, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Network | None:
    """A network from at most ``sample`` labelled documents of each class, none of them held out.

    Both the sample and its texts are bounded by ``sample`` rows; they are read to the driver to train.
    """
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
             .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("_label").alias("_label")))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")))
    few = [known.where(F.col("_label") == k).orderBy(draw, "_id").limit(sample) for k in (0, 1)]
    chosen = few[0].unionByName(few[1])
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_label").alias("_label"))
            .collect())
    rows.sort(key=lambda r: r["_id"])
    return train([r["_text"] for r in rows], [r["_label"] for r in rows], seed=seed)


def toxicity(docs: DataFrame, network: Network | None, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; nothing is shuffled.

    A null or empty text is one window without words and gets the score of that.  Without a network (no
    labelled document of one class) all scores are 0.  Repeated rows get the same score; other columns are not
    looked at.
    """
    weights = None if network is None else network.p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        if weights is not None:
            own = Network.__new__(Network)
            own.p = weights
        for batch in batches:
            scores = score_texts(own, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                         F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_harmless(docs: DataFrame, network: Network | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    if network is None:
        return docs
    weights, at = network.p, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.p = weights
        for batch in batches:
            scores = score_texts(own, batch.column(at))
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
