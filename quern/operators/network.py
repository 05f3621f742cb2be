"""Classifying networks of two hidden layers, trained by minibatch descent with momentum, many configurations at once.

Rows are kept in blocks; a block plays one worker's part of the data.  With ``sync="step"`` every step takes the next
``batch_size`` rows of each block, adds up the gradients of all blocks in a shuffle and moves the shared weights once:
plain synchronous descent, one job per step.  With ``sync="epoch"`` every block goes through its own batches from the
shared weights and the weights of all blocks are averaged by their rows: one job per epoch, whatever the number of
rows.  All configurations share each job.  The order of a block's rows is drawn anew for each epoch from the block's
number, so a retried task sees the same batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import halving
from quern.session import ensure_checkpoint_dir

BLOCK = 256
MOMENTUM = 0.9
TRAIN, VALID = 0, 1


@dataclass(frozen=True)
class Config:
    l1: int = 32
    l2: int = 16
    lr: float = 0.01
    batch_size: int = 8
    max_epoch: int = 20
    seed: int = 0

    @classmethod
    def of(cls, params: Mapping, seed: int = 0) -> "Config":
        return cls(seed=seed, **{k: (float if k == "lr" else int)(params[k]) for k in ("l1", "l2", "lr", "batch_size", "max_epoch")
                                 if params.get(k) is not None})

    def shapes(self, inputs: int, classes: int) -> list[tuple[int, ...]]:
        return [(inputs, self.l1), (self.l1,), (self.l1, self.l2), (self.l2,), (self.l2, classes), (classes,)]

    def start(self, inputs: int, classes: int) -> np.ndarray:
        """All weights in one row, drawn between plus and minus one over the root of a layer's inputs."""
        draw = np.random.default_rng(self.seed)
        shapes = self.shapes(inputs, classes)
        return np.concatenate([draw.uniform(-1, 1, int(np.prod(s))) / np.sqrt(shapes[k - k % 2][0]) for k, s in enumerate(shapes)])


def layers(weights: np.ndarray, shapes: Sequence[tuple[int, ...]]) -> list[np.ndarray]:
    out, at = [], 0
    for s in shapes:
        n = int(np.prod(s))
        out.append(weights[at:at + n].reshape(s))
        at += n
    return out


def log_chances(weights: np.ndarray, shapes: Sequence[tuple[int, ...]], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities of the classes, and the two hidden layers."""
    w1, b1, w2, b2, w3, b3 = layers(weights, shapes)
    one = np.maximum(x @ w1 + b1, 0.0)
    two = np.maximum(one @ w2 + b2, 0.0)
    out = two @ w3 + b3
    out = out - out.max(axis=1, keepdims=True)
    return out - np.log(np.exp(out).sum(axis=1, keepdims=True)), one, two


def gradient(weights: np.ndarray, shapes: Sequence[tuple[int, ...]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Derivative of the summed cross entropy by all weights."""
    _, _, w2, _, w3, _ = layers(weights, shapes)
    chances, one, two = log_chances(weights, shapes, x)
    d3 = np.exp(chances)
    d3[np.arange(len(y)), y] -= 1.0
    d2 = (d3 @ w3.T) * (two > 0)
    d1 = (d2 @ w2.T) * (one > 0)
    return np.concatenate([g.ravel() for g in (x.T @ d1, d1.sum(axis=0), one.T @ d2, d2.sum(axis=0), two.T @ d3, d3.sum(axis=0))])


def order(block: int, n: int, epoch: int, seed: int) -> np.ndarray:
    return np.random.default_rng([abs(block), epoch, seed]).permutation(n)


def to_blocks(df: DataFrame, features: str, label: str, part: str | None = None, size: int = BLOCK) -> DataFrame:
    """``block, part, n, x, y``: rows of an array column and a class number in blocks of one part, stored once.

    Rows without a class, or with a null in the array, are left out.
    """
    ensure_checkpoint_dir(df.sparkSession)
    chosen = df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"),
                       (F.col(part) if part else F.lit(TRAIN)).alias("part"))
    chosen = chosen.where(F.col("y").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[list, int]]] = {}

        def block(part: int, rows: list) -> pa.RecordBatch:
            nonlocal at
            at += 1
            x, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], np.int32)
            return pa.RecordBatch.from_pylist([{"block": at - 1, "part": part, "n": len(rows), "x": x.tobytes(), "y": y.tobytes()}], schema=_BLOCK)

        for batch in batches:
            for x, y, p in zip(*(c.to_pylist() for c in batch.columns)):
                rows = held.setdefault(p, [])
                rows.append((x, y))
                if len(rows) == size:
                    yield block(p, held.pop(p))
        for p, rows in held.items():
            yield block(p, rows)

    return chosen.mapInArrow(run, "block long, part int, n int, x binary, y binary").checkpoint()


_BLOCK = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] == part:
                yield row["block"], np.frombuffer(row["x"]).reshape(row["n"], -1), np.frombuffer(row["y"], np.int32)


class Training:
    """Networks for several configurations; ``grow(to)`` trains each to ``to`` epochs, or its own number."""

    def __init__(self, blocks: DataFrame, inputs: int, classes: int, configs: Mapping[int, Config], states: Mapping[int, str] | None = None,
                 sync: str = "epoch"):
        if sync not in ("step", "epoch"):
            raise ValueError("sync is step or epoch")
        self.blocks, self.inputs, self.classes, self.sync = blocks.persist(), inputs, classes, sync
        self.configs = dict(configs)
        self.done = {t: 0 for t in configs}
        self.weights = {t: c.start(inputs, classes) for t, c in configs.items()}
        self.speed = {t: np.zeros_like(w) for t, w in self.weights.items()}
        for t, s in (states or {}).items():
            state = json.loads(s)
            self.done[t], self.weights[t], self.speed[t] = state["epochs"], np.array(state["weights"]), np.array(state["speed"])

    @property
    def trials(self) -> list[int]:
        return list(self.configs)

    def dump(self, trial: int) -> str:
        return json.dumps({"epochs": self.done[trial], "weights": self.weights[trial].tolist(), "speed": self.speed[trial].tolist()})

    def keep(self, trials: Sequence[int]) -> None:
        self.configs = {t: self.configs[t] for t in self.configs if t in set(trials)}

    def close(self) -> None:
        self.blocks.unpersist()

    def grow(self, to: int) -> None:
        while due := [t for t, c in self.configs.items() if self.done[t] < min(to, c.max_epoch)]:
            if self.sync == "epoch":
                self._averaged(due)
            else:
                self._stepwise(due)
            for t in due:
                self.done[t] += 1

    def _summed(self, each: Callable[[int, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
        """Per trial the sum of what ``each(block, x, y)`` gives for it; tasks add up first, then a shuffle per trial."""

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, total = None, {}
            for block, x, y in _blocks(batches, TRAIN):
                first = block if first is None else first
                for t, v in each(block, x, y):
                    total[t] = total[t] + v if t in total else v
            for t, v in total.items():
                yield pa.RecordBatch.from_pydict({"trial": pa.array([t], pa.int64()), "first": pa.array([first], pa.int64()),
                                                  "sums": pa.array([v.tobytes()], pa.binary())})

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    v = np.frombuffer(row["sums"])
                    total[row["trial"]] = total[row["trial"]] + v if row["trial"] in total else v
            for t, v in total.items():
                yield pa.RecordBatch.from_pydict({"trial": pa.array([t], pa.int64()), "sums": pa.array([v.tobytes()], pa.binary())})

        rows = (self.blocks.mapInArrow(sums, "trial long, first long, sums binary").repartition("trial").sortWithinPartitions("trial", "first")
                .mapInArrow(added, "trial long, sums binary").collect())
        return {r["trial"]: np.frombuffer(r["sums"]) for r in rows}

    def _averaged(self, due: Sequence[int]) -> None:
        work = {t: (self.configs[t], self.weights[t], self.speed[t], self.done[t]) for t in due}
        inputs, classes = self.inputs, self.classes

        def each(block: int, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            for t, (config, weights, speed, epoch) in work.items():
                shapes, rows = config.shapes(inputs, classes), order(block, len(y), epoch, config.seed)
                weights, speed = weights.copy(), speed.copy()
                for k in range(0, len(rows), config.batch_size):
                    some = rows[k:k + config.batch_size]
                    speed = MOMENTUM * speed + gradient(weights, shapes, x[some], y[some]) / len(some)
                    weights = weights - config.lr * speed
                yield t, np.concatenate([weights * len(y), speed * len(y), [len(y)]])

        for t, v in self._summed(each).items():
            self.weights[t], self.speed[t] = np.split(v[:-1] / v[-1], 2)

    def _stepwise(self, due: Sequence[int]) -> None:
        longest = self.blocks.where(F.col("part") == TRAIN).agg(F.max("n")).first()[0] or 0
        inputs, classes = self.inputs, self.classes
        for step in range(max((-(-longest // self.configs[t].batch_size) for t in due), default=0)):
            work = {t: (self.configs[t], self.weights[t], self.done[t]) for t in due if step * self.configs[t].batch_size < longest}

            def each(block: int, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
                for t, (config, weights, epoch) in work.items():  # noqa: B023
                    some = order(block, len(y), epoch, config.seed)[step * config.batch_size:(step + 1) * config.batch_size]  # noqa: B023
                    if len(some):
                        yield t, np.append(gradient(weights, config.shapes(inputs, classes), x[some], y[some]), len(some))

            for t, v in self._summed(each).items():
                self.speed[t] = MOMENTUM * self.speed[t] + v[:-1] / v[-1]
                self.weights[t] = self.weights[t] - self.configs[t].lr * self.speed[t]

    def scores(self, part: int = VALID) -> dict[int, dict[str, float]]:
        """Mean cross entropy and accuracy of a part's rows."""
        work = {t: (c.shapes(self.inputs, self.classes), self.weights[t]) for t, c in self.configs.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, x, y in _blocks(batches, part):
                rows = []
                for t, (shapes, weights) in work.items():
                    chances = log_chances(weights, shapes, x)[0]
                    rows.append({"trial": t, "n": len(y), "loss": -float(chances[np.arange(len(y)), y].sum()), "hits": int((chances.argmax(axis=1) == y).sum())})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("trial", pa.int64()), ("n", pa.int64()), ("loss", pa.float64()), ("hits", pa.int64())]))

        each = self.blocks.mapInArrow(run, "trial long, n long, loss double, hits long")
        found = each.groupBy("trial").agg(*[F.sum(c).alias(c) for c in ("n", "loss", "hits")]).collect()
        return {r["trial"]: {"loss": r["loss"] / r["n"], "accuracy": r["hits"] / r["n"]} for r in found}


def search(blocks: DataFrame, inputs: int, classes: int, configs: Mapping[int, Config], milestones: Sequence[int], longest: int, factor: int = 2,
           metric: str = "loss", mode: str = "min", folder: str | None = None, sync: str = "epoch") -> list[dict]:
    """``halving.run`` over networks: budgets are epochs, survivors keep their weights."""

    def make(trials: Sequence[int], states: Mapping[int, str]) -> Training:
        return Training(blocks, inputs, classes, {t: configs[t] for t in trials}, states, sync)

    return halving.run(blocks.sparkSession, {t: c.__dict__ for t, c in configs.items()}, make, milestones, longest, factor, metric, mode, folder)
