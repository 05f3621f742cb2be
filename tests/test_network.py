"""Minibatch descent on Spark against plain loops."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import halving, network
from quern.operators.network import MOMENTUM, Config, Training


@pytest.fixture(scope="module")
def blocks(spark):
    draw = np.random.default_rng(3)
    x = draw.standard_normal((400, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int) + (x[:, 3] > 1)
    rows = [(k, v.tolist(), int(c), int(k % 5 == 0)) for k, (v, c) in enumerate(zip(x, y))]
    rows += [(500, None, 1, 0), (501, [1.0] * 5, None, 0), (502, [None] * 5, 1, 0)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int, part int").repartition(3, "id")
    return network.to_blocks(df, "x", "y", "part", 70)


def data(blocks, part):
    return [(r.block, np.frombuffer(r.x).reshape(r.n, -1), np.frombuffer(r.y, np.int32)) for r in blocks.where(F.col("part") == part).orderBy("block").collect()]


def test_gradient_matches_differences():
    draw = np.random.default_rng(1)
    config = Config(l1=4, l2=3, seed=5)
    shapes, w = config.shapes(5, 3), config.start(5, 3)
    x, y = draw.standard_normal((7, 5)), draw.integers(0, 3, 7)
    loss = lambda w: -network.log_chances(w, shapes, x)[0][np.arange(7), y].sum()
    found = network.gradient(w, shapes, x, y)
    for k in range(len(w)):
        step = np.zeros(len(w))
        step[k] = 1e-6
        assert found[k] == pytest.approx((loss(w + step) - loss(w - step)) / 2e-6, abs=1e-5)


CONFIGS = {0: Config(8, 4, 0.05, 8, 3, 1), 1: Config(8, 4, 0.05, 16, 3, 1), 2: Config(4, 4, 0.01, 3, 2, 7)}


def test_step_mode_is_plain_descent(blocks):
    training = Training(blocks, 5, 3, CONFIGS, sync="step")
    training.grow(1)
    training.grow(5)
    for t, c in CONFIGS.items():
        w = c.start(5, 3)
        speed, parts, shapes = np.zeros_like(w), data(blocks, 0), c.shapes(5, 3)
        for epoch in range(c.max_epoch):
            for k in range(0, max(len(y) for *_, y in parts), c.batch_size):
                rows = [(x[o], y[o]) for b, x, y in parts for o in [network.order(b, len(y), epoch, c.seed)[k:k + c.batch_size]]]
                x, y = (np.concatenate(v) for v in zip(*rows))
                speed = MOMENTUM * speed + network.gradient(w, shapes, x, y) / len(y)
                w = w - c.lr * speed
        assert training.done[t] == c.max_epoch and np.allclose(training.weights[t], w, atol=1e-10)
    assert not np.allclose(training.weights[0], training.weights[1], atol=1e-3)
    x, y = (np.concatenate([d[k] for d in data(blocks, 1)]) for k in (1, 2))
    chances = network.log_chances(training.weights[0], CONFIGS[0].shapes(5, 3), x)[0]
    assert training.scores()[0] == {"loss": pytest.approx(-chances[np.arange(len(y)), y].mean()), "accuracy": (chances.argmax(axis=1) == y).mean()}
    training.close()


def test_epoch_mode_averages_the_blocks(blocks):
    training = Training(blocks, 5, 3, CONFIGS)
    training.grow(2)
    for t, c in CONFIGS.items():
        w, shapes = c.start(5, 3), c.shapes(5, 3)
        speed = np.zeros_like(w)
        for epoch in range(2):
            ends = []
            for b, x, y in data(blocks, 0):
                v, s = w, speed
                o = network.order(b, len(y), epoch, c.seed)
                for k in range(0, len(y), c.batch_size):
                    some = o[k:k + c.batch_size]
                    s = MOMENTUM * s + network.gradient(v, shapes, x[some], y[some]) / len(some)
                    v = v - c.lr * s
                ends.append((v, s, len(y)))
            total = sum(n for *_, n in ends)
            w, speed = sum(v * n for v, _, n in ends) / total, sum(s * n for _, s, n in ends) / total
        assert np.allclose(training.weights[t], w, atol=1e-10)
    training.close()


def test_search_resumes_from_stored_weights(blocks, tmp_path, monkeypatch):
    configs = {k: Config(8, 8, 0.002 * 4 ** k, 8, 20, k) for k in range(4)}
    whole = network.search(blocks, 5, 3, configs, [1, 2], 4)
    assert [r["rung"] for r in whole] == [1] * 4 + [2] * 2 + [4]
    folder, grow = str(tmp_path / "rungs"), Training.grow

    def stopped(self, to):
        if to == 4:
            raise KeyboardInterrupt
        grow(self, to)

    monkeypatch.setattr(Training, "grow", stopped)
    with pytest.raises(KeyboardInterrupt):
        network.search(blocks, 5, 3, configs, [1, 2], 4, folder=folder)
    monkeypatch.setattr(Training, "grow", grow)
    rest = network.search(blocks, 5, 3, configs, [1, 2], 4, folder=folder)
    one, other = json.loads(rest[0]["state"]), json.loads(whole[-1]["state"])
    assert [r["trial"] for r in rest] == [whole[-1]["trial"]] and one["epochs"] == 4 and np.allclose(one["weights"], other["weights"], atol=1e-10)
    assert halving.best(whole, "loss", "min") is whole[-1]


def test_no_training_rows(blocks):
    training = Training(blocks.where("part = 1"), 5, 3, {0: CONFIGS[0]}, sync="step")
    training.grow(2)
    assert np.array_equal(training.weights[0], CONFIGS[0].start(5, 3))
    training.close()
