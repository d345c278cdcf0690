"""What tasks of the quality classifier hold, and that working in parts rounds as working at once."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tagtable.llm import quality
from tagtable.llm.words import chunks, rows_of, sums

LIMIT = 64 << 20


def texts(n, words=60, seed=5):
    draw = random.Random(seed)
    known = ["".join(draw.choices("abcdefghé", k=draw.randint(1, 12))) for _ in range(3000)]
    return pa.array([" ".join(draw.choices(known, k=draw.randint(0, words))) for _ in range(n)])


def peak(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def described(column):
    found = [quality.Features(part).sparse() for _, _, part in chunks(column)]
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, _, b in found]))])
    return np.concatenate([f[0] for f in found]).astype(np.int32), np.concatenate([f[1] for f in found]).astype(np.float32), bounds


def at_once(buckets, values, bounds, target, rounds):
    """All texts and all features at a time."""
    weights, bias, squares, bias_square = np.zeros(quality.FEATURES), 0.0, np.full(quality.FEATURES, 1e-8), 1e-8
    heavy = np.where(target > 0.5, 0.5 / max(1, (target > 0.5).sum()), 0.5 / max(1, (target <= 0.5).sum()))
    for _ in range(rounds):
        z = sums(weights[buckets] * values, bounds) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * heavy
        slope = np.bincount(buckets, error[rows_of(bounds)] * values, minlength=quality.FEATURES) + 1e-5 * weights
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias -= 0.5 * error.sum() / np.sqrt(bias_square)
    return weights, bias


def test_training_holds_features_that_occur_and_rounds_the_same(monkeypatch):
    buckets, values, bounds = described(texts(300))
    target = np.where(np.arange(300) % 3 == 0, 0.97, 0.02)
    (weights, bias), most = peak(lambda: quality.train(buckets, values, bounds, target, rounds=8))
    assert most < LIMIT
    wanted, wanted_bias = at_once(buckets, values, bounds, target, 8)
    assert np.array_equal(weights, wanted) and bias == wanted_bias
    for size in (1, 1000, 7777):
        monkeypatch.setattr(quality, "TRAINED_AT_ONCE", size)
        got, got_bias = quality.train(buckets, values, bounds, target, rounds=8)
        assert np.array_equal(got, wanted) and got_bias == wanted_bias


def test_texts_without_features_are_trained_on():
    none = np.zeros(0, np.int32), np.zeros(0, np.float32)
    weights, bias = quality.train(*none, np.zeros(3, np.int64), np.array([0.9, 0.9]), rounds=2)
    assert not weights.any() and bias > 0
    assert quality.train(*none, np.zeros(1, np.int64), np.zeros(0))[1] == -30.0


def test_features_of_many_texts_hold_little():
    column = texts(2500, 400)
    assert column.nbytes > 2 << 20
    _, most = peak(lambda: [quality.Features(part).counts for _, _, part in chunks(column)])
    assert most < LIMIT


def test_scores_in_parts_are_those_of_one_pass():
    column = pa.concat_arrays([texts(700, 100), pa.array([None, "", " "]), texts(2, 60000), texts(300, 100, 6)])
    draw = np.random.default_rng(2)
    scorers = [(draw.normal(size=quality.FEATURES).astype("<f4"), bias) for bias in (-1.0, 0.5)]
    wanted = []
    for _, _, part in chunks(column, quality.SCORED_BYTES):
        seen = quality.Features(part)
        wanted.append(np.stack([seen.scores(*s) for s in scorers]))
    got, rows = [], 0
    for first, end, counts, scores in quality._scored(column, scorers):
        assert (first, len(counts)) == (rows, end - first)
        rows = end
        got.append(np.stack(scores))
    assert len(got) > len(wanted) and rows == len(column)
    assert np.array_equal(np.concatenate(got, 1), np.concatenate(wanted, 1))


def test_described_texts_come_by_their_keys():
    draw = np.random.default_rng(4)
    keys, sizes = draw.permutation(50) - 25, draw.integers(0, 6, 50)
    lists = [draw.integers(0, 99, n).astype(np.int32) for n in sizes]
    schema = pa.schema({"key": pa.int64(), "target": pa.float64(), "buckets": pa.list_(pa.int32()), "values": pa.list_(pa.float32())})
    rows = pa.table({"key": keys, "target": keys / 50, "buckets": lists, "values": [x / 2 for x in lists]}, schema=schema)
    batches = pa.Table.from_batches([b for i in range(0, 50, 7) for b in rows.slice(i, 7).to_batches()])
    buckets, values, bounds, target = quality._in_order(batches)
    order = np.argsort(keys)
    assert [buckets[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [lists[i].tolist() for i in order]
    assert np.array_equal(values, buckets / 2) and np.array_equal(target, keys[order] / 50)
