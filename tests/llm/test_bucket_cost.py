"""Buckets of fingerprints: many meet in one call, whatever their size, and no link is lost."""

from __future__ import annotations

import numpy as np
import pytest

from geoloom.llm import minhash, simhash


def buckets(sizes, changes, rng):
    """Keys and distinct fingerprints; a twelfth of them are centres that the others surround."""
    key = np.repeat(np.arange(len(sizes)), sizes)
    fp = rng.integers(0, 1 << 63, max(2, len(key) // 12), dtype=np.uint64)[rng.integers(0, max(2, len(key) // 12), len(key))]
    for _ in range(changes):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, len(key)).astype(np.uint64))
    first = np.sort(np.unique(fp, return_index=True)[1])
    return key[first], fp[first]


def roots(fp, a, b):
    place = {int(x): i for i, x in enumerate(fp)}
    root = list(range(len(fp)))

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        i, j = of(place[x]), of(place[y])
        root[max(i, j)] = min(i, j)
    return [of(x) for x in range(len(fp))]


@pytest.mark.parametrize("medium, words", [(1024, 4096), (40, 3), (1, 4096), (1, 5)])
def test_links_by_brute_force(monkeypatch, medium, words):
    monkeypatch.setattr(simhash, "MEDIUM", medium)
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", words)
    rng = np.random.default_rng(medium + words)
    for trial in range(12):
        key, fp = buckets(rng.integers(1, (5, 70, 300)[trial % 3], (60, 20, 5)[trial % 3]), 3 + trial % 4, rng)
        near = (np.bitwise_count(fp[:, None] ^ fp) <= 6) & (key[:, None] == key)
        a, b = simhash.bucket_edges(key, fp, 6)
        assert (np.bitwise_count(a ^ b) <= 6).all()
        i, j = np.nonzero(near)
        assert roots(fp, a, b) == roots(fp, fp[i], fp[j])
    assert [len(x) for x in simhash.bucket_edges(key[:0], fp[:0], 6)] == [0, 0]


@pytest.mark.parametrize("size", [8, 46, 231, 2000])
def test_many_meet_in_one_call(monkeypatch, size):
    """Two hash blocks of a few million texts have some 46 of them to a bucket: the calls follow the words compared, not the texts."""
    rng, calls, within = np.random.default_rng(size), [], simhash.within
    monkeypatch.setattr(simhash, "within", lambda p, *rest: calls.append(p.shape[1]) or within(p, *rest))
    n = 20_000 // size
    simhash.bucket_edges(np.repeat(np.arange(n), size), rng.integers(0, 1 << 63, n * size, dtype=np.uint64), 6)
    assert len(calls) <= 10 * n * (size > simhash.MEDIUM) + 20_000 * (2 + size / 64) / 4096
    assert sum(calls) <= 20_000 * (2 + size / 64)


def test_a_bucket_of_near_copies_costs_its_size():
    """Near copies give about as many links as there are."""
    rng = np.random.default_rng(1)
    for size in (200, 3000):
        fp = np.full(size, 99, np.uint64)
        for _ in range(3):
            fp = fp ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64))
        fp = np.unique(fp)
        a, b = simhash.bucket_edges(np.zeros(len(fp), np.int64), fp, 6)
        assert len(set(roots(fp, a, b))) == 1 and len(a) < 3 * len(fp)


def test_least_values_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    same, all_ = 0, 0
    for _ in range(60):
        common = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 5, dtype=np.uint64)])) for _ in range(2))
        same += int((minhash.band_keys(a) == minhash.band_keys(b)).sum())
        all_ += minhash.BANDS
    assert abs(same / all_ - (160 / 170) ** minhash.ROWS) < 0.05
