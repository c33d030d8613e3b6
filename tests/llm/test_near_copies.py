"""Near copies of the pipeline's stage, against similarities by brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import minhash, simhash


def sets_of(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def similarity(a, b):
    return len(a & b) / len(a | b)


def test_stage_drops_near_copies_down_to_the_limit(spark):
    """Pairs of texts with a few words changed: one stays of each pair at 0.8 or more, both of those below."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5000)]
    rows, want = [], set()
    for k, (n, changes) in enumerate(itertools.product((40, 80, 250, 1000), (0, 1, 2, 4, 8, 16))):
        for j in range(3):
            a = rng.choices(words, k=n)
            b = list(a)
            for i in rng.sample(range(n), changes):
                b[i] = "changed" + str(i)
            i = 100 * k + 10 * j
            rows += [(i, " ".join(a)), (i + 1, " ".join(b))]
            want |= {i} if similarity(sets_of(" ".join(a)), sets_of(" ".join(b))) >= 0.8 else {i, i + 1}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.near_duplicate_stage(spark, df, "").collect()} == want


@pytest.mark.parametrize("block", [minhash.BLOCK_TEXTS, 3])
def test_components_by_brute_force(spark, block):
    """Chains of edits: members of one component needn't be similar themselves; blocks don't change it."""
    rng = random.Random(6)
    texts, now = [], []
    for k in range(60):
        now = rng.choices([f"w{i}" for i in range(3000)], k=60) if k % 12 == 0 else [*now[:5], *now[6:], f"new{k}"]
        texts.append(" ".join(now))
    sets = [sets_of(t) for t in texts]
    root = list(range(60))
    for i, j in itertools.combinations(range(60), 2):
        if similarity(sets[i], sets[j]) >= 0.8:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["root"] for r in minhash.near_copies(df, ("id",), block_texts=block).collect()}
    for i, j in itertools.combinations(range(60), 2):
        assert (got[i] == got[j]) == (root[i] == root[j])


def test_stage_meets_by_fingerprints(spark, monkeypatch):
    """Operator 1's fingerprints and links alone find close copies: bands that never meet don't change them."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for k in range(20):
        a = rng.choices(words, k=600)
        b = [*a[:300], "changed", *a[301:]]
        rows += [(2 * k, " ".join(a), k), (2 * k + 1, " ".join(b), k)]
    prints = [minhash.shingles(t) for _, t, _ in rows]
    bits = [(simhash.set_fingerprint(x) ^ simhash.set_fingerprint(y)).bit_count() for x, y in zip(prints[::2], prints[1::2], strict=True)]
    close = {k for k, n in enumerate(bits) if n <= simhash.STAGE_RADIUS}
    assert len(close) > 15
    lone = lambda s: np.full(minhash.BANDS, int(s[0]) if len(s) else 0, np.uint64) ^ np.uint64(int(s.sum(dtype=np.uint64)))
    monkeypatch.setattr(minhash, "band_keys", lone)
    df = spark.createDataFrame(rows, "doc_id long, text string, pair int").select("doc_id", "text")
    keyed = df.withColumn("id", F.col("doc_id").cast("string"))
    got = {r["id"]: r["root"] for r in minhash.near_copies(keyed, ("id",), fingerprint=simhash.set_fingerprint, linked=simhash.stage_links).collect()}
    assert {k for k in range(20) if got[str(2 * k)] == got[str(2 * k + 1)]} >= close
