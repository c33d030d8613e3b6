"""Seeds lose no link: the result is that of aligning every text with every item."""

from __future__ import annotations

import random

import numpy as np
import pytest

from geoloom.llm import decontaminate as D


def aligned(texts: list[str], items: D.Items) -> dict[tuple[int, int], int]:
    """Every text against every item."""
    h, begins = D.word_hashes(texts)
    out = {}
    for t in range(len(texts)):
        for i, w in enumerate(items.words):
            score = D.align(h[begins[t] : begins[t + 1]], w)[0] if len(w) else 0
            if len(w) and score >= D.needed(len(w)):
                out[t, i] = score
    return out


def edited(rng: random.Random, copy: list[str], kind: int, vocabulary: list[str]) -> list[str]:
    if kind == 0:
        return copy
    if kind <= 4:  # each third to sixth word replaced
        return [rng.choice(vocabulary) if k % (kind + 2) == kind else x for k, x in enumerate(copy)]
    if kind == 5:  # a word after each word
        return [y for x in copy for y in (x, rng.choice(vocabulary))]
    if kind == 6:  # each third word left out
        return [x for k, x in enumerate(copy) if k % 3]
    at = rng.randint(0, len(copy))
    return copy[at:] + copy[:at]


@pytest.mark.parametrize(("seed", "size"), [(1, 6), (2, 30), (3, 300), (4, 5000)])
def test_as_aligning_all_pairs(seed, size):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(size)]
    rows = [rng.choices(vocabulary, k=n) for n in [0, 1, 2, 3, 4, 5, 6, 8, 12, 15, 20, 40, 70, 130] * 2]
    texts = []
    for d in range(64):
        w = rng.choices(vocabulary, k=rng.randint(0, 120)) if d % 5 else []
        w[len(w) // 2 : len(w) // 2] = edited(rng, rng.choice(rows), d % 8, vocabulary)
        texts.append(" ".join(w))
    items = D.Items.of([(str(i), " ".join(w)) for i, w in enumerate(rows)])
    h, begins = D.word_hashes(texts)
    want = aligned(texts, items)
    assert {(t, i): s for t, i, s in D.copies(h, begins, items)} == want and want
    empty = D.Items.of([])
    assert D.copies(h, begins, empty) == [] and D.copies(*D.word_hashes([]), items) == []


def test_few_places_at_once(monkeypatch):
    """However little is looked at together."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(5)]
    items = D.Items.of([(str(i), " ".join(rng.choices(vocabulary, k=30))) for i in range(10)])
    h, begins = D.word_hashes([" ".join(rng.choices(vocabulary, k=200)) for _ in range(20)])
    before = D.copies(h, begins, items)
    monkeypatch.setattr(D, "MANY_PLACES", 1)
    assert before and D.copies(h, begins, items) == before


@pytest.mark.parametrize("every", [3, 4, 5])
def test_replaced_words(every):
    """Copies with each third, fourth or fifth word replaced: every one is found."""
    rng = random.Random(every)
    vocabulary = [f"v{k}" for k in range(4000)]
    rows = [rng.choices(vocabulary, k=60 if every == 3 else 40) for _ in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=80) + [rng.choice(vocabulary) if k % every == every - 1 else x for k, x in enumerate(w)] + rng.choices(vocabulary, k=80)) for w in rows]
    items = D.Items.of([(str(i), " ".join(w)) for i, w in enumerate(rows)])
    found = {(t, i) for t, i, _ in D.copies(*D.word_hashes(texts), items)}
    assert found == {(i, i) for i in range(40)}


def test_seeds_are_the_rare_places():
    """What many items share is no seed where enough else is one."""
    rng = random.Random(8)
    common = [f"c{k}" for k in range(10)]
    rows = [[*common, *(f"r{i}x{k}" for k in range(30))] for i in range(20)]
    items = D.Items.of([(str(i), " ".join(w)) for i, w in enumerate(rows)])
    shared = D.word_hashes([" ".join(common)])
    assert not len(items.hits(*shared)[0])
    rng.shuffle(rows)
    assert len(items.hits(*D.word_hashes([" ".join(rows[0])]))[0]) > 20


def test_query_on_all_rows(spark, sf_dir):
    """The query's rows and scores on its whole tables."""
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [(r["item_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = aligned([t for _, t in docs], D.Items.of([(str(i), t) for i, t in rows]))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.op9_decontaminate(spark, sf_dir).collect()}
    assert got == {(docs[t][0], rows[i][0]): s for (t, i), s in want.items()} and got


def test_ids_of_text(spark):
    text = "seven words that stand in a row"
    docs = spark.createDataFrame([("https://a.example/1", f"before {text} after"), ("b", "nothing of it"), (None, text)], "doc_id string, text string")
    bench = spark.createDataFrame([("4f-a", text), (None, "nothing of it at all here and there")], "item_id string, text string")
    got = D.contaminated(docs, bench)
    assert dict(got.dtypes)["item_id"] == "string"
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {("https://a.example/1", "4f-a"), (None, "4f-a")}
    numbers = D.contaminated(docs, spark.createDataFrame([(7, text)], "item_id int, text string"))
    assert {r["item_id"] for r in numbers.collect()} == {7}
    assert np.all([r["score"] == 14 for r in got.collect()])
