"""A part of an item that very many documents hold is found in all of them."""

from __future__ import annotations

import random

from geoloom.llm import decontaminate


def test_passages_in_many_documents(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    half, long, other = rng.choices(words, k=60), rng.choices(words, k=120), rng.choices(words, k=50)
    bench = spark.createDataFrame([(0, " ".join(half)), (1, " ".join(long)), (2, " ".join(other))], "item_id long, text string")
    passages = [half[20:47], long[70:111], other[:8]]  # 45 %, a run of 41 words, and a phrase that is no copy
    rows = []
    for d in range(3 * 1100):
        w = rng.choices(words, k=rng.randint(10, 40))
        w[5:5] = passages[d % 3]
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(d, d % 3) for d in range(3 * 1100) if d % 3 < 2}
    assert decontaminate.clean(df, bench).count() == 1100
