"""The language stage drops foreign scripts and letter junk, and keeps short clean documents."""

from __future__ import annotations

import random

from geoloom.llm import langid


def test_stage_on_foreign_scripts_and_junk(spark, sf_dir):
    rng = random.Random(1)
    alphabets = [[chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x5200)], "bcdfghjklmnpqrstvwxz", "abcdefghijklmnopqrstuvwxyz"]
    odd = [" ".join("".join(rng.choices(a, k=rng.randint(2, 9))) for _ in range(120)) for a in alphabets for _ in range(30)]
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").where("lang IS NOT NULL").limit(1000)
    clean = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    english = [x for _, x, lang in clean if lang == "en" and len(x) > 400][:60]
    short = [" ".join(x.split()[10:22]) for x in english]
    rows = clean + [(10**9 + i, x, None) for i, x in enumerate(odd)] + [(2 * 10**9 + i, x, None) for i, x in enumerate(short)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = [r["doc_id"] for r in langid.language_stage(spark, df, sf_dir).collect()]
    assert not [i for i in kept if 10**9 <= i < 2 * 10**9]
    assert sum(i >= 2 * 10**9 for i in kept) == len(short)
    assert sum(i < 10**9 for i in kept) >= 0.995 * len(clean)
