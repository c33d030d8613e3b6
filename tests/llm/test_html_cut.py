"""The cut against the blocks' own scores, on pages whose article is known and whose markup has been taken away."""

from __future__ import annotations

import collections
import html as entities
import re

import pytest

from geoloom.llm import html


def article(page: str) -> collections.Counter:
    a = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    parts = re.split(r"</?(?:p|h1)>", a[1]) if a else []
    return collections.Counter(" ".join(entities.unescape(re.sub(r"<[^>]*>?", "", b.replace("<br>", " "))).split()) for b in parts)


def bare(page: str) -> str:
    page = re.sub(r"<(/?)(article|nav|footer|header|aside|form|main|section)\b[^>]*>", r"<\1div>", page)
    return re.sub(r' (class|id|role)="[^"]*"', "", page)


def test_cut_corrects_labels_in_both_directions(spark, sf_dir):
    where = sf_dir.replace("sf0.001", "sf0.1")
    table = spark.read.parquet(f"{where}/pages.parquet")
    weights = html.fit(table)
    assert weights == html.fit(table.repartition(3))
    own_wrong = cut_wrong = raised = lowered = 0
    for (page,) in table.select("html").collect():
        true = article(page or "")
        for b, own, label in zip(*html.labelled(bare(page or ""), weights), strict=True):
            y = true[b.text] > 0
            own_wrong += (own > 0) != y
            cut_wrong += label != y
            raised += label and own <= 0 and y
            lowered += not label and own > 0 and not y
    assert raised > 10 and lowered > 1000 and cut_wrong < 0.1 * own_wrong


def test_fit_is_drawn_to_the_start(spark):
    assert html.fit(spark.createDataFrame([], "html string")).text == html.START
    assert html.fit(spark.createDataFrame([], "html string")).edges == pytest.approx(html.START_EDGES)
    few = html.fitted([((0, 4, 7), 1, 5)], [])
    assert few.text[4] > html.START[4] and few.text[9] == pytest.approx(html.START[9])


def test_empty_table_and_clashing_names(spark):
    kind = "page_id long, html string, text string, kind string, columns int, y int"
    assert html.extracted(spark.createDataFrame([], kind)).collect() == []
    page = "<article><p>One sentence of the article stands here, long enough to count.</p></article>"
    (r,) = html.extracted(spark.createDataFrame([(1, page, "old", "k", 2, 3)], kind)).collect()
    assert r["text"].startswith("One sentence") and (r["kind"], r["columns"], r["y"]) == ("k", 2, 3)
