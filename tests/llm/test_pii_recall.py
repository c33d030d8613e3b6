"""Recall of the kinds that the method adds, measured on planted spans; EM and classifier against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from geoloom.llm import pii

WORDS = "the of and river stone light house garden window paper winter letter summer table night morning".split()


def token(rng: random.Random) -> str:
    while True:
        s = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=rng.randint(28, 60)))
        if sum(c.isdigit() for c in s) >= 4:
            return s


def account(rng: random.Random) -> str:
    own = "".join(rng.choices("0123456789", k=18))
    body = "DE00" + own
    check = 98 - int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97
    return f"DE{check:02d}{own}"


PLANT = {
    "email": lambda r: (f"write to {r.choice(WORDS)}{r.randint(1, 99)}", f" {r.choice(['at', '[at]', '(at)'])} mail{r.randint(1, 9)} {r.choice(['dot', '[dot]'])} com"),
    "phone": lambda r: ("call ", f"{r.randint(200, 999)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}"),
    "identity": lambda r: ("ssn ", f"{r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"),
    "account": lambda r: ("iban ", account(r)),
    "secret": lambda r: ("api key = ", token(r)),
}
DECOYS = (
    lambda r: "sha commit " + "-".join(r.choices(WORDS, k=8)), lambda r: f"page {r.randint(100, 999)}-{r.randint(100, 999)}", lambda r: "_" * 40,
    lambda r: "doi section-" + "-".join(str(r.randint(1, 9)) for _ in range(12)), lambda r: f"invoice XY{r.randint(10, 99)} {r.randint(1000, 9999)} {r.randint(1000, 9999)} {r.randint(1000, 9999)}",
)


def planted(seed: int, n: int):
    rng = random.Random(seed)
    fill = lambda: " ".join(rng.choices(WORDS, k=rng.randint(5, 40)))
    for i in range(n):
        kind = (*PLANT, None)[i % (len(PLANT) + 1)]
        if kind is None:
            yield f"{fill()} {rng.choice(DECOYS)(rng)} {fill()}", None, ""
        else:
            lead, span = PLANT[kind](rng)
            if kind == "email":
                lead, span = lead.rsplit(" ", 1)[0] + " ", lead.rsplit(" ", 1)[1] + span
            yield f"{fill()} {lead}{span} {fill()}", kind, span


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.createDataFrame([(t,) for t, _, _ in planted(1, 600)], "text string"))


def test_recall_of_each_added_kind(model):
    caught, every, wrong, clean = {k: 0 for k in PLANT}, {k: 0 for k in PLANT}, 0, 0
    for text, kind, span in planted(2, 600):  # other texts than those of the fit
        more = [(pii.KINDS[k], text[a:b]) for k, a, b in pii.all_spans(text, model)[1]]
        if kind is None:
            clean += 1
            wrong += bool(more)
        else:
            every[kind] += 1
            caught[kind] += (kind, span) in more
    print({k: round(caught[k] / every[k], 3) for k in PLANT}, "clean texts with spans", wrong, "of", clean)
    assert all(caught[k] >= 0.9 * every[k] for k in PLANT)
    assert wrong <= 0.1 * clean


def plain_em(rows, rounds=60, edge=0.005, anchor=0.1):
    """The same updates by products of shares, pattern by pattern, labeler by labeler."""
    total, believed = sum(n for _, n in rows), {True: {-1: 0.12, 0: 0.4, 1: 0.48}, False: {-1: 0.36, 0: 0.4, 1: 0.24}}
    m, first = len(rows[0][0]), max(10.0, anchor * total)
    prior, shares = 0.7, {c: [dict(believed[c]) for _ in range(m)] for c in (True, False)}
    for _ in range(rounds):
        post = []
        for votes, _ in rows:
            good = prior * math.prod(shares[True][j][v] for j, v in enumerate(votes))
            bad = (1 - prior) * math.prod(shares[False][j][v] for j, v in enumerate(votes))
            post.append(good / (good + bad))
        weight = {True: [n * p for p, (_, n) in zip(post, rows, strict=True)], False: [n * (1 - p) for p, (_, n) in zip(post, rows, strict=True)]}
        prior = min(1 - edge, max(edge, (sum(weight[True]) + 1) / (total + 2)))
        for c in (True, False):
            for j in range(m):
                for v in (-1, 0, 1):
                    seen = sum(w for w, (votes, _) in zip(weight[c], rows, strict=True) if votes[j] == v)
                    shares[c][j][v] = (seen + first * believed[c][v]) / (sum(weight[c]) + first)
    return post, prior, *([[t[v] for v in (-1, 0, 1)] for t in shares[c]] for c in (True, False))


def test_em_is_the_plain_one():
    rng = random.Random(5)
    rows = [(tuple(rng.choice((-1, 0, 1)) for _ in range(6)), rng.randint(1, 50)) for _ in range(80)]
    got = pii.label_em(np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows]))
    for a, b in zip(got, plain_em(rows), strict=True):
        assert np.asarray(a) == pytest.approx(np.asarray(b), abs=1e-9)


def test_classifier_is_where_no_step_gains():
    """The fit has a vanishing gradient of the penalised likelihood, computed row by row."""
    rng = random.Random(6)
    shapes = np.array([[rng.randrange(s) for s in pii.SHAPE_SIZES] for _ in range(60)])
    target, n = np.array([rng.random() for _ in shapes]), np.array([float(rng.randint(1, 9)) for _ in shapes])
    x = pii._encoded(shapes)
    w = pii.fit_logistic(x, target, n)
    for j in range(x.shape[1]):
        slope = -w[j]
        for i in range(len(x)):
            slope += n[i] * x[i, j] * (target[i] - 1 / (1 + math.exp(-float(x[i] @ w))))
        assert abs(slope) < 1e-6
