"""Secrets of any length are found whole, in time proportional to the text."""

from __future__ import annotations

import random
import time

import pytest

from geoloom.llm import pii


@pytest.mark.parametrize("n", [24, 128, 129, 400, 5000])
def test_unbroken_tokens(n):
    rng = random.Random(n)
    token = "k9" + "".join(rng.choices("ghijkGHIJK_-", k=n - 4)) + "7Z"
    text = f"the token: {token} and more"
    found = [text[a:b] for k, a, b in pii.candidates(text)[1] if pii.KINDS[k] == "secret"]
    assert found == [token]


def test_long_runs_take_linear_time():
    start = time.time()
    pii.candidates("1 " + "-a" * 500_000 + " " + "_-" * 300_000 + "a")
    assert time.time() - start < 10
