"""Operator 2's lattices: words are learned once, their pieces found by slots and read from lines."""

from __future__ import annotations

import random

import numpy as np
import pytest

from geoloom.llm import pieces as P

ODD = ["\n\n a\nb \n  c", "a\n", "\n", " ", "   x", "日本 \n語́ \ńe", "▁a b\n▁▁ c", "\x01 \x02x", "\U0001f600\n\U0001f600 \t\r\n", "<s> </s>\n<unk> <0x0A>\n<0x41>", "x" * 3000, "\0 a\n\0", "the internationalization of Wörter"]


@pytest.fixture(scope="module")
def model():
    return P.Model()


def words(model, texts):
    return list(dict.fromkeys(w for x in texts for w in model.words_of(x)))


def test_lines_give_the_pieces_of_words(model):
    rnd = random.Random(2)
    texts = [*ODD, *("".join(rnd.choice("ab \n▁é語\x01") for _ in range(rnd.randrange(40))) for _ in range(400))]
    spelled = [model.spelled(w) for w in words(model, texts)]
    for n in (1, 63, 64, 65, 128, len(spelled)):
        (ids, counts), (want, want_counts) = model._own(spelled[:n]), model._own_apart(spelled[:n])
        assert ids.tolist() == want.tolist() and counts.tolist() == want_counts.tolist()


def test_edges_are_all_pieces(model):
    of = {model.sp.id_to_piece(i): i for i in range(model.size) if not (model.sp.is_control(i) or model.sp.is_unknown(i) or model.sp.is_byte(i) or model.sp.is_unused(i))}
    for text in ODD:
        found, _ = model.numbers([text])
        for n, w in zip(found.tolist(), model.words_of(text), strict=True):
            s, first = model.spelled(w), int(model.first.view[n])
            for i in range(min(len(s), 60)):
                _, lo, hi = model.around(int(model.edge_at.view[first + i]))
                want = [of[s[i : i + k]] for k in range(model.longest, 0, -1) if i + k <= len(s) and s[i : i + k] in of]
                assert [e for e in model.id.view[lo:hi].tolist() if e >= 0 and e < P._BYTE and e not in set(model.bytes.tolist())] == want
                assert s[i] in of or hi - lo == len(want) + 1


def test_words_are_learned_once():
    model, learned = P.Model(), []
    make = model._lattices
    model._lattices = lambda ws: (learned.extend(ws), make(ws))
    texts = [" ".join(f"{i:x}" for i in range(a, a + 5000)) for a in range(0, 120_000, 5000)]
    for _ in range(2):
        for x in texts:
            model.numbers([x])
    assert len(learned) == len(set(learned)) == len(model.table)
    assert np.array_equal(model.numbers(texts[:1])[0], np.arange(5000))
