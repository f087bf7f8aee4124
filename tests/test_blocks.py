"""Matching blocks of many pairs at once, against difflib."""

import random
from difflib import SequenceMatcher
from time import process_time

import pytest

from scriptorium.functions import blocks, kernels


def by_difflib(a, b):
    return sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())


def pairs(rng):
    letters = rng.choice(["a", "ab", "abcdefgh", "le roy de france", "αβγé𝒳z"])
    text = lambda: "".join(rng.choices(letters, k=rng.randint(1, rng.choice([3, 20, 90]))))
    for _ in range(rng.randint(1, 40)):
        a = text()
        yield a, text() if rng.random() < 0.6 else "".join(c for c in a if rng.random() < 0.9) or "x"


@pytest.mark.parametrize("places,wide,batch", [(1 << 20, 1 << 26, 1 << 17), (20, 1 << 26, 1 << 17), (200, 300, 500)])
def test_blocks_are_those_of_difflib(monkeypatch, places, wide, batch):
    for name, value in (("MOST_PLACES", places), ("WIDE", wide), ("BATCH", batch)):
        monkeypatch.setattr(blocks, name, value)
    rng = random.Random(places)
    for _ in range(20):
        a, b = zip(*pairs(rng), strict=True)
        found = blocks.matched(*([kernels.code_points(t) for t in side] for side in (a, b)))
        assert list(found) == [by_difflib(x, y) for x, y in zip(a, b, strict=True)]


def test_similarities_are_those_of_single_pairs():
    a = ["", None, "le Roy", "¬", "é", "Straße", None, "ſi", "abc", "\ud800x"]
    b = ["x", "a", None, "b", "e", "STRASSE", None, "si", "bcd", "x"]
    assert kernels.similarities(a, b) == [None if x is None or y is None else kernels.similarity(x, y) for x, y in zip(a, b, strict=True)]
    assert kernels.similarities([], []) == []


def test_long_lines_take_no_product_of_lengths():
    rng = random.Random(2)
    a, b = ("".join(rng.choices("abcdefghijklmnop  ", k=30_000)) for _ in range(2))
    began = process_time()
    found = kernels.ratio.func(*(kernels.pd.Series([t]) for t in (a, b)))[0]
    assert 0 < found < 1 and process_time() - began < 5
