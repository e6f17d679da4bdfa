"""The alignment of two pages' lines: one chain, whatever the pages' size and however often lines repeat."""

import random
from bisect import bisect_left

import pytest

from skein.llm import html_text


def chain(a, b):
    """The longest chain of matches, patience style: every match is looked at, so only for small pages."""
    tails, ends = [], []
    for i, x in enumerate(a):
        for j in [j for j in range(len(b)) if b[j] == x][::-1]:
            k = bisect_left(tails, j)
            tails[k : k + 1], ends[k : k + 1] = [j], [(i, j, ends[k - 1] if k else None)]
    out, node = [], ends[-1] if ends else None
    while node:
        out.append(node[:2])
        node = node[2]
    return out[::-1]


@pytest.mark.parametrize("step", [1, 3, 256])
def test_the_chain_is_the_same_however_many_rows_are_kept(monkeypatch, step):
    monkeypatch.setattr(html_text, "STEP", step)
    rnd = random.Random(step)
    for _ in range(1000):
        kinds = rnd.choice([1, 2, 4, 30])
        a, b = ([rnd.randrange(kinds + extra) for _ in range(rnd.randrange(60))] for extra in (0, 2))
        assert html_text.common(a, b) == chain(a, b)


def test_pages_of_over_a_million_matches_are_aligned_as_well_as_small_ones():
    a, b = ["x"] * 600 + ["y"] + ["x", "z"] * 600, ["x", "z"] * 600
    assert html_text.common(a, b) == [(i + 601, i) for i in range(1200)]  # the n-th x with the n-th x gives 601
