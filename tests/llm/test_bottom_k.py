import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tarnlake.llm import bottom_k, spans

from .cases import awkward, empty, frame, words
from .test_join_and_lines import near_copies, result, shingles


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    smallest = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            smallest[find(i)] = min(k, smallest.get(find(i), k))
    root = [smallest.get(find(i)) if sets[i] else k for i, (k, _) in enumerate(rows)]
    return sorted(((k, len(sets[i]), root[i], k is not None and k == root[i]) for i, (k, _) in enumerate(rows)), key=str)


def close_copies(n, seed):
    """Copies with few edits, on both sides of 0.85, of texts of 30 to 400 words."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        base = r.randrange(8)
        text = words(base, [30, 45, 64, 70, 90, 150, 250, 400][base])
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4, 6, 9])):
            text[r.randrange(len(text))] = f"edit{r.randrange(10**6)}"
        rows.append((2000 + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("part", [2000, 10**6])
def test_components_equal_all_pairs(spark, part):
    rows = awkward() + near_copies(80) + close_copies(160, 4)
    assert result(bottom_k.near_duplicates(frame(spark, rows), part=part)) == brute(rows)


def test_empty_table(spark):
    assert bottom_k.near_duplicates(empty(spark)).count() == 0


def test_linked_sets_share_what_is_asked_of_them():
    """The bound of the overlap, by the hypergeometric distribution of shared values among the union's smallest."""
    for k in (16, 64, 128, 256):
        s = bottom_k.least_shared(k, 0.85)
        lost = sum(math.comb(k, i) * 0.85**i * 0.15**(k - i) for i in range(s))
        assert 0 < s < 0.85 * k and lost < 1e-12


def test_blocks_connect_what_all_pairs_connect():
    r = random.Random(6)
    t = Fraction(17, 20)
    for _ in range(40):
        base = r.sample(range(10**6), 120)
        sets = []
        for _ in range(25):
            some = set(base[:r.choice([20, 60, 120])])
            for _ in range(r.choice([0, 1, 3, 6, 12])):
                some.discard(r.choice(base))
                some.add(r.randrange(10**7))
            sets.append(np.sort(spans.mix(np.array(sorted(some), np.uint64))))
        block = bottom_k.Block(sets, range(25), t, 64)
        every = np.ones(25, bool)
        links = block.links(every, every, later=True)
        up = list(range(25))

        def find(i):
            while up[i] != i:
                i = up[i]
            return i
        for i, j in itertools.combinations(range(25), 2):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if 100 * len(a & b) >= 85 * len(a | b):
                up[find(i)] = find(j)
        group = block.group
        assert all((group[i] == group[j]) == (find(i) == find(j)) for i, j in itertools.combinations(range(25), 2))
        assert len(links) == 25 - len({find(i) for i in range(25)})
