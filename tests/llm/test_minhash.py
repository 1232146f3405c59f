import random

import numpy as np
import pytest

from rowproof.llm import minhash


def sets_of(rows, k):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def by_hand(rows, k, percent):
    sets = sets_of(rows, k)
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[:n]:
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(x), find(y)
                top[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def found(df, **options):
    return {r["doc_id"]: tuple(r)[1:] for r in minhash.near_duplicates(df, **options).collect()}


def family(n, edits, seed, words=120):
    """Copies of one text, each with up to ``edits`` other words."""
    rng = random.Random(seed)
    base = [f"{seed}w{i}" for i in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_documents(documents, rows):
    want = by_hand([(r["doc_id"], r["text"]) for r in rows], 3, 85)
    assert found(documents, k=3, percent=85) == want


@pytest.mark.parametrize("small,block", [(16, 512), (2, 7)])
def test_families_in_pairs_and_in_blocks(texts, small, block):
    values = family(40, 8, 1) + family(30, 3, 2) + family(12, 0, 3) + ["a b", "A B", "a b c", "", None, " \t\n", "same word", "same word"]
    random.Random(4).shuffle(values)
    df = texts(values)
    assert found(df, k=3, percent=85, small=small, block=block) == by_hand(list(enumerate(values)), 3, 85)


def test_empty_null_and_repeated(texts, empty):
    assert minhash.near_duplicates(empty).count() == 0
    df = texts(["x y z", "x y z", None, "x y z"], ids=[5, 5, None, None])
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True), (None, 1, 5, False)], key=repr)


def test_only_ascii_letters_are_lowered(texts):
    got = found(texts(["É a b c", "é a b c", "É A b c"]), k=3)
    assert [got[i][1] for i in range(3)] == [0, 1, 0]


def test_every_coordinate_is_filled_and_estimates_hold():
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 2000):
        common = rng.integers(0, 2**63, n).astype(np.uint64)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, n // 4).astype(np.uint64)])) for _ in range(2)]
        got = minhash.sketch(sets, 200)
        assert not (got == minhash._FULL).any()
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        assert abs((got[0] == got[1]).mean() - true) < 0.15


def test_bands_follow_from_the_accepted_miss():
    assert (1 - 0.85**5) ** minhash.n_bands(85) <= minhash.MISS < (1 - 0.85**5) ** (minhash.n_bands(85) - 1)


def test_blocks_give_a_forest_of_links():
    sets = [np.arange(100, dtype=np.uint64) + np.uint64(i) for i in range(10)]
    links = minhash.linked_in_block(np.arange(10), np.zeros(10, bool), sets, 90)
    assert len(links) == 9
    sides = np.array([True] * 5 + [False] * 5)
    assert {(i < 5) != (j < 5) for i, j in minhash.linked_in_block(np.arange(10), sides, sets, 90)} == {True}
