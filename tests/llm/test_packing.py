import collections

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowproof.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(df, values, tokenizer, length=2048):
    """Pieces hold each document's ids once, in order, and sequences are full or a power of two."""
    want = collections.Counter()
    for i, text in values:
        want[i, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(df, PATH, length=length).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    if len({i for i, _ in want}) == sum(want.values()):
        for (i, ids), _ in want.items():
            at = 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert np.frombuffer(r["ids"], "<u4").tolist() == list(ids[at : at + r["length"]])
                at += r["length"]
            assert at == len(ids)
    assert sum(r["length"] for x in pieces.values() for r in x) == sum(len(ids) * n for (_, ids), n in want.items())
    assert sorted(sequences) == list(range(len(sequences)))
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == length or at & (at - 1) == 0
    return sequences


def test_documents(documents, rows, tokenizer):
    check(documents, [(r["doc_id"], r["text"]) for r in rows], tokenizer)


def test_cases(texts, empty, tokenizer):
    values = [None, "", "one", "word " * 9000, "same", "same", "İıſK don't <|endoftext|>, we'll x\x1cy"]
    check(texts(values), list(enumerate(values)), tokenizer, length=64)
    check(texts(["a b", "a b", None], ids=[1, 1, None]), [(1, "a b"), (1, "a b"), (None, None)], tokenizer, length=4)
    assert packing.pack(empty, PATH).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_cached_cuts_give_the_tokenizers_ids(values):
    cache = packing.token_cache(PATH)
    for text, got in zip(values, cache.encode(values), strict=True):
        assert np.frombuffer(got, cache.type).tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CUTS", 50)
    cache = packing.TokenCache(PATH)
    for i in range(40):
        cache.encode([" ".join(f"w{i}x{j}" for j in range(20))])
    assert len(cache.known) + len(cache.before) < 200


def test_hilbert_visits_each_cell_once_by_single_steps():
    bits, n = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    places = packing.hilbert(cells, bits)
    assert sorted(places.tolist()) == list(range(1 << bits * n))
    walk = cells[np.argsort(places)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_tail_is_cut_into_powers_of_two():
    assert packing.tail_starts(10 + 7, 10) == [10, 14, 16]
    assert packing.tail_starts(20, 10) == []
    assert packing.pieces(8, 9, 17, 10) == [(0, 2, 0, 8), (2, 4, 1, 0), (6, 2, 2, 0), (8, 1, 3, 0)]


def test_like_documents_are_neighbours(texts, tokenizer):
    import random

    rng = random.Random(2)
    kinds = [[f"{k}word{i}" for i in range(30)] for k in "abc"]
    values = [" ".join(rng.choices(kinds[i % 3], k=60)) for i in range(90)]
    sequences = check(texts(values), list(enumerate(values)), tokenizer, length=1024)
    order = [r["doc_id"] % 3 for s in sorted(sequences) for r in sorted(sequences[s], key=lambda r: r["offset"])]
    same = sum(a == b for a, b in zip(order, order[1:], strict=False)) / (len(order) - 1)
    assert same > 0.6  # a third, if order were random


def test_tokenizers_that_join_across_spaces_get_whole_texts():
    cache = packing.TokenCache(public_tokenizers.path("byte_bpe_50k.json"))
    assert not cache.cuts
    text = "Hello there, world"
    assert np.frombuffer(cache.encode([text])[0], cache.type).tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids


def test_shortcuts_hold_for_the_tokenizer_in_use():
    cache = packing.token_cache(PATH)
    assert cache.cuts and cache.direct
