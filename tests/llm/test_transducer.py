import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from rowproof.llm import queries, transducer
from rowproof.llm.transducer import TextEncoder, TokenDecoder, Transducer, Utf8Stream, as_library, merged, newer_letters, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = TextEncoder(RANKS, public_tokenizers.PATTERN, as_library(public_tokenizers.PATTERN))
DECODER = TokenDecoder(RANKS)
anything = st.text(st.characters(exclude_categories=["Cs"]), max_size=80)
runs = st.lists(st.sampled_from(["a", "the", "ing", "er", " ", "  ", "\n", "=", "é", "日", "😀", "1", "'s"]), max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(anything | runs)
def test_ids_are_the_librarys_and_decode_to_the_text(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert DECODER.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(1, 7), max_size=40))
def test_bytes_in_any_portions(data, sizes):
    stream, out, at = Utf8Stream(), [], 0
    for size in [*sizes, len(data)]:
        out.append(stream.push(data[at : at + size]))
        at += size
    assert "".join([*out, stream.finish()]) == data.decode("utf-8", "replace")
    ids = [RANKS[data[i : i + 1]] for i in range(len(data))]
    assert DECODER.decode(ids) == data.decode("utf-8", "replace")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "ba", "c"]), min_size=2, max_size=12), st.text("abc", max_size=30))
def test_transducer_of_any_small_vocabulary(more, text):
    """Also where a token's own bytes don't merge to it, and with the table forgotten all the time."""
    words = dict.fromkeys("".join(more[:i]) for i in range(2, len(more) + 1))
    ranks = {bytes([b]): b for b in range(256)} | {w.encode(): 256 + i for i, w in enumerate(w for w in words if len(w) > 1)}
    expected = [ranks[t] for t in merged(text.encode(), ranks)]
    for states in (2, 10_000):
        t = Transducer(ranks, states)
        state, ids = 0, []
        for state, emitted in t.feed(text.encode()):
            ids += emitted
        assert ids + list(t.held(state)) == expected


def test_little_is_held_back():
    t = Transducer(RANKS)
    longest, held = max(map(len, RANKS)), []
    for state, _ in t.feed(b"abcdefghij" * 2000):
        held.append(len(t.held(state)))
    assert max(held) <= longest and max(held) < 10


def test_letters_of_newer_unicode_are_the_librarys():
    for kind in "LN":
        for c in newer_letters(kind)[:3000:17]:
            text = f"a{c}a 1{c}1 {c}{c}"
            assert ENCODER.encode(text) == LIBRARY.encode_ordinary(text)


def test_tables(spark, documents, texts, empty):
    encoded = transducer.encode(documents, ["doc_id", "text"], PATH, decoded_col="back")
    assert encoded.where("text <> back").count() == 0
    assert all(r["ids"] == LIBRARY.encode_ordinary(r["text"]) for r in encoded.collect())
    back = transducer.decode(encoded.drop("text"), ["doc_id"], PATH)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, documents.select("doc_id", "text").collect()))
    odd = texts([None, "", "x" * 100_000, " " * 50_000, "a b", "a b"], ids=[1, 2, 3, 4, None, None])
    rows = {r["doc_id"]: r for r in transducer.encode(odd, ["doc_id", "kept", "node"], PATH, decoded_col="back").collect()}
    assert rows[1]["ids"] == [] == rows[2]["ids"] and rows[1]["back"] == ""
    assert rows[3]["ids"] == LIBRARY.encode_ordinary("x" * 100_000) and rows[4]["back"] == " " * 50_000
    assert rows[None]["ids"] == LIBRARY.encode_ordinary("a b") and rows[3]["node"] == 2
    assert transducer.encode(empty, ["doc_id"], PATH).count() == 0
    raw = spark.sql("SELECT 1 AS doc_id, cast(X'61FF62' AS string) AS text")
    assert transducer.encode(raw, ["doc_id"], PATH, decoded_col="back").first()["back"] == "a�b"
    with pytest.raises(ValueError, match="choose other names"):
        transducer.encode(odd.withColumnRenamed("id", "ids"), ["ids"], PATH)
    unknown = spark.sql("SELECT array(50256) AS ids")
    with pytest.raises(Exception, match="no token has the id 50256"):
        transducer.decode(unknown, [], PATH).collect()


def test_query(spark, rows):
    def sha(data):
        return hashlib.sha256(data).hexdigest()

    got = queries.op11_byte_bpe(spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema.fields] == [
        "doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string",
    ]
    want = set()
    for r in rows:
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        want.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    assert set(map(tuple, got.collect())) == want
