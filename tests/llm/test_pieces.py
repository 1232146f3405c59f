import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rowproof.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "\n\n", "a\tb", "日本語 テスト", "😀 x", "<s> </s> <unk> <0x0A>", "x" * 5000, "aaaa   bbbb      c", "\u0000a​b", "İıſK", "é"]


def test_parity_and_round_trip(spark, documents):
    odd = spark.createDataFrame([(t,) for t in ODD], "text string")
    assert pieces.differing(odd, PATH).where("differs").count() == 0
    assert pieces.differing(documents, PATH).where("differs").count() == 0
    encoded = pieces.encode_pieces(documents, ["doc_id", "text"], PATH, sample_rows=0)
    assert encoded.where("not round_trip").count() == 0
    back = pieces.decode_pieces(encoded.drop("text").withColumnRenamed("round_trip", "text_"), ["doc_id"], PATH)
    assert sorted(map(tuple, back.collect())) == sorted((r["doc_id"], r["text"]) for r in documents.collect())


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_is_encoded_like_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert pieces.piece_tokenizer(PATH).encode([text])[0].tolist() == library.encode(text)


def test_cases(texts, empty):
    got = {r["doc_id"]: r for r in pieces.encode_pieces(texts([None, "", "a b", "long " * 50_000]), ["doc_id"], PATH).collect()}
    assert got[0]["ids"] is None and got[0]["round_trip"] is None
    assert got[1]["ids"] == b"" and got[1]["round_trip"]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert np.frombuffer(got[3]["ids"], "<u4").tolist() == library.encode("long " * 50_000)
    assert pieces.encode_pieces(empty, ["doc_id"], PATH).count() == 0


def _message(*parts):
    """A protobuf message of (number, value) pairs."""
    out = b""
    for number, value in parts:
        if isinstance(value, bytes):
            out += bytes([number << 3 | 2]) + _varint(len(value)) + value
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            out += _varint(number << 3) + _varint(value)
    return out


def _varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def test_unigram_model_of_hand(tmp_path):
    units = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    units += [("▁the", -2.0, 1), ("▁cat", -3.0, 1), ("▁", -4.0, 1), ("s", -3.5, 1), ("at", -4.0, 1), ("c", -5.0, 1), ("▁ca", -4.5, 1), ("t", -5.0, 1)]
    pieces_ = [(1, _message((1, p.encode()), (2, s), (3, k))) for p, s, k in units]
    data = _message(*pieces_, (2, _message((3, 1), (4, len(units)))), (3, _message((1, b"identity"), (3, 1), (4, 1))))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    model = pieces.PieceModel.parse(data)
    assert model.model_type == pieces.UNIGRAM and model.pieces[3][0] == "▁the" and model.remove_extra_whitespaces
    library, rebuilt = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.PieceTokenizer(model)
    for text in ("the cats", "  cat   the ", "catt", "t"):
        assert rebuilt.encode([text])[0].tolist() == library.encode(text), text


def test_parity_is_demanded(spark, documents, monkeypatch):
    monkeypatch.setattr(pieces, "differing", lambda *a: spark.createDataFrame([(True,)], "differs boolean"))
    with pytest.raises(ValueError, match="encoded otherwise"):
        pieces.verify_parity(documents, PATH)
