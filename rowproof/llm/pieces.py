"""Operator 3, SentencePiece models on the tokenizers library.

The model's protobuf is parsed here: pieces with scores and kinds, the normalizer's rules and
the trainer's kind of model. From it a fast tokenizer is rebuilt: the precompiled character map and white
space rules as a normalizer, ``▁`` as the mark of spaces, unigram scores or, for BPE
models, merges in the order of the scores, and byte fallback for characters without a piece. Texts are
encoded in batches by several threads. Parity with the SentencePiece library is verified on a
sample before a table is encoded; a difference is an error.

If no piece holds a mark after another character, no piece crosses the start of a word; texts are
then cut there, which bounds the memory of a batch and lets words be encoded once.

Defined cases: a null text has no ids (null) and a null round trip; an empty text has no ids.
Repeated rows get a row each; ids of any type pass through; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from rowproof.llm.common import bounded_batches, kept, map_texts

SAMPLE_ROWS = 300
CUT = 1 << 14
BATCH = 1 << 19
THREADS = "2"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield number, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {wire}")


@dataclass
class PieceModel:
    """What a model file says, with the format's defaults."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                if kind == UNKNOWN:
                    out.unk_id = len(out.pieces)
                out.pieces.append((piece, score, kind))
            elif number == 2:
                spec = dict(_fields(value))
                out.model_type, out.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                out.charsmap = spec.get(2, b"")
                out.add_dummy_prefix, out.remove_extra_whitespaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        return out

    @property
    def cuts_at_words(self) -> bool:
        return not any(MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED))


class PieceTokenizer:
    """A model rebuilt from its parts."""

    def __init__(self, model: PieceModel):
        self.model = model
        unk = model.pieces[model.unk_id][0]
        if model.model_type == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
        elif model.model_type == BPE:
            ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
            usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
            merges = []
            for piece, score in usable.items():
                for i in range(1, len(piece)):
                    left, right = piece[:i], piece[i:]
                    if left in usable and right in usable:
                        merges.append((-score, ids[left], ids[right], (left, right)))
            core = models.BPE(ids, [m[-1] for m in sorted(merges)], unk_token=unk, fuse_unk=True, byte_fallback=model.byte_fallback)
        else:
            raise ValueError(f"model type {model.model_type}")
        self.tokenizer = Tokenizer(core)
        if model.cuts_at_words:
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "removed", invert=True)
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.tokenizer.decoder = decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []))
        bytes_ = [int(p[1:-1], 16) if kind == BYTE else None for p, _, kind in model.pieces]
        self.high = np.array([b is not None and b > 127 for b in bytes_])
        self.strings = np.array([p.replace(MARK, " ") if b is None else chr(b) for (p, _, _), b in zip(model.pieces, bytes_, strict=True)], object)
        self.normalizer = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        self.cut = re.compile(f"(?:{MARK}*[^{MARK}]+){{1,{CUT // 8}}}|{MARK}+", re.S) if model.cuts_at_words else None

    def normalize(self, text: str) -> str:
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        if self.model.remove_extra_whitespaces:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.model.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, encoded in batches of bounded size."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        batch, owners, size = [], [], 0

        def flush() -> None:
            nonlocal batch, owners, size
            for owner, found in zip(owners, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                out[owner].append(np.array(found.ids, np.uint32))
            batch, owners, size = [], [], 0

        for i, text in enumerate(texts):
            text = self.normalize(text)
            for part in [text] if not self.cut or len(text) <= CUT else self.cut.findall(text):
                batch.append(part)
                owners.append(i)
                size += len(part)
                if size >= BATCH:
                    flush()
        if batch:
            flush()
        return [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids. Only bytes beyond ASCII, which make a character together, need the tokenizer's decoder."""
        if self.high[ids].any():
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        text = "".join(self.strings[ids])
        return text[1:] if self.model.add_dummy_prefix and text.startswith(" ") else text


def piece_tokenizer(path: str) -> PieceTokenizer:
    """The rebuilt tokenizer of a model file, once for each worker."""

    def build() -> PieceTokenizer:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", THREADS)
        with open(path, "rb") as file:
            return PieceTokenizer(PieceModel.parse(file.read()))

    return kept(("pieces", path), build)


def differing(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``differs`` for each text that isn't null: whether the SentencePiece library gives other ids."""

    def make():
        import sentencepiece

        library, rebuilt = sentencepiece.SentencePieceProcessor(model_file=model_path), piece_tokenizer(model_path)

        def compute(texts):
            texts = [x or "" for x in texts]
            return [[list(x) != y.tolist() for x, y in zip(library.encode(texts, num_threads=1), rebuilt.encode(texts), strict=True)]]

        return compute

    return map_texts(docs.where(docs[text_col].isNotNull()), text_col, [], [("differs", T.BooleanType())], make, keeps="pieces")


def verify_parity(docs: DataFrame, model_path: str, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> None:
    n = docs.count()
    sample = docs if n <= sample_rows else docs.sample(sample_rows / n, seed=41)
    bad = differing(sample, model_path, text_col).where("differs").count()
    if bad:
        raise ValueError(f"{bad} texts of the sample are encoded otherwise by the SentencePiece library")


def encode_pieces(docs: DataFrame, keep: list[str], model_path: str, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``keep`` columns, ``ids`` (little-endian unsigned 32-bit), and ``round_trip``: whether decoding gives the text."""
    bounded_batches(docs.sparkSession)
    if sample_rows:
        verify_parity(docs, model_path, text_col, sample_rows)

    def make():
        rebuilt = piece_tokenizer(model_path)

        def compute(texts):
            at = [i for i, x in enumerate(texts) if x is not None]
            ids, same = [None] * len(texts), [None] * len(texts)
            for i, found in zip(at, rebuilt.encode([texts[i] for i in at]), strict=True):
                ids[i], same[i] = found.astype("<u4").tobytes(), rebuilt.decode(found) == texts[i]
            return [ids, same]

        return compute

    return map_texts(docs, text_col, keep, [("ids", T.BinaryType()), ("round_trip", T.BooleanType())], make, keeps="pieces")


def decode_pieces(encoded: DataFrame, keep: list[str], model_path: str, ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``text`` of encoded rows; null ids give a null text."""

    def make():
        rebuilt = piece_tokenizer(model_path)
        return lambda rows: [[None if x is None else rebuilt.decode(np.frombuffer(x, "<u4")) for x in rows]]

    return map_texts(encoded, ids_col, keep, [("text", T.StringType())], make, keeps="pieces")


def digest(encoded: DataFrame, id_col: str) -> DataFrame:
    """Length and checksum of each row's ids."""
    n = (F.octet_length("ids") / 4).cast("long").alias("n_ids")
    return encoded.select(id_col, n, F.crc32("ids").alias("ids_crc32"), "round_trip")
