"""Operator 5, packing along a space-filling curve.

Each document is tokenized, its token counts are hashed into a vector, and a fixed random
projection takes the vector to few dimensions. The place on the Hilbert curve through them is
the document's key: neighbours on the curve hold similar words. Documents are dealt into ranges of
the key with about equally many rows, ordered within each range, and laid end to end, so
that a sequence holds neighbours on the curve. The line is cut every ``length`` tokens; what is left
at its end is cut into powers of two, so no padding is needed at all.

Scale: tokens are shuffled once, two bytes each where the vocabulary allows it. The ranges come
from quantiles of all keys; the key's low bits are a hash of the id, so equal texts spread over ranges. A task reads one
range after another and sorts it with spilling. The driver sees one number for each range, at most ``MAX_RANGES``.

Tokens: a text is cut at spaces and line feeds, which the tokenizer never joins across, and each
cut is tokenized once for a worker and kept: up to ``CACHE_CUTS`` cuts, and as many of those seen before. This gives the ids of
the whole text, which tests hold against the tokenizer. Plain words in lower case go to the
tokenizer's model alone, in its byte-level letters. Both are tried on a few words when a tokenizer is loaded; one that works
otherwise gets whole texts.

Defined cases: a null or empty text is the end id alone. Every row is packed, rows that repeat an id or have none
too; pieces of such rows carry that id. Other columns are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import gc
import math
import struct
from collections.abc import Iterable
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rowproof.llm.common import Steps, bounded_batches, fresh, kept, map_texts

LENGTH = 2048
DIMENSIONS, BITS, HASHED = 4, 8, 256
CACHE_CUTS = 400_000
LEARNED_AT_ONCE = 8192
RANGE_TOKENS = 16 << 20
MAX_RANGES = 20_000
#: Keys have 53 bits together, so that they are exact as doubles when ranges are looked up.
_TIE_BITS = 53 - DIMENSIONS * BITS
#: Signs that are tokenized by themselves after a letter; none that a special token may hold.
_SIGNS = ",.!?;:#$%&*"


#: The byte-level alphabet of these tokenizers: printable bytes stand for themselves, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}


def _byte_letters(word: str) -> str:
    """A word as the byte-level letters that the model knows."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)


def _parts(cut: str) -> tuple[str, str] | None:
    """A word and the signs after it, whose ids in a row are those of ``cut``; nothing if it is best taken whole.

    The tokenizer takes letters in lower case, one by one, so words of letters share their ids
    with that; but for the few whose lower case is longer or depends on the place.
    """
    word = cut.rstrip(_SIGNS)
    if word != cut and not word[-1:].isalpha():
        return None
    plain = word.lower() if word.isalpha() and "Σ" not in word else word
    plain = plain if len(plain) == len(word) else word
    return (plain, cut[len(word) :]) if plain != cut else None


class TokenCache:
    """Ids of texts, little-endian, with a cache of cuts at white space."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.type.itemsize == 2 else "I"
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

        probes = ["a", "word", "packing", "zqxv", "été", "straße", "niño", "слово", "語"]
        whole = self._ids("".join(f" {p}\n{p.title()}." for p in probes))
        #: whether white space ends words, and whether the model alone tokenizes a plain word
        self.cuts = whole == [i for p in probes for x in (p, p.title(), ".") for i in self._ids(x)]
        self.direct = all(self._ids(p) == [x.id for x in self.tokenizer.model.tokenize(_byte_letters(p))] for p in probes)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _learn(self, cuts: list[str]) -> None:
        if self.direct:
            tokenize, packed = self.tokenizer.model.tokenize, self._packed
            plain = [x for x in cuts if x.isalpha() and x == x.lower() and (x.isascii() or is_normalized("NFC", x))]
            self.known.update((x, packed([t.id for t in tokenize(_byte_letters(x))])) for x in plain)
            cuts = [x for x in cuts if x not in self.known] if len(plain) < len(cuts) else []
        for i in range(0, len(cuts), LEARNED_AT_ONCE):
            part = cuts[i : i + LEARNED_AT_ONCE]
            for cut, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[cut] = self._packed(found.ids)

    def _new(self, unknown: Iterable[str]) -> list[str]:
        """Those of ``unknown`` to be tokenized; what was known before is known again."""
        known, before, new = self.known, self.before.get, []
        for x in unknown:
            if (value := before(x)) is None:
                new.append(x)
            else:
                known[x] = value
        return new

    def _know(self, unknown: set[str]) -> None:
        made, whole = {}, []
        for x in self._new(unknown):
            if parts := _parts(x):
                made[x] = parts
            else:
                whole.append(x)
        parts = {p for x in made.values() for p in x}.difference(self.known, whole)
        self._learn(whole + self._new(parts))
        known = self.known
        known.update((x, known[word] + known[signs]) for x, (word, signs) in made.items())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. Python's search for cycles is off meanwhile: there are none to find in large lists of words."""
        searching = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if searching:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.cuts:
            return [self._packed(self._ids(x)) if x else b"" for x in texts]
        if len(self.known) > CACHE_CUTS:
            self.before, self.known = self.known, {"": b""}
        get = self.known.get
        cuts = [x.replace("\n", " ").split(" ") if x else [] for x in texts]
        found = [list(map(get, x)) for x in cuts]
        unknown = [[i for i, v in enumerate(x) if v is None] if None in x else [] for x in found]
        self._know({x[i] for x, at in zip(cuts, unknown, strict=True) for i in at})
        for x, values, at in zip(cuts, found, unknown, strict=True):
            for i in at:
                values[i] = get(x[i])
        return [b"".join(x) for x in found]


def token_cache(path: str) -> TokenCache:
    return kept(("packing", path), lambda: TokenCache(path))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of points on the Hilbert curve; ``cells`` has a row of whole numbers for each point.

    Skilling's transform (2004): undo the rotations from the highest bit down, then Gray code.
    """
    x = [c.astype(np.uint64) for c in cells.T]
    n, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        p = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        t = np.where((x[n - 1] & q) != 0, t ^ (q - one), t)
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << one) | (((x[i] ^ t) >> np.uint64(b)) & one)
    return place


def curve_keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = BITS, hashed: int = HASHED) -> np.ndarray:
    """Hilbert keys of documents, from the hashed counts of their tokens."""
    rows = np.zeros((len(ids), hashed))
    for i, x in enumerate(ids):
        rows[i] = np.bincount((x.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - int(math.log2(hashed))), minlength=hashed)
    rows = np.log1p(rows)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    projected = rows @ np.random.default_rng(5).standard_normal((hashed, dimensions))
    # coordinates of a unit vector lie within a few standard deviations; the curve's cube spans four each way
    cells = np.clip((projected + 4) / 8 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    return hilbert(cells, bits)


def _tokenized(docs: DataFrame, key: str, path: str, end_id: int) -> DataFrame:
    def make():
        cache = token_cache(path)
        end = np.array([end_id], cache.type).tobytes()
        width = cache.type.itemsize

        def compute(texts):
            ids = [x + end for x in cache.encode(texts)]
            places = curve_keys([np.frombuffer(x, cache.type) for x in ids])
            return [[len(x) // width for x in ids], ids, pa.array(places.astype(np.int64))]

        return compute

    fields = [("n", T.LongType()), ("ids", T.BinaryType()), ("place", T.LongType())]
    return map_texts(docs, "text", [key], fields, make, keeps="packing")


def tail_starts(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one start: powers of two, the largest first."""
    at, left, out = total - total % length, total % length, []
    while left:
        out.append(at)
        part = 1 << (left.bit_length() - 1)
        at, left = at + part, left - part
    return out


def pieces(start: int, n: int, total: int, length: int) -> list[tuple[int, int, int, int]]:
    """(ids before, length, sequence, offset) of a document's pieces, for its place on the line."""
    full, tail = total - total % length, tail_starts(total, length)
    out, at, end = [], start, start + n
    while at < end:
        if at < full:
            sequence, begin = at // length, at - at % length
            stop = begin + length
        else:
            k = max(i for i, x in enumerate(tail) if x <= at)
            sequence, begin = full // length + k, tail[k]
            stop = tail[k + 1] if k + 1 < len(tail) else total
        stop = min(stop, end)
        out.append((at - start, stop - at, sequence, at - begin))
        at = stop
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 1) -> DataFrame:
    """One row for each piece.

    ``id_col``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset``. Sequences have ``length`` tokens or, at the end, a power of two.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    steps, key = Steps(spark, "packing"), fresh("id")
    docs = docs.select(docs[id_col].alias(key), docs[text_col].alias("text"))
    tie = F.pmod(F.xxhash64(key, "n"), F.lit(1 << _TIE_BITS))
    tokens = steps.write(_tokenized(docs, key, tokenizer_path, end_id).withColumn("place", F.col("place") * (1 << _TIE_BITS) + tie))
    n_rows, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ranges = min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / RANGE_TOKENS)), max(1, n_rows))
    bounds = []
    if ranges > 1:
        wanted = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(tokens.agg(F.percentile_approx(F.col("place").cast("double"), wanted, 10 * MAX_RANGES)).first()[0]))
    placed = tokens.withColumn("at", F.col("place").cast("double"))
    if bounds:
        split = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="at", outputCol="range")
        placed = split.transform(placed).drop("at")
    else:
        placed = placed.drop("at").withColumn("range", F.lit(0.0))
    before, offsets = 0, []
    for r in sorted(placed.groupBy("range").agg(F.sum("n").alias("n")).collect()):  # one row a range
        offsets.append((r["range"], before))
        before += r["n"]
    known = F.broadcast(spark.createDataFrame(offsets, "range double, before long"))
    line = Window.partitionBy("range").orderBy("place", key, "n").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("n").over(line), F.lit(0))).join(known, "range")
    placed = placed.select(key, "n", "ids", (F.col("before") + F.col("inside")).alias("at"))
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset")]
    )

    def cut(batches):
        for batch in batches:
            rows, taken = [], []
            for i, (n, ids, at) in enumerate(zip(*[batch.column(c).to_pylist() for c in (1, 2, 3)], strict=True)):
                wide = np.frombuffer(ids, np.dtype(f"<u{len(ids) // n}")).astype("<u4")
                for start, size, sequence, offset in pieces(at, n, total, length):
                    taken.append(i)
                    rows.append((start, size, wide[start : start + size].tobytes(), n, sequence, offset))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(taken, pa.int32())), *columns], names=schema.names)

    return placed.mapInArrow(cut, schema)
