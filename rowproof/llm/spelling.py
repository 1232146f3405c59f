"""Operator 12, spelling variants: words that differ by one code point, found through PartEnum signatures.

A word's letters are a set of dimensions, (letter, how often it came before); two words an edit apart differ in two of these at
most. PartEnum (Arasu, Ganti and Kaushik 2006) deals the dimensions out to ``PARTS`` parts, and enumerates
the choices of ``PARTS - 2`` parts: for words that near, one choice is the same on both, whole. A word's signatures are these choices,
each beside where the words may differ: of ``STRETCHES`` stretches of the shorter word's places an edit touches one,
and all letters before it and behind it are equal. Equal signatures meet in an equi-join, whose condition
verifies the distance of the letter sets (hashed to 64 bits) first and the edit distance then, so only near pairs leave the join.

The signatures of a word are at most ``2 * STRETCHES * PARTS``, whatever the table, and nothing is dropped: every pair at distance one has a
signature in common. Words are counted in the tasks before they are shuffled.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case. A fixed 31st of the occurrences,
chosen by a checksum of id and word, loses a code point; this plants misspellings at known places and can be switched off.

Defined cases: null and empty texts have no words; a null id counts as an empty one in the checksum. Rows that repeat count
each time. Words under ``min_length`` code points or ``min_count`` occurrences take no part, neither as words nor as
anybody's form. Of near words of equal count the first in code-point order is the form. Texts and words of any length are
taken whole; an empty table has no words; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.llm.common import Steps, bounded_batches, map_texts, release

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
PLANTED = 31
STRETCHES = 4
PARTS = 3
DISTANCE = 2
COUNTED_WORDS = 200_000


def spelled(one: str, words: list[str], every: int | None) -> Iterator[str]:
    """Words of a document with its planted misspellings; ``one`` is its id as text."""
    start = zlib.crc32(f"{one}:".encode())
    for word in words:
        if every:
            check = zlib.crc32(word.encode(), start)
            if check % every == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1 :]
        yield word


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, planted_every: int | None = PLANTED
) -> DataFrame:
    """``word`` and ``n``, its occurrences."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        run_of_letters = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for one, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = run_of_letters.findall(text.lower().decode("utf-8", "replace"))  # bytes: A-Z only
                counts.update(w for w in spelled(one or "", words, planted_every) if len(w) >= min_length)
                if len(counts) >= COUNTED_WORDS:
                    yield out()
        yield out()

    counted = slim.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_set(word: str) -> list[str]:
    """The dimensions of a word: each letter with the number of its occurrence."""
    seen: dict[str, int] = {}
    dimensions = []
    for letter in word:
        seen[letter] = seen.get(letter, 0) + 1
        dimensions.append(f"{letter}{seen[letter]}")
    return dimensions


def part_enum(word: str, parts: int = PARTS, distance: int = DISTANCE) -> tuple[list[str], int]:
    """A word's choices of parts, and its letter set hashed to 64 bits."""
    dealt: list[list[str]] = [[] for _ in range(parts)]
    mask = 0
    for dimension in letter_set(word):
        h = xxhash.xxh32_intdigest(dimension)
        dealt[(h >> 6) % parts].append(dimension)
        mask ^= 1 << (h & 63)
    whole = ["".join(sorted(p)) for p in dealt]
    return [f"{chosen}{[whole[i] for i in chosen]}" for chosen in combinations(range(parts), parts - distance)], mask


def signatures(word: str, min_length: int = MIN_LENGTH) -> tuple[list[int], int]:
    """Signatures of a word, as signed 64-bit hashes, and its letter set in 64 bits.

    ``m`` is the shorter length of a pair: the word's own, or one less where the other word is the shorter one.
    """
    choices, mask = part_enum(word)
    found = []
    for m in (len(word), len(word) - 1):
        if m < min_length:
            continue
        bounds = [m * j // STRETCHES for j in range(STRETCHES + 1)]
        for j in range(STRETCHES):
            rest = f"{m} {j} {word[: bounds[j]]} {word[len(word) - (m - bounds[j + 1]) :]} "
            found += [xxhash.xxh64_intdigest(rest + c) for c in choices]
    return found, mask


def _signed(words: DataFrame, min_length: int) -> DataFrame:
    def make():
        def compute(texts: list) -> list:
            both = [signatures(t, min_length) for t in texts]
            offsets = np.cumsum([0, *(len(s) for s, _ in both)]).astype(np.int32)
            flat = np.fromiter((x for s, _ in both for x in s), np.uint64, int(offsets[-1])).view(np.int64)
            masks = np.fromiter((m for _, m in both), np.uint64, len(both)).view(np.int64)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(masks)]

        return compute

    fields = [("signature", T.ArrayType(T.LongType())), ("letters", T.LongType())]
    return map_texts(words, "word", ["word", "n"], fields, make).withColumn("signature", F.explode("signature"))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Pairs of words an edit apart, each in both orders: ``word``, ``n``, ``near``, ``near_n``.

    ``words`` has distinct ``word`` of at least ``min_length`` code points, and ``n``; read it from a written table.
    """
    signed = _signed(words, min_length)
    left = signed.select("signature", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("letters").alias("a_letters"))
    right = signed.select("signature", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("letters").alias("b_letters"))
    condition = (
        (left["signature"] == right["signature"])
        & (F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= DISTANCE)
        & (F.col("a") < F.col("b"))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = left.join(right, condition).select("a", "a_n", "b", "b_n").distinct()
    return pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )))


def _roots(steps: Steps, forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form reached from it, by pointer doubling; ``forms`` has ``word`` and ``form``.

    A form is many times as frequent as its word, so there are no circles, and a few rounds suffice whatever the table.
    """
    now = steps.write(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = steps.write(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    planted_every: int | None = PLANTED,
) -> DataFrame:
    """Each word with its near words' number, its form and its root.

    ``word``, ``n``, ``n_near``, ``form`` (the most frequent near word, if it is ``ratio`` times as frequent at least),
    ``form_n``, and ``root``. Intermediate tables are written; the words' table is read again.
    """
    steps = Steps(docs.sparkSession, "spelling")
    words = steps.write(word_counts(docs, id_col, text_col, min_length, min_count, planted_every))
    near = near_words(words, min_length).groupBy("word").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    )
    is_form = -F.col("best.n") >= ratio * F.col("n")
    known = steps.write(near.select("word", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")))
    roots = _roots(steps, known.where("form is not null"))
    return words.join(known, "word", "left").join(roots, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
