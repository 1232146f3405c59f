"""Operator 6, language identification by string kernels.

The kernel is a blended spectrum: for each order 1 to 3 the number of character n-grams that
both texts hold (presence, not frequency), over the root of the product of their own numbers,
averaged over the orders. N-grams are hashed into ``BUCKETS`` buckets for each order. A bounded
sample of labelled rows is spread evenly over the languages; ``LANDMARKS`` of them span the
Nyström approximation, in which one ridge regression for each language against the rest is solved.
Texts are scored in blocks: one product of the presence matrix with the landmarks' columns, one
with the regressions' coefficients. Only buckets that some landmark has take part in products,
as others add nothing.

Training uses text and non-null language of rows whose ``crc32(id as text) mod 4`` is not 2. At
most ``TRAIN_ROWS`` rows reach the driver, as bits of their buckets and not as texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text
if there is nothing to learn from. Rows with a null id are predicted but not learned from, and
are not held out. Repeated rows get a row each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.llm.common import bounded_batches, filtered, fresh, map_texts
from rowproof.llm.hashing import mix

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
TRAIN_ROWS = 1024
LANDMARKS = 128
RIDGE = 1e-3
BLOCK = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 15)


def buckets(text: str) -> list[np.ndarray]:
    """For each order the buckets of the n-grams of a text, in order and once each."""
    codes = np.frombuffer(text.lower().replace("\n", " ").encode("utf-32-le"), "<u4").astype(np.uint64)
    out, running = [], np.zeros(len(codes) + 1, np.uint64)
    for n in ORDERS:
        size = max(0, len(codes) - n + 1)
        running = running[:size] * _BASE + codes[n - 1 :] + np.uint64(n)
        flags = np.zeros(BUCKETS, bool)
        flags[(mix(running) >> _SHIFT).astype(np.int64)] = True
        out.append(np.flatnonzero(flags))
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Model:
    """Landmarks' presence columns and the regressions' coefficients; empty if nothing was learned."""

    def __init__(self, languages: list[str], landmarks: list[list[np.ndarray]]):
        self.languages = languages
        self.columns, self.parts = [], []
        for i in range(len(ORDERS)):
            used = np.unique(np.concatenate([x[i] for x in landmarks])) if landmarks else np.zeros(0, np.int64)
            lookup = np.full(BUCKETS, -1, np.int32)
            lookup[used] = np.arange(len(used))
            matrix = np.zeros((len(used), len(landmarks)), np.float32)
            for j, x in enumerate(landmarks):
                matrix[lookup[x[i]], j] = 1 / np.sqrt(max(1, len(x[i])))
            self.columns.append(lookup)
            self.parts.append(matrix)
        self.weights = np.zeros((len(landmarks), len(languages)))

    def kernel(self, texts: list[list[np.ndarray]]) -> np.ndarray:
        total = np.zeros((len(texts), self.weights.shape[0]))
        for i, (lookup, matrix) in enumerate(zip(self.columns, self.parts, strict=True)):
            has = np.zeros((len(texts), matrix.shape[0]), np.float32)
            for j, x in enumerate(texts):
                at = lookup[x[i]]
                has[j, at[at >= 0]] = 1 / np.sqrt(max(1, len(x[i])))
            total += has @ matrix
        return total / len(ORDERS)

    def fit(self, texts: list[list[np.ndarray]], labels: list[int], landmarks: list[list[np.ndarray]], ridge: float) -> None:
        """Kernel ridge regression within the span of the landmarks, a column for each language."""
        own, known = self.kernel(landmarks), self.kernel(texts)
        target = np.where(np.arange(len(self.languages))[None, :] == np.array(labels)[:, None], 1.0, -1.0)
        left = known.T @ known + ridge * len(texts) * own + 1e-8 * np.eye(len(own))
        self.weights = np.linalg.solve(left, known.T @ target)

    def predict(self, texts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        margin = self.kernel(texts) @ self.weights
        return margin.argmax(axis=1), np.clip((margin.max(axis=1) + 1) / 2, 0, 1)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = TRAIN_ROWS,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
) -> Model:
    """Learn from at most ``rows`` labelled rows, as many of each language as there are or fit in evenly."""
    labelled = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    labelled = labelled.where((F.pmod(F.crc32(F.col("id").cast("string")), F.lit(4)) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = labelled.agg(F.count_distinct("lang")).first()[0]
    if not n:
        return Model([], [])
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    picked = labelled.select("id", "lang").withColumn("r", F.row_number().over(order)).where(F.col("r") <= max(1, rows // n))
    ids = [r["id"] for r in picked.select("id").limit(rows).collect()]  # at most ``rows`` ids
    chosen = filtered(labelled, "id", docs.sparkSession.createDataFrame([(i,) for i in ids], docs.select(docs[id_col].alias("id")).schema))

    def make():
        def bits(text):
            flags = np.zeros((len(ORDERS), BUCKETS), bool)
            for i, x in enumerate(buckets(text)):
                flags[i, x] = True
            return np.packbits(flags).tobytes()

        return lambda texts: [[bits(x) for x in texts]]

    found = map_texts(chosen, "text", ["id", "lang"], [("bits", T.BinaryType())], make)
    found = sorted(found.orderBy(F.xxhash64("id"), "id", "lang").limit(rows).collect(), key=lambda r: (str(r["id"]), r["lang"]))
    languages = sorted({r["lang"] for r in found})
    texts = [[np.flatnonzero(x) for x in np.unpackbits(np.frombuffer(r["bits"], np.uint8)).reshape(len(ORDERS), BUCKETS)] for r in found]
    labels = [languages.index(r["lang"]) for r in found]
    turns: dict[int, int] = {}
    rank = []
    for i, y in enumerate(labels):
        turns[y] = turns.get(y, 0) + 1
        rank.append((turns[y], y, i))
    marks = [texts[i] for _, _, i in sorted(rank)[:landmarks]]
    model = Model(languages, marks)
    model.fit(texts, labels, marks, ridge)
    return model


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` for every row."""
    bounded_batches(docs.sparkSession)
    model = train(docs, id_col, text_col, lang_col) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = fresh("id")

    def make():
        model = shared.value

        def compute(texts):
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            at = [i for i, x in enumerate(texts) if model.languages and has_letter(x)]
            for start in range(0, len(at), BLOCK):
                part = at[start : start + BLOCK]
                best, score = model.predict([buckets(texts[i]) for i in part])
                for i, b, v in zip(part, best, score, strict=True):
                    names[i], scores[i] = model.languages[b], float(v)
            return [names, scores]

        return compute

    found = map_texts(docs.select(docs[id_col].alias(key), docs[text_col].alias("text")), "text", [key], [("lang_pred", T.StringType()), ("score", T.DoubleType())], make)
    held = F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))
    return found.select(F.col(key).alias(id_col), held.alias("held_out"), "lang_pred", "score")
