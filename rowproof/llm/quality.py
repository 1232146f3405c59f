"""Operator 1, quality rules: a short-circuit cascade ordered by a sample.

Every document gets its base counts. Those that pass the base rule go through further rules,
and the first rule that rejects ends the cascade. Which rule comes first is decided by a
sample: each rule's seconds and share of rejected documents are measured there, and rules run
by rejections per second. The verdict is the conjunction of all rules, so it doesn't depend on
the order.

Defined cases: a null or empty text has no words, so it fails the base rule. Every input row
gives one output row, repeated rows too. Any type of id is passed through, null ids too.
Columns of any other name are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.llm.common import WORD, bounded_batches, map_texts

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COLUMNS = [*BASE, "base_failed", "kept"]
SAMPLE_ROWS = 1000
MIN_WORDS = 50
_SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LETTER = re.compile(r"[A-Z]+"), re.compile(r"[A-Za-z]+")
_WORDLIKE = re.compile(r"[A-Za-z\u0080-\U0010ffff]")


class Text:
    """Counts of a text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, "#*$%&|<>"))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        first: dict[tuple, int] = {}
        marked = bytearray(len(w))
        for i, x in enumerate(windows):
            if (j := first.setdefault(x, i)) != i:
                marked[i : i + 3] = marked[j : j + 3] = b"\1\1\1"
        return sum(marked)

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: Whole-number thresholds, so that every engine decides alike.
RULES = (
    Rule("symbols", lambda x: 10 * x.n_symbols > x.n_words),
    Rule("duplicate_lines", lambda x: 2 * x.n_dup_lines > len(x.lines)),
    Rule("short_words", lambda x: x.word_chars < 2 * x.n_words),
    Rule("long_words", lambda x: x.word_chars > 20 * x.n_words),
    Rule("shouting", lambda x: 10 * sum(map(len, _UPPER.findall(x.text))) > 3 * sum(map(len, _LETTER.findall(x.text)))),
    Rule("exclamations", lambda x: 2 * x.text.count("!") > x.n_words),
    Rule("few_wordlike", lambda x: 10 * sum(map(bool, map(_WORDLIKE.search, x.words))) < 6 * x.n_words),
    Rule("few_distinct", lambda x: 100 * len(set(x.words)) < 5 * x.n_words),
)


def measure_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each rule: ``rule`` (its number), ``seconds``, ``seen``, ``rejected``.

    A rule is timed on texts whose base counts are there already, as in the cascade.
    """

    def run(batches):
        seconds, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                text = Text(value)
                if text.base_failed:
                    continue
                ready = {k: getattr(text, k) for k in (*BASE, "words")}
                seen += 1
                for i, rule in enumerate(rules):
                    alone = Text(value)
                    alone.__dict__.update(ready)
                    began = time.perf_counter()
                    rejected[i] += rule.rejects(alone)
                    seconds[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array(seconds, pa.float64()), pa.array([seen] * len(rules), pa.int64()), pa.array(rejected, pa.int64())],
            names=["rule", "seconds", "seen", "rejected"],
        )

    rows = docs.select(docs[text_col]).mapInArrow(run, "rule int, seconds double, seen long, rejected long")
    return rows.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seconds", "seen", "rejected")])


def order_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """Rules by rejections per second, measured on about ``sample_rows`` rows of the whole table."""
    n = docs.count()
    if not n or len(rules) < 2:
        return rules
    sample = docs if n <= sample_rows else docs.sample(sample_rows / n, seed=17)
    found = {r["rule"]: r for r in measure_rules(sample, text_col, rules).collect()}  # one row a rule

    def gain(i: int) -> float:
        r = found.get(i)
        return (r["rejected"] + 0.5) / (r["seconds"] + 1e-6) if r else 0.0

    return tuple(rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain(i), i)))


def quality(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """``keep`` columns, base counts, ``base_failed`` and ``kept`` for every row.

    ``names`` gives other names for the added columns, where ``keep`` has theirs.
    """
    bounded_batches(docs.sparkSession)
    ordered = order_rules(docs, text_col, rules, sample_rows)

    def make():
        def compute(texts):
            rows = []
            for value in texts:
                text = Text(value)
                failed = text.base_failed
                kept = not failed and not any(r.rejects(text) for r in ordered)
                rows.append((*(getattr(text, k) for k in BASE), failed, kept))
            return list(map(list, zip(*rows, strict=True))) if rows else [[]] * len(COLUMNS)

        return compute

    kinds = [T.LongType()] * len(BASE) + [T.BooleanType()] * 2
    fields = [((names or {}).get(c, c), t) for c, t in zip(COLUMNS, kinds, strict=True)]
    return map_texts(docs, text_col, keep, fields, make)


def keep_good(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that every rule lets pass, with their columns."""
    names = {c: f"__quality_{c}" for c in COLUMNS}
    judged = quality(docs, docs.columns, text_col, names=names, **options)
    return judged.where(F.col(names["kept"])).select(*[judged[c] for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), p AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 2
), g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c FROM p
), m AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat FROM (SELECT r, i FROM g WHERE c > 1), (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), b AS (
  SELECT doc_id, t, w, l, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN m USING (r)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR 10 * n_symbols > n_words
         OR 2 * n_dup_lines > len(l)
         OR word_chars < 2 * n_words
         OR word_chars > 20 * n_words
         OR 10 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(regexp_replace(t, '[^A-Za-z]', '', 'g'))
         OR 2 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
         OR 10 * len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < 6 * n_words
         OR 100 * len(list_distinct(w)) < 5 * n_words) AS kept
FROM f
"""
