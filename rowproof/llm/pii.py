"""Operator 4, personal data: high-recall candidates judged by boosted trees, in SQL functions only.

Four base kinds are found by their patterns and checks and always stay. Generators with high
recall propose further, overlapping spans: contacts with spelled-out signs, long digit groups,
and groups of colon-separated hex numbers. Boosted trees (Spark ML, in the JVM) judge each candidate by its
format and the words before it. They learn from the candidates of all documents, equal ones as one row with
their number as its weight; candidates count as personal if the base rules confirm them. A third of
them, by a hash of the span, is kept from the trees, and all of it calibrates a threshold per
generator: the lowest score above which at least ``PRECISION`` of them are confirmed. The trees become one SQL
expression, so a document's spans are found, judged and cut where it is read, with no shuffle and no Python.

Patterns scan in linear time: possessive parts, and no start inside a run that failed.

Defined cases: a null or empty text has no spans. Each row gives one row, repeated rows too; ids of any
type and null ids pass through; other columns are ignored. Where the sample has too few
candidates to calibrate a generator, that generator adds nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowproof.llm.common import Steps, fresh

ROWS_PER_TASK = 50_000
PRECISION = 0.98
LEAST_CONFIRMED = 20
KINDS = ("email", "ip", "card", "phone", "contact", "number", "address")
_LOCAL = "[A-Za-z0-9._%+-]"
#: \G: right after the last match; else not inside a run that has been tried from its start.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "contact": rf"(?<!{_LOCAL}){_LOCAL}{{2,64}}+\x20?(?:@|\(at\)|\[at\]|\{{at\}})\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{{dot\}})\x20?)[A-Za-z0-9-]++)++",
    "number": r"(?<![0-9])\(?[0-9](?:[().\x20-]{0,2}+[0-9]){6,}+",
    "address": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){4,7}+(?![0-9A-Fa-f:])",
}
_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
_SPAN = "struct<start:int,end:int,hit:string,before:string>"
_BLOCK = 256


def located(text: Column, pattern: str) -> Column:
    """All matches with their places in code points and the 24 characters before them.

    The texts between the matches give the places. They are summed up in blocks, as
    appending to one long array would copy it for each match.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.filter(
        F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("hit"), F.length(g).alias("gap"), F.right(g, F.lit(24)).alias("before"))),
        lambda s: s["hit"].isNotNull(),
    )

    def add(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + F.length(s["hit"])
        new = F.array(F.struct(start.alias("start"), end.alias("end"), s["hit"].alias("hit"), s["before"].alias("before")))
        full = F.size(state["last"]) >= _BLOCK
        return F.struct(
            F.when(full, F.concat(state["done"], F.array(state["last"]))).otherwise(state["done"]).alias("done"),
            F.when(full, new).otherwise(F.concat(state["last"], new)).alias("last"),
            end.alias("at"),
        )

    empty = F.struct(
        F.array().cast(f"array<array<{_SPAN}>>").alias("done"), F.array().cast(f"array<{_SPAN}>").alias("last"), F.lit(0).alias("at")
    )
    return F.aggregate(pairs, empty, add, lambda s: F.flatten(F.concat(s["done"], F.array(s["last"]))))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    digits = F.regexp_extract_all(F.reverse(hit), F.lit("[0-9]"), F.lit(0))

    def worth(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    return F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(_OCTETS)
    if kind == "card":
        return F.length(_digits(hit)).between(12, 19) & luhn(hit)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _checked(kind: str) -> Callable[[Column], Column]:
    return lambda s: _valid(kind, s["hit"])


def _marked(i: int) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"], F.lit(i).alias("kind"), s["end"])


def _count(hit: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(hit, f"[^{characters}]", ""))


def features(kind: Column, hit: Column, before: Column) -> Column:
    """Format and context of a candidate, as numbers."""
    near = F.lower(before)
    flags = [
        hit.startswith("("), hit.contains("@"), (F.length(_digits(hit)).between(12, 19) & luhn(hit)), hit.rlike(_OCTETS),
        before.rlike("[A-Za-z0-9]$"), before.rlike(r"\+$"), near.rlike("tel|phone|call|fax|mobil"), near.rlike("card|visa|iban|account|konto"),
        near.rlike("mail|contact|write"), near.rlike("ip|host|server|addr"), hit.rlike(r"\((?:at|dot)\)|\[(?:at|dot)\]"), hit.rlike("[A-Za-z]$"),
    ]
    counts = [F.length(hit), F.length(_digits(hit)), _count(hit, "."), _count(hit, r"\x20"), _count(hit, r"\-"), _count(hit, "()"), _count(hit, ":"), _count(hit, "A-Za-z")]
    return F.array(*[x.cast("double") for x in (kind, *counts, *flags)])


def _candidates(text: Column) -> Column:
    """All generators' spans with their features; an array."""
    found = []
    for i, (name, pattern) in enumerate(GENERATORS.items()):
        need = {"contact": "[@(\\[{]", "number": "[0-9]", "address": "[0-9A-Fa-f]:"}[name]
        spans = F.when(text.rlike(need), located(text, pattern)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        found.append(F.transform(spans, _candidate(i)))
    return F.concat(*found)


def _candidate(i: int) -> Callable[[Column], Column]:
    def made(s: Column) -> Column:
        f = features(F.lit(i), s["hit"], s["before"])
        return F.struct(s["start"], s["end"], F.lit(len(BASE) + i).alias("kind"), s["hit"], f.alias("f"), s["before"])

    return made


def confirmed(kind: Column, hit: Column, before: Column) -> Column:
    """Whether the base rules hold for a candidate; what the trees learn."""
    plain = hit.rlike(r"^\(?[0-9]+(?:[\x20-]?[0-9]+)*$")
    number = (plain & F.length(_digits(hit)).between(12, 19) & luhn(hit)) | (before.rlike(r"\+$") & F.length(_digits(hit)).between(9, 15)) | hit.rlike(_OCTETS)
    email = hit.rlike(rf"^{_LOCAL}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++$")
    address = hit.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
    return F.when(kind == len(BASE), email).when(kind == len(BASE) + 1, number).otherwise(address)


def _tree_sql(node, at: str) -> str:
    """A tree of Spark ML as nested conditions over the array ``at``."""
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    test = f"element_at({at}, {split.featureIndex() + 1}) <= {split.threshold()!r}D"
    return f"if({test}, {_tree_sql(node.leftChild(), at)}, {_tree_sql(node.rightChild(), at)})"


class Judge:
    """Boosted trees as SQL, and a threshold for each generator; without ``sql`` nothing is added."""

    def __init__(self, sql: str | None = None, thresholds: dict[int, float] | None = None):
        self.sql, self.thresholds = sql, thresholds or {}

    def selected(self, candidates: str) -> str:
        """SQL of the array of candidates that are redacted."""
        if not self.sql or not self.thresholds:
            return f"filter({candidates}, c -> false)"
        limit = " ".join(f"when {k} then {v!r}D" for k, v in self.thresholds.items())
        return f"filter({candidates}, c -> coalesce(({self.sql}) >= case c.kind {limit} end, false))"


def candidate_groups(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The candidates of all documents: ``kind``, features ``f``, ``label``, ``part`` (0 is kept from the trees), and their number ``n``."""
    picked = docs.select(docs[text_col].alias("text")).where("text is not null")
    rows = picked.select(F.explode(_candidates(F.col("text"))).alias("c"))
    label = confirmed(F.col("c.kind"), F.col("c.hit"), F.col("c.before")).cast("double").alias("label")
    part = F.pmod(F.xxhash64("c.hit"), F.lit(3)).alias("part")
    groups = rows.select("c.kind", "c.f", label, part).groupBy("kind", "f", "label", "part").agg(F.count(F.lit(1)).alias("n"))
    return groups.sortWithinPartitions("kind", "f", "label", "part")


def train(docs: DataFrame, text_col: str = "text") -> Judge:
    """Fit the trees and calibrate the thresholds on the candidates of all documents."""
    groups = Steps(docs.sparkSession, "candidates").write(candidate_groups(docs, text_col))
    table = groups.where("part > 0").select(array_to_vector("f").alias("features"), "label", F.col("n").cast("double").alias("weight"))
    labels, rows = table.agg(F.count_distinct("label"), F.count(F.lit(1))).first()
    if labels < 2:
        return Judge()
    # Spark ML chooses splits by all rows as long as these are no more than the square of the bins
    trees = GBTClassifier(
        weightCol="weight", maxBins=max(32, math.isqrt(rows) + 1), maxIter=8, maxDepth=3, stepSize=0.3, seed=3, checkpointInterval=-1, cacheNodeIds=False
    )
    model = trees.fit(table.coalesce(-(-rows // ROWS_PER_TASK)))
    judge = Judge(" + ".join(f"{float(w)!r}D * {_tree_sql(t._java_obj.rootNode(), 'c.f')}" for w, t in zip(model.treeWeights, model.trees, strict=True)))
    unseen = groups.where("part = 0").select("kind", F.struct("f").alias("c"), "label", "n")
    scored = unseen.select("kind", F.expr(judge.sql).alias("score"), "label", "n")
    judge.thresholds = {r["kind"]: r["threshold"] for r in thresholds(scored).collect()}  # one row a generator
    return judge


def thresholds(scored: DataFrame, precision: float = PRECISION, least: int = LEAST_CONFIRMED) -> DataFrame:
    """``kind`` and its ``threshold`` as ``calibrated`` gives it, from ``kind``, ``score``, ``label`` and their number ``n``.

    Kinds that can't be calibrated are left out.
    """
    by_score = scored.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right"))
    above = Window.partitionBy("kind").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = by_score.select("kind", "score", F.sum("n").over(above).alias("n"), F.sum("right").over(above).alias("right"))
    good = summed.where((F.col("right") >= least) & (F.col("right") >= precision * F.col("n")))
    return good.groupBy("kind").agg(F.min("score").alias("threshold"))


def calibrated(scored: list[tuple[float, float]], precision: float = PRECISION, least: int = LEAST_CONFIRMED) -> float | None:
    """The lowest score at which ``precision`` of the candidates from there up are confirmed."""
    best, right = None, 0.0
    ordered = sorted(scored, reverse=True)
    for i, (score, label) in enumerate(ordered, 1):
        right += label
        last_of_score = i == len(ordered) or ordered[i][0] != score
        if last_of_score and right >= least and right >= precision * i:
            best = score
    return best


def located_pii(docs: DataFrame, keep: list[str], text_col: str = "text", judge: Judge | None = None, prefix: str = "") -> DataFrame:
    """``keep`` columns, ``n_`` and the kind for each base kind, ``base``, the base spans, and ``more``, the added ones.

    The new columns' names begin with ``prefix``.
    """
    judge = train(docs, text_col) if judge is None else judge
    text = fresh("text")
    docs = docs.select(*[docs[c] for c in keep], F.coalesce(docs[text_col], F.lit("")).alias(text))
    for kind, pattern in BASE.items():
        need = F.col(text).contains("@") if kind == "email" else F.col(text).rlike("[0-9]")
        spans = F.filter(located(F.col(text), pattern), _checked(kind))
        docs = docs.withColumn(f"{text}_{kind}", F.when(need, spans).otherwise(F.array().cast(f"array<{_SPAN}>")))
    base = F.concat(*[F.transform(f"{text}_{k}", _marked(i)) for i, k in enumerate(BASE)])
    docs = docs.withColumn(f"{text}_base", F.array_sort(base)).withColumn(f"{text}_all", _candidates(F.col(text)))
    docs = docs.withColumn(f"{text}_picked", F.expr(judge.selected(f"{text}_all")))
    more = F.expr(
        f"filter({text}_picked, c -> not exists({text}_base, b -> b.start <= c.start and b.end >= c.end))"
    )
    more = F.transform(more, lambda c: F.struct(c["start"], c["kind"], c["end"]))
    counts = [F.size(f"{text}_{k}").cast("long").alias(f"{prefix}n_{k}") for k in BASE]
    return docs.select(*keep, *counts, F.col(f"{text}_base").alias(f"{prefix}base"), more.alias(f"{prefix}more"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, keep: list[str], text_col: str = "text", judge: Judge | None = None) -> DataFrame:
    """``keep`` columns, counts by base kind, the base spans' digest, and all spans."""
    found = located_pii(docs, keep, text_col, judge)
    everything = F.array_sort(F.concat("base", "more"))
    return found.select(*keep, *[f"n_{k}" for k in BASE], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(everything).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", judge: Judge | None = None) -> DataFrame:
    """The rows of ``docs`` with each span replaced by its kind, as ``<EMAIL>``; overlapping spans become one.

    ``length_col`` is set to the new length where the text changes; a null text stays null.
    """
    prefix, spans, inner = fresh("pii"), fresh("spans"), docs.columns
    found = located_pii(docs, inner, text_col, judge, prefix)
    joined = F.aggregate(
        F.array_sort(F.concat(f"{prefix}base", f"{prefix}more")),
        F.array().cast("array<struct<start:int,kind:int,end:int>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["end"] > s["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.get(a, F.size(a) - 1)["start"].alias("start"), F.get(a, F.size(a) - 1)["kind"].alias("kind"), F.greatest(F.get(a, F.size(a) - 1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(a, F.array(s))),
    )
    found = found.select(*[found[c] for c in inner], joined.alias(spans))
    text, names = F.col(text_col), F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    parts = F.aggregate(
        F.col(spans),
        F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at")),
        lambda a, s: F.struct(F.concat(a["parts"], F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).alias("parts"), s["end"].alias("at")),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
    new = F.when(F.size(spans) > 0, parts).otherwise(text)
    found = found.withColumn(text_col, new)
    if length_col in inner:
        kind = docs.schema[length_col].dataType
        found = found.withColumn(length_col, F.when(F.size(spans) > 0, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return found.select(*inner)
