"""Operator 10, licence scan by canonical digests.

A text is brought to a canonical form: A-Z in lower case, copyright lines dropped, spellings
that mean the same made equal, runs of punctuation, list numbers and white space turned into one space. The SHA-256 of the form is
joined by hash with the digests of known licences, so only entire texts match. The units looked up
are a whole document, its paragraphs (between blank lines), and its lines; equal units of a document
count once. Units without any of a few words, of which every known text holds one, are passed over before they are brought to their form. Known digests are a small table of fixed size, so the join is a broadcast and the
corpus is not shuffled.

Defined cases: a null or empty text, and units of which nothing is left, match nothing. Each row of the input
is looked up by itself, repeated rows too; null ids pass through; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.llm.common import fresh
from rowproof.llm.license_texts import KNOWN

#: What follows "copyright" in the words of a licence, and not in a notice.
_NOT_NOTICES = (
    "notice", "notices", "holder", "holders", "owner", "owners", "law", "laws", "license", "licenses", "licence", "permission", "statement", "statements",
    "interest", "interests", "disclaimer", "treaty", "and", "or", "on", "in", "is", "as", "to", "for", "the software", "the library", "the program", "rights",
    "ownership", "of", "if", "resulting",
)

#: Patterns (in lower case) and what stands for them, applied in this order. A line that a wrapped
#: text begins with "copyright notice" is no copyright line: a hyphen marks such words until punctuation goes.
RULES = (
    *((rf"copyright[^\S\n]+{word}\b", f"copyright-{word}") for word in _NOT_NOTICES),
    *((rf"\(c\)[^\S\n]+{words}\b", f"c-{words}") for words in ("you must", "the licenses")),
    (r"(^|\n)[^\na-z0-9]*(copyright([^\S\n]+[^\s]|[:(©])|\(c\)|©|all rights reserved)[^\n]*", "\n"),
    ("[‘’“”–—• ]", " "),
    (r"(^|\n)[^\S\n]*([0-9]{1,2}|[a-z])[.)][^\S\n]", "\n"),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("non-infringement", "noninfringement"),
    ("https:", "http:"),
    ("[\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+", " "),
    ("copyright owner", "copyright holder"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    text = F.translate(text, _UPPER, _LOWER)
    for pattern, new in RULES:
        text = F.regexp_replace(text, pattern, new)
    return F.btrim(text)


def canonical_text(text: str) -> str:
    """The same in Python, for the known texts and tests."""
    text = text.translate(str.maketrans(_UPPER, _LOWER))
    for pattern, new in RULES:
        text = re.sub(pattern, new, text, flags=re.A)
    return text.strip(" ")


def known_digests(known=KNOWN) -> dict[str, str]:
    """Licence identifiers by the digests of their texts' canonical forms."""
    return {hashlib.sha256(canonical_text(t).encode()).hexdigest(): name for name, t in known}


def anchors(known=KNOWN) -> list[str]:
    """Words of which every known text holds one, as written in the text in either case.

    A word that no rule makes stands in the text as it does in the canonical form, so a unit
    without any of these words cannot match.
    """
    made = [new for _, new in RULES if new.strip()]
    words = [{w for w in canonical_text(t).split() if w.isascii() and w.isalpha() and not any(m in w or w in m for m in made)} for _, t in known]
    out: list[str] = []
    while left := [x for x in words if not x.intersection(out)]:
        rest = set.union(*left)
        out.append(max(sorted(rest), key=lambda w: (sum(w in x for x in left) * len(w), len(w))))
    return out


def find_licenses(docs: DataFrame, keep: list[str], text_col: str = "text", known=KNOWN) -> DataFrame:
    """``keep`` columns, ``license_id``, ``digest``, and ``whole`` (the unit is all of the text), a row for each unit that matches."""
    text, unit = fresh("text"), fresh("unit")
    possible = f"(?i){'|'.join(anchors(known))}"
    docs = docs.select(*[docs[c] for c in keep], docs[text_col].alias(text)).where(F.col(text).rlike(possible))
    whole, lines = F.array(text), F.split(text, "\n", -1)
    paragraphs = F.split(text, r"\n[\x20\t\r]*\n", -1)
    units = F.array_distinct(F.concat(whole, paragraphs, lines))
    found = docs.select(*keep, text, F.explode(units).alias(unit)).where(F.col(unit).rlike(possible))
    found = found.select(*keep, (F.col(unit) == F.col(text)).alias("whole"), F.sha2(canonical(F.col(unit)), 256).alias("digest"))
    names = docs.sparkSession.createDataFrame(list(known_digests(known).items()), "digest string, license_id string")
    return found.join(F.broadcast(names), "digest").select(*keep, "license_id", "digest", "whole")


def oracle() -> str:
    form = f"translate(unit, '{_UPPER}', '{_LOWER}')"
    for pattern, new in RULES:
        new = "chr(10)" if new == "\n" else f"'{new}'"
        form = f"regexp_replace({form}, '{pattern}', {new}, 'g')"
    values = ", ".join(f"('{d}', '{n}')" for d, n in known_digests().items())
    return rf"""
WITH u AS (
  SELECT doc_id, text, unnest(list_distinct(list_concat([text], string_split_regex(text, '\n[\x20\t\r]*\n'), string_split(text, chr(10))))) AS unit
  FROM documents WHERE length(text) > 0
), f AS (
  SELECT doc_id, unit = text AS whole, trim({form}, ' ') AS form FROM u
)
SELECT doc_id, license_id, digest, whole
FROM f JOIN (VALUES {values}) AS k(digest, license_id) ON sha256(form) = digest WHERE length(form) > 0
"""
