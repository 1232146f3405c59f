"""Operator 2, secret scan: base patterns and assignment-aware lexing.

The lexer goes once over a text, token by token: strings with escapes (also triple-quoted, and with
prefixes), comments, names, operators, brackets, line breaks. From these it reads pairs of a name and
the literals assigned to it: assignments and comparisons, keys of mappings, ``d["name"] = "x"``, arguments
of calls (``set_password("x")``, ``put("name", "x")``), attributes and elements of XML, ``#define``, settings without
quotes, and the lines of YAML blocks. Literals side by side or joined by an operator, over
line breaks too, are one value. A name that was given a literal stands for it in later
expressions, as long as its scope (braces, or the body of an indented function) is open. Commented-out
code is read in the same way. An empty line ends every expression that is still open.

Each value is scored by how sensitive its target's name is and by how much the value looks like a
key or a pass phrase. Values over the threshold are reported where their literals stand, as kind
``literal``, unless a base span holds them already.

Defined cases: a null or empty text has no spans. A text of any length is read whole, in time and memory
in proportion to it. Every row of the input gives one row, repeated rows too; ids of any type and null
ids are passed through; other columns are ignored, but ``keep`` may not hold a result's name (``ValueError``).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowproof.llm.common import bounded_batches, map_texts

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 2.0
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: Weights of the parts of a target's name.
SENSITIVE = {
    "password": 2, "passwd": 2, "pwd": 2, "passphrase": 2, "secret": 2, "token": 1.5, "apikey": 2, "key": 1,
    "private": 1, "credential": 2, "credentials": 2, "auth": 1, "api": 0.5, "access": 0.5, "bearer": 1.5, "signing": 1, "client": 0.5,
}
#: Last parts of names that stand for something about a secret, not for the secret.
ABOUT = {
    "label", "hint", "type", "name", "file", "path", "url", "uri", "mode", "field", "message", "msg", "error", "length", "size", "policy",
    "prompt", "title", "text", "count", "min", "max", "regex", "pattern", "format", "env", "placeholder", "column", "header", "prefix", "help",
}
#: A name that stands for more literals than this is not followed further, or sums of sums would grow without bound.
FOLLOWED = 64
_COMPARES = ("==", "===", "!=", "!==")
_TYPES = {"str", "string", "char", "bytes", "text", "const", "varchar", "object", "any", "var", "val", "let"}
_HINT = re.compile("pass|pwd|secret|token|key|private|credential|auth|bearer|signing", re.I | re.A)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PLACEHOLDER = re.compile(r"example|changeme|placeholder|your|xxx|<|\$\{|\{\{|\*\*\*|todo|dummy|sample|redacted", re.I)
_MESSAGE = re.compile(r"\b(enter|please|required|must|invalid|incorrect|wrong|forgot|reset|cannot|missing|not|is|are|for|of|the|an?|to|with)\b|[.?!:]$|%[sd]|\{\w*\}", re.I)
_IDENTIFIER = re.compile(r"[A-Za-z]+(?:[_./:-][A-Za-z]+)+|[a-z]{3,}(?:[A-Z][a-z]{2,})+|[A-Z]?[a-z]+|[A-Z]+")
_ADDRESS = re.compile(r"[a-z][a-z0-9+.-]*://[^@]*$|[./~]+/|/\w+/", re.I)

_TOKEN = re.compile(
    r"""
    (?P<nl>\r?\n[ \t]*+)
  | (?P<ws>[ \t\f\v\r]++|\\\r?\n)
  | (?P<prose>(?:[A-Za-z]++[ ](?=[A-Za-z]))++)
  | (?P<str>(?<![A-Za-z0-9_])[A-Za-z]{0,2}(?:
        \"{3}(?P<s1>(?:[^\\"]|\\[\s\S]|"(?!""))*+)\"{3} | '{3}(?P<s2>(?:[^\\']|\\[\s\S]|'(?!''))*+)'{3}
      | "(?P<s3>[^"\\\n]*+(?:\\.[^"\\\n]*+)*+)" | '(?P<s4>[^'\\\n]*+(?:\\.[^'\\\n]*+)*+)' | `(?P<s5>[^`\\]*+(?:\\[\s\S][^`\\]*+)*+)`))
  | (?P<comment>(?<![^\s;,(){}\[\]+])(?:\#|//)[^\n]*+)
  | (?P<esc>\\[\s\S])
  | (?P<name>[$@]?\{?[A-Za-z0-9_][A-Za-z0-9_.\-]*+)
  | (?P<op>===?|!==?|=>|:=|\?=|\+=|->|::|=|:)
  | (?P<sign>[(){}\[\],;+&.|])
    """,
    re.X,
)
_BARE = re.compile(r"[^\s\"'`,;<>(){}\[\]]{8,}")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?[0-9]?[ \t]*\r?\n")
_LINE = re.compile(r"([ \t]*)([^\r\n]*)\r?(?:\n|\Z)")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*+)[^<>]*+>\s*+([^<>]*?)\s*</", re.A)
_OPENS = {")": "(", "]": "[", "}": "{"}
Span = tuple[str, int, int]
Place = tuple[int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost matches that don't overlap, for each kind by itself."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in _PART.findall(name)]
    weight = sum(SENSITIVE.get(p) or SENSITIVE.get(p.removesuffix("s"), 0) for p in parts)
    return weight / 4 if parts and parts[-1] in ABOUT else float(weight)


def randomness(value: str) -> float:
    """0 for placeholders, names and messages, up to 1 for long mixed strings; pass phrases are in between."""
    n = len(value)
    if n < 8 or _PLACEHOLDER.search(value) or _ADDRESS.match(value):
        return 0.0
    if len(value.split()) > 1:
        phrase = len(value.split()) > 3 or re.search("[0-9]", value)
        return 0.7 if phrase and not _MESSAGE.search(value.strip()) else 0.0
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    if kinds >= 2 and re.search("[0-9]", value):
        return min(1.0, entropy / 4)
    if value.isascii() and value.isalpha() and n >= 16:
        # letters only: words have vowels all along and capitals at their starts
        gaps = max(map(len, re.split("[aeiouyAEIOUY]", value)))
        turns = sum(a.isupper() != b.isupper() for a, b in zip(value, value[1:], strict=False))
        if gaps > 4 or (turns > 2 and not _IDENTIFIER.fullmatch(value)):
            return min(1.0, entropy / 4)
    if _IDENTIFIER.fullmatch(value):
        return 0.1
    return min(1.0, entropy / 4) * (0.4 if kinds >= 2 else 0.1)


class _Lexer:
    """One pass over ``text[start:end]``: pairs of a target's name and the places of its literals."""

    def __init__(self, text: str, start: int = 0, end: int | None = None, outer: _Lexer | None = None):
        self.text, self.start, self.end, self.in_comment = text, start, len(text) if end is None else end, outer is not None
        self.found: list[tuple[str, list[Place]]] = outer.found if outer else []
        # what names stand for, innermost scope last, and the names of each open scope
        self.known: dict[str, list[tuple[int, list[Place]]]] = outer.known if outer else {}
        self.scopes: list[list[str]] = outer.scopes if outer else [[]]
        self.bodies: list[int] = []  # indents of the functions whose bodies are open, a scope each
        # bracket, what stood before it, the first string inside, the sensitive mapping that it is in
        self.frames: list[list] = []
        self.braces = 0
        self.key = self.before = self.named = self.block = None
        self.clear()

    def clear(self) -> None:
        """No target. ``depth`` counts the brackets around it, ``parts`` are its literals so far."""
        self.target, self.depth, self.op, self.parts = None, 0, "", []
        self.expecting = self.joined = self.broken = self.wrapped = False

    def lookup(self, name: str) -> list[Place] | None:
        found = self.known.get(name.strip("${.").lower())
        return found[-1][1] if found else None

    def define(self, name: str, parts: list[Place]) -> None:
        held, depth = self.known.setdefault(name.lower(), []), len(self.scopes)
        if held and held[-1][0] == depth:
            held.pop()
        else:
            self.scopes[-1].append(name.lower())
        held.append((depth, parts if len(parts) <= FOLLOWED else []))

    def leave_scope(self) -> None:
        if len(self.scopes) > 1:
            for name in self.scopes.pop():
                self.known[name].pop()

    def emit(self) -> None:
        """The value is complete: literals of one expression, or of one place in a list."""
        if self.target is None or not self.parts:
            return
        name = self.target
        if name.lower() == "value" and self.named and self.op == "=":
            name = self.named
        elif not sensitivity(name) and self.frames:  # a mapping's name speaks for its keys
            name = self.frames[-1][3] or name
        self.found.append((name, self.parts))
        if self.target.lower() in ("key", "name") and self.op == "=":
            self.named = self.text[self.parts[0][0] : self.parts[0][1]]
        if self.op not in _COMPARES:
            self.define(self.target, self.parts)
        self.parts = []

    def flush(self) -> None:
        self.emit()
        self.clear()

    def pairs(self) -> list[tuple[str, list[Place]]]:
        at = self.start
        while at < self.end and (m := _TOKEN.search(self.text, at, self.end)):
            kind, at = m.lastgroup, m.end()
            if kind in ("ws", "esc"):
                continue
            if kind == "nl":
                self.line_break(m)
                continue
            if self.broken:  # only an operator or, in C and shells, another string joins the lines
                if not (kind == "sign" and m[0] in "+&." or (kind.startswith("s") and kind != "sign" and self.op in ("=", ":=") and self.expecting)):
                    self.flush()
                self.broken = False
            at = getattr(self, "on_" + ("str" if kind in ("s1", "s2", "s3", "s4", "s5") else kind))(m) or at
        self.flush()
        return self.found

    def line_break(self, m: re.Match) -> None:
        indent = len(m[0].strip("\r\n").expandtabs())
        after = self.text[m.end() : m.end() + 1]
        if after in ("\n", "\r"):  # an empty line ends whatever is open
            self.flush()
            while self.frames and self.frames[-1][0] != "{":
                self.frames.pop()
        elif self.target is not None and self.bracketed() <= self.depth:
            if self.expecting and not self.joined and self.op not in ("=", ":="):
                self.clear()  # a mapping begins
            elif not self.joined:
                self.broken = True
        while self.bodies and after and after not in "\r\n" and indent <= self.bodies[-1]:
            self.flush()
            self.broken = False
            self.bodies.pop()
            self.leave_scope()
        self.block = indent
        self.key = self.before = self.named = None

    def bracketed(self) -> int:
        return len(self.frames)

    def on_comment(self, m: re.Match) -> None:
        if not self.in_comment:
            define = re.match(r"#\s*define\s+", m[0])
            a = m.start() + (len(define[0]) if define else len(m[0]) - len(m[0].lstrip("#/* \t")))
            inner = _Lexer(self.text, a, m.end(), self)
            if define and (named := re.match(r"(\w+)\s+(?=[\"'])", self.text[a : m.end()])):
                inner.start += len(named[0])
                inner.target, inner.op, inner.expecting = named[1], "=", True
                inner.pairs()
            elif a < m.end():
                self.scopes.append([])
                depth = len(self.scopes)
                inner.pairs()
                while len(self.scopes) >= depth:
                    self.leave_scope()

    def on_prose(self, m: re.Match) -> None:
        if m[0].startswith(("def ", "class ", "func ", "function ")):
            self.bodies.append(self.block or 0)
            self.scopes.append([])
        self.named = None
        if self.target is not None and self.expecting and self.bracketed() <= self.depth:
            self.clear()
        self.key, self.before = None, m[0].split()[-1]

    def on_str(self, m: re.Match) -> None:
        number = next(i for i in range(1, 6) if m[f"s{i}"] is not None)
        place = m.span(f"s{number}")
        if self.target is not None and (self.expecting or self.wrapped):
            self.parts.append(place)
            self.expecting, self.joined, self.wrapped = False, False, True
        elif self.frames and self.frames[-1][0] == "(" and self.frames[-1][1] and self.target is None:
            if place[1] > place[0]:
                self.found.append((self.frames[-1][1], [place]))
        if self.frames and self.frames[-1][2] is None:
            self.frames[-1][2] = self.text[place[0] : place[1]][:256]
        self.key, self.before = self.text[place[0] : place[1]][:256], None

    def on_name(self, m: re.Match) -> int | None:
        word = m[0].strip("${@.")
        if m[0] in ("def", "class", "func", "function"):
            self.on_prose(m)
            return None
        if word.lower() in ("or", "else") and self.target is not None and not self.expecting:
            self.emit()
            self.expecting, self.wrapped = True, False
            return None
        end = None
        if self.target is not None and self.expecting and not word.lower() in _TYPES:
            known = self.lookup(m[0])
            if known is not None:
                self.parts.extend(known)
            elif self.bracketed() <= self.depth and not self.parts and self.op in ("=", ":", ":=", "?=", "+=", "=>"):
                # a setting without quotes, unless it is a call or a subscript
                bare = _BARE.match(self.text, m.start(), self.end)
                if bare and self.text[bare.end() : bare.end() + 1] not in ("(", "["):
                    self.parts = [(m.start(), bare.end())]
                    end = bare.end()
            self.expecting = self.wrapped = self.joined = False
        elif self.target is None and self.key and word.lower() in _TYPES:
            return None  # char password[] and the like
        if self.target is None and self.before is None:
            self.before = self.key
        self.key = self.before if word.lower() in _TYPES and self.before else word
        return end

    def on_op(self, m: re.Match) -> int | None:
        if m[0] in ("::", "->"):
            self.key = None
            return None
        typed = self.target is not None and self.op == ":" and m[0] == "=" and not self.wrapped
        if typed and self.bracketed() <= self.depth and (not self.parts or self.key):
            name = self.target  # name: type = value
            self.clear()
        elif not self.key:
            return None
        elif self.op in _COMPARES and self.wrapped:
            self.flush()
            return None
        else:
            name = self.key
            self.parts = [] if self.wrapped and self.bracketed() <= self.depth and self.key == self.last_text() else self.parts
            self.flush()
        self.target, self.op, self.depth, self.expecting = name, m[0], self.bracketed(), True
        self.key = self.before = None
        if m[0] == ":" and (block := _BLOCK.match(self.text, m.end(), self.end)):
            return self.read_block(block.end())
        return None

    def last_text(self) -> str | None:
        return self.text[self.parts[-1][0] : self.parts[-1][1]][:256] if self.parts else None

    def read_block(self, at: int) -> int:
        """The lines of a YAML block: those with more indent than the key's line."""
        outer, parts = self.block or 0, []
        while at < self.end and (line := _LINE.match(self.text, at, self.end)):
            if line[2] and len(line[1].expandtabs()) <= outer:
                break
            if line[2]:
                parts.append(line.span(2))
            at = line.end()
        # the line break before the next line is left to be read
        self.parts = parts
        self.flush()
        return at - 1 if at < self.end and at > 0 and self.text[at - 1] == "\n" else at

    def on_sign(self, m: re.Match) -> None:
        sign = m[0]
        if sign in "([":
            self.frames.append([sign, self.key, None, self.frames[-1][3] if self.frames else None])
            if self.target is not None and not self.expecting and not self.parts:
                self.expecting = True  # arguments of a call whose result is assigned
            self.key = None
        elif sign == "{":
            name = self.target if self.target is not None and self.expecting and sensitivity(self.target) else None
            self.flush()
            self.frames.append([sign, None, None, name or (self.frames[-1][3] if self.frames else None)])
            self.scopes.append([])
            self.braces += 1
            self.key = None
        elif sign in _OPENS:
            self.close(sign)
        elif sign == "," or sign == "|":
            if self.target is not None and (sign == "|" or self.bracketed() > self.depth):
                self.emit()
                self.expecting, self.wrapped = True, False
            else:
                self.flush()
                first = self.frames[-1] if self.frames else None
                if first and first[0] == "(" and sign == "," and first[2] and first[2] == self.key and sensitivity(self.key):
                    self.target, self.op, self.depth, self.expecting = self.key, ",", self.bracketed(), True
            self.key = None
        elif sign == ";":
            self.flush()
            self.key = None
        elif self.target is not None:  # + & .
            self.expecting = self.joined = True
        self.before = None

    def close(self, sign: str) -> None:
        self.key = None
        if not self.frames or self.frames[-1][0] != _OPENS[sign]:
            if sign == "}" and self.braces:
                while self.frames[-1][0] != "{":
                    self.frames.pop()
            else:
                self.flush()
                return
        bracket, name, text, _ = self.frames.pop()
        if self.target is not None and len(self.frames) < self.depth:
            self.flush()
        if bracket == "{":
            self.flush()
            self.braces -= 1
            self.leave_scope()
        elif bracket == "[":
            self.key = text or name
        if self.target is not None:
            self.expecting = False


def lex(text: str) -> Iterator[tuple[str, list[Place]]]:
    """Pairs of a target's name and the literals assigned to it, each with its place."""
    yield from _Lexer(text).pairs()
    for m in _ELEMENT.finditer(text):
        if m[2]:
            yield m[1], [m.span(2)]


def literal_spans(text: str, base: list[Span], threshold: float = THRESHOLD) -> list[Span]:
    """Literals whose value scores at least ``threshold``, but for those within a base span."""
    if not _HINT.search(text):
        return []
    found: set[Place] = set()
    for name, places in lex(text):
        weight = sensitivity(name)
        if weight and (1 + weight) * randomness(_plain("".join(text[a:b] for a, b in places))) >= threshold:
            found.update((a, b) for a, b in places if b > a)
    covered = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in covered], list(accumulate((b for _, b in covered), max))
    return [("literal", a, b) for a, b in sorted(found) if not ((i := bisect_right(starts, a)) and reach[i - 1] >= b)]


def _plain(value: str) -> str:
    """A literal without its escapes."""
    return re.sub(r"\\(.)", r"\1", value, flags=re.S) if "\\" in value else value


def listed(spans: list[Span], kinds: tuple[str, ...] = KINDS) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find_secrets(docs: DataFrame, keep: list[str], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, counts by base kind, the base spans' digest, and all spans."""
    bounded_batches(docs.sparkSession)
    fields = [(f"n_{k}", T.LongType()) for k in KINDS[:3]] + [("base_sha256", T.StringType()), ("spans", T.StringType())]
    if clash := {c.lower() for c in keep} & {n for n, _ in fields}:
        raise ValueError(f"names of results: {sorted(clash)}")

    def make():
        def compute(texts):
            rows = []
            for text in texts:
                base = base_spans(text) if text else []
                added = literal_spans(text, base, threshold) if text else []
                n = Counter(k for k, _, _ in base)
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((n["assign"], n["access"], n["hex"], digest, listed(base + added)))
            return list(map(list, zip(*rows, strict=True))) if rows else [[]] * 5

        return compute

    return map_texts(docs, text_col, keep, fields, make)
