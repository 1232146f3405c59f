import textwrap

from rowproof.llm import licenses
from rowproof.llm.license_texts import KNOWN, LONG, SHORT


def found(df):
    return sorted((r["doc_id"], r["license_id"], r["whole"]) for r in licenses.find_licenses(df, ["doc_id"]).collect())


def test_every_known_text_is_found_whole(texts):
    got = found(texts([t for _, t in KNOWN]))
    assert {(i, n) for i, n, whole in got if whole} == set(enumerate(n for n, _ in KNOWN))


def test_equivalent_forms(texts):
    mit = KNOWN[1][1]
    values = [
        "Copyright (c) 2020 Someone\n\n" + mit.upper(), mit.replace(", ", " ,\t").replace('"', "“"), mit.replace("sublicense", "sub-license").replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
        mit + " And one more condition.", "Some prose.\nReleased under the MIT licence!\nMore prose.", "x\n\n" + mit + "\n\ny" if "\n\n" not in mit else "x",
        None, "", "...", "Released under the MIT License.\nReleased under the MIT License.", "word " * 50_000,
    ]
    got = found(texts(values))
    assert [(i, w) for i, n, w in got if n == "MIT"] == [(0, True), (1, True), (2, True), (4, False), (9, False)]


def test_spark_and_python_agree(documents, rows, texts):
    values = [r["text"] for r in rows][:60] + [t for _, t in KNOWN] + ["1. a\n2) b\n  c. d", "© X\nAll Rights Reserved", "  x　y—z  "]
    df = texts(values)
    got = {r["doc_id"]: r["c"] for r in df.select("doc_id", licenses.canonical(df["text"]).alias("c")).collect()}
    assert got == {i: licenses.canonical_text(v) for i, v in enumerate(values)}


def test_empty_and_repeated(texts, empty):
    assert licenses.find_licenses(empty, ["doc_id"]).count() == 0
    assert found(texts(["SPDX-License-Identifier: MIT"] * 2, ids=[3, 3])) == [(3, "MIT", True)] * 2


def wrapped(text, width):
    return "\n".join(line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""]))


def test_known_texts_wrapped_at_any_width():
    for name, text in SHORT:
        form = licenses.canonical_text(text)
        for width in range(40, 101):
            for notice in ("", "Copyright (c) 2020 Some One\n\n", "Copyright 1999-2004, The Foundation\nAll rights reserved.\n\n", "(c) 2011 Andrew Orwell\n", "Copyright Oracle\n\n", "© X\n"):
                assert licenses.canonical_text(notice + wrapped(text, width)) == form, (name, width, notice)


def test_wrapped_isc_is_found(texts):
    isc = next(t for n, t in KNOWN if n == "ISC")
    widths = [w for w in range(40, 101) if "\ncopyright notice" in wrapped(isc, w)]
    assert widths
    assert found(texts([wrapped(isc, w) for w in widths])) == [(i, "ISC", True) for i in range(len(widths))]


def test_long_texts_headers_and_identifiers(texts):
    commented = [("\n".join((" * " if len(t) < 1200 else "\t") + line.rstrip() for line in t.split("\n")), n) for n, t in LONG]
    ids = ["GPL-2.0-only", "LGPL-2.1-or-later", "BSD-3-Clause", "MPL-2.0", "AGPL-3.0-only", "Unlicense"]
    values = commented + [(f"// SPDX-License-Identifier: {x}\nint main() {{}}", x) for x in ids]
    got = {(i, n) for i, n, _ in found(texts([v for v, _ in values]))}
    assert {(i, n) for i, (_, n) in enumerate(values)} <= got
    assert len(licenses.known_digests()) == len(KNOWN)
