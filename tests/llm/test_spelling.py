import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from rowproof.llm import queries, spelling


def one_edit(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def by_hand(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    # words an edit apart have a spelling with one place left out in common
    holes = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for some in holes.values():
        for a in some:
            near[a] |= {b for b in some if one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(rows)


def collected(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()))


@settings(max_examples=500, deadline=None)
@given(st.text("abéÿz", min_size=7, max_size=14), st.integers(0, 13), st.sampled_from("abéc"), st.sampled_from(["replace", "insert", "delete"]))
def test_words_an_edit_apart_share_a_signature(word, at, letter, kind):
    at = min(at, len(word) - 1)
    other = word[:at] + ("" if kind == "delete" else letter) + word[at + (kind != "insert") :]
    if len(other) < 7 or not one_edit(word, other):
        return
    (one, mask), (two, other_mask) = spelling.signatures(word), spelling.signatures(other)
    assert set(one) & set(two)
    assert (mask ^ other_mask).bit_count() <= 2


def test_forms_and_roots(spark):
    counts = {"abcdefgh": 1000, "abcdefgx": 100, "abcdefxx": 10, "abcdxfxx": 2, "zbcdefgh": 101, "bcdefgh": 2, "aabcdefgh": 3, "abcdefgk": 1000, "ééééééé": 2, "ééééééè": 20, "alonealone": 5, "oncenever": 1, "abcdef": 9}
    table = spark.createDataFrame([(i, " ".join([w] * n), "x", 1) for i, (w, n) in enumerate(counts.items())], "doc_id long, text string, word string, n int")
    rows = {r["word"]: r for r in spelling.variants(table, planted_every=None).collect()}
    assert set(rows) == set(counts) - {"oncenever", "abcdef"}
    assert rows["abcdxfxx"]["form"] is None and rows["abcdxfxx"]["n_near"] == 1
    assert rows["abcdefxx"]["form"] == "abcdefgx" and rows["abcdefxx"]["root"] == "abcdefgh"
    assert rows["abcdefgx"]["form"] == "abcdefgh"  # of two as frequent the first
    assert rows["zbcdefgh"]["form"] is None and rows["bcdefgh"]["form"] == "abcdefgh"
    assert rows["ééééééé"]["root"] == "ééééééè"
    assert (rows["alonealone"]["n_near"], rows["alonealone"]["form_n"], rows["alonealone"]["root"]) == (0, None, "alonealone")


def test_cases(spark, texts, empty):
    docs = [(1, None), (2, ""), (3, "Abcdefgh ABCDEFGH abcdefgh× Äbcdefgh äbcdefgh"), (None, "nullnull nullnull"), (4, "w" * 200_000 + " " + "w" * 200_000), (5, "longer words " * 30_000), (5, "longer words"), (6, "ábcdefghi abcdefghi")]
    assert collected(spelling.variants(texts([t for _, t in docs], [i for i, _ in docs]))) == by_hand(docs)
    assert spelling.variants(empty).count() == 0


def test_query_by_hand(spark, rows):
    got = queries.op12_spelling_variants(spark, "/root/testdata/sf0.001")
    kinds = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert kinds == {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string", "form_n": "bigint", "root": "string"}
    assert collected(got) == by_hand([(r["doc_id"], r["text"]) for r in rows])
