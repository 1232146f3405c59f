import pytest

from rowproof.llm import quality

GOOD = " ".join(f"word{i}" for i in range(60))


def judged(df):
    return {r["doc_id"]: r for r in quality.quality(df, ["doc_id"]).collect()}


def test_base_counts_by_brute_force(documents, rows):
    got = judged(documents)
    for r in rows:
        words = [w for w in "".join(c if ord(c) != 32 and not 9 <= ord(c) <= 13 else " " for c in r["text"]).split(" ") if w]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(set(windows)) < len(windows) else ()
        lines = [x for x in r["text"].split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in r["text"]), sum(x in lines[:i] for i, x in enumerate(lines)), len(many))
        assert tuple(got[r["doc_id"]][c] for c in quality.BASE) == want
        assert got[r["doc_id"]]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_cases(texts):
    long = " ".join(f"w{i}" for i in range(30_000))
    got = judged(texts([None, "", GOOD, "a b " * 40, GOOD.upper(), GOOD + " $$$" * 10, long, GOOD]))
    assert [got[i]["kept"] for i in range(8)] == [False, False, True, False, False, False, True, True]
    assert got[0]["n_words"] == 0 and got[0]["base_failed"]
    assert got[3]["n_repeat_words"] == 80 and got[6]["n_words"] == 30_000


def test_order_does_not_change_the_verdict(documents):
    one = quality.quality(documents, ["doc_id"], rules=quality.RULES).collect()
    other = quality.quality(documents, ["doc_id"], rules=quality.RULES[::-1], sample_rows=20).collect()
    assert sorted(one) == sorted(other)


def test_rules_are_ordered_by_rejections_per_second(texts):
    import time

    slow = quality.Rule("slow", lambda x: time.sleep(0.002) or True)
    never = quality.Rule("never", lambda x: False)
    quick = quality.Rule("quick", lambda x: True)
    ordered = quality.order_rules(texts([GOOD] * 20), rules=(never, slow, quick))
    assert [r.name for r in ordered] == ["quick", "slow", "never"] or ordered[0].name == "quick"


def test_keep_good_returns_the_input_columns(texts, empty):
    df = texts([GOOD, "short", None])
    kept = quality.keep_good(df)
    assert kept.schema == df.schema and [r["doc_id"] for r in kept.collect()] == [0]
    assert quality.keep_good(empty).count() == 0
    assert quality.quality(empty, ["doc_id"]).count() == 0


@pytest.mark.parametrize("value,n", [("a b", 1), ("a\x0bb", 2), ("\x1ca", 1)])
def test_words_end_at_ascii_white_space_only(value, n):
    assert quality.Text(value).n_words == n
