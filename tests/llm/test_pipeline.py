import re

import corpus_pipeline
import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from rowproof.llm import minhash, queries, quality

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    if name in queries.ORACLES:
        assert differences(spark, connect(FOLDER), queries.QUERIES[name], queries.ORACLES[name], FOLDER) == ""
    else:
        assert queries.QUERIES[name](spark, FOLDER).count() > 0


def test_stages(spark, documents, tmp_path):
    docs, kept = documents, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs)
        assert docs.columns == documents.columns or i == len(corpus_pipeline.STAGES) - 1, name
    whole = {r["doc_id"]: r["text"] for r in documents.collect()}
    good = {i for i, t in whole.items() if not (x := quality.Text(t)).base_failed and not any(r.rejects(x) for r in quality.RULES)}
    assert {r["doc_id"] for r in kept[0].collect()} == good
    after = [{r["doc_id"] for r in k.select("doc_id").distinct().collect()} for k in kept]
    assert all(b <= a for a, b in zip(after, after[1:], strict=False)) and len(after[1]) < len(after[0])
    assert after[3] == after[2] == after[4]
    for r in kept[3].collect():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["text"]) and r["n_chars"] == len(r["text"])


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "redact_pii", "pack"]
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"] and rows.count() > 0


def test_near_dedup_judges_rows_by_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text.replace("w59", "end"), " ".join(f"v{i}" for i in range(60))
    rows = [
        (5, text, "b"), (5, text, "a"), (None, text, "c"), (7, near, "d"), (7, other, "e"), (3, other + " more", "f"),
        (None, "only here " * 9, "g"), (8, None, "h"), (8, None, "h"), (9, "", "i"), (10, "", "j"), (None, None, "k"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()), key=repr)
    want = [(5, text, "a"), (3, other + " more", "f"), (None, "only here " * 9, "g"), (8, None, "h"), (9, "", "i"), (10, "", "j"), (None, None, "k")]
    assert got == sorted(want, key=repr)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), FOLDER).count() == 0


def test_near_dedup_keeps_one_of_each_component(spark, documents):
    judged = minhash.near_duplicates(documents)
    want = sorted(r["doc_id"] for r in judged.where("kept").select("doc_id").collect())
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents, FOLDER).collect()) == want
