import zlib

from rowproof.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).collect()
    true = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(true) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) > 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_labels_do_not_matter(spark, documents):
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    changed = documents.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    one = {r["doc_id"]: tuple(r) for r in language.identify(documents).collect()}
    other = {r["doc_id"]: tuple(r) for r in language.identify(changed).collect()}
    assert one == other


def test_cases(spark, empty):
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr", 0) for i in range(40)]
    rows += [(100, None, "en", 1), (101, "12 34 ...", "en", 1), (102, "", "fr", 1), (None, "the dog", "en", 1), (103, "le chien " * 20_000, None, 1), (104, "日本", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r["doc_id"]: r for r in language.identify(df).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and got[100]["score"] == 0
    assert got[None]["lang_pred"] == "en" and not got[None]["held_out"]
    assert got[103]["lang_pred"] == "fr" and got[104]["lang_pred"] in ("en", "fr")
    assert language.identify(empty).count() == 0
    unlabelled = df.withColumn("lang", df["lang"].substr(0, 0)).where("false").union(spark.createDataFrame([(1, "text", None, 0)], df.schema))
    assert language.identify(unlabelled).first()["lang_pred"] == "und"


def test_kernel_is_the_blended_spectrum():
    texts = ["banana", "bandana", "xyz"]
    model = language.Model(["a"], [language.buckets(t) for t in texts])
    got = model.kernel([language.buckets(t) for t in texts])
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            grams = [({x[a : a + n] for a in range(len(x) - n + 1)}, {y[a : a + n] for a in range(len(y) - n + 1)}) for n in (1, 2, 3)]
            want = sum(len(p & q) / (len(p) * len(q)) ** 0.5 for p, q in grams) / 3
            assert abs(got[i, j] - want) < 1e-5
