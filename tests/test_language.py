"""Languages against held-out labels and against a plain version."""

import zlib

from pyspark.sql import functions as F

from millrace.functions import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.fit(docs.where(~held), sample=400)
    rows = docs.where(held).select("doc_id", "text", "lang", language.detect(F.col("text"), model).alias("found")).collect()
    assert len(model.languages) == 4 and len(rows) > 150
    assert sum(r["lang"] == r["found"] for r in rows) >= 0.95 * len(rows)
    for r in rows[:40]:  # the same by plain code
        assert zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        found = language.bins(r["text"])
        score = {n: sum(w[b] for b in found) for n, w in zip(model.languages, model.weights)}
        assert r["found"] == min(score, key=lambda n: (-score[n], n))


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "12 34"), (5, "😀é ß the and of the"), (6, "der und die " * 20000), (7, "the of and " * 5)]
    model = language.fit_rows([("the of and with from this", "en"), ("der die das und nicht ein", "de"), (None, "fr"), ("x", None)])
    df = spark.createDataFrame([(i, t, "xx" if i == 7 else None) for i, t in rows], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang"] for r in language.with_language(df, model, "text").collect()}
    want = {i: language.DEFAULT for i in (1, 2)} | {6: "de", 5: "en", 7: "xx"}
    assert got.items() >= want.items() and model.languages == ("de", "en")
    assert df.select(language.detect(F.col("text"), language.fit_rows([])).alias("x")).distinct().collect() == [("en",)]
    plan = language.with_language(df, model, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
