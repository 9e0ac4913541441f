"""Postings are counted by one worker a task."""

from millrace.functions.stem import stem
from millrace.operators import search


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_by_one_worker(spark):
    df = spark.createDataFrame([(1, "Running runs ran quickly, running"), (2, None), (3, "the"), (4, "quick quickly")], "id long, text string")
    found = search.inverted_index(df, stem=True)
    assert plan(found).count("MapInArrow") == 1 and "ArrowEvalPython" not in plan(found)
    words = {1: "running runs ran quickly running".split(), 4: "quick quickly".split()}
    want = {(stem(w), i, sum(stem(x) == stem(w) for x in own), len(own)) for i, own in words.items() for w in own}
    assert {(r["term"], r["id"], r["tf"], r["len"]) for r in found.collect()} == want and found.count() == len(want)
