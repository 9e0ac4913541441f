"""Merges move their rows once."""

from pyspark.sql import functions as F

from millrace.operators import merge


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merges_move_items_once(spark):
    kind = "id long, url string, title string, content_body string, doi string"
    stored = spark.createDataFrame([(1, "a", "A", "old", "10/1"), (2, "b", "B", None, None)], kind)
    new = spark.createDataFrame([(0, "a", "A2", "new", None), (1, "c", "C", "x", "10/1"), (2, "d", "D", "y", "10/2"), (3, "e", "E", "z", None)], "seq long, url string, title string, content_body string, doi string")
    deal = ("__bucket", F.pmod(F.xxhash64("url"), F.lit(3)).cast("int"))
    plain, dealt = merge.merge_items(stored, new), merge.merge_items(stored, new, deal=deal)
    assert sorted(map(tuple, plain.collect()), key=lambda r: r[1]) == [(1, "a", "A", "new", "10/1"), (2, "b", "B", None, None), (None, "d", "D", "y", "10/2"), (None, "e", "E", "z", None)]
    assert sorted(map(tuple, dealt.drop("__bucket").collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    bare = merge.merge_items(stored, new.drop("doi"), deal=deal)
    assert plan(bare).count("Exchange ") == 1 and "Join" not in plan(bare)
