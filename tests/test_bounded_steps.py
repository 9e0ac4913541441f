"""Python workers hold a bounded number of bytes at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.functions.batches import ends, sizes_of, steps
from millrace.operators import dedup, link_index


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_steps():
    assert list(ends(np.array([3, 3, 9, 1, 0]), 6)) == [(0, 2), (2, 3), (3, 5)] and list(ends(np.array([], np.int64))) == []
    texts = pa.array(["abc", None, "x" * 50, ""])
    assert sizes_of(texts).tolist() == [3, 0, 50, 0] and sizes_of(pa.array([[1, 2], None, []])).tolist() == [2, 0, 0]
    assert [p.to_pylist() for p in steps(texts, 10)] == [["abc", None], ["x" * 50], [""]] and [len(p) for p in steps(texts.slice(4))] == [0]


def test_fingerprints_in_one_pass(spark, monkeypatch):
    texts = [" ".join(f"w{(i * k) % 23}" for k in range(60)) for i in range(30)] + [None, "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, content_body string")
    found = dedup.fingerprints(df)
    assert plan(found).count("MapInArrow") == 1 and "ArrowEvalPython" not in plan(found)
    assert {r["id"]: r["fingerprint"] for r in found.collect()} == {i: p for i, t in enumerate(texts) if (p := dedup.frequent_runs(t))}
    groups = found.select(F.sha2(F.array_join("fingerprint", ","), 256).alias("print"), F.transform("fingerprint", lambda r: F.xxhash64(r)).alias("runs")).distinct()
    rarity = np.arange(1 << link_index.BITS)
    monkeypatch.setattr(link_index, "STEP_RUNS", 40)
    want = set()
    for r in groups.collect():
        own = np.array(r["runs"], np.int64)
        first = own[np.lexsort((own, rarity[link_index.bins_of(own)]))[: len(own) - int(np.ceil(0.7 * len(own) - 1e-9)) + 1]]
        want |= {(int(x), r["print"], len(own)) for x in first}
    assert {tuple(r) for r in link_index.rare_runs(groups, rarity).collect()} == want
