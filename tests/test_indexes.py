"""Indexes that save work: how near their results are to the exact ones, and what they read and compare."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import graph_index, search
from millrace.plans.queries import QUERIES, stated_queries

VECTORS = "/root/testdata/sf0.1"


def test_graph_finds_the_nearest_with_few_distances(spark):
    e = spark.read.parquet(f"{VECTORS}/embeddings.parquet")
    n, queries = e.count(), stated_queries(e)
    exact = {(r["query_id"], r["id"]) for r in search.vector_topk_many(e, queries, 10, "vec_id").collect()}
    got = QUERIES["graph_topk"](spark, VECTORS).collect()
    assert len(exact) == len(got) == 10 * queries.count()
    assert len(exact & {(r["query_id"], r["id"]) for r in got}) >= 0.9 * len(exact)
    distances = {r["query_id"]: r["distances"] for r in got}
    assert sum(distances.values()) <= n * len(distances) / 4
    scores = {(r["query_id"], r["id"]): r["score"] for r in search.vector_topk_many(e, queries, 10, "vec_id").collect()}
    assert all(abs(scores[k] - r["score"]) < 1e-6 for r in got if (k := (r["query_id"], r["id"])) in scores)
    assert all([r["rank"] for r in got if r["query_id"] == q] == list(range(1, 11)) for q in list(distances)[:5])


def test_graph_of_several_parts(spark):
    """Vectors without structure in several parts: what the parts find is put together."""
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=24).tolist()) for i in range(3000)]
    e = spark.createDataFrame(rows, "id long, embedding array<double>")
    index = graph_index.graph_index(e, part_rows=1000)
    assert {r["part"] for r in index.select("part").collect()} == {0, 1, 2}
    queries = e.where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    got = {(r["query_id"], r["id"]) for r in graph_index.graph_topk(index, queries, 10, 40).collect()}
    exact = {(r["query_id"], r["id"]) for r in search.vector_topk_many(e, queries, 10).collect()}
    assert len(got & exact) >= 0.9 * len(exact)
    links = graph_index.adjacency(index).collect()
    assert sorted(r["id"] for r in links if r["level"] == 0) == list(range(3000))
    assert max(r["level"] for r in links) >= 1 and all(r["id"] not in r["neighbours"] for r in links)
    assert max(len(r["neighbours"]) for r in links) <= 2 * graph_index.LINKS + 5


def test_all_vectors_can_be_reached():
    """Two far clusters of equal vectors: links lead from one to the other."""
    x = np.repeat(np.eye(4)[:2], 200, axis=0) + np.random.default_rng(1).normal(scale=1e-4, size=(400, 4))
    offsets, targets = graph_index.level_links(search.unit(x), 4)
    seen, todo = {0}, [0]
    while todo:
        i = todo.pop()
        for t in targets[offsets[i] : offsets[i + 1]]:
            if t not in seen:
                seen.add(int(t))
                todo.append(int(t))
    assert len(seen) == 400


@pytest.mark.parametrize("rows", [[], [(1, [0.0, 0.0]), (2, None)], [(1, [1.0, 0.0])], [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (None, [0.0, 2.0]), (1, [1.0, 0.0])]])
def test_graph_of_odd_tables(spark, rows):
    e = spark.createDataFrame(rows, "id long, embedding array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.1]), (8, [0.0, 0.0])], "query_id long, query array<double>")
    got = [(r["query_id"], r["id"], r["rank"]) for r in graph_index.graph_topk(graph_index.graph_index(e), queries, 3).collect()]
    usable = [i for i, v in rows if v and len(v) == 2 and any(v)]
    assert [g[0] for g in got] == [7] * len(usable) and sorted(map(str, (g[1] for g in got))) == sorted(map(str, usable))


def test_lists_are_folders(spark):
    """The fewer lists a query asks for, the fewer files are opened."""
    from millrace.plans.queries import vector_index

    index, centres = vector_index(spark, "/root/testdata/sf0.01")
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    one = stated_queries(e).limit(1)
    files = []
    for probes in (2, 10, 100):
        blocks = search.query_blocks(one, search.nearest_lists(centres, probes))
        files.append(len(search.probed(index, blocks).select("ids").inputFiles()) if probes == 100 else len(opened(search.probed(index, blocks))))
    assert files[0] <= 2 < files[1] <= 10 < files[2]
    near = search.ann_topk(index, one, centres, 5, probes=10).collect()
    exact = search.vector_topk_many(e, one, 5, "vec_id").collect()
    assert near[0]["id"] == exact[0]["id"] and len(near) == 5


def opened(df):
    """The files that a plan reads after its partitions are chosen."""
    return {r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_queries_of_words_in_capitals(spark, tmp_path):
    docs = spark.createDataFrame([(1, "He sleeps."), (2, "No SLEEP at all")], "id long, text string")
    index = search.TextIndex(docs, str(tmp_path / "t"))
    assert [r["id"] for r in index.topk(["Sleep"]).collect()] == [2] == [r["id"] for r in index.lookup(["SLEEP"]).collect()]


def test_nearest_of_many_meetings(spark):
    """A task gives each of its queries k rows, however many matrices they meet; matrices of a list are filled over batches."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).round(2)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").coalesce(1)
    of = lambda m: (np.arange(len(m)), (m[:, 0] > 0).astype(np.int64))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        index = search.slices(rows, "id", "v", of, 150).cache()
        assert index.count() <= 4  # 20 batches of 2 lists
        small = search.slices(rows, "id", "v", None, 10).coalesce(1)
        queries = search.query_blocks(rows.where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("query"))).drop("list").withColumnRenamed("width", "w")
        found = search.best_of(small.crossJoin(queries).where("width = w").coalesce(1), 5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    score = np.round(x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1), 6)
    want = {(q, int(i), r + 1) for q in range(0, 400, 20) for r, i in enumerate(np.lexsort((np.arange(400), -score[q]))[:5])}
    assert {(r["query_id"], r["id"], r["rank"]) for r in found} == want
    q, i, s = np.repeat([1, 2], 6), np.arange(12), np.tile([0.5, 0.5, 0.9, 0.1, 0.2, 0.3], 2)
    assert [c.tolist() for c in search.best_rows(q, i, s, 2)] == [[1, 1, 2, 2], [2, 0, 8, 6], [0.9, 0.5, 0.9, 0.5]]
