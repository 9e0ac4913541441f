"""Retrieval: cosine top-k, an approximate index for it, an inverted index with BM25, and two-stage search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.batches import ends, sizes_of
from millrace.functions.text import words
from millrace.session import work_path

STOP_WORDS = "a an and are as at be but by for from has have in into is it its not of on or that the their then there these they this to was were which will with".split()
K1, B = 1.2, 0.75
#: Words that a step of an index holds at a time.
STEP_WORDS = 1 << 18


def as_doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in doubles; null for a vector of zeros or of another width."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (n > 0), dot(a, b) / n)


def vector_topk(vectors: DataFrame, query: list[float], k: int = 10, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest of one query vector: a scan and a bounded heap in every task."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.where(F.col(vector_col).isNotNull()).select(id_col, F.round(cosine(F.col(vector_col), q), 6).alias("score")).where("score IS NOT NULL").orderBy(F.desc("score"), id_col).limit(k)


#: Bytes of vectors that slices() holds back to fill the matrices of its lists.
HELD_BYTES = 32 << 20
#: Rows that best_of() holds before it leaves each query its best ones.
HELD_ROWS = 1 << 20
#: Pairs of matrices of an Arrow batch.
ARROW_ROWS, PAIRS = "spark.sql.execution.arrow.maxRecordsPerBatch", 8


def slices(vectors: DataFrame, id_col: str, vector_col: str, lists=None, rows: int = 4096) -> DataFrame:
    """(list, width, ids, matrix): vectors in groups of one list and width and up to so many rows, their values as bytes of doubles.

    lists: a function from a matrix to (row, list) pairs, which may name a row several times; without one all are in list 0.
    Vectors of a list are held until they fill a matrix, up to HELD_BYTES for all lists of a task: small matrices would meet in many more pairs.
    """

    def run(batches):
        held, size = {}, 0

        def full(name, width, parts):
            ids, matrix = np.concatenate([i for i, _ in parts]), np.concatenate([m for _, m in parts])
            for at in range(0, len(ids), rows):
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), pa.array([width], pa.int32()), pa.array([ids[at : at + rows].tolist()], pa.list_(pa.int64())), pa.array([matrix[at : at + rows].tobytes()], pa.binary())], names=["list", "width", "ids", "matrix"])

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                vector, ids = part.column(1).combine_chunks() if isinstance(part.column(1), pa.ChunkedArray) else part.column(1), np.array(part.column(0).to_pylist(), object)
                widths = np.diff(vector.offsets.to_numpy())
                values = np.asarray(vector.flatten(), dtype=np.float64)
                starts = np.cumsum(widths) - widths
                for width in np.unique(widths[widths > 0]).tolist():
                    own = np.flatnonzero(widths == width)
                    matrix = values[starts[own][:, None] + np.arange(width)]
                    row, of = lists(matrix) if lists else (np.arange(len(own)), np.zeros(len(own), np.int64))
                    for name in np.unique(of).tolist():
                        some = row[of == name]
                        group = held.setdefault((name, width), [])
                        group.append((ids[own[some]], matrix[some]))
                        size += matrix[some].nbytes
                        if sum(len(i) for i, _ in group) >= rows:
                            ids_of, values_of = np.concatenate([i for i, _ in group]), np.concatenate([m for _, m in group])
                            yield from full(name, width, [(ids_of[:rows], values_of[:rows])])
                            held[name, width] = [(ids_of[rows:], values_of[rows:].copy())]
                            size -= values_of[:rows].nbytes
                        elif size > HELD_BYTES:
                            for (n, w), parts in held.items():
                                yield from full(n, w, parts)
                            held, size = {}, 0
        for (n, w), parts in held.items():
            yield from full(n, w, parts)

    return vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")).mapInArrow(run, "list int, width int, ids array<long>, matrix binary")


def best_rows(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of each query with the k largest scores, ties by id."""
    order = np.lexsort((ids, -scores, query))
    at, new = np.arange(len(order)), np.append(True, query[order][1:] != query[order][:-1])[: len(order)]
    order = order[at - np.maximum.accumulate(np.where(new, at, 0)) < k]
    return query[order], ids[order], scores[order]


def best_of(pairs: DataFrame, k: int) -> DataFrame:
    """query_id, id, score, rank: the best k of every query over rows of (width, ids, matrix, query_ids, queries).

    A task keeps the best k of its queries over all its rows, so what is moved and sorted grows with the queries and not with the
    meetings; a task with so many queries that they fill HELD_ROWS gives what it has and goes on. Rows are matrices, so few of
    them make an Arrow batch: the rows found are written here, under that setting.
    """

    def run(batches):
        held, size = [], 0

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.float64())], names=["query_id", "id", "score"])

        def best():
            return best_rows(*(np.concatenate(c) for c in zip(*held)), k)

        for batch in batches:
            for width, ids, matrix, query_ids, queries in zip(*(batch.column(c).to_pylist() for c in ("width", "ids", "matrix", "query_ids", "queries"))):
                v, q = (np.frombuffer(x, np.float64).reshape(-1, width) for x in (matrix, queries))
                nv, nq = np.linalg.norm(v, axis=1), np.linalg.norm(q, axis=1)
                use = np.flatnonzero(nv > 0)
                names = np.array(ids)[use]
                for row in np.flatnonzero(nq > 0) if len(use) else ():
                    score = np.round(v[use] @ q[row] / (nv[use] * nq[row]), 6)
                    near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k]) if len(score) > k else np.arange(len(score))
                    near = near[np.lexsort((names[near], -score[near]))][:k]
                    held.append((np.full(len(near), query_ids[row]), names[near], score[near]))
                    size += len(near)
                if size > HELD_ROWS:
                    held = [best()]
                    size = len(held[0][0])
                    if 2 * size > HELD_ROWS:
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(best())

    spark, path = pairs.sparkSession, work_path(pairs.sparkSession, "nearest")
    found = pairs.select("width", "ids", "matrix", "query_ids", "queries").mapInArrow(run, "query_id long, id long, score double")
    was = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(PAIRS))
    try:
        found.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, was)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return spark.read.schema(found.schema).parquet(path).withColumn("rank", rank).where(F.col("rank") <= k)


def query_blocks(queries: DataFrame, lists=None) -> DataFrame:
    return slices(queries, "query_id", "query", lists, 1024).withColumnsRenamed({"ids": "query_ids", "matrix": "queries"})


def vector_topk_many(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """query_id, id, score, rank: the exact k nearest of each query of a stated set (query_id, query).

    Both sides are cut into matrices of bounded size; every block of queries meets every slice of vectors, and only the
    best k of each meeting go on. Nothing is collected, and Spark copies the blocks to all tasks only where it knows them
    to be small.
    """
    return best_of(slices(vectors, id_col, vector_col).crossJoin(query_blocks(queries).drop("list").withColumnRenamed("width", "w")).where("width = w"), k)


def unit(matrix: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(n > 0, n, 1)


def list_centres(vectors: DataFrame, lists: int = 100, sample: int = 20_000, rounds: int = 8, id_col: str = "id", vector_col: str = "embedding") -> np.ndarray:
    """Centres of the lists of an index, by k-means on directions. Fitted on at most `sample` vectors, those with the least hashes of their ids."""
    some = vectors.where(F.col(vector_col).isNotNull()).select(F.col(vector_col).cast("array<double>").alias("v")).orderBy(F.xxhash64(id_col), id_col).limit(sample).collect()
    if not some:
        return np.zeros((1, 1))
    width = max(len(r["v"]) for r in some)
    x = unit(np.array([r["v"] for r in some if len(r["v"]) == width]))
    draw = np.random.default_rng(7)
    centres = x[draw.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        of = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = unit(np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, sums, centres))
    return centres


def nearest_lists(centres: np.ndarray, probes: int):
    def run(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if matrix.shape[1] != centres.shape[1]:  # vectors of another width: a list of their own
            return np.arange(len(matrix)), np.full(len(matrix), -1)
        near = np.argsort(-(unit(matrix) @ centres.T), axis=1, kind="stable")[:, :probes]
        return np.repeat(np.arange(len(matrix)), near.shape[1]), near.ravel()

    return run


def ann_index(vectors: DataFrame, centres: np.ndarray, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """An inverted-list index: every vector once, in the list of its nearest centre, as matrices of one list."""
    return slices(vectors, id_col, vector_col, nearest_lists(centres, 1))


def ann_topk(index: DataFrame, queries: DataFrame, centres: np.ndarray, k: int = 10, probes: int = 50) -> DataFrame:
    """query_id, id, score, rank: the k nearest of each query (query_id, query) in its `probes` nearest lists. Vectors without any structure need half of the lists for a recall of 0.9."""
    blocks = query_blocks(queries, nearest_lists(centres, probes)).withColumnRenamed("width", "w")
    return best_of(probed(index, blocks).join(blocks, "list").where("width = w"), k)


def probed(index: DataFrame, blocks: DataFrame) -> DataFrame:
    """The lists that queries ask for: of an index stored with a folder a list, no other folder is opened. There are as many names as centres at most."""
    return index.where(F.col("list").isin([r["list"] for r in blocks.select("list").distinct().collect()]))


def terms(text: Column, stem: bool = False) -> Column:
    """Words in lower case, without marks and stop words; with stem, their English stems."""
    found = F.filter(words(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", " ")), lambda w: ~w.isin(*STOP_WORDS))
    return stems(found) if stem else found


def stems(lists: Column) -> Column:
    """The English stems of lists of words; each word is looked up once a task."""
    from millrace.functions.stem import stem

    @F.arrow_udf("array<string>")
    def run(given: pa.Array) -> pa.Array:
        if isinstance(given, pa.ChunkedArray):
            given = given.combine_chunks()
        known = given.flatten().dictionary_encode()
        each = pa.array([stem(w) for w in known.dictionary.to_pylist()], pa.string())
        return pa.ListArray.from_arrays(given.offsets, each.take(known.indices), mask=given.is_null() if given.null_count else None) if given.offset == 0 else pa.array([None if x is None else [stem(w) for w in x] for x in given.to_pylist()], pa.list_(pa.string()))

    return run(lists)


def inverted_index(docs: DataFrame, id_col: str = "id", text_col: str = "text", stem: bool = False) -> DataFrame:
    """term, id, tf, len: the postings, to be stored sorted by term.

    Words are counted within their text, so only one row a term and text is made and nothing is shuffled. One Python worker a task
    stems and counts, in steps of bounded size.
    """
    each = docs.select(id_col, terms(F.coalesce(F.col(text_col), F.lit(""))).alias("terms"))

    def count(batches):
        from millrace.functions.stem import stem as stem_of

        for batch in batches:
            ids, lists = batch.column(0), batch.column("terms")
            for a, b in ends(sizes_of(lists), STEP_WORDS):
                part = lists.slice(a, b - a)
                sizes = np.diff(part.offsets.to_numpy())
                known = part.flatten().dictionary_encode()
                names, code = known.dictionary, np.asarray(known.indices, np.int64)
                if stem:
                    known = pa.array([stem_of(w) for w in names.to_pylist()], pa.string()).dictionary_encode()
                    names, code = known.dictionary, np.asarray(known.indices, np.int64)[code]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                found, tf = np.unique(owner * max(1, len(names)) + code, return_counts=True)
                owner, code = found // max(1, len(names)), found % max(1, len(names))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(code, pa.int64())), ids.take(pa.array(owner + a, pa.int64())), pa.array(sizes[owner], pa.int32()), pa.array(tf, pa.int64())], names=["term", id_col, "len", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    return each.mapInArrow(count, f"term string, `{id_col}` {kind}, len int, tf long")


def bm25_topk(postings: DataFrame, n_docs: int | Column, mean_len: float | Column, query: list[str], k: int = 10, id_col: str = "id") -> DataFrame:
    """The k best documents for the terms of a query. n_docs and mean_len are those of the whole collection."""
    hits = postings.where(F.col("term").isin(*query))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    n, mean = (F.lit(n_docs) if not isinstance(n_docs, Column) else n_docs).cast("double"), F.lit(mean_len) if not isinstance(mean_len, Column) else mean_len
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    return hits.join(df, "term").groupBy(id_col).agg(F.round(F.sum(weight), 6).alias("score")).orderBy(F.desc("score"), id_col).limit(k)


def keyword_scan(docs: DataFrame, query: list[str], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Documents with all terms of a query, by reading every text: what the index saves. Only texts that hold the terms as strings are cut into words."""
    found, low = terms(F.coalesce(F.col(text_col), F.lit(""))), F.lower(F.col(text_col))
    cond = F.lit(True)
    for q in query:
        cond = cond & F.contains(low, F.lit(q))
    for q in query:
        cond = cond & F.array_contains(found, q)
    return docs.where(cond).select(id_col)


def keyword_lookup(postings: DataFrame, query: list[str], id_col: str = "id") -> DataFrame:
    """The same from stored postings: the rows of the query's terms only."""
    wanted = sorted(set(query))
    return postings.where(F.col("term").isin(*wanted)).groupBy(id_col).agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select(id_col)


def two_stage(summaries: DataFrame, chunks: DataFrame, query: list[float], documents: int = 10, k: int = 10, item_col: str = "parent_item_id", id_col: str = "id") -> DataFrame:
    """The best chunks of the documents whose summaries are nearest."""
    near = vector_topk(summaries, query, documents, item_col).select(item_col)
    return vector_topk(chunks.join(near, item_col, "left_semi"), query, k, id_col)


def outdated(rows: DataFrame, version: str) -> DataFrame:
    """Rows whose vector another schema version made."""
    return rows.where("embedding IS NOT NULL").where(~F.col("embedding_schema_version").eqNullSafe(F.lit(version)))


def embed(rows: DataFrame, text_col: str, model, version: str, model_name: str, as_of: Column) -> DataFrame:
    """Rows with vectors of a model: a function from a list of texts to a list of lists of floats, called on Arrow batches."""
    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        given = texts.to_pylist()
        return pa.array(model([t or "" for t in given]), pa.list_(pa.float32()))

    return rows.withColumns({"embedding": run(F.col(text_col)), "embedding_model": F.lit(model_name), "embedding_schema_version": F.lit(version), "embedded_at": as_of})


def write_back(items: DataFrame, vectors: DataFrame, id_col: str = "id") -> DataFrame:
    """Items with the vectors that a pass has made, by id; the others stay as they are."""
    names = [c for c in ("embedding", "embedding_model", "embedding_schema_version", "embedded_at") if c in items.columns and c in vectors.columns]
    new = vectors.select(id_col, *(F.col(c).alias(f"__{c}") for c in names), F.lit(True).alias("__hit"))
    return items.join(new, id_col, "left").withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in names}).select(*items.columns)


def store_index(postings: DataFrame, path: str) -> DataFrame:
    """Postings clustered by term and written, so that a query reads the row groups of its terms; what was written is returned."""
    postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").option("parquet.block.size", str(4 << 20)).parquet(path)
    return postings.sparkSession.read.schema(postings.schema).parquet(path)


class TextIndex:
    """Stored postings of a collection with the two figures that ranking needs: the number of texts and their mean length."""

    def __init__(self, docs: DataFrame, path: str, id_col: str = "id", text_col: str = "text", stem: bool = False):
        self.id_col, self.stem = id_col, stem
        self.postings = store_index(inverted_index(docs, id_col, text_col, stem), path)
        self.n_docs = docs.count()
        self.mean_len = (self.postings.agg(F.sum("tf").alias("n")).first()["n"] or 0) / max(1, self.n_docs)

    def terms(self, query: list[str]) -> list[str]:
        from millrace.functions.stem import stem

        low = [q.lower() for q in query]
        return [stem(q) for q in low] if self.stem else low

    def topk(self, query: list[str], k: int = 10) -> DataFrame:
        return bm25_topk(self.postings, self.n_docs, self.mean_len, self.terms(query), k, self.id_col)

    def lookup(self, query: list[str]) -> DataFrame:
        return keyword_lookup(self.postings, self.terms(query), self.id_col)
