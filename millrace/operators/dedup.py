"""Near-duplicate items by the overlap of their most frequent three-word runs.

An item's fingerprint is its 50 most frequent runs, ties by first appearance. Its candidates are earlier items that
have one of its ten most frequent runs; the least of those whose fingerprints overlap by more than 0.7 (Jaccard) is
named as its original. Duplicates are linked, never dropped.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.batches import ends, sizes_of, steps

MOST, SAMPLE, LEAST, OVER, SHORTEST = 50, 10, 10, 0.70, 100
OTHER = re.compile(r"[^a-z0-9\s]")


def frequent_runs(text: str | None, n: int = 3, most: int = MOST) -> list[str] | None:
    """The most frequent runs of n words of a text, ties by first appearance; null for one under SHORTEST characters."""
    if text is None or len(text) < SHORTEST:
        return None
    words = OTHER.sub("", text.lower()).split()
    return [" ".join(run) for run, _ in Counter(zip(*(words[k:] for k in range(n)))).most_common(most)]


def fingerprint(text: Column) -> Column:
    """frequent_runs() as a column: all counting stays within the row, so no run is ever shuffled."""

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([frequent_runs(t) for t in part.to_pylist()], pa.list_(pa.string())) for part in steps(texts)])

    return run(text)


def fingerprints(items: DataFrame, key: str = "id", body: str = "content_body") -> DataFrame:
    """key, fingerprint (array, most frequent first) for items with at least 100 characters and one run.

    One pass of one Python worker a task, in steps of bounded size: as a column, the condition would count all runs twice.
    """

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in ends(sizes_of(texts)):
                runs = [frequent_runs(t) for t in texts.slice(a, b - a).to_pylist()]
                some = [k for k, r in enumerate(runs) if r]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array([a + k for k in some], pa.int64())), pa.array([runs[k] for k in some], pa.list_(pa.string()))], names=[key, "fingerprint"])

    given = items.select(key, F.col(body).cast("string"))
    return given.mapInArrow(run, f"`{key}` {given.schema[key].dataType.simpleString()}, fingerprint array<string>")


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def near_duplicates(prints: DataFrame, key: str = "id") -> DataFrame:
    """key, original, for every item that has an earlier near-duplicate. prints: what fingerprints() returns.

    Items with the same fingerprint are one group, so copies make no pairs. Two fingerprints that overlap by more than
    0.7 have seven tenths of the larger in common: each has one of the common runs among its rarest three tenths and one.
    Groups meet on those runs only (64-bit hashes, rarest first, sizes compared in the join), so a run that very many
    items share brings none of them together; that finds every pair, and each is then held to the full rule.
    """
    hashed = prints.select(key, F.transform("fingerprint", lambda r: F.xxhash64(r)).alias("runs"))
    named = hashed.withColumn("print", F.sha2(F.array_join("runs", ",").cast("binary"), 256))
    groups = named.groupBy("print").agg(F.min(key).alias("least"), F.first("runs").alias("runs"))
    entries = groups.select("print", F.size("runs").alias("n"), F.explode("runs").alias("run"))
    often = entries.groupBy("run").agg(F.count("*").alias("often")).where("often > 1")
    # runs of one group bring nobody together, but they come first among the rare ones
    ordered = entries.join(often, "run", "left").groupBy("print", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "run"))).alias("by"))
    rare = ordered.select("print", "n", F.explode(F.slice("by", F.lit(1), F.col("n") - F.ceil(F.col("n") * OVER).cast("int") + 1)).alias("at")).where("at.often > 1").select("print", "n", F.col("at.run").alias("run"))
    other = rare.toDF("other", "m", "run")
    pairs = rare.join(other, "run").where((F.col("print") != F.col("other")) & (F.least("n", "m") > F.lit(OVER) * F.greatest("n", "m"))).select("print", "other").distinct()
    full = pairs.join(groups.select("print", "runs"), "print").join(groups.select(F.col("print").alias("other"), F.col("least").alias("other_least"), F.col("runs").alias("other_runs")), "other")
    good = full.where((F.size("runs") >= LEAST) & F.arrays_overlap(F.slice("runs", 1, SAMPLE), "other_runs") & (overlap(F.col("runs"), F.col("other_runs")) > OVER))
    best = good.select("print", F.col("other_least").alias("original")).union(groups.where(F.size("runs") >= LEAST).select("print", "least")).groupBy("print").agg(F.min("original").alias("original"))
    return named.select(key, "print").join(best, "print").where(F.col("original") < F.col(key)).select(key, "original")
