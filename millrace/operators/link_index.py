"""Links between near-duplicate items, kept up batch by batch: the same links as dedup.near_duplicates over all items.

Stored are groups of items with one fingerprint, by fingerprint, and of each group the first three tenths and one of its
runs, by run, in hashed buckets (see sources.buckets). Two fingerprints that overlap by more than 0.7 share one of these
runs in whatever order runs are taken, as long as it never changes; here rare ones come first, as counted in a fixed
number of bins when the index began. A batch reads the buckets of its own runs and fingerprints, and of those it is linked
to; the least key of a group only ever falls, so an original is the least of what was known and what the batch adds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.batches import ends, sizes_of
from millrace.operators.dedup import LEAST, OVER, SAMPLE, overlap
from millrace.session import work_path
from millrace.sources.buckets import BucketStore

GROUPS = "print string, n int, least long, original long, runs array<long>"
RUNS = "run long, print string, n int"
ITEMS = "key long, print string"
RARITY = "bin int, often long"
BITS = 18
#: Runs that a step holds at a time.
STEP_RUNS = 1 << 16


def bins_of(runs: np.ndarray) -> np.ndarray:
    return ((runs.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def rare_runs(groups: DataFrame, rarity: np.ndarray) -> DataFrame:
    """run, print, n: of every group (print, n, runs) the first three tenths and one of its runs, rarest first."""

    def make(batches):
        for batch in batches:
            lists = batch.column("runs")
            for a, b in ends(sizes_of(lists), STEP_RUNS):
                names, sizes = batch.column("print").slice(a, b - a), []
                parts = []
                for runs in lists.slice(a, b - a):
                    own = np.asarray(runs.values, np.int64)
                    order = np.lexsort((own, rarity[bins_of(own)]))
                    parts.append(own[order[: len(own) - int(np.ceil(OVER * len(own) - 1e-9)) + 1]])
                    sizes.append(len(own))
                counts = [len(x) for x in parts]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts), pa.int64()), names.take(pa.array(np.repeat(np.arange(len(parts)), counts))), pa.array(np.repeat(sizes, counts), pa.int32())], names=["run", "print", "n"])

    return groups.select("print", "runs").mapInArrow(make, RUNS)


def count_runs(groups: DataFrame) -> DataFrame:
    """bin, often: how often the runs of a bin occur; 2 ** BITS rows at most."""

    def make(batches):
        counts = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            counts += np.bincount(bins_of(np.asarray(batch.column("runs").flatten(), np.int64)), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["bin", "often"])

    return groups.select("runs").mapInArrow(make, RARITY).groupBy("bin").agg(F.sum("often").alias("often"))


def near(pairs: DataFrame, groups: DataFrame, others: DataFrame) -> DataFrame:
    """print, other, and whether each is near the other by the full rule; groups and others have print, n, least, runs."""
    a = groups.select("print", "n", "least", "runs")
    b = others.select(F.col("print").alias("other"), F.col("n").alias("m"), F.col("least").alias("other_least"), F.col("runs").alias("other_runs"))
    full = pairs.join(a, "print").join(b, "other").where(overlap(F.col("runs"), F.col("other_runs")) > OVER)
    says = lambda size, own, them: (F.col(size) >= LEAST) & F.arrays_overlap(F.slice(own, 1, SAMPLE), them)
    return full.select("print", "other", "least", "other_least", says("n", "runs", "other_runs").alias("links"), says("m", "other_runs", "runs").alias("linked"))


class LinkIndex(BucketStore):
    """The index under a path. add() takes fingerprints (key, fingerprint) of new items; links() gives what near_duplicates would."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, keep: int = 2):
        super().__init__(spark, path, {"groups": (GROUPS, "print"), "runs": (RUNS, "run"), "items": (ITEMS, "print"), "rarity": (RARITY, "bin")}, buckets, keep)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """df, computed once into the shared folder."""
        path = work_path(self.spark, f"links-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add(self, prints: DataFrame, batch: int, key: str = "id") -> bool:
        """New items into the index. Whether the batch was new: one that comes again changes nothing. An item that comes again with
        another text is in two groups; callers give each item once."""
        if batch <= self.manifest()["batch"]:
            return False
        hashed = prints.select(F.col(key).cast("long").alias("key"), F.transform("fingerprint", lambda r: F.xxhash64(r)).alias("runs"))
        rows = self.written(hashed.withColumn("print", F.sha2(F.array_join("runs", ",").cast("binary"), 256)), "rows")
        fresh = self.written(rows.groupBy("print").agg(F.min("key").alias("least"), F.first("runs").alias("runs")).withColumn("n", F.size("runs")), "fresh")
        first = not self.manifest()["tables"].get("rarity")
        changes = {}
        if first:
            changes["rarity"] = (self.write_folder("rarity", count_runs(fresh), batch), None)
            counted = self.spark.read.schema(RARITY).parquet(f"{self.path}/{changes['rarity'][0]}").toArrow()
        else:
            counted = self.read("rarity").toArrow()
        rarity = np.zeros(1 << BITS, np.int64)
        rarity[counted.column("bin").to_numpy()] = counted.column("often").to_numpy()

        touched = self.touched(groups=(fresh, "print"))["groups"]
        stored = self.read("groups", touched)
        known = stored.select("print", F.col("least").alias("was"))
        changed = fresh.join(known, "print", "left").where(F.col("was").isNull() | (F.col("least") < F.col("was")))
        changed = self.written(changed.withColumn("is_new", F.col("was").isNull()).drop("was"), "changed")
        entries = self.written(rare_runs(changed, rarity).join(changed.select("print", "is_new"), "print"), "entries")
        run_buckets = self.touched(runs=(entries, "run"))["runs"]
        runs = self.read("runs", run_buckets)
        added = entries.where("is_new").select("run", "print", "n")
        there = runs.unionByName(added)
        pairs = entries.select("run", "print", "n").join(there.toDF("run", "other", "m"), "run").where(F.col("print") != F.col("other"))
        pairs = pairs.where(F.least("n", "m") > F.lit(OVER) * F.greatest("n", "m")).select("print", "other").distinct()
        pairs = self.written(pairs, "pairs")

        # the groups of all ends, as they are after this batch
        others = self.touched(groups=(pairs, "other"))["groups"]
        both = sorted(set(touched) | set(others))
        stored = self.read("groups", both)
        now = fresh.select("print", F.col("least").alias("new_least"), F.col("n").alias("new_n"), F.col("runs").alias("new_runs"))
        merged = stored.join(now, "print", "full").select(
            "print", F.coalesce("n", "new_n").alias("n"), F.least("least", "new_least").alias("least"), "original", F.coalesce("runs", "new_runs").alias("runs"),
        )
        merged = self.written(merged, "groups")
        found = self.written(near(pairs, merged, merged), "near")
        offers = found.where("links").select("print", F.col("other_least").alias("offer")).union(found.where("linked").select(F.col("other").alias("print"), F.col("least").alias("offer")))
        offers = offers.groupBy("print").agg(F.min("offer").alias("offer"))
        best = F.when(F.col("n") >= LEAST, F.least("original", "offer", "least"))
        groups = merged.join(offers, "print", "left").select("print", "n", "least", best.alias("original"), "runs")

        changes["groups"] = (self.write_folder("groups", groups, batch), both)
        new_runs = self.touched(runs=(added, "run"))["runs"]
        changes["runs"] = (self.write_folder("runs", self.read("runs", new_runs).unionByName(added), batch), new_runs)
        items = self.read("items", touched).unionByName(rows.select("key", "print"))
        changes["items"] = (self.write_folder("items", items, batch), touched)
        return self.commit(batch, changes)

    def links(self) -> DataFrame:
        """key, original, for every item that has an earlier near-duplicate."""
        best = self.read("groups").where("original IS NOT NULL").select("print", "original")
        return self.read("items").join(best, "print").where(F.col("original") < F.col("key")).select("key", "original")
