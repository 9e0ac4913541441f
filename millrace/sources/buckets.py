"""Tables in hashed buckets: a batch reads and rewrites the buckets that its keys fall into, and no others.

A store holds several tables, each dealt into the same number of buckets by a hash of its key. What is current is said by
one manifest, which names a folder for every bucket that has rows; the next manifest takes over what a batch did not
touch. A manifest is written under another name and renamed to its number, so all tables of a batch change in one step,
and a writer that dies at any point leaves the store as it was. Folders that no kept manifest names are removed by
expire().
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.merge import merge_items
from millrace.schemas import ITEMS
from millrace.sources.sinks import hadoop

BUCKET = "__bucket"
#: Files of a bucket get at most this many rows, so a large bucket is written by few tasks' worth of memory.
FILE_ROWS = 2_000_000


class BucketStore:
    """tables: name to (schema, key column). buckets: their number, which the first manifest fixes; so many that one is read
    and written in a minute or so. keep: manifests that expire() leaves, for readers that still use an older one."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, tuple], buckets: int = 256, keep: int = 2):
        self.spark, self.path, self.keep, self.new_buckets = spark, path.rstrip("/"), keep, buckets
        empty = {name: spark.createDataFrame([], schema) for name, (schema, _) in tables.items()}
        self.schemas, self.keys = {n: df.schema for n, df in empty.items()}, {n: key for n, (_, key) in tables.items()}

    # --- what is there

    def numbers(self) -> list[int]:
        """The batches that have a manifest, in order."""
        fs, folder = hadoop(self.spark, f"{self.path}/manifests")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[6:-5]) for n in names if n.startswith("batch-"))

    def manifest(self, number: int | None = None) -> dict:
        """batch, buckets and, for each table, the folder of every bucket that has rows; the latest one if no number is given."""
        have = self.numbers()
        if not have:
            return {"batch": -1, "buckets": self.new_buckets, "tables": {n: {} for n in self.schemas}}
        at = f"{self.path}/manifests/batch-{have[-1] if number is None else number:012d}.json"
        return json.loads(self.spark.read.text(at, wholetext=True).first()["value"])

    def bucket(self, key: Column | str, buckets: int) -> Column:
        """The bucket of a key; a null key's is that of its hash too."""
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def read(self, name: str, only: Iterable[int] | None = None, number: int | None = None) -> DataFrame:
        """A table as the latest manifest (or that of a number) has it; with only, these buckets alone are opened."""
        folders = self.manifest(number)["tables"].get(name, {})
        wanted = folders.values() if only is None else [folders[str(b)] for b in only if str(b) in folders]
        if not wanted:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*(f"{self.path}/{f}" for f in sorted(wanted)))

    def touched(self, **keys: tuple[DataFrame, str]) -> dict[str, list[int]]:
        """For each table the buckets that the keys of a column fall into; nulls have none. One pass for the columns of one DataFrame."""
        buckets, out = self.manifest()["buckets"], {}
        by_frame: dict[int, tuple[DataFrame, list]] = {}
        for name, (df, column) in keys.items():
            by_frame.setdefault(id(df), (df, []))[1].append((name, column))
        for df, columns in by_frame.values():
            sets = (F.collect_set(F.when(F.col(c).isNotNull(), self.bucket(c, buckets))).alias(n) for n, c in columns)
            row = df.agg(*sets).first()
            out |= {n: sorted(row[n]) for n, _ in columns}
        return out

    # --- what changes

    def write_folder(self, name: str, rows: DataFrame, batch: int) -> str:
        """rows, dealt to their buckets, in a folder of this attempt; its name. Rows that have a column of their bucket lie by it already."""
        buckets = self.manifest()["buckets"]
        folder = f"data/v{batch:012d}-{uuid.uuid4().hex[:8]}/{name}"
        dealt = rows if BUCKET in rows.columns else rows.withColumn(BUCKET, self.bucket(self.keys[name], buckets)).repartition(BUCKET)
        dealt.write.partitionBy(BUCKET).option("maxRecordsPerFile", FILE_ROWS).parquet(f"{self.path}/{folder}")
        return folder

    def buckets_in(self, folder: str) -> dict[str, str]:
        """bucket: folder, for what write_folder() has written."""
        fs, p = hadoop(self.spark, f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return {n.partition("=")[2]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def commit(self, batch: int, changes: dict[str, tuple[str, list[int] | None]]) -> bool:
        """Makes folders current: changes has for a table the folder and the buckets it stands for (None: all). Whether this batch
        was the first of its number to be committed."""
        last = self.manifest()
        if batch <= last["batch"]:
            return False
        tables = {n: dict(folders) for n, folders in last["tables"].items()}
        for name, (folder, only) in changes.items():
            have = self.buckets_in(folder)
            gone = tables.get(name, {}) if only is None else map(str, only)
            tables[name] = {b: f for b, f in tables.get(name, {}).items() if b not in set(gone)} | have
        fs, temp = hadoop(self.spark, f"{self.path}/manifests/.next-{uuid.uuid4().hex}")
        out = fs.create(temp)
        out.write(bytearray(json.dumps({"batch": batch, "buckets": last["buckets"], "tables": tables}).encode()))
        out.close()
        return self.publish(fs, temp, batch)

    def publish(self, fs, temp, batch: int) -> bool:
        _, to = hadoop(self.spark, f"{self.path}/manifests/batch-{batch:012d}.json")
        return not fs.exists(to) and bool(fs.rename(temp, to))

    def replace(self, batch: int, **tables: DataFrame) -> bool:
        """Whole tables in place of what is there."""
        if batch <= self.manifest()["batch"]:
            return False
        return self.commit(batch, {name: (self.write_folder(name, rows, batch), None) for name, rows in tables.items()})

    def expire(self) -> list[str]:
        """Removes all manifests but the last `keep`, and the folders of earlier batches that these don't name: buckets written
        anew since, and what writers that died have left. Returns what is gone."""
        have = self.numbers()
        kept = have[-self.keep :]
        if not kept:
            return []
        fs, data = hadoop(self.spark, f"{self.path}/data")
        used = {f for n in kept for folders in self.manifest(n)["tables"].values() for f in folders.values()}
        gone = []
        for number in have[: -self.keep]:  # first, so no reader starts on what goes next
            fs.delete(hadoop(self.spark, f"{self.path}/manifests/batch-{number:012d}.json")[1], False)
        for attempt in fs.listStatus(data) if fs.exists(data) else []:
            name = attempt.getPath().getName()
            if int(name[1:13]) > kept[0]:
                continue  # a writer may still be at work on it
            left = False
            for table in fs.listStatus(attempt.getPath()):
                for part in fs.listStatus(table.getPath()):
                    path = f"data/{name}/{table.getPath().getName()}/{part.getPath().getName()}"
                    if path in used:
                        left = True
                    elif part.isDirectory():
                        fs.delete(part.getPath(), True)
                        gone.append(path)
            if not left:
                fs.delete(attempt.getPath(), True)
        return gone


DOIS = "doi string, url string"


class ItemStore(BucketStore):
    """Items by URL, and beside them who has each DOI, by DOI: both rules of the merge look at the buckets of a batch's own keys."""

    def __init__(self, spark: SparkSession, path: str, schema=ITEMS, buckets: int = 256, keep: int = 2):
        super().__init__(spark, path, {"items": (schema, "url"), "dois": (DOIS, "doi")}, buckets, keep)

    def load(self, items: DataFrame, batch: int = 0) -> bool:
        """A whole table of items as the store's first batch, in the form that a merge leaves (tags sorted, marks set), one row a URL."""
        if batch <= self.manifest()["batch"]:
            return False
        nothing = self.spark.createDataFrame([], "seq long, url string")
        items = merge_items(items.where("url IS NOT NULL").select(*self.schemas["items"].names), nothing, deal=self.deal())
        written = self.write_folder("items", items, batch)
        return self.commit(batch, {"items": (written, None), "dois": (self.write_folder("dois", self.dois_of(written), batch), None)})

    def deal(self) -> tuple[str, Column]:
        return BUCKET, self.bucket("url", self.manifest()["buckets"])

    def dois_of(self, written: str) -> DataFrame:
        """doi, url of the items in a folder."""
        return self.spark.read.schema(self.schemas["items"]).parquet(f"{self.path}/{written}").where("doi IS NOT NULL").select("doi", "url")

    def merge(self, incoming: DataFrame, batch: int, seq: str = "seq") -> bool:
        """A batch into the items, by the rules of merge_items. Whether it was new: a batch that comes again changes nothing.

        Rows without URL are no items and are left out.
        """
        if batch <= self.manifest()["batch"]:
            return False
        incoming = incoming.where("url IS NOT NULL")
        has_doi = "doi" in incoming.columns
        touched = self.touched(items=(incoming, "url"), **({"dois": (incoming, "doi")} if has_doi else {}))
        if not touched["items"]:
            return self.commit(batch, {})
        stored, taken = self.read("items", touched["items"]), self.read("dois", touched.get("dois", []))
        written = self.write_folder("items", merge_items(stored, incoming, seq, taken, self.deal()), batch)
        changes = {"items": (written, touched["items"])}
        if touched.get("dois"):
            # DOIs of the batch stand in its buckets; the rows that share the items' buckets by chance have theirs already
            buckets = self.manifest()["buckets"]
            now = self.dois_of(written)
            now = now.where(self.bucket("doi", buckets).isin(touched["dois"]))
            changes["dois"] = (self.write_folder("dois", taken.union(now).distinct(), batch), touched["dois"])
        return self.commit(batch, changes)
