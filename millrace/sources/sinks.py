"""Where results go: snapshots that replace each other whole, catalog appends, log lines."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.records import entry_is_valid
from millrace.functions.urls import domain
from millrace.schemas import CATALOG


def hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Snapshots:
    """A table as numbered folders under one path, each named by a pointer file of its own number.

    A writer writes a folder, then a pointer under another name, and renames that to its number: one step, which takes
    nothing away. Readers take the greatest number. A writer that dies at any point leaves the table as it was. A batch
    number makes a repeated write of the same batch have no effect.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> tuple[str | None, int]:
        fs, p = hadoop(self.spark, f"{self.path}/pointers")
        if not fs.exists(p):
            return None, -1
        named = [n for f in fs.listStatus(p) if (n := f.getPath().getName()).startswith("batch-")]
        if not named:
            return None, -1
        said = json.loads(self.spark.read.text(f"{self.path}/pointers/{max(named)}").first()["value"])
        return said["folder"], said["batch"]

    def read(self, schema) -> DataFrame:
        folder, _ = self.current()
        return self.spark.createDataFrame([], schema) if folder is None else self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def write(self, df: DataFrame, batch: int) -> bool:
        """Whether the batch was new. Of two writers of one batch the first to name its folder wins."""
        _, last = self.current()
        if batch <= last:
            return False
        folder = f"v{batch:012d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{folder}")
        fs, temp = hadoop(self.spark, f"{self.path}/pointers/.next-{uuid.uuid4().hex}")
        out = fs.create(temp)
        out.write(bytearray(json.dumps({"folder": folder, "batch": batch}).encode()))
        out.close()
        return self.publish(fs, temp, batch)

    def publish(self, fs, temp, batch: int) -> bool:
        _, to = hadoop(self.spark, f"{self.path}/pointers/batch-{batch:012d}.json")
        return not fs.exists(to) and bool(fs.rename(temp, to))


def appendable(catalog: DataFrame, entries: DataFrame) -> DataFrame:
    """New catalog entries that may come in: valid, of a new key, and of a domain that no entry of tier 1 or 2 covers yet; of several for a key or domain the first by key."""
    host = lambda: domain(F.get_json_object("config", "$.base_url"))
    covered = catalog.where("authority_tier IN (1, 2)").select(host().alias("__host")).where("__host IS NOT NULL").distinct()
    good = entries.where(entry_is_valid(F.col("key"), F.col("platform"), F.col("authority_tier"), F.col("config"))).withColumn("__host", host())
    free = good.join(catalog.select("key"), "key", "left_anti").join(covered, "__host", "left_anti")
    row = F.struct("key", *(c for c in entries.columns if c != "key"), "__host")
    per_key = free.groupBy("key").agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return per_key.groupBy("__host").agg(F.min_by(F.struct(*entries.columns), "key").alias("row")).select("row.*")


def append_catalog(spark: SparkSession, path: str, entries: DataFrame, batch: int) -> DataFrame:
    """The catalog with new entries, as its next snapshot; returns what came in."""
    store = Snapshots(spark, path)
    catalog = store.read(CATALOG)
    new = appendable(catalog, entries)
    store.write(catalog.unionByName(new, allowMissingColumns=True), batch)
    return new


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalog file: one JSON array; config stays JSON text."""
    return spark.read.schema(CATALOG).option("multiLine", True).json(path)


def skip_domains(catalog: DataFrame) -> DataFrame:
    """Domains that the catalog says to skip."""
    return catalog.where(F.coalesce(F.trim("blocked_domain"), F.lit("")) != "").select(F.lower(F.trim("blocked_domain")).alias("domain")).distinct()


def write_line(line: DataFrame, path: str) -> None:
    line.write.mode("append").text(path)


def read_requests(spark: SparkSession, path: str | None = None, **jdbc: str) -> DataFrame | None:
    """The request queue, which may live in another database: from a folder, by JDBC options, or none if neither is given."""
    from millrace.schemas import REQUESTS, conform

    if path:
        return spark.read.schema(REQUESTS).parquet(path)
    return conform(spark.read.format("jdbc").options(**jdbc).load(), REQUESTS) if jdbc else None


def read_pdfs(spark: SparkSession, path: str, pages_of=None) -> DataFrame:
    """(path, text) of PDF files. pages_of: a function from bytes to the texts of the pages; without one the text is null, as for a file that can't be read."""
    from millrace.functions.text import pdf_text

    @F.arrow_udf("array<string>")
    def run(files: pa.Array) -> pa.Array:
        def one(data):
            try:
                return None if pages_of is None else list(pages_of(data))
            except Exception:  # noqa: BLE001  whatever a decoder raises on a broken file
                return None

        return pa.array([one(x) for x in files.to_pylist()], pa.list_(pa.string()))

    return spark.read.format("binaryFile").load(path).select("path", pdf_text(run(F.col("content"))).alias("text"))


def storage_bytes(spark: SparkSession, path: str) -> int:
    """What a folder takes."""
    fs, p = hadoop(spark, path)
    return fs.getContentSummary(p).getLength()
