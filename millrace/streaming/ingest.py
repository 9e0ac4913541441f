"""Streams: the same merge and the same state rules as in batches.

Collected items come as files; every micro-batch is merged into the item snapshots by the rules of merge_items, once,
whatever is repeated: its number is kept with the snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.merge import merge_items
from millrace.operators.state import give_up_stream
from millrace.schemas import ITEMS
from millrace.sources.buckets import ItemStore
from millrace.sources.sinks import Snapshots

GIVE_UP = "domain string, ever_succeeded boolean, first_failure_at timestamp, consecutive_403_count int, given_up boolean, given_up_at timestamp, last_checked_at timestamp"
GIVE_UP_STATE = "ever boolean, first long, refused int, given long"


def merge_batch(store: Snapshots | ItemStore, schema=ITEMS):
    """For foreachBatch: batch rows, which carry seq, into the store. In buckets only those of the batch's keys are rewritten, and
    what earlier batches have left is removed; snapshots are written whole each time."""

    def run(batch: DataFrame, number: int) -> None:
        if isinstance(store, ItemStore):
            store.merge(batch, number)
            store.expire()
        else:
            store.write(merge_items(store.read(schema), batch), number)

    return run


def ingest(spark: SparkSession, incoming: str, table: str | ItemStore, checkpoint: str, schema, files_per_batch: int = 100, every: str | None = None) -> StreamingQuery:
    """Item files under incoming into the snapshots under table, or into the buckets of an ItemStore. schema: of the files, with
    seq. every: how often it looks for new files, such as 60 seconds; without it, it ends when all files are in."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    store = table if isinstance(table, ItemStore) else Snapshots(spark, table)
    return stream.writeStream.foreachBatch(merge_batch(store)).option("checkpointLocation", checkpoint).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def new_only(stream: DataFrame, key: str = "url", time: str = "collected_at", delay: str = "7 days") -> DataFrame:
    """The first row of each key within the delay: for streams where first wins and nothing is merged."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def later_than(stream: DataFrame, mark: str | None, time: str = "published") -> DataFrame:
    """Without the rows of the mark's time and before; undated rows pass. A watermark would drop state, not rows."""
    return stream if mark is None else stream.where(F.col(time).isNull() | (F.col(time) > mark))


def give_ups(fetches: DataFrame) -> DataFrame:
    """The state of every domain after each of its fetches (domain, ok, http_status, at), kept by the engine between batches."""
    return fetches.groupBy("domain").applyInPandasWithState(give_up_stream, GIVE_UP, GIVE_UP_STATE, "update", "NoTimeout")


def activity(events: DataFrame, time: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and key, for batches and streams alike; on streams rows later than `late` are out."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, window)
    return rows.groupBy(w, key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), key, "n")
