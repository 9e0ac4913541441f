"""Work queues: what is due, most urgent first, as many as a pass takes. Ties go by id, so every queue is determinate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.urls import starts_on_domain

# Fixed values.
NO_DOI_SOURCES = ("openalex", "core", "europepmc", "doaj", "semanticscholar", "pubmed", "clinicaltrials")
URGENT_TAGS = ("sleep", "eating")
RECHECK_DAYS, PENDING_DAYS, LEASE_MINUTES = 7, 14, 10


def priority(tags: Column) -> Column:
    """0 where the tags, written as JSON, mention an urgent subject anywhere, else 1."""
    text = F.to_json(tags)
    found = F.lit(False)
    for t in URGENT_TAGS:
        found = found | text.ilike(f"%{t}%")
    return F.when(found, 0).otherwise(1)


def ago(as_of: Column, days: int) -> Column:
    return as_of - F.expr(f"INTERVAL {days} DAYS")


def urgent_first(items: DataFrame, n: int) -> DataFrame:
    return items.withColumn("priority", priority(F.col("domain_tags"))).orderBy("priority", F.desc_nulls_last("collected_at"), "id").limit(n)


def oa_check(items: DataFrame, n: int = 3000) -> DataFrame:
    """Items with a DOI whose open access is unknown, or known without a place."""
    return urgent_first(items.where("doi IS NOT NULL AND (open_access IS NULL OR (open_access AND oa_url IS NULL))"), n).select("id", "doi", "priority", "collected_at")


def fulltext(items: DataFrame, n: int = 500) -> DataFrame:
    return urgent_first(items.where("open_access AND content_body IS NULL AND doi IS NOT NULL AND oa_url IS NOT NULL"), n).select("id", "oa_url", "fetch_attempts", "priority", "collected_at")


def no_doi(items: DataFrame, n: int = 300, sources: Sequence[str] = NO_DOI_SOURCES) -> DataFrame:
    return urgent_first(items.where("doi IS NULL AND content_body IS NULL AND authority_tier IN (1, 2)").where(F.col("source").isin(*sources)), n).select("id", "url", "fetch_attempts", "priority", "collected_at")


def to_chunk(items: DataFrame, chunks: DataFrame, n: int = 200) -> DataFrame:
    """Items to chunk again, then items with a body that have no chunk but a summary; an item in both comes once, in the first pass."""
    newest = lambda df, k: df.select("id", "collected_at", F.lit(k).alias("pass")).orderBy(F.desc_nulls_last("collected_at"), "id").limit(n)
    again = newest(items.where("needs_rechunk AND content_body IS NOT NULL AND content_body <> ''"), 0)
    done = chunks.where("NOT is_summary").select(F.col("parent_item_id").alias("id")).distinct()
    fresh = newest(items.where("content_body IS NOT NULL AND content_body <> ''").join(done, "id", "left_anti"), 1)
    first = F.row_number().over(Window.partitionBy("id").orderBy("pass"))
    return again.unionByName(fresh).withColumn("__rn", first).where("__rn = 1").drop("__rn")


def to_embed(items: DataFrame, n: int = 50) -> DataFrame:
    return items.where("embedding IS NULL").orderBy(F.desc_nulls_last("collected_at"), "id").limit(n)


def chunks_to_embed(chunks: DataFrame, n: int = 50) -> DataFrame:
    return chunks.where("embedding IS NULL").orderBy(F.desc("id")).limit(n)


def captions(items: DataFrame, n: int = 10) -> DataFrame:
    return items.where("source = 'youtube' AND content_body IS NULL").orderBy(F.desc_nulls_last("collected_at"), "id").limit(n)


def captions_to_reset(items: DataFrame, as_of: Column, n: int = 20) -> DataFrame:
    """Given-up captions of over a week ago; the order is by id where there was none."""
    return items.where("source = 'youtube' AND content_body = ''").where(F.col("collected_at") < ago(as_of, RECHECK_DAYS)).orderBy("id").limit(n)


def to_harvest(items: DataFrame, as_of: Column, after: int = 0, n: int = 100) -> DataFrame:
    due = F.col("last_harvested_at").isNull() | (F.col("last_harvested_at") < ago(as_of, RECHECK_DAYS))
    return items.where("content_body IS NOT NULL").where(due).where(F.col("id") > after).orderBy("id").limit(n)


def stubs_to_fill(items: DataFrame, after: int = 0, n: int = 30, source: str = "link_harvester") -> DataFrame:
    return items.where((F.col("source") == source) & F.col("description").isNull() & (F.col("id") > after)).orderBy("id").limit(n)


def recent_urls(items: DataFrame, domain: str, n: int = 30) -> DataFrame:
    return items.where(starts_on_domain(F.col("url"), domain)).orderBy(F.desc_nulls_last("collected_at"), "id").limit(n).select("id", "url", "collected_at")


def claim(requests: DataFrame, as_of: Column, n: int = 50) -> DataFrame:
    """Requests that wait, or whose time to try again has come, the earliest found first; claimed ones are processing."""
    due = (F.col("status") == "pending") | ((F.col("status") == "failed") & (F.col("next_retry_at") <= as_of))
    return requests.where(due).orderBy("discovered_at", "id").limit(n).withColumn("status", F.lit("processing"))


def due_sources(surfaces: DataFrame, as_of: Column) -> DataFrame:
    elapsed = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_run_at").cast("timestamp"))
    return surfaces.where(F.col("enabled") & (F.col("force_run") | F.col("last_run_at").isNull() | (elapsed >= F.col("poll_interval_sec").cast("long") * 1_000_000)))


def newest_entries(feed: DataFrame, cursor: str | None, n: int) -> DataFrame:
    """Feed entries newest first, those of the cursor's time and before left out (as strings); undated ones are never left out and sort last."""
    fresh = feed if cursor is None else feed.where(F.col("published").isNull() | (F.col("published") > cursor))
    return fresh.orderBy(F.coalesce("published", F.lit("")).desc(), "url").limit(n)


def domain_topics(surfaces: DataFrame) -> DataFrame:
    """Different pairs of domain and topic of enabled sources of tier 1 and 2, numbered in order from 0: a small table, one row a pair."""
    pairs = surfaces.where("enabled AND authority_tier IN (1, 2) AND domain IS NOT NULL").select("domain", F.explode("domain_tags").alias("topic")).distinct()
    return pairs.withColumn("index", F.row_number().over(Window.orderBy("domain", "topic")) - 1)


def next_pair(pairs: DataFrame, last_index: int) -> DataFrame:
    """The pair after the last one, around the end."""
    n = pairs.agg(F.count("*").alias("__n"))
    return pairs.join(n).where(F.col("index") == F.pmod(F.lit(last_index + 1), F.col("__n"))).drop("__n")


def best_sources(surfaces: DataFrame) -> DataFrame:
    """The source whose metadata holds for a domain: of several the one of the lowest tier, then the first by key. Sources without a tier say nothing."""
    best = surfaces.where(F.col("authority_tier").isNotNull() & F.col("domain").isNotNull()).groupBy("domain").agg(F.min_by(F.struct(*surfaces.columns), F.struct("authority_tier", "key")).alias("best"))
    return best.select("best.*")
