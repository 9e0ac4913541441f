"""Views and reports over items, chunks, sources and requests. Every one takes the time it looks back from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import FULL_TEXT
from millrace.operators.queues import NO_DOI_SOURCES


#: Patterns that are sent to every task; a longer list is left to Spark.
#: Characters of a pattern that its matches are looked up by.
GRAM = 4
MOST_PATTERNS = 1000


def week_before(as_of: Column) -> Column:
    return as_of - F.expr("INTERVAL 7 DAYS")


def rate(n: Column, total: Column, places: int = 4) -> Column:
    """A share in decimals, rounded; null of nothing."""
    return F.round(n.cast("decimal(20,0)") / F.nullif(total.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")), places).cast("double")


def source_health(items: DataFrame, as_of: Column) -> DataFrame:
    """By source: extraction and duplicate rates, latest item, items of the last week, whether it has gone stale."""
    body, dup = F.count_if(F.col("content_body").isNotNull()), F.count_if(F.col("near_duplicate_of").isNotNull())
    return items.groupBy("surface_key").agg(
        F.max("authority_tier").alias("authority_tier"), F.max("source_type").alias("source_type"), F.count("*").alias("source_count"), body.alias("with_content_body"), rate(body, F.count("*")).alias("extraction_success_rate"),
        dup.alias("duplicate_count"), rate(dup, F.count("*")).alias("duplicate_rate"), F.max("collected_at").alias("last_item_at"), F.count_if(F.col("collected_at") >= week_before(as_of)).alias("items_last_7d"), (F.max("collected_at") < week_before(as_of)).alias("staleness_flag"),
    )


def tier_health(items: DataFrame, as_of: Column) -> DataFrame:
    return items.groupBy("authority_tier").agg(F.count("*").alias("source_count"), F.max("collected_at").alias("last_item_at"), F.count_if(F.col("collected_at") >= week_before(as_of)).alias("items_last_7d"), (F.max("collected_at") < week_before(as_of)).alias("staleness_flag")).orderBy(F.asc_nulls_last("authority_tier"))


def evidence_distribution(items: DataFrame) -> DataFrame:
    return items.groupBy("evidence_level").agg(F.count("*").alias("item_count")).orderBy(F.desc_nulls_last("item_count"), F.asc_nulls_last("evidence_level"))


def by_tag(items: DataFrame) -> DataFrame:
    """A row for each tag of an item; items without tags have none."""
    return items.withColumn("tag", F.explode(F.coalesce("domain_tags", F.array().cast("array<string>"))))


def tag_coverage(items: DataFrame) -> DataFrame:
    return by_tag(items).groupBy(F.col("tag").alias("domain_tag")).agg(F.count("*").alias("item_count")).orderBy(F.desc("item_count"), "domain_tag")


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.col("parent_item_id").alias("id")).agg(F.count("*").alias("n_chunks"), F.count("embedding").alias("n_embedded"))


def db_stats(items: DataFrame, chunks: DataFrame, per_chunk: bool = False) -> DataFrame:
    """By source: items, with a body, full texts, abstracts, chunked items, embedded chunks. Chunks are counted before the join. per_chunk: item counts as the join of items and chunks gives them, where an item counts once for each of its chunks."""
    j = items.join(chunk_counts(chunks), "id", "left")
    times = F.greatest(F.coalesce("n_chunks", F.lit(1)), F.lit(1)) if per_chunk else F.lit(1).cast("long")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, times)), F.lit(0)).cast("long")
    length = F.length("content_body")
    return j.groupBy("surface_key").agg(
        n(F.lit(True)).alias("total"), n(F.col("content_body").isNotNull()).alias("has_content"), n(length >= FULL_TEXT).alias("full_text"), n(length < FULL_TEXT).alias("abstract_only"), F.count("n_chunks").alias("chunked"), F.coalesce(F.sum("n_embedded"), F.lit(0)).alias("embedded")
    )


def totals(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: items, chunks, embedded chunks."""
    return items.agg(F.count("*").alias("items")).join(chunks.agg(F.count("*").alias("chunks"), F.count("embedding").alias("embedded")))


def embedding_coverage(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: items, those with at least one embedded chunk, the share."""
    has = chunks.where("embedding IS NOT NULL").select(F.col("parent_item_id").alias("id"))
    embedded = items.join(has, "id", "left_semi").agg(F.count("*").alias("with_embedding"))
    return items.agg(F.count("*").alias("items")).join(embedded).select("items", "with_embedding", rate(F.col("with_embedding"), F.col("items")).alias("coverage"))


def source_breakdown(items: DataFrame, discovery: str) -> DataFrame:
    """By tag, of tier 1 and 2: all items and full texts, found by discovery or by the other sources."""
    full, found = F.length("content_body") >= FULL_TEXT, F.col("source") == discovery
    return by_tag(items.where("authority_tier IN (1, 2)")).groupBy(F.col("tag").alias("track")).agg(F.count_if(found).alias("websearch_total"), F.count_if(found & full).alias("websearch_full"), F.count_if(~found).alias("pages_total"), F.count_if(~found & full).alias("pages_full")).orderBy(F.desc("websearch_total"), "track")


def backlog(items: DataFrame, retriable: Sequence[str] = NO_DOI_SOURCES) -> DataFrame:
    """By tag, of tier 1 and 2: downloaded, waiting, skipped and abstracts, which add up to the total."""
    body, doi, oa, url = (F.col(c) for c in ("content_body", "doi", "open_access", "oa_url"))
    empty, again = body.isNull() | (body == ""), F.col("source").isin(*retriable)
    yes = lambda c: F.coalesce(c, F.lit(False))
    unchecked = oa.isNull() | (yes(oa) & url.isNull())
    waiting = yes(empty) & ((doi.isNotNull() & (unchecked | (body.isNull() & yes(oa) & url.isNotNull()))) | (doi.isNull() & again))
    skipped = yes(empty) & ((doi.isNotNull() & (yes(~oa) | (yes(body == "") & yes(oa) & url.isNotNull()))) | (doi.isNull() & ~again))
    return by_tag(items.where("authority_tier IN (1, 2)")).groupBy(F.col("tag").alias("track")).agg(
        F.count("*").alias("total"), F.count_if(F.length(body) >= FULL_TEXT).alias("downloaded"), F.count_if(waiting).alias("waiting"), F.count_if(skipped).alias("skipped"), F.count_if((body != "") & (F.length(body) < FULL_TEXT)).alias("abstract")
    ).orderBy(F.desc("waiting"), "track")


def url_keys(url: Column) -> Column:
    """The different stretches of GRAM characters of a URL, and the empty one, which all have."""
    def of(chars: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(chars) - GRAM + 1)), lambda i: F.array_join(F.slice(chars, i, F.lit(GRAM)), ""))
        return F.array_distinct(F.concat(F.array(F.lit("")), each))

    return F.transform(F.array(F.split(url, "")), of)[0]


def pattern_key(pattern: Column) -> Column:
    """A stretch that every match of a LIKE pattern holds: the middle of its longest piece without wildcards; empty if that is short or characters are escaped."""
    longest = F.reduce(F.split(pattern, "[%_]"), F.lit(""), lambda best, piece: F.when(F.length(piece) > F.length(best), piece).otherwise(best))
    middle = F.transform(F.array(longest), lambda x: F.when(F.length(x) >= GRAM, F.substring(x, F.floor((F.length(x) - GRAM) / 2).cast("int") + 1, F.lit(GRAM))).otherwise(""))[0]
    return F.when(F.contains(pattern, F.lit("\\")), "").otherwise(middle)


def matched(found: DataFrame, domains: DataFrame) -> DataFrame:
    """Rows of found (oa_url) with each pattern (domain, pattern) that they match. Rows and patterns meet on a stretch that a match
    must hold; LIKE is asked of these candidates only, so the work follows the matches and not rows times patterns."""
    keyed = found.withColumn("__key", F.explode(url_keys(F.col("oa_url"))))
    patterns = domains.withColumn("__key", pattern_key(F.col("pattern")))
    return keyed.join(patterns, "__key").where(F.expr("oa_url LIKE pattern")).drop("__key")


def manual_skips(items: DataFrame, domains: DataFrame) -> DataFrame:
    """By configured domain (domain, pattern): items whose open-access URL matches, and those that the reports by tag count. A few patterns go to every task and each item meets all of them; more are matched by key."""
    found = items.where("doi IS NOT NULL AND oa_url IS NOT NULL").select("id", "oa_url", "authority_tier", "domain_tags")
    few = domains.limit(MOST_PATTERNS + 1).count() <= MOST_PATTERNS
    j = F.broadcast(domains).join(found, F.expr("oa_url LIKE pattern"), "inner") if few else matched(found, domains)
    counted = j.groupBy("domain").agg(F.count("id").alias("total_matched"), F.count_if(F.col("authority_tier").isin(1, 2) & (F.size(F.coalesce("domain_tags", F.array().cast("array<string>"))) > 0)).alias("counted_above"))
    return domains.select("domain").distinct().join(counted, "domain", "left").na.fill(0, ["total_matched", "counted_above"]).orderBy(F.desc("total_matched"), "domain")


def zipped(domains: Column, patterns: Column) -> Column:
    """Generator: rows of (domain, pattern) from two arrays side by side."""
    return F.inline(F.arrays_zip(domains.alias("domain"), patterns.alias("pattern")))


def full_article_counts(items: DataFrame, as_of: Column) -> DataFrame:
    full = F.length("content_body") >= FULL_TEXT
    return items.agg(F.count_if(full).alias("total"), F.count_if(full & (F.col("collected_at") >= as_of - F.expr("INTERVAL 24 HOURS"))).alias("last_24h"))


def queue_depths(items: DataFrame, chunks: DataFrame, surfaces: DataFrame) -> DataFrame:
    """One row: items without vector, items with a body (chunked ones too), sources that failed over three times."""
    a = items.agg(F.count_if(F.col("embedding").isNull()).alias("embedding_queue"), F.count_if((F.col("content_body") != "") & F.col("content_body").isNotNull()).alias("chunk_queue"))
    return a.join(surfaces.agg(F.count_if(F.col("consecutive_fails") > 3).alias("failing_sources")))


def status_histogram(requests: DataFrame) -> DataFrame:
    return requests.groupBy("status").agg(F.count("*").alias("n")).withColumn("processed", F.col("status").isin("done", "out_of_scope", "failed"))


def processed_totals(requests: DataFrame) -> DataFrame:
    return requests.agg(F.count_if(F.col("status").isin("pending", "processing")).alias("not_processed"), F.count_if(F.col("status").isin("done", "out_of_scope", "failed")).alias("processed"))


def promotions_last_day(requests: DataFrame, as_of: Column) -> DataFrame:
    return requests.where(F.col("promoted_surface_key").isNotNull() & (F.col("processed_at") > as_of - F.expr("INTERVAL 24 HOURS"))).agg(F.count("*").alias("promoted"))


def tier_one_staleness(surfaces: DataFrame, items: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Sources of tier 1: never collected, stale (with days), fresh."""
    latest = items.groupBy(F.col("surface_key").alias("key")).agg(F.max("collected_at").alias("latest"))
    age = F.datediff(as_of, F.col("latest"))
    state = F.when(F.col("latest").isNull(), "never").when(F.col("latest") < as_of - F.expr(f"INTERVAL {days} DAYS"), "stale").otherwise("fresh")
    return surfaces.where("authority_tier = 1 AND enabled").select("key").join(latest, "key", "left").select("key", state.alias("state"), F.when(F.col("latest").isNotNull(), age).alias("days"))


def catalog_stats(surfaces: DataFrame, stats: DataFrame) -> DataFrame:
    """All sources of the catalog with their numbers; sources without any item have none yet."""
    s = stats.withColumnRenamed("surface_key", "key")
    return surfaces.select("key", "authority_tier").join(s, "key", "left").withColumn("has_data", F.col("total").isNotNull())


def tier_totals(surfaces: DataFrame, stats: DataFrame) -> DataFrame:
    """Subtotals by tier 1 and 2 and the total of both (tier null)."""
    rows = catalog_stats(surfaces, stats).where("authority_tier IN (1, 2)")
    return rows.rollup("authority_tier").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "full_text", "abstract_only", "chunked", "embedded")))


def catalog_faults(catalog: DataFrame, platforms: Sequence[str]) -> DataFrame:
    """(key, fault): keys that repeat, unknown platforms, missing addresses, disabled entries without a reason, tiers, types and tags that don't exist."""
    from millrace.functions.records import AUDIENCES, DOMAIN_TAGS, SOURCE_TYPES

    conf = lambda k: F.get_json_object("config", f"$.{k}")
    address = F.coalesce(conf("base_url"), conf("start_url"), conf("sitemap_url"), conf("slugs"), conf("query"))
    faults = F.array_compact(F.array(
        F.when(~F.col("platform").isin(*platforms), "unknown platform"),
        F.when(F.col("platform").isin("html_pages", "browser_pages", "sitemap", "nhs_api") & address.isNull(), "no address"),
        F.when((F.col("enabled") == 0) & ~F.coalesce(F.contains("content_notes", F.lit("DISABLED")), F.lit(False)), "disabled without reason"),
        F.when(F.col("authority_tier").isNotNull() & ~F.col("authority_tier").isin(1, 2), "tier"),
        F.when(F.col("source_type").isNotNull() & ~F.col("source_type").isin(*SOURCE_TYPES), "source type"),
        F.when(F.col("audience_type").isNotNull() & ~F.col("audience_type").isin(*AUDIENCES), "audience"),
        F.when(F.size(F.array_except(F.coalesce("domain_tags", F.array().cast("array<string>")), F.array(*map(F.lit, DOMAIN_TAGS)))) > 0, "domain tag"),
    ))
    repeated = catalog.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit("key repeats").alias("fault"))
    return catalog.select("key", F.explode(faults).alias("fault")).unionByName(repeated)


def metrics_line(depths: DataFrame, as_of: Column) -> DataFrame:
    """The numbers of a pass as one line of JSON."""
    return depths.select(F.to_json(F.struct(F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss").alias("at"), *depths.columns)).alias("line"))


def last_counts(log: DataFrame, pattern: str) -> DataFrame:
    """The last line of a log (text, at) that a pattern of one number matches, with the number."""
    hits = log.where(F.col("text").rlike(pattern)).select("at", F.regexp_extract("text", pattern, 1).try_cast("long").alias("n"))
    return hits.agg(F.max_by("n", "at").alias("n"), F.max("at").alias("at"))


def item_list(items: DataFrame, search: str | None = None, n: int = 100, **filters) -> DataFrame:
    """The admin list of items: filters on columns, a search in title, DOI, author and URL, newest first, long titles cut."""
    from millrace.functions.text import truncated

    out = items
    for column, value in filters.items():
        out = out.where(F.col(column).eqNullSafe(F.lit(value)))
    if search is not None:
        found = F.lit(False)
        for c in ("title", "doi", "author", "url"):
            found = found | F.coalesce(F.contains(F.lower(c), F.lit(search.lower())), F.lit(False))
        out = out.where(found)
    return out.orderBy(F.desc_nulls_last("collected_at"), "id").limit(n).select("id", truncated(F.col("title")).alias("title"), "source", "url", "collected_at")


def source_list(surfaces: DataFrame) -> DataFrame:
    return surfaces.orderBy(F.desc("consecutive_fails"), "last_status", "key")


def health_body(counts: DataFrame, beats: DataFrame) -> DataFrame:
    """The health report: article counts, and whether every loop is alive."""
    return counts.join(beats.agg((F.count_if("stuck") == 0).alias("alive"), F.array_sort(F.collect_list(F.when(F.col("stuck"), F.col("name")))).alias("stuck"))).select(F.to_json(F.struct("*")).alias("body"), F.col("alive"))
