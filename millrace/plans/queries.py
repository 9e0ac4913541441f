"""The registered queries: every operator applied to the synthetic tables, with the same result stated as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import chunking, html, language, records, text, urls
from millrace.operators import dedup, graph_index, lifecycle, merge, queues, search, state
from millrace.operators.link_index import LinkIndex
from millrace.plans import corpus, views
from millrace.plans.corpus import AS_OF, CHUNKS, DISCOVERY, FETCHES, ITEMS, REQUESTS, SURFACES, as_of, table
from millrace.session import once, work_path
from millrace.sources.buckets import ItemStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
NOW = f"TIMESTAMP '{AS_OF}'"
TAGGED = "tagged AS (SELECT i.*, t.tag FROM items i, unnest(i.domain_tags) AS t(tag))"
FULL = text.FULL_TEXT


def query(sql: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {', '.join(ctes)} {sql}" if ctes else sql
        return f

    return add


def strings(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def contains_any(column: str, values) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{v}')" for v in values) + ")"


HEALTH = f"count(*) AS source_count, max(collected_at) AS last_item_at, count(*) FILTER (WHERE collected_at >= {NOW} - INTERVAL 7 DAY) AS items_last_7d, max(collected_at) < {NOW} - INTERVAL 7 DAY AS staleness_flag"


@query(
    f"SELECT surface_key, max(authority_tier) AS authority_tier, max(source_type) AS source_type, count(content_body) AS with_content_body, round(count(content_body)::DECIMAL(20,0) / nullif(count(*), 0), 4)::DOUBLE AS extraction_success_rate, "
    f"count(near_duplicate_of) AS duplicate_count, round(count(near_duplicate_of)::DECIMAL(20,0) / nullif(count(*), 0), 4)::DOUBLE AS duplicate_rate, {HEALTH} FROM items GROUP BY surface_key",
    ITEMS,
)
def source_health(spark, d):
    return views.source_health(corpus.items(spark, d), as_of())


@query(f"SELECT authority_tier, {HEALTH} FROM items GROUP BY authority_tier", ITEMS)
def tier_health(spark, d):
    return views.tier_health(corpus.items(spark, d), as_of())


EVIDENCE = (
    "CASE WHEN source_type IN ('forum', 'reddit', 'social') THEN 'anecdotal' WHEN source_type = 'blog' THEN 'blog' "
    + " ".join(f"WHEN {contains_any('t', parts)} THEN '{level}'" for level, parts in text.EVIDENCE_WORDS.items())
    + " ".join(f" WHEN source = '{p}' THEN '{level}'" for p, level in text.EVIDENCE_OF_PLATFORM.items())
    + f" WHEN source_type = 'official_health' AND source IN ({strings(text.GUIDANCE_PLATFORMS)}) THEN 'government_guidance' WHEN source_type = 'hospital' THEN 'hospital_education' WHEN source_type = 'academic' THEN 'peer_reviewed_study' WHEN source_type = 'peer_reviewed' THEN 'peer_reviewed' END"
)


@query(f"SELECT evidence_level, count(*) AS item_count FROM (SELECT {EVIDENCE} AS evidence_level FROM (SELECT *, coalesce(title, '') || ' ' || coalesce(description, '') AS t FROM items)) GROUP BY evidence_level", ITEMS)
def evidence_distribution(spark, d):
    i = corpus.items(spark, d)
    return views.evidence_distribution(i.withColumn("evidence_level", text.evidence_level(F.col("title"), F.col("description"), F.col("source_type"), F.col("source"))))


@query("SELECT tag AS domain_tag, count(*) AS item_count FROM tagged GROUP BY tag", ITEMS, TAGGED)
def tag_coverage(spark, d):
    return views.tag_coverage(corpus.items(spark, d))


DB_STATS = f"count(%s) AS total, count(%s content_body) AS has_content, count(%s CASE WHEN length(content_body) >= {FULL} THEN 1 END) AS full_text"
STATS = (
    "SELECT i.surface_key, {n} AS total, {body} AS has_content, {full} AS full_text, {part} AS abstract_only, count(DISTINCT c.parent_item_id) AS chunked, count(c.embedding) AS embedded FROM items i LEFT JOIN chunks c ON c.parent_item_id = i.id GROUP BY i.surface_key"
)


@query(STATS.format(n="count(*)", body="count(i.content_body)", full=f"count(CASE WHEN length(i.content_body) >= {FULL} THEN 1 END)", part=f"count(CASE WHEN length(i.content_body) < {FULL} THEN 1 END)"), ITEMS, CHUNKS)
def db_stats_faithful(spark, d):
    return views.db_stats(corpus.items(spark, d), corpus.chunks(spark, d), per_chunk=True)


@query(STATS.format(n="count(DISTINCT i.id)", body="count(DISTINCT CASE WHEN i.content_body IS NOT NULL THEN i.id END)", full=f"count(DISTINCT CASE WHEN length(i.content_body) >= {FULL} THEN i.id END)", part=f"count(DISTINCT CASE WHEN length(i.content_body) < {FULL} THEN i.id END)"), ITEMS, CHUNKS)
def db_stats_corrected(spark, d):
    return views.db_stats(corpus.items(spark, d), corpus.chunks(spark, d))


@query("SELECT (SELECT count(*) FROM items) AS items, (SELECT count(*) FROM chunks) AS chunks, (SELECT count(embedding) FROM chunks) AS embedded", ITEMS, CHUNKS)
def totals(spark, d):
    return views.totals(corpus.items(spark, d), corpus.chunks(spark, d))


@query("SELECT items, with_embedding, round(with_embedding::DECIMAL(20,0) / items, 4)::DOUBLE AS coverage FROM (SELECT count(*) AS items, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM chunks c WHERE c.parent_item_id = i.id AND c.embedding IS NOT NULL)) AS with_embedding FROM items i)", ITEMS, CHUNKS)
def embedding_coverage(spark, d):
    return views.embedding_coverage(corpus.items(spark, d), corpus.chunks(spark, d))


@query(
    f"SELECT tag AS track, count(*) FILTER (WHERE source = '{DISCOVERY}') AS websearch_total, count(*) FILTER (WHERE source = '{DISCOVERY}' AND length(content_body) >= {FULL}) AS websearch_full, count(*) FILTER (WHERE source <> '{DISCOVERY}') AS pages_total, count(*) FILTER (WHERE source <> '{DISCOVERY}' AND length(content_body) >= {FULL}) AS pages_full FROM tagged WHERE authority_tier IN (1, 2) GROUP BY tag",
    ITEMS, TAGGED,
)
def source_breakdown(spark, d):
    return views.source_breakdown(corpus.items(spark, d), DISCOVERY)


RETRIABLE = strings(queues.NO_DOI_SOURCES)


@query(
    f"SELECT tag AS track, count(*) AS total, count(*) FILTER (WHERE length(content_body) >= {FULL}) AS downloaded, "
    f"count(*) FILTER (WHERE (content_body IS NULL OR content_body = '') AND ((doi IS NOT NULL AND ((open_access IS NULL OR (open_access = true AND oa_url IS NULL)) OR (content_body IS NULL AND open_access = true AND oa_url IS NOT NULL))) OR (doi IS NULL AND source IN ({RETRIABLE})))) AS waiting, "
    f"count(*) FILTER (WHERE (content_body IS NULL OR content_body = '') AND ((doi IS NOT NULL AND (open_access = false OR (content_body = '' AND open_access = true AND oa_url IS NOT NULL))) OR (doi IS NULL AND NOT (source IN ({RETRIABLE}))))) AS skipped, "
    f"count(*) FILTER (WHERE content_body IS NOT NULL AND content_body <> '' AND length(content_body) < {FULL}) AS abstract FROM tagged WHERE authority_tier IN (1, 2) GROUP BY tag",
    ITEMS, TAGGED,
)
def backlog_partition(spark, d):
    return views.backlog(corpus.items(spark, d))


SKIPS = [(f"oa{k}.example.org", f"%oa{k}.example.org%") for k in (0, 1, 3, 5, 8)] + [("nowhere.example", "%nowhere.example%")]


@query(
    f"SELECT d.domain, count(i.id) AS total_matched, count(i.id) FILTER (WHERE i.authority_tier IN (1, 2) AND coalesce(len(i.domain_tags), 0) > 0) AS counted_above FROM (VALUES {', '.join(f'({strings(s)})' for s in SKIPS)}) AS d(domain, pattern) LEFT JOIN items i ON i.doi IS NOT NULL AND i.oa_url IS NOT NULL AND i.oa_url LIKE d.pattern GROUP BY d.domain",
    ITEMS,
)
def manual_skip_detail(spark, d):
    pairs = spark.range(1).select(views.zipped(F.array(*(F.lit(a) for a, _ in SKIPS)), F.array(*(F.lit(b) for _, b in SKIPS))))
    return views.manual_skips(corpus.items(spark, d), pairs.toDF("domain", "pattern"))


@query(f"SELECT count(*) FILTER (WHERE length(content_body) >= {FULL}) AS total, count(*) FILTER (WHERE length(content_body) >= {FULL} AND collected_at >= {NOW} - INTERVAL 24 HOUR) AS last_24h FROM items", ITEMS)
def full_article_counts(spark, d):
    return views.full_article_counts(corpus.items(spark, d), as_of())


@query("SELECT count(*) FILTER (WHERE NOT embedded) AS embedding_queue, count(*) FILTER (WHERE content_body IS NOT NULL AND content_body <> '') AS chunk_queue, (SELECT count(*) FROM surfaces WHERE consecutive_fails > 3) AS failing_sources FROM items", ITEMS, SURFACES)
def queue_depths(spark, d):
    return views.queue_depths(corpus.items(spark, d), corpus.chunks(spark, d), corpus.surfaces(spark, d))


@query("SELECT status, count(*) AS n, status IN ('done', 'out_of_scope', 'failed') AS processed FROM requests GROUP BY status", REQUESTS)
def status_histogram(spark, d):
    return views.status_histogram(corpus.requests(spark, d))


@query("SELECT count(*) FILTER (WHERE status IN ('pending', 'processing')) AS not_processed, count(*) FILTER (WHERE status IN ('done', 'out_of_scope', 'failed')) AS processed FROM requests", REQUESTS)
def processed_totals(spark, d):
    return views.processed_totals(corpus.requests(spark, d))


@query(f"SELECT count(*) AS promoted FROM requests WHERE promoted_surface_key IS NOT NULL AND processed_at > {NOW} - INTERVAL 24 HOUR", REQUESTS)
def rolling_promotions(spark, d):
    return views.promotions_last_day(corpus.requests(spark, d), as_of())


@query(
    f"SELECT s.key, CASE WHEN m IS NULL THEN 'never' WHEN m < {NOW} - INTERVAL 7 DAY THEN 'stale' ELSE 'fresh' END AS state, date_diff('day', m::DATE, {NOW}::DATE)::INT AS days "
    "FROM surfaces s LEFT JOIN (SELECT surface_key, max(collected_at) AS m FROM items GROUP BY surface_key) x ON x.surface_key = s.key WHERE s.authority_tier = 1 AND s.enabled",
    ITEMS, SURFACES,
)
def tier1_staleness(spark, d):
    return views.tier_one_staleness(corpus.surfaces(spark, d), corpus.items(spark, d), as_of())


CORRECTED = f"stats AS ({ORACLES['db_stats_corrected'].split('. ')[0].partition(CHUNKS + ' ')[2]})"


@query("SELECT authority_tier, coalesce(sum(total), 0)::BIGINT AS total, coalesce(sum(full_text), 0)::BIGINT AS full_text, coalesce(sum(abstract_only), 0)::BIGINT AS abstract_only, coalesce(sum(chunked), 0)::BIGINT AS chunked, coalesce(sum(embedded), 0)::BIGINT AS embedded FROM surfaces s LEFT JOIN stats t ON t.surface_key = s.key WHERE authority_tier IN (1, 2) GROUP BY ROLLUP (authority_tier)", ITEMS, CHUNKS, SURFACES, CORRECTED)
def tier_subtotals(spark, d):
    return views.tier_totals(corpus.surfaces(spark, d), db_stats_corrected(spark, d))


@query("SELECT s.key, s.authority_tier, total, has_content, full_text, abstract_only, chunked, embedded, total IS NOT NULL AS has_data FROM surfaces s LEFT JOIN stats t ON t.surface_key = s.key", ITEMS, CHUNKS, SURFACES, CORRECTED)
def catalog_stats(spark, d):
    return views.catalog_stats(corpus.surfaces(spark, d), db_stats_corrected(spark, d))


# --- work queues

PRIORITY = "CASE WHEN list_contains(domain_tags, 'sleep') OR list_contains(domain_tags, 'eating') THEN 0 ELSE 1 END::INT AS priority"
URGENT = "ORDER BY priority, collected_at DESC NULLS LAST, id LIMIT"


@query(f"SELECT id, doi, {PRIORITY}, collected_at FROM items WHERE doi IS NOT NULL AND (open_access IS NULL OR (open_access AND oa_url IS NULL)) {URGENT} 3000", ITEMS)
def oa_queue(spark, d):
    return queues.oa_check(corpus.items(spark, d))


@query(f"SELECT id, oa_url, fetch_attempts, {PRIORITY}, collected_at FROM items WHERE open_access AND content_body IS NULL AND doi IS NOT NULL AND oa_url IS NOT NULL {URGENT} 500", ITEMS)
def fulltext_queue(spark, d):
    return queues.fulltext(corpus.items(spark, d))


@query(f"SELECT id, url, fetch_attempts, {PRIORITY}, collected_at FROM items WHERE doi IS NULL AND content_body IS NULL AND authority_tier IN (1, 2) AND source IN ({RETRIABLE}) {URGENT} 300", ITEMS)
def nodoi_queue(spark, d):
    return queues.no_doi(corpus.items(spark, d))


BODY = "content_body IS NOT NULL AND content_body <> ''"


@query(
    f"SELECT id, collected_at, min(pass)::INT AS pass FROM ((SELECT id, collected_at, 0 AS pass FROM items WHERE needs_rechunk AND {BODY} ORDER BY collected_at DESC, id LIMIT 200) UNION ALL (SELECT id, collected_at, 1 FROM items WHERE {BODY} AND id NOT IN (SELECT parent_item_id FROM chunks WHERE NOT is_summary) ORDER BY collected_at DESC, id LIMIT 200)) GROUP BY id, collected_at",
    ITEMS, CHUNKS,
)
def unchunked_items(spark, d):
    return queues.to_chunk(corpus.items(spark, d), corpus.chunks(spark, d))


@query("SELECT id, collected_at FROM items WHERE NOT embedded ORDER BY collected_at DESC, id LIMIT 50", ITEMS)
def embed_queue(spark, d):
    return queues.to_embed(corpus.items(spark, d)).select("id", "collected_at")


@query("SELECT id, parent_item_id FROM chunks WHERE embedding IS NULL ORDER BY id DESC LIMIT 50", CHUNKS)
def chunk_embed_queue(spark, d):
    return queues.chunks_to_embed(corpus.chunks(spark, d)).select("id", "parent_item_id")


@query("SELECT id, collected_at FROM items WHERE source = 'youtube' AND content_body IS NULL ORDER BY collected_at DESC, id LIMIT 10", ITEMS)
def caption_queue(spark, d):
    return queues.captions(corpus.items(spark, d)).select("id", "collected_at")


@query(f"SELECT id, collected_at FROM items WHERE source = 'youtube' AND content_body = '' AND collected_at < {NOW} - INTERVAL 7 DAY ORDER BY id LIMIT 20", ITEMS)
def caption_reset(spark, d):
    return queues.captions_to_reset(corpus.items(spark, d), as_of()).select("id", "collected_at")


@query(f"SELECT id, last_harvested_at FROM items WHERE content_body IS NOT NULL AND (last_harvested_at IS NULL OR last_harvested_at < {NOW} - INTERVAL 7 DAY) AND id > 25 ORDER BY id LIMIT 100", ITEMS)
def harvest_queue(spark, d):
    return queues.to_harvest(corpus.items(spark, d), as_of(), after=25).select("id", "last_harvested_at")


@query("SELECT id FROM items WHERE source = 'sitemap' AND description IS NULL AND id > 10 ORDER BY id LIMIT 30", ITEMS)
def stub_queue(spark, d):
    return queues.stubs_to_fill(corpus.items(spark, d), after=10, source="sitemap").select("id")


@query("SELECT id, url, collected_at FROM items WHERE url LIKE 'http://src1.example.org%' OR url LIKE 'http://www.src1.example.org%' OR url LIKE 'https://src1.example.org%' OR url LIKE 'https://www.src1.example.org%' ORDER BY collected_at DESC, id LIMIT 30", ITEMS)
def recent_known_urls(spark, d):
    return queues.recent_urls(corpus.items(spark, d), "src1.example.org")


@query(f"SELECT id, url, 'processing' AS status, discovered_at FROM requests WHERE status = 'pending' OR (status = 'failed' AND next_retry_at <= {NOW}) ORDER BY discovered_at, id LIMIT 50", REQUESTS)
def claim_batch(spark, d):
    return queues.claim(corpus.requests(spark, d), as_of()).select("id", "url", "status", "discovered_at")


@query(f"SELECT key, platform FROM surfaces WHERE enabled AND (force_run OR last_run_at IS NULL OR date_diff('microsecond', last_run_at, {NOW}) / 1000000 >= poll_interval_sec)", SURFACES)
def due_sources(spark, d):
    return queues.due_sources(corpus.surfaces(spark, d), as_of()).select("key", "platform")


PAIRS = "pairs AS (SELECT domain, topic, (row_number() OVER (ORDER BY domain, topic) - 1)::INT AS index FROM (SELECT DISTINCT domain, unnest(domain_tags) AS topic FROM surfaces WHERE enabled AND authority_tier IN (1, 2)))"


@query("SELECT domain, topic, index FROM pairs", SURFACES, PAIRS)
def domain_topic_queue(spark, d):
    return queues.domain_topics(corpus.surfaces(spark, d))


@query("SELECT domain, topic, index FROM pairs WHERE index = 5 % (SELECT count(*) FROM pairs)", SURFACES, PAIRS)
def round_robin(spark, d):
    return queues.next_pair(queues.domain_topics(corpus.surfaces(spark, d)), 4)


@query("SELECT event_id, props FROM events WHERE event_type = 'view' ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S.%f') DESC, event_id LIMIT 20")
def feed_newest(spark, d):
    feed = table(spark, d, "events").where("event_type = 'view'").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("published"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("url"), "event_id", "props")
    return queues.newest_entries(feed, None, 20).select("event_id", "props")


# --- scalar functions

PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1)"
NETLOC = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
BARE = r"split_part(url, '#', 1)"


@query(
    f"SELECT page_id, regexp_replace(lower(regexp_extract({BARE}, '^([a-zA-Z]+://[^/?]*)', 1)) || regexp_extract({BARE}, '^[a-zA-Z]+://[^/?]*([^?]*)', 1) || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END, '/+$', '') AS url FROM (SELECT page_id, url, list_filter(string_split(regexp_extract({BARE}, '\\?(.*)$', 1), '&'), lambda p: split_part(p, '=', 2) <> '' AND lower(split_part(p, '=', 1)) NOT IN ({strings(urls.TRACKING)})) AS kept FROM pages)"
)
def url_normalize(spark, d):
    return table(spark, d, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("url"))


@query(rf"SELECT page_id, {NETLOC} AS netloc, regexp_replace(lower({NETLOC}), '^www\.', '') AS domain, lower({NETLOC}) AS domain_www, split_part(trim(url), '#', 1) AS no_fragment, regexp_replace(split_part(url, '#', 1), '/+$', '') AS link, ends_with(split_part(lower(url), '?', 1), '.pdf') AS is_pdf, sha256(url) AS cache_key FROM pages")
def url_parts(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.netloc(u).alias("netloc"), urls.domain(u).alias("domain"), urls.domain(u, keep_www=True).alias("domain_www"), urls.strip_fragment(u).alias("no_fragment"), urls.link_form(u).alias("link"), urls.is_pdf_url(u).alias("is_pdf"), urls.cache_key(u).alias("cache_key"))


BLOCKED = strings(urls.BLOCKED_SEGMENTS)
PHRASES = strings(f"-{s}-" for s in urls.BLOCKED_SEGMENTS if "-" in s)


@query(
    rf"""SELECT page_id, regexp_extract(url, '#(.*)$', 1) = '' AND host IN ('m.tiontion.example.com', 'www.ththin.example.net') AND len(list_filter(parts, lambda s: s IN ({BLOCKED}) OR regexp_replace(s, '\.(aspx|html?|php|jsp|cfm)$', '', 'i') IN ({BLOCKED}) OR len(list_filter([{PHRASES}], lambda p: contains('-' || regexp_replace(s, '\.(aspx|html?|php|jsp|cfm)$', '', 'i') || '-', p))) > 0)) = 0 AND len(parts) >= CASE WHEN host = 'm.tiontion.example.com' THEN 2 ELSE 1 END AS is_content
FROM (SELECT page_id, url, {NETLOC} AS host, list_filter(string_split(lower({PATH} || CASE page_id % 5 WHEN 0 THEN '/donate' WHEN 1 THEN '/x-request-appointment.aspx' WHEN 2 THEN '/login.aspx' ELSE '' END), '/'), lambda s: s <> '') AS parts FROM pages)"""
)
def content_url_filter(spark, d):
    p = table(spark, d, "pages")
    more = F.expr("CASE page_id % 5 WHEN 0 THEN '/donate' WHEN 1 THEN '/x-request-appointment.aspx' WHEN 2 THEN '/login.aspx' ELSE '' END")
    changed = F.concat(F.regexp_extract("url", "^([^?#]*)", 1), more, F.regexp_extract("url", "^[^?#]*(.*)$", 1))
    return p.select("page_id", urls.is_content_url(changed, "m.tiontion.example.com", 2, ["www.ththin.example.net"]).alias("is_content"))


@query(f"SELECT page_id, (CASE WHEN contains(lower(url), '/en/') THEN 5 ELSE 0 END + CASE WHEN contains(lower(url), 'page=') THEN -8 ELSE 0 END + CASE WHEN length(url) - length(replace(url, '/', '')) > 6 THEN -2 ELSE 0 END)::INT AS score, {PATH} LIKE '/en/%' AND NOT {PATH} LIKE '%.html' AS allowed FROM pages")
def url_scores(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.url_score(u, ["/en/"], ["page="]).alias("score"), urls.path_allowed(u, ["/en/*"], ["*.html"]).alias("allowed"))


@query("SELECT doc_id, lower(regexp_replace(trim(raw), '^https?://(dx\\.)?doi\\.org/', '', 'i')) AS doi FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ' HTTPS://doi.org/10.1/AbC' || doc_id WHEN 1 THEN 'http://dx.doi.org/10.2/' || doc_id || ' ' WHEN 2 THEN '10.3/X' || doc_id END AS raw FROM documents)")
def doi_normalize(spark, d):
    raw = F.expr("CASE doc_id % 4 WHEN 0 THEN concat(' HTTPS://doi.org/10.1/AbC', doc_id) WHEN 1 THEN concat('http://dx.doi.org/10.2/', doc_id, ' ') WHEN 2 THEN concat('10.3/X', doc_id) END")
    return table(spark, d, "documents").select("doc_id", text.normalize_doi(raw).alias("doi"))


WORDS = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"


@query(
    f"SELECT id, CASE WHEN content_body = '' OR length(regexp_replace(content_body, '^\\s+|\\s+$', '', 'g')) >= 150 THEN length(content_body) END AS stored, coalesce(length(content_body) >= 300 AND len({WORDS.format('content_body')}) >= 50 AND NOT ({contains_any('content_body', text.BOILERPLATE)} AND length(content_body) < 1000), false) AS extracts, length(content_body) < 300 OR {contains_any('content_body', text.PAYWALL)} AS paywall, trim(title) <> '' AND url <> '' AS required FROM items",
    ITEMS,
)
def quality_gates(spark, d):
    b = F.col("content_body")
    return corpus.items(spark, d).select("id", F.length(text.stored_body(b)).cast("long").alias("stored"), text.passes_extraction(b).alias("extracts"), text.behind_paywall(b).alias("paywall"), text.has_required(F.col("title"), F.col("url")).alias("required"))


@query(f"SELECT id, published_at < {NOW} - INTERVAL 1825 DAY AS is_stale FROM items", ITEMS)
def staleness_flag(spark, d):
    return corpus.items(spark, d).select("id", text.is_stale(F.col("published_at"), as_of()).alias("is_stale"))


@query(f"SELECT id, CASE WHEN content_body <> '' THEN sha256(content_body) END AS hash, ((4 * len({WORDS.format('content_body')})) // 3)::INT AS tokens, trim(coalesce(title, '') || ' ' || substring(coalesce(content_body, ''), 1, 500)) AS summary, trim(trim(coalesce(title, '')) || ' ' || trim(CASE WHEN coalesce(content_body, '') <> '' THEN substring(content_body, 1, 800) ELSE substring(coalesce(description, ''), 1, 500) END)) AS embed, CASE WHEN length(description) > 80 THEN substring(description, 1, 80) || '…' ELSE description END AS short, 'search_document: ' || title AS document, 'en' AS lang FROM items", ITEMS)
def item_texts(spark, d):
    b, t, s = F.col("content_body"), F.col("title"), F.col("description")
    return corpus.items(spark, d).select("id", text.content_hash(b).alias("hash"), F.when(b.isNotNull(), text.estimate_tokens(b)).alias("tokens"), text.summary_text(t, b).alias("summary"), text.embed_text(t, s, b).alias("embed"), text.truncated(s).alias("short"), text.as_document(t).alias("document"), text.language(b).alias("lang"))


@query(r"SELECT page_id, nullif(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\s+', ' ', 'g'), '^ | $', '', 'g'), '') AS cleaned FROM pages")
def clean_html_text(spark, d):
    return table(spark, d, "pages").select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


@query(f"SELECT doc_id, array_to_string(list_slice(w, greatest(1, len(w) - k + 1), len(w)), ' ') AS tail FROM (SELECT doc_id, w, greatest(1, floor(len(w) * 0.15)::INT) AS k FROM (SELECT doc_id, {WORDS.format('text')} AS w FROM documents))")
def overlap_tails(spark, d):
    return table(spark, d, "documents").select("doc_id", text.overlap_prefix(F.col("text")).alias("tail"))


REFERS = "'see (doi.org/10.1/a' || doc_id || '). And (doi.org/10.2/b(' || doc_id || ')), arxiv.org/abs/2301.' || (10000 + doc_id) || ', https://pubmed.ncbi.nlm.nih.gov/' || (10000 + doc_id) || '/ pmc.ncbi.nlm.nih.gov/PMC' || doc_id || '; doi.org/10.1/a' || doc_id"


@query(
    "SELECT doc_id, unnest(['doi:10.1/a' || doc_id, 'doi:10.2/b(' || doc_id || ')', 'pmid:' || (10000 + doc_id), 'arxiv:2301.' || (10000 + doc_id), 'pmc:' || doc_id]) AS stub_id, unnest(['https://doi.org/10.1/a' || doc_id, 'https://doi.org/10.2/b(' || doc_id || ')', 'https://pubmed.ncbi.nlm.nih.gov/' || (10000 + doc_id) || '/', 'https://arxiv.org/abs/2301.' || (10000 + doc_id), 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || doc_id || '/']) AS url FROM documents"
)
def harvest_ids(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.inline(text.references(F.expr(REFERS))))
    return found.select("doc_id", "stub_id", "url")


@query("SELECT conv_id, string_agg(role, ' ' ORDER BY turn) AS speakers FROM (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) WHERE before IS NULL OR before <> role GROUP BY conv_id")
def caption_dedup(spark, d):
    lines = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("x"))
    srt = F.array_join(F.transform("x", lambda r, i: F.concat((i + 1).cast("string"), F.lit("\n00:00:01,000 --> 00:00:02,000\n<i>"), r["role"], F.lit("</i>\n"))), "\n")
    return lines.select("conv_id", text.srt_to_text(srt).alias("speakers"))


@query("SELECT doc_id, array_to_string(list_slice(w, 1, 12), ' ') AS abstract FROM (SELECT doc_id, list_transform(range(0, 12), lambda i: 'w' || ((doc_id * 7 + i * 5) % 12)) AS w FROM documents)")
def inverted_abstract(spark, d):
    placed = F.expr("transform(sequence(0, 11), i -> struct(concat('w', (doc_id * 7 + i * 5) % 12) AS word, array(CAST(i AS INT)) AS at))")
    return table(spark, d, "documents").select("doc_id", records.abstract_from_index(F.map_from_entries(placed)).alias("abstract"))


@query("SELECT vec_id, CASE WHEN k = 0 THEN 'Curie' WHEN k = 1 THEN 'Lovelace' ELSE 'Plato' END AS family, CASE WHEN k = 0 THEN 'Marie S.' WHEN k = 1 THEN 'Ada' END AS given FROM (SELECT vec_id, vec_id % 3 AS k FROM embeddings)")
def author_names(spark, d):
    name = F.expr("CASE vec_id % 3 WHEN 0 THEN 'Marie S. Curie' WHEN 1 THEN 'Ada Lovelace' ELSE 'Plato' END")
    return table(spark, d, "embeddings").select("vec_id", records.split_name(name).alias("n")).select("vec_id", "n.family", "n.given")


# --- merges

INCOMING = """incoming AS (SELECT id AS old_id, (id % 40) * 1000 + id AS seq, CASE WHEN id % 2 = 0 THEN url ELSE url || '/new' END AS url, 'new ' || title AS title, description, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN content_body ELSE 'changed ' || coalesce(content_body, '') END AS content_body, CASE WHEN id % 5 = 0 THEN NULL ELSE id % 3 END::INT AS authority_tier, ['adhd', 'new'] AS domain_tags, surface_key, CAST(NULL AS VARCHAR) AS doi, collected_at FROM items WHERE id % 3 <> 1
UNION ALL SELECT id, (id % 40) * 1000 + id + 500000, url || '/new', 'later ' || title, NULL, NULL, 2, ['zeta'], surface_key, NULL, collected_at FROM items WHERE id % 7 = 3)"""


def incoming(spark: SparkSession, d: str) -> DataFrame:
    i = corpus.items(spark, d)
    a = i.where("id % 3 <> 1").selectExpr(
        "(id % 40) * 1000 + id AS seq", "CASE WHEN id % 2 = 0 THEN url ELSE concat(url, '/new') END AS url", "concat('new ', title) AS title", "description", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN content_body ELSE concat('changed ', coalesce(content_body, '')) END AS content_body",
        "CAST(CASE WHEN id % 5 = 0 THEN NULL ELSE id % 3 END AS INT) AS authority_tier", "array('adhd', 'new') AS domain_tags", "surface_key", "CAST(NULL AS STRING) AS doi", "collected_at",
    )
    b = i.where("id % 7 = 3").selectExpr("(id % 40) * 1000 + id + 500000 AS seq", "concat(url, '/new') AS url", "concat('later ', title) AS title", "CAST(NULL AS STRING) AS description", "CAST(NULL AS STRING) AS content_body", "2 AS authority_tier", "array('zeta') AS domain_tags", "surface_key", "CAST(NULL AS STRING) AS doi", "collected_at")
    return a.unionByName(b)


KEPT = ["id", "url", "title", "description", "content_body", "authority_tier", "domain_tags", "surface_key", "doi", "collected_at"]


@query(
    "SELECT url, arg_min_null(id, seq) AS id, arg_min_null(title, seq) AS title, arg_max_null(description, seq) AS description, sha256(max_by(content_body, seq) FILTER (WHERE content_body IS NOT NULL)) AS body_hash, arg_max_null(authority_tier, seq) AS authority_tier, array_to_string(list_sort(list_distinct(flatten(list(domain_tags) FILTER (WHERE domain_tags IS NOT NULL)))), ',') AS tags, arg_min_null(doi, seq) AS doi FROM (SELECT -1 AS seq, id, url, title, description, content_body, authority_tier, domain_tags, doi FROM items UNION ALL SELECT seq, NULL, url, title, description, content_body, authority_tier, domain_tags, doi FROM incoming) GROUP BY url",
    ITEMS, INCOMING,
)
def merge_items(spark, d):
    new = merge.merge_items(corpus.items(spark, d).select(*KEPT), incoming(spark, d))
    return new.select("url", "id", "title", "description", F.sha2("content_body", 256).alias("body_hash"), "authority_tier", F.array_join("domain_tags", ",").alias("tags"), "doi")


@query(ORACLES["merge_items"])
def merge_items_in_buckets(spark, d):
    """The same merge into a store of buckets: the items loaded, then two batches, each into the buckets of its keys."""
    rows = incoming(spark, d)
    store = ItemStore(spark, work_path(spark, "items"), corpus.items(spark, d).select(*KEPT).schema, buckets=64)
    store.load(corpus.items(spark, d).select(*KEPT))
    middle = 500_000
    store.merge(rows.where(F.col("seq") < middle), 1)
    store.merge(rows.where(F.col("seq") >= middle), 2)
    return store.read("items").select("url", "id", "title", "description", F.sha2("content_body", 256).alias("body_hash"), "authority_tier", F.array_join("domain_tags", ",").alias("tags"), "doi")


@query(
    "SELECT seq, url, doi FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY seq) AS rn FROM (SELECT id AS seq, url || '/b' AS url, '10.1000/x' || (id % 500) AS doi FROM items WHERE id % 2 = 1) b WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.doi = b.doi AND i.url <> b.url)) WHERE rn = 1",
    ITEMS,
)
def doi_conflicts(spark, d):
    i = corpus.items(spark, d)
    return merge.one_per_doi(i.select("url", "doi"), i.where("id % 2 = 1").selectExpr("id AS seq", "concat(url, '/b') AS url", "concat('10.1000/x', id % 500) AS doi"))


@query("SELECT surface_key, array_to_string(list_sort(list_distinct(flatten(list(domain_tags)))), ',') AS tags FROM items WHERE domain_tags IS NOT NULL GROUP BY surface_key", ITEMS)
def tag_union(spark, d):
    return corpus.items(spark, d).groupBy("surface_key").agg(F.array_join(merge.union_tags(F.col("domain_tags")), ",").alias("tags"))


@query(
    "SELECT o.url, o.h AS old_hash, n.h AS new_hash, o.h IS DISTINCT FROM n.h AS changed FROM (SELECT url, CASE WHEN content_body <> '' THEN sha256(content_body) END AS h FROM items) o JOIN (SELECT url, CASE WHEN content_body <> '' THEN sha256(content_body) END AS h FROM incoming WHERE NOT ends_with(url, '/new')) n USING (url)",
    ITEMS, INCOMING,
)
def content_hash_change(spark, d):
    return merge.changed_hashes(corpus.items(spark, d), incoming(spark, d))


@query(
    "SELECT coalesce(s.key, f.key) AS key, coalesce(f.platform, s.platform) AS platform, coalesce(f.authority_tier, CASE WHEN f.key IS NULL THEN s.authority_tier END) AS authority_tier, coalesce(s.consecutive_fails, 0) AS consecutive_fails, s.last_run_at FROM surfaces s FULL JOIN (SELECT CASE WHEN n % 2 = 0 THEN key ELSE key || '_new' END AS key, 'rss' AS platform, CAST(n % 2 + 1 AS INT) AS authority_tier FROM (SELECT key, CAST(substring(key, 4) AS INT) AS n FROM surfaces) WHERE n < 15) f ON f.key = s.key",
    SURFACES,
)
def catalog_merge(spark, d):
    s = corpus.surfaces(spark, d)
    n = s.withColumn("n", F.expr("CAST(substring(key, 4) AS INT)")).where("n < 15")
    catalog = n.selectExpr("CASE WHEN n % 2 = 0 THEN key ELSE concat(key, '_new') END AS key", "'rss' AS platform", "1 AS enabled", "CAST(NULL AS INT) AS poll_interval_sec", "CAST(NULL AS INT) AS max_items", "'{\"base_url\": \"https://a.example\"}' AS config", "CAST(n % 2 + 1 AS INT) AS authority_tier", "CAST(NULL AS STRING) AS source_type", "CAST(NULL AS STRING) AS audience_type", "CAST(NULL AS STRING) AS language", "CAST(NULL AS STRING) AS country", "CAST(NULL AS STRING) AS organization_name", "domain_tags", "domain_tags AS topic_tags")
    from millrace import schemas

    return merge.refresh_surfaces(schemas.conform(s, schemas.SURFACES), catalog).select("key", "platform", "authority_tier", "consecutive_fails", F.col("last_run_at").cast("timestamp_ntz").alias("last_run_at"))


@query("SELECT i.id, coalesce(i.authority_tier, s.authority_tier) AS authority_tier FROM items i LEFT JOIN surfaces s ON s.key = i.surface_key", ITEMS, SURFACES)
def tier_backfill(spark, d):
    return merge.fill_from(corpus.items(spark, d), corpus.surfaces(spark, d)).select("id", "authority_tier")


@query("SELECT i.id, s.authority_tier, array_to_string(s.domain_tags, ',') AS tags FROM items i LEFT JOIN surfaces s ON s.key = i.surface_key", ITEMS, SURFACES)
def stamped_items(spark, d):
    from millrace import schemas

    return merge.stamp(corpus.items(spark, d), schemas.conform(corpus.surfaces(spark, d), schemas.SURFACES)).select("id", "authority_tier", F.array_join("domain_tags", ",").alias("tags"))


@query("SELECT parent_item_id, chunk_index, 'old' AS version FROM chunks WHERE parent_item_id % 7 <> 0 UNION ALL SELECT parent_item_id, chunk_index, 'new' FROM (SELECT parent_item_id, chunk_index + 1 AS chunk_index FROM chunks WHERE parent_item_id % 14 = 0) UNION ALL SELECT parent_item_id, 9, 'new' FROM chunks WHERE chunk_index = -1 AND parent_item_id % 5 = 1", CHUNKS)
def chunk_replacement(spark, d):
    c = corpus.chunks(spark, d).select("parent_item_id", "chunk_index", F.lit("old").alias("version"))
    again = c.where("parent_item_id % 7 = 0")
    new = c.where("parent_item_id % 14 = 0").select("parent_item_id", F.expr("chunk_index + 1 AS chunk_index"), F.lit("new").alias("version")).union(c.where("chunk_index = -1 AND parent_item_id % 5 = 1").select("parent_item_id", F.lit(9), F.lit("new")))
    return merge.replace_chunks(c, new, again)


@query("SELECT DISTINCT url FROM (SELECT url FROM incoming) WHERE url NOT IN (SELECT url FROM items)", ITEMS, INCOMING)
def unknown_links(spark, d):
    return merge.known_links(incoming(spark, d).select("url", F.col("seq").alias("position")), corpus.items(spark, d)).select("url")


@query("SELECT domain, authority_tier, key FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY authority_tier, key) AS rn FROM surfaces WHERE authority_tier IS NOT NULL) WHERE rn = 1", SURFACES)
def domain_best_metadata(spark, d):
    return queues.best_sources(corpus.surfaces(spark, d)).select("domain", "authority_tier", "key")


# --- near-duplicates

RUN_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(lower(content_body), '[^a-z0-9\s]', '', 'g'), '\s+'), lambda w: w <> '')"
PRINTS = (
    f"worded AS (SELECT id, {RUN_WORDS} AS w FROM items WHERE length(content_body) >= 100), "
    "runs AS (SELECT id, pos, w[pos] || ' ' || w[pos + 1] || ' ' || w[pos + 2] AS run FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS pos FROM worded WHERE len(w) >= 3)), "
    "top AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, pos) AS place FROM (SELECT id, run, count(*) AS n, min(pos) AS pos FROM runs GROUP BY id, run) QUALIFY place <= 50), "
    "prints AS (SELECT id, list(run ORDER BY place) AS fingerprint FROM top GROUP BY id)"
)


@query("SELECT id, len(fingerprint)::INT AS n, md5(array_to_string(fingerprint, '|')) AS digest FROM prints", ITEMS, PRINTS)
def fingerprint(spark, d):
    return dedup.fingerprints(corpus.items(spark, d)).select("id", F.size("fingerprint").alias("n"), F.md5(F.array_join("fingerprint", "|").cast("binary")).alias("digest"))


@query(
    "SELECT a AS id, min(b) AS original FROM (SELECT a, b FROM (SELECT DISTINCT x.id AS a, y.id AS b FROM top x JOIN top y ON x.run = y.run AND y.id < x.id WHERE x.place <= 10 AND x.id IN (SELECT id FROM prints WHERE len(fingerprint) >= 10)) p JOIN prints pa ON pa.id = p.a JOIN prints pb ON pb.id = p.b WHERE len(list_intersect(pa.fingerprint, pb.fingerprint)) / len(list_distinct(list_concat(pa.fingerprint, pb.fingerprint))) > 0.7) GROUP BY a",
    ITEMS, PRINTS,
)
def near_duplicates(spark, d):
    """Fingerprints are made once and written: every branch of the join reads them."""
    path = work_path(spark, "prints")
    dedup.fingerprints(corpus.items(spark, d)).write.parquet(path)
    return dedup.near_duplicates(spark.read.parquet(path))


@query(ORACLES["near_duplicates"])
def near_duplicates_by_batches(spark, d):
    """The same links from an index that takes the items in three batches."""
    index, items = LinkIndex(spark, work_path(spark, "links"), buckets=32), corpus.items(spark, d)
    for number in range(3):
        index.add(dedup.fingerprints(items.where(F.pmod(F.xxhash64("id"), F.lit(3)) == number)), number)
    return index.links().withColumnRenamed("key", "id")


# --- state

LAST_DAY = "CAST('2024-01-06 00:00:00' AS TIMESTAMP)"


@query(
    f"SELECT domain, CASE WHEN bool_or(ok) THEN 0 ELSE count(*) FILTER (WHERE http_status = 403) END::INT AS consecutive_403_count, NOT bool_or(ok) AND min(before) <= {NOW} - INTERVAL 24 HOUR AS given_up, bool_or(ok) OR bool_or(ever) AS ever_succeeded FROM (SELECT f.*, CASE WHEN seen_at < {LAST_DAY} THEN seen_at END AS before, false AS ever FROM fetches f) GROUP BY domain HAVING NOT bool_or(ok)",
    FETCHES,
)
def give_up_domains(spark, d):
    """Domains that no fetch reached: the state after the first days' fetches, then after all later ones."""
    f = corpus.fetches(spark, d)
    early, late = f.where(f"seen_at < {LAST_DAY.replace('AS TIMESTAMP', 'AS TIMESTAMP_NTZ')}"), f.where(f"seen_at >= {LAST_DAY.replace('AS TIMESTAMP', 'AS TIMESTAMP_NTZ')}")
    none = spark.createDataFrame([], "domain string, consecutive_403_count int, given_up boolean, given_up_at timestamp_ntz, last_checked_at timestamp_ntz, ever_succeeded boolean, first_failure_at timestamp_ntz")
    first = state.domain_states(none, state.tally(early), F.to_timestamp_ntz(F.lit("2024-01-06 00:00:00")))
    after = merge.merge_blocked(first, state.domain_states(first, state.tally(late), as_of()))
    return after.where("NOT ever_succeeded").select("domain", "consecutive_403_count", "given_up", "ever_succeeded")


@query("SELECT domain, bool_or(ok) AS succeeded, bool_or(NOT ok) AS failed, count(*) FILTER (WHERE http_status = 403)::INT AS refused FROM fetches GROUP BY domain", FETCHES)
def domain_tally(spark, d):
    return state.tally(corpus.fetches(spark, d))


RETRY = "CASE error_note WHEN 'http_403' THEN 30 WHEN 'fetch_failed' THEN 1 WHEN 'extract_failed' THEN 1 WHEN 'classifier_unavailable' THEN 1 END"


@query(f"SELECT id, retry_count + 1 AS retry_count, CASE WHEN retry_count + 1 < 5 THEN {NOW} + to_days({RETRY}) END AS next_retry_at, CASE error_note WHEN 'http_404' THEN 404 WHEN 'http_403' THEN 403 END AS last_http_status FROM requests", REQUESTS)
def retry_schedule(spark, d):
    r = corpus.requests(spark, d)
    return r.select("id", records.retry_count(F.col("retry_count")).alias("retry_count"), records.next_retry(F.col("error_note"), F.col("retry_count"), as_of()).alias("next_retry_at"), records.status_of_reason(F.col("error_note")).alias("last_http_status"))


@query(f"SELECT id, CASE WHEN status = 'processing' AND discovered_at < {NOW} - INTERVAL 10 MINUTE THEN 'pending' ELSE status END AS status FROM requests", REQUESTS)
def lease_recovery(spark, d):
    return state.recover_leases(corpus.requests(spark, d), as_of()).select("id", "status")


@query(f"SELECT id, CASE WHEN late THEN 'failed' ELSE status END AS status, CASE WHEN late THEN 'stale_ttl_exceeded' ELSE error_note END AS error_note FROM (SELECT *, status = 'pending' AND discovered_at < {NOW} - INTERVAL 14 DAY AS late FROM requests)", REQUESTS)
def ttl_expiry(spark, d):
    return state.expire(corpus.requests(spark, d), as_of()).select("id", "status", "error_note")


@query("SELECT key, CASE WHEN n % 3 = 0 THEN 'error' WHEN n % 3 = 1 AND n % 2 = 0 THEN 'empty' WHEN n % 3 = 1 THEN 'ok' ELSE 'before' END AS last_status, CASE WHEN n % 3 = 0 THEN consecutive_fails + 1 WHEN n % 3 = 1 THEN 0 ELSE consecutive_fails END AS consecutive_fails, CASE WHEN n % 3 = 1 THEN 'next' ELSE 'old' END AS last_cursor FROM (SELECT *, CAST(substring(key, 4) AS INT) AS n FROM surfaces)", SURFACES)
def run_outcomes(spark, d):
    s = corpus.surfaces(spark, d).withColumns({"last_status": F.lit("before"), "last_cursor": F.lit("old"), "n": F.expr("CAST(substring(key, 4) AS INT)")})
    ran = s.where("n % 3 <> 2").select("key", F.when(F.expr("n % 3 = 1"), F.expr("n % 2")).alias("items"), F.lit("next").alias("cursor"), F.when(F.expr("n % 3 = 0"), "boom").alias("error"))
    return state.after_runs(s, ran, as_of()).select("key", "last_status", "consecutive_fails", "last_cursor")


@query("SELECT id, CASE WHEN id % 2 = 0 AND fetch_attempts + 1 >= 3 THEN 'give_up' WHEN id % 2 = 0 THEN 'retry' WHEN id % 7 = 0 THEN 'give_up' WHEN content_body IS NULL OR content_body = '' THEN 'give_up' WHEN length(content_body) < 300 OR " + contains_any("content_body", text.PAYWALL) + " THEN 'give_up' ELSE 'body' END AS action FROM items", ITEMS)
def fulltext_decisions(spark, d):
    i = corpus.items(spark, d)
    result = lifecycle.fulltext_result(F.when(F.expr("id % 2 = 0"), "fetch_failed").otherwise("ok"), F.when(F.expr("id % 7 = 0"), "reject").otherwise("html"), F.col("content_body"), F.col("fetch_attempts"), F.lit(False))
    return i.select("id", result["action"].alias("action"))


@query("SELECT event_id, CASE http_status WHEN 200 THEN 'ok' WHEN 403 THEN 'forbidden' WHEN 404 THEN 'not_found' ELSE 'retry' END AS outcome FROM fetches", FETCHES)
def http_outcomes(spark, d):
    return corpus.fetches(spark, d).select("event_id", state.http_outcome(F.col("http_status")).alias("outcome"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_activity(spark, d):
    from millrace.streaming.ingest import activity

    return activity(table(spark, d, "events")).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


# --- retrieval

DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"
COSINE = f"round({DOT.format('v.embedding', 'q.embedding')} / (sqrt({DOT.format('v.embedding', 'v.embedding')}) * sqrt({DOT.format('q.embedding', 'q.embedding')})), 6)"


@query(f"SELECT v.vec_id, {COSINE} AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 7) q ORDER BY score DESC, vec_id LIMIT 10")
def vector_topk(spark, d):
    e = table(spark, d, "embeddings")
    return search.vector_topk(e, e.where("vec_id = 7").first()["embedding"], 10, "vec_id")


@query(
    f"SELECT query_id, id, score, rank::INT AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id AS id, {COSINE} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {COSINE} DESC, v.vec_id) AS rank "
    "FROM embeddings v, (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0) q) WHERE rank <= 5"
)
def vector_topk_many(spark, d):
    e = table(spark, d, "embeddings")
    return search.vector_topk_many(e, stated_queries(e), 5, "vec_id")


def stated_queries(e: DataFrame) -> DataFrame:
    """The vectors that are searched for: every one whose id is divisible by 20."""
    return e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


def vector_index(spark, d):
    """The stored list index of the vectors and its centres, built once for a session and state of the table."""

    def build(path: str):
        e = table(spark, d, "embeddings")
        centres = search.list_centres(e, id_col="vec_id")
        index = search.ann_index(e, centres, "vec_id")
        index.repartition("list").write.mode("overwrite").partitionBy("list").parquet(path)
        return spark.read.schema(index.schema).parquet(path), centres

    return once(spark, f"{d}/embeddings.parquet", "vectors", build)


@query()
def ann_topk(spark, d):
    index, centres = vector_index(spark, d)
    return search.ann_topk(index, stated_queries(table(spark, d, "embeddings")), centres, 10)


def vector_graph(spark: SparkSession, d: str) -> DataFrame:
    """The graph index of the vectors, stored once."""

    def build(path: str) -> DataFrame:
        graph_index.graph_index(table(spark, d, "embeddings"), "vec_id").write.parquet(path)
        return spark.read.parquet(path)

    return once(spark, f"{d}/embeddings.parquet", "vector-graph", build)


@query()
def graph_topk(spark, d):
    return graph_index.graph_topk(vector_graph(spark, d), stated_queries(table(spark, d, "embeddings")), 10)


TERMS = rf"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\pL\pN\pM\p{{Pc}}]+', ' ', 'g'), '\s+'), lambda w: w <> '' AND w NOT IN ({strings(search.STOP_WORDS)}))"
POSTINGS = f"worded AS (SELECT doc_id, {TERMS} AS w FROM documents), postings AS (SELECT term, doc_id, len, count(*) AS tf FROM (SELECT doc_id, len(w)::INT AS len, unnest(w) AS term FROM worded) GROUP BY ALL)"


@query("SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM postings GROUP BY term", POSTINGS)
def inverted_index(spark, d):
    p = search.inverted_index(table(spark, d, "documents"), "doc_id")
    return p.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


WANTED = ["anea", "thtion", "erre"]


def text_index(spark, d, stem: bool = False) -> search.TextIndex:
    """The stored postings of the documents, built once for a session and state of the table."""
    return once(spark, f"{d}/documents.parquet", f"postings-{stem}", lambda path: search.TextIndex(table(spark, d, "documents"), path, "doc_id", stem=stem))


@query(
    f"SELECT doc_id, round(sum(ln(1 + ((SELECT count(*) FROM worded) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / (SELECT avg(len(w)) FROM worded)))), 6) AS score FROM postings "
    f"JOIN (SELECT term, count(*) AS df FROM postings WHERE term IN ({strings(WANTED)}) GROUP BY term) USING (term) GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10",
    POSTINGS,
)
def bm25_topk(spark, d):
    return text_index(spark, d).topk(WANTED)


@query()
def stemmed_topk(spark, d):
    return text_index(spark, d, stem=True).topk(WANTED)


BOTH_WORDS = f"SELECT doc_id FROM worded WHERE {' AND '.join(f'list_contains(w, {strings([t])})' for t in WANTED[:2])}"


@query(BOTH_WORDS, POSTINGS)
def keyword_scan(spark, d):
    return search.keyword_scan(table(spark, d, "documents"), WANTED[:2], "doc_id")


@query(BOTH_WORDS, POSTINGS)
def keyword_lookup(spark, d):
    return text_index(spark, d).lookup(WANTED[:2])


@query(f"SELECT v.vec_id, {COSINE} AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 7) q WHERE v.label IN (SELECT label FROM (SELECT label, {COSINE} AS s FROM (SELECT label, embedding FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1) v, (SELECT embedding FROM embeddings WHERE vec_id = 7) q ORDER BY s DESC, label LIMIT 3)) ORDER BY score DESC, vec_id LIMIT 10")
def two_stage_retrieval(spark, d):
    e = table(spark, d, "embeddings")
    summaries = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return search.two_stage(summaries, e, e.where("vec_id = 7").first()["embedding"], 3, 10, "label", "vec_id")


# --- row-wise extraction that SQL can't state

TOKENS = f"((4 * len({WORDS})) // 3)"
SQL_TAIL = f"array_to_string(list_slice({WORDS}, greatest(1, len({WORDS}) - greatest(1, floor(len({WORDS}) * 0.15)::INT) + 1), len({WORDS})), ' ')"
CHUNK_STEP = (
    "{'done': a.done || CASE WHEN a.n > 0 AND a.n + x.n > 1000 THEN [a.s] ELSE [] END || CASE WHEN x.n > 1000 THEN [x.s] ELSE [] END, "
    "'s': CASE WHEN x.n > 1000 THEN '' WHEN a.n = 0 THEN x.s WHEN a.n + x.n > 1000 THEN " + SQL_TAIL.format("a.s") + " || ' ' || x.s ELSE a.s || ' ' || x.s END, "
    "'n': CASE WHEN x.n > 1000 THEN 0 WHEN a.n > 0 AND a.n + x.n > 1000 THEN " + TOKENS.format(f"({SQL_TAIL.format('a.s')})") + " + x.n ELSE a.n + x.n END}"
)


@query(
    "SELECT doc_id, unnest(range(len(parts)))::INT AS chunk_index, unnest(parts) AS chunk_text FROM ("
    f"SELECT doc_id, list_reduce(list_transform(done || CASE WHEN n > 0 THEN [s] ELSE [] END, lambda c: [c]), lambda o, c: CASE WHEN {TOKENS.format('c[1]')} < 200 THEN o[:-2] || [o[-1] || ' ' || c[1]] ELSE o || c END) AS parts FROM ("
    f"SELECT doc_id, unnest(list_reduce([{{'done': []::VARCHAR[], 's': '', 'n': 0::BIGINT}}] || segments, lambda a, x: {CHUNK_STEP})) FROM ("
    rf"SELECT doc_id, list_transform(flatten(list_transform(list_filter(list_transform(regexp_split_to_array(text, '\n\n+'), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> ''), lambda p: CASE WHEN {TOKENS.format('p')} > 1000 THEN string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) ELSE [p] END)), lambda s: {{'done': []::VARCHAR[], 's': s, 'n': {TOKENS.format('s')}::BIGINT}}) AS segments FROM documents WHERE text IS NOT NULL))) WHERE len(parts) > 0"
)
def chunk_documents(spark, d):
    return chunking.with_chunks(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "chunk_index", "chunk_text")


@query()
def document_languages(spark, d):
    """The language of every document, by profiles fitted on four fifths of the labelled ones (a bounded sample of them)."""
    docs = table(spark, d, "documents")
    model = language.fit(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    return docs.select("doc_id", language.detect(F.col("text"), model).alias("language"))


@query()
def html_bodies(spark, d):
    return table(spark, d, "pages").select("page_id", html.extract_body(F.col("html")).alias("body"))


@query()
def html_sections(spark, d):
    return table(spark, d, "pages").select("page_id", F.inline_outer(html.extract_sections(F.col("html")))).where("text IS NOT NULL")


@query()
def page_links(spark, d):
    from millrace.sources.frontier import links

    return links(table(spark, d, "pages").select("url", F.col("html").alias("body")))
