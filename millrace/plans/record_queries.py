"""More registered queries: decisions, lists, parsers and row-wise functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, records, text, urls
from millrace.operators import lifecycle, merge, state
from millrace.plans import corpus, views
from millrace.plans.corpus import FETCHES, ITEMS, REQUESTS, SURFACES, as_of, table
from millrace.plans.queries import NETLOC, NOW, PATH, query


@query("SELECT id, CASE WHEN length(title) > 80 THEN substring(title, 1, 80) || '…' ELSE title END AS title, source, url, collected_at FROM items WHERE source = 'sitemap' AND (contains(lower(title), 'th') OR contains(lower(coalesce(doi, '')), 'th') OR contains(lower(url), 'th')) ORDER BY collected_at DESC NULLS LAST, id LIMIT 100", ITEMS)
def item_list(spark, d):
    return views.item_list(corpus.items(spark, d).withColumn("author", F.lit(None).cast("string")), "TH", source="sitemap")


@query("SELECT key, consecutive_fails FROM surfaces ORDER BY consecutive_fails DESC, platform, key", SURFACES)
def source_list(spark, d):
    return views.source_list(corpus.surfaces(spark, d).withColumn("last_status", F.col("platform"))).select("key", "consecutive_fails")


@query(
    "SELECT key, fault FROM (SELECT CASE WHEN n = 7 THEN 'src6' ELSE key END AS key, n FROM (SELECT key, CAST(substring(key, 4) AS INT) AS n FROM surfaces)) s, (VALUES ('unknown platform'), ('no address'), ('disabled without reason'), ('tier'), ('source type'), ('domain tag')) f(fault) WHERE (fault = 'unknown platform' AND n % 5 = 0) OR (fault = 'no address' AND n % 5 = 1) OR (fault = 'disabled without reason' AND n % 4 = 1) OR (fault = 'tier' AND n % 6 = 3) OR (fault = 'source type' AND n % 7 = 2) OR (fault = 'domain tag' AND n % 8 = 3) UNION ALL SELECT 'src6', 'key repeats'",
    SURFACES,
)
def catalog_integrity(spark, d):
    from millrace.sources.payloads import READERS

    n = corpus.surfaces(spark, d).select("key", F.expr("CAST(substring(key, 4) AS INT)").alias("n"))
    catalog = n.select(
        F.when(F.col("n") == 7, "src6").otherwise(F.col("key")).alias("key"), F.expr("CASE n % 5 WHEN 0 THEN 'nothing' WHEN 1 THEN 'html_pages' ELSE 'rss' END").alias("platform"), F.expr("CASE WHEN n % 4 < 2 THEN 0 ELSE 1 END").alias("enabled"), F.expr("CASE WHEN n % 4 = 0 THEN 'DISABLED: gone' END").alias("content_notes"),
        F.lit("{}").alias("config"), F.expr("CASE WHEN n % 6 = 3 THEN 3 ELSE 1 END").alias("authority_tier"), F.expr("CASE WHEN n % 7 = 2 THEN 'odd' ELSE 'academic' END").alias("source_type"), F.lit("mixed").alias("audience_type"), F.expr("CASE WHEN n % 8 = 3 THEN array('sleep', 'odd') ELSE array('adhd') END").alias("domain_tags"),
    )
    return views.catalog_faults(catalog, list(READERS))


@query("SELECT id, CASE WHEN id % 3 = 0 AND content_body <> '' THEN 'body' WHEN fetch_attempts + 1 >= 3 THEN 'give_up' ELSE 'retry' END AS action, CASE WHEN id % 3 = 0 AND content_body <> '' THEN fetch_attempts ELSE fetch_attempts + 1 END AS attempts FROM items", ITEMS)
def no_doi_decisions(spark, d):
    i = corpus.items(spark, d)
    r = lifecycle.no_doi_result(F.when(F.expr("id % 3 = 0"), F.col("content_body")), F.col("fetch_attempts"))
    return i.select("id", r["action"].alias("action"), r["attempts"].alias("attempts"))


@query(
    "SELECT page_id, CASE WHEN NOT (host = 'example.com' OR ends_with(host, '.example.com')) THEN 'failed' WHEN page_id % 7 = 0 THEN 'already_known' WHEN page_id % 5 IN (1, 2, 3) OR page_id % 11 = 0 THEN 'failed' ELSE 'landed' END AS outcome, CASE WHEN NOT (host = 'example.com' OR ends_with(host, '.example.com')) THEN 'not_allowlisted' WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 1 THEN 'http_404' WHEN page_id % 5 = 2 THEN 'http_403' WHEN page_id % 5 = 3 THEN 'fetch_failed' WHEN page_id % 11 = 0 THEN 'extract_failed' END AS reason FROM (SELECT page_id, regexp_replace(regexp_extract(url, '://([^/?#]*)', 1), '^www\\.', '') AS host FROM pages)"
)
def landing_decisions(spark, d):
    status = F.expr("CASE page_id % 5 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 500 ELSE 200 END")
    r = lifecycle.landing_result(F.col("url"), F.lit("example.com"), F.expr("page_id % 7 = 0"), status, F.expr("CASE WHEN page_id % 11 = 0 THEN 'image/png' ELSE 'text/html' END"), F.lit("t"), F.col("html"))
    return table(spark, d, "pages").select("page_id", r["outcome"].alias("outcome"), r["reason"].alias("reason"))


@query(
    "SELECT id, CASE WHEN id % 3 = 0 THEN CASE WHEN id % 2 = 0 THEN 'done' ELSE 'failed' END WHEN id % 13 = 0 THEN 'out_of_scope' WHEN id % 5 = 0 THEN 'failed' WHEN id % 4 <> 1 THEN 'out_of_scope' WHEN id % 2 = 0 THEN 'done' ELSE 'failed' END AS outcome, CASE WHEN id % 3 = 0 THEN CASE WHEN id % 2 = 1 THEN 'http_404' END WHEN id % 13 = 0 THEN 'daily_cap' WHEN id % 5 = 0 THEN 'classifier_unavailable' WHEN id % 4 <> 1 THEN 'because' WHEN id % 2 = 1 THEN 'http_404' END AS reason FROM requests",
    REQUESTS,
)
def request_decisions(spark, d):
    verdict = F.when(F.expr("id % 5 <> 0"), F.struct(F.expr("CAST(id % 4 AS INT)").alias("tier"), F.expr("CASE WHEN id % 4 = 1 THEN 'high' ELSE 'low' END").alias("confidence"), F.lit("because").alias("reason")))
    landed = F.struct(F.expr("CASE WHEN id % 2 = 0 THEN 'landed' ELSE 'failed' END").alias("outcome"), F.expr("CASE WHEN id % 2 = 1 THEN 'http_404' END").alias("reason"))
    r = lifecycle.request_result(F.expr("id % 3 = 0"), F.expr("CASE WHEN id % 13 = 0 THEN 5 ELSE 0 END"), verdict, F.lit(True), landed)
    return corpus.requests(spark, d).select("id", r["outcome"].alias("outcome"), r["reason"].alias("reason"))


@query(
    f"SELECT id, CASE WHEN id % 2 = 0 THEN CASE WHEN id % 3 = 0 THEN 'done' ELSE 'failed' END ELSE status END AS status, CASE WHEN id % 2 = 0 AND id % 3 = 0 THEN NULL WHEN id % 2 = 0 THEN 'fetch_failed' ELSE error_note END AS error_note, CASE WHEN id % 2 = 0 AND id % 3 <> 0 THEN retry_count + 1 ELSE retry_count END AS retry_count, CASE WHEN id % 2 = 0 THEN CASE WHEN id % 3 <> 0 AND retry_count + 1 < 5 THEN {NOW} + INTERVAL 1 DAY END ELSE next_retry_at END AS next_retry_at FROM requests",
    REQUESTS,
)
def finished_requests(spark, d):
    r = corpus.requests(spark, d).withColumn("last_http_status", F.lit(None).cast("int"))
    outcomes = r.where("id % 2 = 0").select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'done' ELSE 'failed' END").alias("outcome"), F.expr("CASE WHEN id % 3 <> 0 THEN 'fetch_failed' END").alias("reason"))
    return state.finish(r, outcomes, as_of()).select("id", "status", "error_note", "retry_count", "next_retry_at")


@query("SELECT id, CASE WHEN id % 3 = 0 THEN id % 2 = 0 ELSE open_access END AS open_access, CASE WHEN id % 3 = 0 THEN CASE WHEN id % 2 = 0 THEN CASE WHEN id % 4 = 0 THEN 'pdf' ELSE 'page' END END ELSE oa_url END AS oa_url FROM items", ITEMS)
def open_access_results(spark, d):
    i = corpus.items(spark, d)
    checks = i.where("id % 3 = 0").select("id", F.expr("id % 2 = 0").alias("is_oa"), F.expr("CASE WHEN id % 4 = 0 THEN 'pdf' END").alias("pdf_url"), F.lit("page").alias("landing_url"))
    return lifecycle.write_open_access(i, checks).select("id", "open_access", "oa_url")


@query(f"SELECT id, CASE WHEN id % 4 = 0 THEN {NOW} ELSE last_harvested_at END AS last_harvested_at FROM items", ITEMS)
def harvest_marks(spark, d):
    i = corpus.items(spark, d)
    return lifecycle.mark_harvested(i, i.where("id % 4 = 0"), as_of()).select("id", "last_harvested_at")


@query("SELECT id, CASE WHEN id % 6 = 0 THEN 'filled' ELSE description END AS description FROM items", ITEMS)
def stub_fill(spark, d):
    i = corpus.items(spark, d)
    return merge.fill_stubs(i, i.where("id % 6 = 0").select("id", F.lit("filled").alias("description"))).select("id", "description")


@query("SELECT id, array_to_string(coalesce(domain_tags, ['general']), ',') AS tags FROM items", ITEMS)
def default_tags(spark, d):
    return merge.default_tags(corpus.items(spark, d), "general").select("id", F.array_join("domain_tags", ",").alias("tags"))


@query("SELECT action, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'retry' WHEN event_type = 'view' THEN 'give_up' ELSE 'body' END AS action FROM events) GROUP BY action")
def outcome_counts(spark, d):
    return lifecycle.outcome_counts(table(spark, d, "events").select(F.expr("CASE WHEN event_type = 'error' THEN 'retry' WHEN event_type = 'view' THEN 'give_up' ELSE 'body' END").alias("action")))


@query("SELECT domain FROM (SELECT domain FROM fetches GROUP BY domain HAVING count(*) FILTER (WHERE http_status = 403) > 20 UNION SELECT 'manual.example.org')", FETCHES)
def skipped_domains(spark, d):
    states = state.tally(corpus.fetches(spark, d)).select("domain", (F.col("refused") > 20).alias("given_up"))
    return state.skipped_domains(states, spark.createDataFrame([("manual.example.org",)], "domain string"))


@query("SELECT key AS name, (date_diff('microsecond', last_run_at, TIMESTAMP '2024-01-31 00:00:00') / 1000000)::DOUBLE AS age_s, (poll_interval_sec * 3)::DOUBLE AS most_s, date_diff('microsecond', last_run_at, TIMESTAMP '2024-01-31 00:00:00') / 1000000 > poll_interval_sec * 3 AS stuck FROM surfaces", SURFACES)
def liveness(spark, d):
    beats = corpus.surfaces(spark, d).select(F.col("key").alias("name"), F.col("last_run_at").alias("beat_at"), F.col("poll_interval_sec").alias("interval_s"), F.lit(None).cast("double").alias("multiplier"))
    return state.stuck(beats, as_of())


@query("SELECT url_hash, etag FROM (SELECT sha256(url) AS url_hash, 'e' || page_id AS etag, row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS rn FROM pages) WHERE rn = 1")
def cache_entries(spark, d):
    pages = table(spark, d, "pages")
    rows = pages.select(urls.cache_key(F.col("url")).alias("url_hash"), F.concat(F.lit("e"), F.col("page_id")).alias("etag"), F.col("page_id").alias("seq"))
    return merge.cache_put(rows.where("seq < 0").drop("seq"), rows)


@query("SELECT key, 'stored' AS origin FROM surfaces UNION ALL SELECT DISTINCT 'discovery_' || domain || '_sleep', 'new' FROM surfaces WHERE list_contains(domain_tags, 'sleep')", SURFACES)
def synthetic_sources(spark, d):
    s = corpus.surfaces(spark, d)
    new = s.where("array_contains(domain_tags, 'sleep')").select(records.surface_key(F.col("domain"), F.lit("sleep")).alias("key"), F.lit("new").alias("origin"))
    return merge.insert_absent(s.select("key", F.lit("stored").alias("origin")), new, "key")


@query("SELECT vec_id, CASE WHEN vec_id % 3 = 0 AND vec_id % 4 < 3 THEN CASE WHEN vec_id % 4 > 0 THEN vec_id % 4 END ELSE NULL END::INT AS tier, CASE WHEN vec_id % 3 = 0 AND vec_id % 4 < 3 THEN 'r' || vec_id END AS reason FROM embeddings")
def verdicts(spark, d):
    reply = F.expr("concat('{\"structured_output\": {\"tier\": ', CASE WHEN vec_id % 4 = 0 THEN 'null' ELSE CAST(vec_id % 4 AS STRING) END, ', \"confidence\": \"', CASE WHEN vec_id % 3 = 0 THEN 'high' ELSE 'sure' END, '\", \"reason\": \"r', vec_id, '\", \"source_type\": \"academic\", \"audience_type\": \"mixed\"}}')")
    v = table(spark, d, "embeddings").select("vec_id", records.verdict(reply).alias("v"))
    return v.select("vec_id", "v.tier", "v.reason")


@query("SELECT vec_id, k, CASE WHEN k = 0 THEN 'u' ELSE 'v' END || vec_id AS url FROM embeddings, (VALUES (0), (1)) t(k) WHERE k = 0 OR vec_id % 2 = 0")
def search_candidates(spark, d):
    reply = F.expr("concat('{\"structured_output\": {\"results\": [{\"url\": \"u', vec_id, '\", \"title\": \"t\"}, {\"url\": \"v', vec_id, '\", \"title\": \"', CASE WHEN vec_id % 2 = 0 THEN 't' ELSE '' END, '\"}]}}')")
    return table(spark, d, "embeddings").select("vec_id", F.posexplode_outer(records.candidates(reply)).alias("k", "c")).where("c IS NOT NULL").select("vec_id", "k", "c.url")


@query("SELECT vec_id, make_timestamp(2000 + vec_id % 20, CASE WHEN vec_id % 3 = 0 THEN 1 ELSE 1 + vec_id % 12 END, 1, 0, 0, 0) AS published FROM embeddings")
def date_parts(spark, d):
    parts = F.expr("CASE WHEN vec_id % 3 = 0 THEN array(CAST(2000 + vec_id % 20 AS INT)) ELSE array(CAST(2000 + vec_id % 20 AS INT), CAST(1 + vec_id % 12 AS INT)) END")
    return table(spark, d, "embeddings").select("vec_id", dates.from_date_parts(parts).cast("timestamp_ntz").alias("published"))


@query(r"SELECT item_id, trim(regexp_replace(regexp_replace(lower(text), '[^\pL\pN_\s]', '', 'g'), '\s+', ' ', 'g')) AS title, CASE WHEN length(split_part(trim(text), chr(10), 1)) BETWEEN 8 AND 200 THEN trim(split_part(trim(text), chr(10), 1)) ELSE 'my file ' || item_id END AS pdf_title FROM benchmark")
def titles(spark, d):
    t = F.col("text")
    return table(spark, d, "benchmark").select("item_id", text.normalize_title(t).alias("title"), text.title_from_pdf(t, F.concat(F.lit("https://a.org/my_file-"), F.col("item_id"), F.lit(".PDF"))).alias("pdf_title"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE (10 + event_id % 50)::DOUBLE / ((1 + event_id % 5) * CASE event_id % 4 WHEN 1 THEN 1 WHEN 2 THEN 60 ELSE 3600 END) END AS rate, least(pow(2.0, event_id % 9), 60.0) AS backoff FROM events")
def rate_headers(spark, d):
    limit = F.expr("CAST(10 + event_id % 50 AS STRING)")
    interval = F.expr("CASE event_id % 4 WHEN 0 THEN 'odd' ELSE concat(CAST(1 + event_id % 5 AS STRING), CASE event_id % 4 WHEN 1 THEN 's' WHEN 2 THEN 'm' ELSE 'h' END) END")
    return table(spark, d, "events").select("event_id", text.rate_per_second(limit, interval).alias("rate"), text.backoff_seconds(F.expr("event_id % 9")).alias("backoff"))


@query(f"SELECT key, CASE WHEN last_run_at IS NULL THEN 0 ELSE greatest(0, 14400 - date_diff('microsecond', last_run_at, {NOW}) / 1000000) END::DOUBLE AS delay FROM surfaces", SURFACES)
def startup_delays(spark, d):
    return corpus.surfaces(spark, d).select("key", text.startup_delay(F.col("last_run_at"), as_of(), 14400).alias("delay"))


@query(
    "SELECT l_orderkey, string_agg('line: ' || l_linenumber || ', part: ' || l_partkey || ', qty: ' || CAST(l_quantity AS INT) || ', flag: ' || l_returnflag || ', status: ' || l_linestatus, chr(10) ORDER BY rn) AS lines FROM "
    "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn <= 10 GROUP BY l_orderkey"
)
def tabular_lines(spark, d):
    given = {"line": "l_linenumber", "part": "l_partkey", "qty": "CAST(l_quantity AS INT)", "flag": "l_returnflag", "status": "l_linestatus", "more": "l_shipdate"}
    row = F.create_map(*(x for k, e in given.items() for x in (F.lit(k), F.expr(e).cast("string"))))
    rows = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus").alias("at"), F.map_entries(row).alias("row"))
    lists = rows.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda x: F.map_from_entries(x["row"])).alias("rows"))
    return lists.select("l_orderkey", records.tabular_text(F.col("rows")).alias("lines"))


@query(f"SELECT page_id FROM pages WHERE {PATH} LIKE '/en/%' AND NOT regexp_replace({PATH}, '/+$', '') LIKE '%.html' AND {NETLOC} <> 'tionsh.example.net' AND NOT ends_with({NETLOC}, '.tionsh.example.net')")
def path_filters(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").where(urls.path_allowed(u, ["/en/*"], ["*.html"]) & ~urls.on_domain(u, "tionsh.example.net")).select("page_id")
