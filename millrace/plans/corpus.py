"""The corpus tables derived from the synthetic tables, once as DataFrames and once as SQL for comparison.

Every derived column is a plain function of the row's id, so that both sides state the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
DISCOVERY = "websearch_discovery"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of():
    return F.to_timestamp_ntz(F.lit(AS_OF))


#: column: expression, in words that Spark SQL and DuckDB both read
ITEM_EXPRESSIONS = {
    "id": "doc_id",
    "surface_key": "source",
    "source": f"CASE doc_id % 7 WHEN 0 THEN 'pubmed' WHEN 1 THEN 'openalex' WHEN 2 THEN 'html_pages' WHEN 3 THEN 'sitemap' WHEN 4 THEN 'biorxiv' WHEN 5 THEN 'youtube' ELSE '{DISCOVERY}' END",
    "url": "concat('https://', source, '.example.org/doc/', CAST(doc_id AS VARCHAR(20)))",
    "title": "substring(text, 1, 60)",
    "description": "CASE WHEN doc_id % 4 <> 0 THEN substring(text, 1, 600) END",
    "content_body": "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' ELSE text END",
    "doi": "CASE WHEN doc_id % 3 <> 0 THEN concat('10.1000/x', CAST(doc_id AS VARCHAR(20))) END",
    "open_access": "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id % 5 < 3 END",
    "oa_url": "CASE WHEN doc_id % 5 IN (1, 2) AND doc_id % 2 = 0 THEN concat('https://oa', CAST(doc_id % 9 AS VARCHAR(20)), '.example.org/p/', CAST(doc_id AS VARCHAR(20))) END",
    "authority_tier": "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id % 4 AS INT) END",
    "source_type": "CASE doc_id % 6 WHEN 0 THEN 'official_health' WHEN 1 THEN 'academic' WHEN 2 THEN 'hospital' WHEN 3 THEN 'blog' WHEN 4 THEN 'social' END",
    "collected_at": "CAST('2024-01-01 00:00:00' AS {ts}) + make_interval(47 * doc_id)",
    "published_at": "CASE WHEN doc_id % 10 <> 0 THEN CAST('2024-01-01 00:00:00' AS {ts}) - make_interval(1440 * (doc_id % 3000)) END",
    "last_harvested_at": "CASE WHEN doc_id % 3 = 1 THEN CAST('2024-01-20 00:00:00' AS {ts}) + make_interval(97 * (doc_id % 200)) END",
    "embedded": "doc_id % 5 <> 3",
    "needs_rechunk": "doc_id % 19 = 0",
    "fetch_attempts": "CAST(doc_id % 4 AS INT)",
    "near_duplicate_of": "CASE WHEN doc_id % 17 = 0 THEN 'earlier' END",
    "domain_tags": "CASE doc_id % 6 WHEN 0 THEN {a}'sleep'{z} WHEN 1 THEN {a}'eating', 'adhd'{z} WHEN 3 THEN {a}'general'{z} WHEN 4 THEN {a}'adhd', 'sleep'{z} WHEN 5 THEN {a}'behavioral'{z} END",
}


def spark_sql(expression: str) -> str:
    return expression.replace("VARCHAR(20)", "STRING").replace("{ts}", "TIMESTAMP_NTZ").replace("make_interval(", "make_dt_interval(0, 0, ").replace("{a}", "array(").replace("{z}", ")")


def duck_sql(expression: str) -> str:
    import re

    return re.sub(r"make_interval\(", "to_minutes(", expression.replace("{ts}", "TIMESTAMP").replace("{a}", "[").replace("{z}", "]"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").selectExpr(*(f"{spark_sql(e)} AS {c}" for c, e in ITEM_EXPRESSIONS.items()))
    return df.withColumn("embedding", F.expr("CASE WHEN embedded THEN array(CAST(1.0 AS FLOAT)) END")).drop("embedded")


ITEMS = "items AS (SELECT " + ", ".join(f"{duck_sql(e)} AS {c}" for c, e in ITEM_EXPRESSIONS.items()) + " FROM documents)"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three chunks and a summary for each document but every fifth."""
    base = table(spark, sf_dir, "documents").where("doc_id % 5 <> 2").select("doc_id", F.explode(F.expr("sequence(-1, CAST(doc_id % 3 AS INT))")).alias("chunk_index"))
    return base.selectExpr("doc_id * 10 + chunk_index + 1 AS id", "doc_id AS parent_item_id", "chunk_index", "chunk_index = -1 AS is_summary", "CASE WHEN (doc_id + chunk_index) % 3 <> 0 THEN array(CAST(1.0 AS FLOAT)) END AS embedding")


CHUNKS = "chunks AS (SELECT doc_id * 10 + chunk_index + 1 AS id, doc_id AS parent_item_id, chunk_index, chunk_index = -1 AS is_summary, CASE WHEN (doc_id + chunk_index) % 3 <> 0 THEN 1 END AS embedding FROM (SELECT doc_id, CAST(unnest(range(-1, CAST(doc_id % 3 AS INT) + 1)) AS INT) AS chunk_index FROM documents WHERE doc_id % 5 <> 2))"

SURFACE_EXPRESSIONS = {
    "key": "source",
    "platform": "CASE n % 3 WHEN 0 THEN 'html_pages' WHEN 1 THEN 'rss' ELSE 'sitemap' END",
    "enabled": "n % 7 <> 3",
    "force_run": "n % 8 = 5",
    "poll_interval_sec": "CAST(3600 * (1 + n % 3) AS INT)",
    "authority_tier": "CASE WHEN n % 3 = 0 THEN NULL ELSE CAST(n % 3 AS INT) END",
    "last_run_at": "CASE WHEN n % 5 <> 4 THEN CAST('2024-01-30 20:00:00' AS {ts}) + make_interval(13 * n) END",
    "consecutive_fails": "CAST(n % 6 AS INT)",
    "domain": "concat('site', CAST(n % 9 AS VARCHAR(20)), '.example.org')",
    "domain_tags": "CASE WHEN n % 2 = 0 THEN {a}'sleep', 'adhd'{z} ELSE {a}'general'{z} END",
}


def surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "documents").select("source").distinct().withColumn("n", F.expr("CAST(substring(source, 4) AS INT)"))
    return base.selectExpr(*(f"{spark_sql(e)} AS {c}" for c, e in SURFACE_EXPRESSIONS.items()))


SURFACES = "surfaces AS (SELECT " + ", ".join(f"{duck_sql(e)} AS {c}" for c, e in SURFACE_EXPRESSIONS.items()) + " FROM (SELECT DISTINCT source, CAST(substring(source, 4) AS INT) AS n FROM documents))"

REQUEST_EXPRESSIONS = {
    "id": "page_id",
    "url": "url",
    "status": "CASE page_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'done' WHEN 3 THEN 'failed' ELSE 'out_of_scope' END",
    "discovered_at": "CAST('2024-01-10 00:00:00' AS {ts}) + make_interval(31 * (page_id % 990))",
    "processed_at": "CASE WHEN page_id % 5 IN (2, 3, 4) THEN CAST('2024-01-29 12:00:00' AS {ts}) + make_interval(11 * (page_id % 190)) END",
    "retry_count": "CAST(page_id % 6 AS INT)",
    "next_retry_at": "CASE WHEN page_id % 5 = 3 AND page_id % 2 = 0 THEN CAST('2024-01-30 00:00:00' AS {ts}) + make_interval(29 * (page_id % 100)) END",
    "error_note": "CASE page_id % 7 WHEN 0 THEN 'http_404' WHEN 1 THEN 'http_403' WHEN 2 THEN 'fetch_failed' WHEN 3 THEN 'extract_failed' WHEN 4 THEN 'robots_blocked' WHEN 5 THEN 'classifier_unavailable' ELSE 'odd' END",
    "promoted_surface_key": "CASE WHEN page_id % 4 = 2 THEN concat('auto_', CAST(page_id AS VARCHAR(20))) END",
}


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr(*(f"{spark_sql(e)} AS {c}" for c, e in REQUEST_EXPRESSIONS.items()))


REQUESTS = "requests AS (SELECT " + ", ".join(f"{duck_sql(e)} AS {c}" for c, e in REQUEST_EXPRESSIONS.items()) + " FROM pages)"

FETCH_EXPRESSIONS = {
    "event_id": "event_id",
    "domain": "concat('d', CAST(user_id % 97 AS VARCHAR(20)), '.example.org')",
    "ok": "event_type = 'purchase' AND user_id % 97 < 40",
    "http_status": "CASE WHEN event_type = 'purchase' THEN 200 WHEN event_type = 'error' THEN 403 WHEN event_type = 'view' THEN 404 ELSE 500 END",
    "seen_at": "ts",
}


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*(f"{spark_sql(e)} AS {c}" for c, e in FETCH_EXPRESSIONS.items()))


FETCHES = "fetches AS (SELECT " + ", ".join(f"{duck_sql(e)} AS {c}" for c, e in FETCH_EXPRESSIONS.items()) + " FROM events)"
