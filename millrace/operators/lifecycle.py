"""What happens to items and requests after a fetch, as ordered decisions over outcomes that are rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import behind_paywall, passes_extraction, strip_nul
from millrace.functions.urls import is_pdf_url, normalize_url, on_domain
from millrace.operators.state import GIVE_UP_ATTEMPTS, may_promote

PMC = r"(?i)pmc\.ncbi\.nlm\.nih\.gov/articles/PMC(\d+)"


def write_open_access(items: DataFrame, checks: DataFrame) -> DataFrame:
    """Items with what the open-access service said (id, is_oa, pdf_url, landing_url); also that there is none is kept."""
    c = checks.select("id", F.col("is_oa").alias("__oa"), F.coalesce("pdf_url", "landing_url").alias("__url"), F.lit(True).alias("__hit"))
    new = {"open_access": F.when(F.col("__hit"), F.col("__oa")).otherwise(F.col("open_access")), "oa_url": F.when(F.col("__hit"), F.when(F.col("__oa"), F.col("__url"))).otherwise(F.col("oa_url"))}
    return items.join(c, "id", "left").withColumns(new).select(*items.columns)


def content_route(content_type: Column) -> Column:
    """pdf, html or reject; no type counts as html."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(F.contains(kind, F.lit("application/pdf")), "pdf").when((kind == "") | F.contains(kind, F.lit("html")) | F.startswith(kind, F.lit("text/")), "html").otherwise("reject")


def fulltext_result(outcome: Column, route: Column, text: Column, attempts: Column, given_up: Column) -> Column:
    """(action, body, attempts) for a full-text fetch: give_up leaves the empty body, retry counts an attempt, body is what was found."""
    n = F.coalesce(attempts, F.lit(0)) + 1
    clean = strip_nul(text)
    action = (
        F.when(F.coalesce(given_up, F.lit(False)), "give_up")
        .when(outcome != "ok", F.when(n >= GIVE_UP_ATTEMPTS, "give_up").otherwise("retry"))
        .when(route == "reject", "give_up")
        .when(clean.isNull() | (clean == ""), "give_up")
        .when(behind_paywall(clean), "give_up")
        .otherwise("body")
    )
    return F.struct(action.alias("action"), F.when(action == "give_up", "").when(action == "body", clean).alias("body"), F.when(outcome != "ok", n).otherwise(F.coalesce(attempts, F.lit(0))).alias("attempts"))


def no_doi_result(text: Column, attempts: Column) -> Column:
    """(action, body, attempts) for a fetch by URL: text is the body, else an attempt is counted, the last gives up."""
    n = F.coalesce(attempts, F.lit(0)) + 1
    has = F.coalesce(text, F.lit("")) != ""
    action = F.when(has, "body").when(n >= GIVE_UP_ATTEMPTS, "give_up").otherwise("retry")
    return F.struct(action.alias("action"), F.when(has, strip_nul(text)).when(action == "give_up", "").alias("body"), F.when(has, F.coalesce(attempts, F.lit(0))).otherwise(n).alias("attempts"))


def landing_result(url: Column, domain: Column, known: Column, http_status: Column, content_type: Column, title: Column, body: Column) -> Column:
    """(outcome, reason) for one found URL, the first rule that holds."""
    route = content_route(content_type)
    reject = lambda reason: F.struct(F.lit("failed").alias("outcome"), F.lit(reason).alias("reason"))
    settled = lambda outcome: F.struct(F.lit(outcome).alias("outcome"), F.lit(None).cast("string").alias("reason"))
    return (
        F.when(~F.coalesce(on_domain(url, domain), F.lit(False)), reject("not_allowlisted"))
        .when(known, settled("already_known"))
        .when(http_status == 404, reject("http_404"))
        .when(http_status == 403, reject("http_403"))
        .when(http_status.isNull() | ~(http_status.between(200, 299) | (http_status == 304)), reject("fetch_failed"))
        .when(route == "reject", reject("extract_failed"))
        .when(F.coalesce(F.trim(title), F.lit("")) == "", reject("extract_failed"))
        .when((F.coalesce(body, F.lit("")) == "") & ((route == "pdf") | (F.regexp_extract(url, PMC, 1) != "")), reject("extract_failed"))
        .otherwise(settled("landed"))
    )


def request_result(known_domain: Column, promoted_today: Column, verdict: Column, classifier_ran: Column, landed: Column) -> Column:
    """(outcome, reason) for a queued request: a known domain lands; else the day's cap, the classifier, the gate, then landing."""
    pair = lambda o, r: F.struct(F.lit(o).alias("outcome"), r.alias("reason") if isinstance(r, Column) else F.lit(r).cast("string").alias("reason"))
    landing = F.struct(F.when(landed["outcome"].isin("landed", "already_known"), "done").otherwise("failed").alias("outcome"), landed["reason"].alias("reason"))
    return (
        F.when(known_domain, landing)
        .when(promoted_today >= 5, pair("out_of_scope", "daily_cap"))
        .when(~F.coalesce(classifier_ran, F.lit(False)) | verdict.isNull(), pair("failed", "classifier_unavailable"))
        .when(~F.coalesce(may_promote(verdict["tier"], verdict["confidence"], promoted_today), F.lit(False)), pair("out_of_scope", verdict["reason"]))
        .otherwise(landing)
    )


def mark_harvested(items: DataFrame, done: DataFrame, as_of: Column) -> DataFrame:
    hit = done.select("id", F.lit(True).alias("__hit")).distinct()
    return items.join(hit, "id", "left").withColumn("last_harvested_at", F.when(F.col("__hit"), as_of).otherwise(F.col("last_harvested_at"))).select(*items.columns)


def first_good(*texts: Column) -> Column:
    """The first text that passes the extraction gate: fallbacks in their order."""
    return F.coalesce(*(F.when(passes_extraction(t), t) for t in texts))


def publisher_order(url: Column, pmc_html: Column, pmc_xml: Column, html: Column, pdf: Column) -> Column:
    """Which text to take: PMC pages before XML; PDF links before pages; else pages before PDF."""
    return F.when(url.rlike(PMC), first_good(pmc_html, pmc_xml)).when(is_pdf_url(url), first_good(pdf, html)).otherwise(first_good(html, pdf))


def with_bodies(items: DataFrame, texts: DataFrame, key: str = "url") -> DataFrame:
    """Items with fetched texts (key, text) where there is one."""
    return items.join(texts.select(key, F.col("text").alias("__text")), key, "left").withColumn("content_body", F.coalesce("__text", "content_body")).drop("__text").select(*items.columns)


def outcome_counts(batch: DataFrame) -> DataFrame:
    return batch.groupBy("action").agg(F.count("*").alias("n"))


def with_known(links: DataFrame, items: DataFrame, url: str = "url") -> DataFrame:
    """links with known: whether an item has the link's URL in its canonical form."""
    stored = items.select(normalize_url(F.col("url")).alias("__url")).distinct().withColumn("__known", F.lit(True))
    return links.withColumn("__url", normalize_url(F.col(url))).join(stored, "__url", "left").withColumn("known", F.coalesce("__known", F.lit(False))).drop("__url", "__known")
