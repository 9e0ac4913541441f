"""Records: authors, inverted abstracts, replies of outside services, retry rules, catalog entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a catalog entry may say.
SOURCE_TYPES = ("official_health", "academic", "hospital", "nonprofit", "community", "news", "social")
AUDIENCES = ("parent_facing", "clinician_facing", "mixed", "research")
DOMAIN_TAGS = ("sleep", "eating", "behavioral", "adhd", "general")
#: Days until a failed request is tried again, by reason; any other reason is never tried again.
RETRY_DAYS = {"http_403": 30, "fetch_failed": 1, "extract_failed": 1, "classifier_unavailable": 1}
STATUS_OF_REASON = {"http_404": 404, "http_403": 403}
MOST_RETRIES, MOST_CANDIDATES, MOST_KNOWN = 5, 10, 30
CANDIDATES = "structured_output struct<results:array<struct<url:string,title:string>>>, result string"
VERDICT = "tier int, source_type string, audience_type string, confidence string, reason string"


def split_name(name: Column) -> Column:
    """(family, given) at the last space; one word is the family."""
    parted = F.regexp_extract(F.trim(name), r"^(.*) ([^ ]*)$", 1)
    return F.when(parted != "", F.struct(F.regexp_extract(F.trim(name), r"^(.*) ([^ ]*)$", 2).alias("family"), parted.alias("given"))).otherwise(F.struct(F.trim(name).alias("family"), F.lit(None).cast("string").alias("given")))


def author_name(value: Column) -> Column:
    """The name in a JSON value that is an object, a list of objects or strings, or plain text."""
    text = F.trim(value)
    return F.coalesce(F.get_json_object(text, "$.name"), F.get_json_object(text, "$[0].name"), F.get_json_object(text, "$[0]"), F.when(~text.rlike(r"^[\[{]"), F.regexp_replace(text, '^"|"$', "")))


def abstract_from_index(index: Column) -> Column:
    """Text from a map of word to places, in order of the places."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.cast("int").alias("at"), e["key"].alias("word")))))
    return F.nullif(F.array_join(F.transform(F.array_sort(placed), lambda x: x["word"]), " "), F.lit(""))


def candidates(reply: Column) -> Column:
    """Up to ten (url, title) of a search reply: its structured output, else its result, as JSON text or as an object. What lacks either is dropped; what can't be read is empty."""
    whole = F.from_json(reply, CANDIDATES)
    inner = F.from_json(F.coalesce(F.get_json_object(reply, "$.result"), F.lit("{}")), "results array<struct<url:string,title:string>>")
    found = F.coalesce(whole["structured_output"]["results"], inner["results"], F.array().cast("array<struct<url:string,title:string>>"))
    return F.slice(F.filter(found, lambda r: (F.coalesce(r["url"], F.lit("")) != "") & (F.coalesce(r["title"], F.lit("")) != "")), 1, MOST_CANDIDATES)


def verdict(reply: Column) -> Column:
    """A classification, checked: tier 1, 2 or null, known types and confidence, a reason; anything else is null."""
    said = F.coalesce(F.get_json_object(reply, "$.structured_output"), F.get_json_object(reply, "$.result"))
    v = F.from_json(said, VERDICT)
    tier = F.get_json_object(said, "$.tier")
    has_tier = F.array_contains(F.json_object_keys(said), "tier")
    good = has_tier & (tier.isNull() | tier.isin("1", "2")) & v["confidence"].isin("high", "medium", "low") & (F.coalesce(F.trim(v["reason"]), F.lit("")) != "") & (v["source_type"].isNull() | v["source_type"].isin(*SOURCE_TYPES)) & (v["audience_type"].isNull() | v["audience_type"].isin(*AUDIENCES))
    return F.when(good, v)


def search_prompt(domain: Column, topic: Column, known: Column) -> Column:
    """A prompt text with the URLs that are known already."""
    listed = F.when(F.size(known) > 0, F.array_join(F.transform(F.slice(known, 1, MOST_KNOWN), lambda u: F.concat(F.lit("- "), u)), "\n")).otherwise("(none yet)")
    return F.concat(F.lit("site:"), domain, F.lit(" "), topic, F.lit("\nKnown:\n"), listed)


def retry_count(before: Column) -> Column:
    return before + 1


def next_retry(reason: Column, before: Column, now: Column) -> Column:
    """When a failed request is tried again; null for never."""
    days = F.lit(None).cast("int")
    for name, n in RETRY_DAYS.items():
        days = F.when(reason == name, F.lit(n)).otherwise(days)
    return F.when(before + 1 < MOST_RETRIES, now + F.make_dt_interval(days=days))


def status_of_reason(reason: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, status in STATUS_OF_REASON.items():
        out = F.when(reason == name, F.lit(status)).otherwise(out)
    return out


def surface_key(domain: Column, topic: Column) -> Column:
    return F.when(topic.isNull(), F.concat(F.lit("discovery_search_"), domain)).otherwise(F.concat(F.lit("discovery_"), domain, F.lit("_"), topic))


def auto_key(domain: Column) -> Column:
    return F.concat(F.lit("auto_"), F.replace(domain, F.lit("."), F.lit("_")))


def auto_entry(domain: Column, v: Column, tags: Column) -> Column:
    """A catalog entry as JSON for a domain that was promoted."""
    return F.to_json(F.struct(auto_key(domain).alias("key"), F.lit("html_pages").alias("platform"), F.lit(1).alias("enabled"), F.struct(F.concat(F.lit("https://"), domain).alias("base_url")).alias("config"), v["tier"].alias("authority_tier"), v["source_type"].alias("source_type"), v["audience_type"].alias("audience_type"), tags.alias("domain_tags")))


def entry_is_valid(key: Column, platform: Column, tier: Column, config: Column) -> Column:
    base = F.get_json_object(config, "$.base_url")
    return F.coalesce((key != "") & tier.isin(1, 2) & (platform == "html_pages") & (base != ""), F.lit(False))


def tabular_text(rows: Column, most_rows: int = 10, most_columns: int = 5) -> Column:
    """The first rows and columns of a table (array of maps) as lines of k: v."""
    return F.array_join(F.transform(F.slice(rows, 1, most_rows), lambda r: F.array_join(F.transform(F.slice(F.map_entries(r), 1, most_columns), lambda e: F.concat_ws(": ", e["key"], e["value"])), ", ")), "\n")
