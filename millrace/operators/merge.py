"""Keyed merges with a policy for each column.

A merge is one shuffle by key: stored rows and incoming ones are put together, each with its place in the order of
arrival (stored rows first), and every column takes its value by its policy in one aggregation. Nothing is updated in
place; the result is the next snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import content_hash

#: first: the earliest row's value, null or not. last: the latest row's, null or not. known: the latest that isn't null.
#: union: all values of the arrays, sorted. stored: the stored row's, whatever comes in.
ITEM_POLICY = {
    **dict.fromkeys(("id", "external_id", "source", "surface_key", "title", "author", "authors_json", "published_at", "doi", "journal", "open_access", "raw_payload"), "first"),
    **dict.fromkeys(("engagement", "rank_position", "description", "collected_at", "authority_tier", "source_type", "audience_type", "lang", "is_stale", "evidence_level", "content_fingerprint", "near_duplicate_of"), "last"),
    **dict.fromkeys(("content_body", "content_hash", "content_updated_at"), "known"),
    **dict.fromkeys(("domain_tags", "topic_tags"), "union"),
    **dict.fromkeys(("embedding", "embedding_model", "embedded_at", "oa_url", "last_harvested_at", "fetch_attempts", "needs_rechunk", "embedding_schema_version"), "stored"),
}
SEQ = "__seq"


def union_tags(tags: Column) -> Column:
    """Aggregate: the union of arrays, sorted; null if there is none at all. Equal arrays are held once, so a key with very many rows holds what it has of different ones."""
    return F.array_sort(F.array_distinct(F.flatten(F.nullif(F.collect_set(F.array_sort(tags)), F.array().cast("array<array<string>>")))))


def by_policy(name: str, policy: str, order: Column) -> Column:
    c = F.col(f"`{name}`")
    if policy == "first":
        return F.min_by(c, order)
    if policy == "last":
        return F.max_by(c, order)
    if policy == "known":
        return F.max_by(c, F.when(c.isNotNull(), order))
    if policy == "stored":
        return F.min_by(c, F.when(order < 0, order))
    if policy == "union":
        return union_tags(c)
    raise ValueError(f"no policy {policy}")


def merge_by_key(stored: DataFrame, incoming: DataFrame, key: str, policy: dict[str, str], seq: str, deal: tuple[str, Column] | None = None) -> DataFrame:
    """The next snapshot of stored, one row a key. seq: the incoming rows' order of arrival, from 0 up. Columns that incoming lacks are null in it; columns that the policy doesn't name are last.
    deal: a name and a function of the key; rows are shuffled by it and have it as their last column, so they can be written by it as they lie."""
    names = [c for c in stored.columns if c != key]
    first = stored.withColumn(SEQ, F.lit(-1).cast("long"))
    then = incoming.withColumn(SEQ, F.col(seq).cast("long"))
    both = first.select(key, SEQ, *names).unionByName(then.select(key, SEQ, *(c for c in names if c in incoming.columns)), allowMissingColumns=True)
    grouped = both.groupBy(key) if deal is None else both.withColumn(*deal).repartition(deal[0]).groupBy(deal[0], key)
    return grouped.agg(*(by_policy(c, policy.get(c, "last"), F.col(SEQ)).alias(c) for c in names)).select(*stored.columns, *([deal[0]] if deal else []))


def one_per_doi(stored: DataFrame, incoming: DataFrame, seq: str = "seq", taken: DataFrame | None = None) -> DataFrame:
    """Incoming rows without those whose DOI another URL has: a stored one, or an earlier one of the batch. taken: who has which
    DOI (doi, url) where stored isn't the whole table."""
    if "doi" not in incoming.columns:
        return incoming
    taken = (stored if taken is None else taken).where("doi IS NOT NULL").select(F.col("doi").alias("__doi"), F.col("url").alias("__url"))
    # rows without DOI go by the joins: they would all meet in one task
    free = incoming.where("doi IS NOT NULL").join(taken, (F.col("doi") == F.col("__doi")) & (F.col("url") != F.col("__url")), "left_anti")
    stored_urls = stored.select("url", F.lit(True).alias("__known"))
    first_url = F.first("url").over(Window.partitionBy("doi").orderBy(F.col("__known").desc_nulls_last(), seq, "url"))
    with_doi = free.join(stored_urls, "url", "left").withColumn("__first", first_url).where(F.col("url") == F.col("__first")).drop("__known", "__first")
    return incoming.where("doi IS NULL").unionByName(with_doi.select(*free.columns))


def merge_items(stored: DataFrame, incoming: DataFrame, seq: str = "seq", taken: DataFrame | None = None, deal: tuple[str, Column] | None = None) -> DataFrame:
    """The items' own merge on url. Bodies that change set needs_rechunk and clear the embedding (compared before and after; the
    hash of the stored body goes through the merge as a column). taken: see one_per_doi. deal: see merge_by_key."""
    hashed = stored.withColumn("__before", content_hash(F.col("content_body")))
    joined = merge_by_key(hashed, one_per_doi(stored, incoming, seq, taken), "url", ITEM_POLICY | {"__before": "stored"}, seq, deal)
    changed = F.col("__before").isNotNull() & ~content_hash(F.col("content_body")).eqNullSafe(F.col("__before"))
    marks = {"needs_rechunk": F.when(changed, True).otherwise(F.coalesce("needs_rechunk", F.lit(False)))} if "needs_rechunk" in stored.columns else {}
    for c in ("embedding", "embedded_at"):
        if c in stored.columns:
            marks[c] = F.when(changed, None).otherwise(F.col(c))
    if "fetch_attempts" in stored.columns:
        marks["fetch_attempts"] = F.coalesce("fetch_attempts", F.lit(0))
    return joined.withColumns(marks).select(*stored.columns, *([deal[0]] if deal else []))


def inserted(stored: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """Rows of the new snapshot whose key was not stored."""
    return new.join(stored.select(key), key, "left_anti")


def changed_hashes(stored: DataFrame, incoming: DataFrame, key: str = "url", body: str = "content_body") -> DataFrame:
    """key, old and new hash, changed: for keys on both sides."""
    old = stored.select(key, content_hash(F.col(body)).alias("old_hash"))
    new = incoming.select(key, content_hash(F.col(body)).alias("new_hash"))
    return old.join(new, key).withColumn("changed", F.coalesce(F.col("old_hash") != F.col("new_hash"), F.col("old_hash").isNotNull() != F.col("new_hash").isNotNull()))


CONFIG_COLUMNS = ("platform", "enabled", "poll_interval_sec", "max_items_per_run", "config_json", "authority_tier", "source_type", "audience_type", "language", "country", "organization_name", "domain_tags", "topic_tags")
JSON_MAP = "map<string,string>"


def refresh_surfaces(stored: DataFrame, catalog: DataFrame) -> DataFrame:
    """The source table after reading the catalog: new entries come in, known ones take the file's configuration (stored overrides win over it) and keep their run state, rows the file lacks stay."""
    file = catalog.select(
        "key", "platform", (F.coalesce("enabled", F.lit(1)) != 0).alias("enabled"), F.coalesce("poll_interval_sec", F.lit(3600)).alias("poll_interval_sec"), F.coalesce("max_items", F.lit(30)).alias("max_items_per_run"),
        F.col("config").alias("config_json"), "authority_tier", "source_type", "audience_type", F.coalesce("language", F.lit("en")).alias("language"), "country", "organization_name", "domain_tags", "topic_tags",
    )
    file = file.select("key", *(F.col(c).alias(f"__{c}") for c in CONFIG_COLUMNS), F.lit(True).alias("__in_file"))
    both = stored.join(file, "key", "full")
    over = F.map_concat(F.coalesce(F.from_json("__config_json", JSON_MAP), F.create_map().cast(JSON_MAP)), F.coalesce(F.from_json("overrides_json", JSON_MAP), F.create_map().cast(JSON_MAP)))
    config = F.when(F.col("overrides_json").isNull(), F.col("__config_json")).otherwise(F.to_json(over))
    new = {c: F.when(F.col("__in_file"), config if c == "config_json" else F.col(f"__{c}")).otherwise(F.col(c)) for c in CONFIG_COLUMNS}
    new |= {"force_run": F.coalesce("force_run", F.lit(False)), "consecutive_fails": F.coalesce("consecutive_fails", F.lit(0))}
    return both.withColumns(new).select(*stored.columns)


def merge_blocked(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Domain states, the incoming one in place of the stored one, column by column where it says something."""
    names = [c for c in stored.columns if c != "domain"]
    new = incoming.select("domain", *(F.col(c).alias(f"__{c}") for c in names))
    return stored.join(new, "domain", "full").select("domain", *(F.coalesce(f"__{c}", c).alias(c) for c in names))


def insert_absent(stored: DataFrame, incoming: DataFrame, *key: str) -> DataFrame:
    """stored with the incoming rows whose key it lacks; of several incoming rows of a key the first in the order of their columns."""
    rest = [c for c in stored.columns if c not in key]
    fresh = incoming.join(stored.select(*key), list(key), "left_anti")
    one = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("row")).select(*key, "row.*") if rest else fresh.select(*key).distinct()
    return stored.unionByName(one.select(*stored.columns))


def replace_chunks(stored: DataFrame, new: DataFrame, rechunked: DataFrame) -> DataFrame:
    """Chunks after a pass: those of re-chunked items give way, then new ones come in where (item, index) is free."""
    kept = stored.join(rechunked.select("parent_item_id").distinct(), "parent_item_id", "left_anti")
    return insert_absent(kept.select(*stored.columns), new, "parent_item_id", "chunk_index")


def cache_put(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Conditional-request cache: the latest entry of a key."""
    return merge_by_key(stored, incoming, "url_hash", {}, "seq")


def fill_from(items: DataFrame, surfaces: DataFrame, column: str = "authority_tier") -> DataFrame:
    """A null column filled from the item's source."""
    names = items.columns
    return items.join(surfaces.select(F.col("key").alias("surface_key"), F.col(column).alias("__fill")), "surface_key", "left").withColumn(column, F.coalesce(column, "__fill")).select(*names)


def stamp(items: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Items with the metadata of their source."""
    meta = ("authority_tier", "source_type", "audience_type", "language", "domain_tags", "topic_tags")
    return items.drop(*meta).join(surfaces.select(F.col("key").alias("surface_key"), *meta), "surface_key", "left")


def default_tags(items: DataFrame, tag: str) -> DataFrame:
    return items.withColumn("domain_tags", F.coalesce("domain_tags", F.array(F.lit(tag))))


def reset_embeddings(items: DataFrame) -> DataFrame:
    return items.withColumns({c: F.lit(None).cast(items.schema[c].dataType) for c in ("embedding", "embedding_model", "embedded_at") if c in items.columns})


def fill_stubs(items: DataFrame, payloads: DataFrame) -> DataFrame:
    """Stub rows overwritten by their payload's columns, by id."""
    names = [c for c in payloads.columns if c != "id"]
    new = payloads.select("id", *(F.col(c).alias(f"__{c}") for c in names), F.lit(True).alias("__hit"))
    return items.join(new, "id", "left").withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in names}).select(*items.columns)


def known_links(links: DataFrame, items: DataFrame, url: str = "url") -> DataFrame:
    """Links whose URL no item has, in their own order, first occurrence of each."""
    first = links.groupBy(url).agg(F.min("position").alias("position"))
    return first.join(items.select(F.col("url").alias(url)).distinct(), url, "left_anti")


def new_stubs(stubs: DataFrame, items: DataFrame) -> DataFrame:
    """Stubs that no item has by URL or by DOI."""
    return stubs.join(items.select("url").distinct(), "url", "left_anti").join(items.where("doi IS NOT NULL").select("doi").distinct(), "doi", "left_anti")


def split_rejects(rows: DataFrame, *needed: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and those where a needed column is null with the reason: one bad row never stops a batch."""
    bad = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in needed)))
    marked = rows.withColumn("missing", bad)
    return marked.where(F.size("missing") == 0).drop("missing"), marked.where(F.size("missing") > 0)
