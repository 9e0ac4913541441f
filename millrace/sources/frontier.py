"""Link frontiers: which saved pages are reached, level by level, as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import html, urls


def links(pages: DataFrame) -> DataFrame:
    """(page, url, position): every link of saved pages (url, body), resolved, without fragment."""
    each = pages.select(F.col("url").alias("page"), F.posexplode_outer(html.extract_links(F.col("body"))).alias("position", "href")).where("href IS NOT NULL")
    return each.select("page", F.split_part(urls.resolve(F.col("page"), F.col("href")), F.lit("#"), F.lit(1)).alias("url"), "position").where("url RLIKE '^https?://'")


def frontier(spark: SparkSession, edges: DataFrame, start: Sequence[str], known: DataFrame, seed: str, depth: int = 1, limit: int = 30, least_segments: int = 2, child_domains: Sequence[str] = (), allowed: Sequence[str] = (), excluded: Sequence[str] = (), positive: Sequence[str] = (), negative: Sequence[str] = ()) -> DataFrame:
    """(url, level, position) of the new content pages that edges (page, url, position) lead to from start in so many levels, at most twice the limit a level (the feature of bounded search), in page order."""
    u = F.col("url")
    good = edges.where(urls.is_content_url(u, seed, least_segments, child_domains) & urls.path_allowed(u, allowed, excluded) & urls.passes_score(u, positive, negative))
    level = spark.createDataFrame([(s,) for s in start], "url string")
    seen = known.select("url").union(level).distinct()
    out = None
    for k in range(1, depth + 1):
        reached = good.join(level.withColumnsRenamed({"url": "page"}), "page", "left_semi").groupBy("url").agg(F.min(F.struct("page", "position")).alias("at"))
        new = reached.join(seen, "url", "left_anti").orderBy("at", "url").limit(2 * limit).withColumn("level", F.lit(k))
        new = new.withColumn("position", F.row_number().over(Window.orderBy("at", "url")) - 1).select("url", "level", "position")
        out = new if out is None else out.unionByName(new)
        level = new.select("url")
        seen = seen.union(level)
    return out
