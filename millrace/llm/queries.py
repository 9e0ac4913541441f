"""The queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, capture_index, decontamination, mpeg_audio, order_minhash, personal_data, quality, secret_scan, spelling_variants, sstable, tandem_runs, token_count, url_filter
from millrace.llm._common import table, work_path


def op1_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = mpeg_audio.store_media(table(spark, sf_dir, "documents"))
    read = mpeg_audio.read_media(media, columns="payload binary, duration_samples long, sample_rate int, frames long, seek_offsets array<long>, crc_good long, crc_bad long, feature string")
    tail = F.expr("substring(payload, length(payload) - 15, 16)")
    return read.select("doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", "duration_samples", "sample_rate", "frames", "seek_offsets", "crc_good", "crc_bad")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = sstable.write_shards(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), work_path(spark, "sst"), end_id=1)
    return sstable.read_shards(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@functools.lru_cache(1)
def url_model() -> tuple[int, list[int]]:
    return url_filter.train(url_filter.labelled_urls(held_out=False))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_model())


def op5_byte_bpe(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    how = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    read = bpe.round_trip_documents(docs if docs is not None else table(spark, sf_dir, "documents"), *how)
    return read.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    directory = capture_index.write_archives(spark, pages, work_path(spark, "warc"))
    return capture_index.read_archives(spark, directory, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.select("doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE), F.sha2(text(of(*secret_scan.BASE)), 256).alias("base_sha256"), text(F.col("secrets")).alias("spans"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants.spelling_variants(spark, table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tandem_runs.digest(tandem_runs.find_runs(table(spark, sf_dir, "documents"), plant=True))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find_personal_data(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mpeg_audio, op2_token_counts, op3_sstable, op4_url_filter, op5_byte_bpe, op6_quality, op7_warc, op8_decontamination, op9_secret_scan, op10_order_minhash, op11_spelling_variants, op12_tandem_runs, op13_personal_data)}


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": url_filter.oracle(url_model()), "op13_personal_data": personal_data.oracle()}
