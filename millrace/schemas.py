"""The tables of the corpus. Everything is read with these schemas; nothing is inferred.

VERSION goes up with every change; CHANGES says what a reader of older data has to add.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = 2
TAGS = T.ArrayType(T.StringType())
VECTOR = T.ArrayType(T.FloatType())
AUTHORS = T.ArrayType(T.StructType([T.StructField("family", T.StringType()), T.StructField("given", T.StringType())]))


def table(spec: str) -> T.StructType:
    """A schema from name:type pairs."""
    named = {"tags": TAGS, "vector": VECTOR, "authors": AUTHORS, "str": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "bool": T.BooleanType(), "time": T.TimestampType(), "json": T.StringType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(n, named[t]) for n, t in (x.split(":") for x in spec.split())])


#: What a source yields for one item; every column may be null.
COLLECTED = table("title:str url:str source:str external_id:str description:str content_body:str author:str authors_json:authors published_at:time rank_position:int doi:str journal:str open_access:bool engagement:json raw_payload:json")
ITEMS = table(
    "id:long external_id:str source:str surface_key:str title:str url:str description:str content_body:str author:str authors_json:authors published_at:time collected_at:time lang:str rank_position:int "
    "engagement:json doi:str journal:str open_access:bool authority_tier:int source_type:str audience_type:str content_hash:str content_updated_at:time raw_payload:json embedding:vector embedding_model:str "
    "embedded_at:time oa_url:str last_harvested_at:time fetch_attempts:int needs_rechunk:bool is_stale:bool evidence_level:str content_fingerprint:tags near_duplicate_of:str embedding_schema_version:str domain_tags:tags topic_tags:tags"
)
CHUNKS = table(
    "id:long parent_item_id:long chunk_index:int chunk_text:str embedding:vector embedding_model:str embedded_at:time title:str url:str domain:str source_type:str authority_tier:int published_at:time lang:str "
    "is_summary:bool section_heading:str heading_path:str embedding_schema_version:str domain_tags:tags topic_tags:tags"
)
SURFACES = table(
    "key:str platform:str enabled:bool poll_interval_sec:int max_items_per_run:int config_json:json authority_tier:int source_type:str audience_type:str language:str country:str organization_name:str force_run:bool "
    "last_run_at:time last_cursor:str last_status:str last_error:str last_run_count:int consecutive_fails:int overrides_json:json domain_tags:tags topic_tags:tags"
)
HTTP_CACHE = table("url_hash:str etag:str last_modified:str expires_at:time")
BLOCKED_DOMAINS = table("domain:str consecutive_403_count:int given_up:bool given_up_at:time last_checked_at:time ever_succeeded:bool first_failure_at:time")
QUEUE_STATE = table("id:int last_index:int last_pair_domain:str last_pair_topic:str last_run_at:time")
REQUESTS = table(
    "id:long url:str title:str snippet:str source_domain:str trigger_query:str status:str discovered_at:time processed_at:time retry_count:int last_http_status:int next_retry_at:time error_note:str "
    "classifier_tier:int classifier_confidence:str classifier_reason:str promoted_surface_key:str"
)
#: An entry of the source catalog file.
CATALOG = table("key:str platform:str enabled:int poll_interval_sec:int max_items:int config:json authority_tier:int source_type:str audience_type:str language:str country:str organization_name:str domain_tags:tags topic_tags:tags content_notes:str blocked_domain:str")

#: version: columns that came with it, by table
CHANGES = {2: {"items": ("domain_tags", "topic_tags"), "chunks": ("domain_tags", "topic_tags", "is_summary")}}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the columns of schema: what is missing becomes null, what is there is cast. Reads data of every version."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
