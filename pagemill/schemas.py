"""Record types as Spark schemas. Defaults of optional fields are applied where records are read."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    """DDL text to a schema without a running session (flat and array types only)."""
    kinds = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "binary": T.BinaryType()}
    kinds |= {f"array<{k}>": T.ArrayType(v) for k, v in list(kinds.items())} | {"vector": T.ArrayType(T.FloatType(), False), "map": T.MapType(T.StringType(), T.StringType())}
    kinds |= {"dec5": T.DecimalType(5, 2), "dec10": T.DecimalType(10, 2)}
    return T.StructType([T.StructField(*x.split(":")[:1], kinds[x.split(":")[1]]) for x in ddl.split()])


RAW_PAGE = _schema("url:string html:string status_code:int headers:map crawl_time_ms:double timestamp:double redirect_url:string raw_size:long")
RAW_DLQ = _schema("url:string error_type:string error_message:string timestamp:double")
SCOPE = _schema("seed_url:string allowed_domain:string path_prefix:string max_depth:int max_pages:int current_depth:int pages_crawled:int")
QUEUE_ITEM = _schema("url:string rank:int domain:string priority:int url_type:string source_url:string")
CHUNK = _schema("text:string heading_ctx:string chunk_index:int")
PAGES = _schema("id:long url:string domain:string title:string description:string language:string keywords:array<string> processor:string static_score:int route_reason:string raw_html_key:string markdown_key:string raw_size_bytes:long markdown_size_bytes:long status_code:int content_type:string crawled_at:timestamp processed_at:timestamp version:int")
PAGE_CHUNKS = _schema("id:long page_id:long url:string chunk_index:int chunk_text:string heading_ctx:string embedding:vector created_at:timestamp")
CRAWL_RESULTS = _schema("id:long url:string domain:string success:boolean error_type:string error_message:string status_code:int response_time:double content_length:int worker_id:int shard_id:int attempt:int crawl_time:timestamp extra_info:string")
CRAWL_STATS = _schema("stat_hour:timestamp total_crawled:long total_processed:long fast_processed:long rich_processed:long avg_static_score:dec5 total_raw_bytes:long total_markdown_bytes:long")
CRAWLED_PAGES = _schema("url:string domain:string title:string content_text:string metadata:string created_at:timestamp updated_at:timestamp")
CRAWLER_DLQ = _schema("url:string error_message:string error_type:string raw_data:string created_at:timestamp")
RANK_LIST = _schema("rank:int domain:string")
METRIC_SAMPLE = _schema("ts:timestamp name:string labels:map value:double")
