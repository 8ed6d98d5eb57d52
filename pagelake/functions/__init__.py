"""Column functions (``Column -> Column``), all built from ``pyspark.sql.functions``."""

from pagelake.functions.json import has_key, json_keys, key_count, safe_path
from pagelake.functions.text import counter, id_text, strip_query
from pagelake.functions.time import (
    created_month, created_ts, created_year, parse_created_at, site_time_text,
)
from pagelake.functions.urls import (
    comment_request, next_comment_page, next_status_page, next_supertopic_page,
    profile_request, status_list_request, supertopic_request, topic_name_request,
    topic_search_request, url_quote,
)

__all__ = [
    "has_key", "json_keys", "key_count", "safe_path", "counter", "id_text", "strip_query",
    "created_month", "created_ts", "created_year", "parse_created_at", "site_time_text",
    "comment_request", "next_comment_page", "next_status_page", "next_supertopic_page",
    "profile_request", "status_list_request", "supertopic_request", "topic_name_request",
    "topic_search_request", "url_quote",
]
