"""Table schemas.

``RAW_PAGES`` is the bronze landing table: one fetched response per row with
the request context a fetcher carried from page to page.  The silver record
tables are typed; ``as_text`` gives the all-text form the relational sink of
the original workload used.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The page kinds of the landing table.
PAGE_KINDS = ("profile", "status_list", "hot_comments", "supertopic", "topic_name", "topic_search")

RAW_PAGES = _schema(
    ("page_key", S), ("kind", S), ("seed_key", S), ("seed_name", S),
    ("parent_user_id", S), ("parent_status_id", S), ("page_no", I),
    ("request_url", S), ("http_status", I), ("attempt", I),
    ("fetched_at", TS), ("body", S),
)

PROFILES = _schema(
    ("user_id", L), ("name", S), ("follow_count", L), ("followers_count", L),
    ("description", S), ("statuses_count", L), ("verified", B), ("verified_reason", S),
)

STATUSES = _schema(
    ("user_id", L), ("edit_at", S), ("created_ts", TS), ("text", S),
    ("reposts_count", L), ("comments_count", L), ("attitudes_count", L),
    ("status_id", S), ("origin_url", S),
)

COMMENTS = _schema(
    ("father_user_id", S), ("father_status_id", S), ("comment_time", S), ("comment_ts", TS),
    ("text", S), ("comment_people_id", L), ("comment_people_name", S),
    ("comment_likes", L), ("total_number", L),
)

COMMENT_PEOPLE = T.StructType(
    COMMENTS.fields + [f for f in PROFILES.fields if f.name != "user_id"]
)

SUPERTOPIC_POSTS = _schema(
    ("chaohua_id", S), ("cid", S), ("nick", S), ("comments_count", S), ("created_at", S),
    ("source", S), ("text", S), ("user_id", S), ("description", S), ("screen_name", S),
    ("followers_count", S), ("verified_reason", S),
)

TOPICS = _schema(
    ("weibo_movie_id", S), ("weibo_movie_name", S), ("title_sub", S), ("desc1", S),
    ("desc2", S), ("pic", S), ("item_id", S), ("analysis_extra", S),
)

REJECTS = _schema(
    ("source_table", S), ("page_key", S), ("pos", L), ("reason", S), ("payload", S),
)

STATUS_SEEDS = _schema(("statues_id", S), ("user_id", S))

# The table tag of each record kind, as the original sink named
# its tables.
TABLE_TAGS = {
    "profiles": "weibouseritem",
    "people": "weibopeopleitem",
    "statuses": "weibostatusitem",
    "statuses_month": "weibostatusitem4",
    "comments": "weibocommentitem",
    "supertopic_posts": "weibochaohuaitem",
    "topics": "weibotopicitem",
}

SILVER = {
    "profiles": PROFILES,
    "statuses": STATUSES,
    "comments": COMMENTS,
    "comment_people": COMMENT_PEOPLE,
    "supertopic_posts": SUPERTOPIC_POSTS,
    "topics": TOPICS,
}


def as_text(schema: T.StructType) -> T.StructType:
    """Every field as text (the all-``TEXT`` relational form)."""
    return T.StructType([T.StructField(f.name, S, True) for f in schema.fields])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
