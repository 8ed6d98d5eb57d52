"""Landed pages derived, with Spark, from the shared test tables.

The engine reads landed response pages; the test tables are relational.  These
builders render each table as the JSON pages a fetcher would have landed, so
every query reads the given tables and its work grows with them.  The
renderings are plain and deterministic, and their edge cases come from the
data itself:

* ``status_list`` from ``orders``: an account is ``o_custkey``; its feed is
  newest first by post id (``o_orderkey`` descending), 10 posts a page, with a
  4-key promo slot first and a label slot (no ``mblog``) last on every page.
  ``created_at`` is ``o_orderdate`` written in ``+0800``.  Posts of
  ``1-URGENT``/``P`` orders carry an unreadable date, posts of
  ``3-MEDIUM``/``F`` orders lack ``text``.  The cursor is the last post id of
  the page; the last page has ``cardlistInfo`` without ``since_id``.
* ``profile`` from ``customer``; a negative balance drops ``description``;
  ``MACHINERY`` accounts are landed twice (an older, zeroed snapshot first).
* ``hot_comments`` from ``lineitem`` (comments) under ``orders`` (posts): two
  comments a page by line number; ``max_id`` is 0 on the last page.
  ``l_discount = 0`` gives ``"user": null``, ``l_tax = 0`` drops
  ``like_count``, and pages of ``2-HIGH``/``F`` orders have no cursor.
* ``supertopic`` from ``documents``: one feed per ``source``, 5 posts a page by
  ``doc_id``, outer card ``"11"`` holding inner ``"9"`` cards plus noise
  cards, whole texts; after the last page comes an ``ok: 0`` page.
* ``topic_name`` / ``topic_search`` from ``part``: a film per ``p_brand``,
  8 results a page (inner card ``8``), then an ``ok: 0`` page; brands 23 and
  up have no ``ok`` on their title page; ``ECONOMY`` parts lack
  ``analysis_extra``.
* a fetch log from ``events``: one fetch per event of a feed page
  (``user_id``, ``props.k``); status by ``event_type``; attempts counted per
  URL in time order.

Positions inside an account, order, source or brand are a window over the key's
rows, whose partitioning the page assembly and the joins on the key reuse: rows
are shuffled once, as narrow columns, and rendered after it.  Keys with more
than ``HOT_ROWS`` rows go through ``keyed_running_count`` instead, which spreads
one key over many tasks.  Each kind is landed when a query first reads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelake.functions.time import site_time_text
from pagelake.operators.ordinal import keyed_running_count
from pagelake.functions.urls import (
    comment_request, profile_request, status_list_request, supertopic_request,
    topic_name_request, topic_search_request,
)
from pagelake.schemas import RAW_PAGES

# Fixed values of the renderings (shared with the oracle SQL).
POSTS_PER_PAGE = 10
COMMENTS_PER_PAGE = 2
FEED_POSTS_PER_PAGE = 5
TOPICS_PER_PAGE = 8
LANDED_AT = "2024-02-01 00:00:00"
FEED_EPOCH = "2023-06-01 00:00:00"
STATUS_BY_EVENT = {"view": 200, "click": 200, "purchase": 404, "signup": 418, "error": 503}
BAD_DATE_TEXT = "刚刚"
HOT_ROWS = 1_000_000       # a key with more rows is ranked over many tasks
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity",
              "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _json(struct: Column, keep_nulls: bool = False) -> Column:
    return F.to_json(struct, {"ignoreNullFields": "false"} if keep_nulls else {})


def _pages(df: DataFrame) -> DataFrame:
    """Project onto the landing schema (missing columns are NULL)."""
    cols = []
    for f in RAW_PAGES.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _landed(offset_seconds: Column | None = None) -> Column:
    ts = F.lit(LANDED_AT).cast("timestamp")
    if offset_seconds is None:
        return ts
    return ts + F.make_interval(secs=offset_seconds.cast("int"))


def _joined(items: Column) -> Column:
    """Comma-joined JSON texts of an array of ``struct(pos, json)``, by ``pos``."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["json"]), ",")


def _assemble(items: Column) -> Column:
    """JSON array text from an array of ``struct(pos, json)``."""
    return F.concat(F.lit("["), _joined(items), F.lit("]"))


def _json_string(c: Column) -> Column:
    """A value as a JSON literal (quoted and escaped for text)."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)


# --------------------------------------------------------------------------- status_list

def container_of(user: Column) -> Column:
    return F.concat(F.lit("107603"), user.cast("string"))


def rank_within(df: DataFrame, keys: list[str], order: list, name: str = "rn") -> DataFrame:
    """0-based position inside each key (skew-safe: see ``keyed_running_count``)."""
    return keyed_running_count(df, keys, order, None, name=name, inclusive=False)


def count_within(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows per key joined back (a hash aggregate, then an equi-join)."""
    return df.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys)


def split_hot(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys, and those of keys with more than ``HOT_ROWS``
    rows (None if there are none).  Rows without a key are in neither."""
    df = df.where(F.col(key).isNotNull())
    found = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select(key).collect()
    if not found:
        return df, None
    hot = F.broadcast(df.sparkSession.createDataFrame(found, df.select(key).schema))  # at most 1 / HOT_ROWS of the rows
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")


def placed(df: DataFrame, key: str, order: list, name: str, total: str) -> list[DataFrame]:
    """``df`` with the 0-based position inside each ``key`` and its number of
    rows: one frame partitioned by ``key``, and one more for hot keys."""
    ordinary, hot = split_hot(df, key)
    mine = Window.partitionBy(key)
    out = [ordinary.withColumn(name, (F.row_number().over(mine.orderBy(*order)) - 1).cast("long"))
           .withColumn(total, F.count(F.lit(1)).over(mine))]
    if hot is not None:
        out.append(count_within(rank_within(hot, [key], order, name), [key], total))
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def status_posts(orders: DataFrame) -> list[DataFrame]:
    """Post-level rows of the feed layout: ``user, oid, rn, page_no, pos, n_posts``
    (ordinary accounts, and hot ones if there are any)."""
    o = orders.select(F.col("o_custkey").alias("user"), F.col("o_orderkey").alias("oid"),
                      "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    page_no = F.floor(F.col("rn") / POSTS_PER_PAGE).cast("int")
    return [p.withColumn("page_no", page_no).withColumn("pos", F.col("rn") - F.col("page_no") * POSTS_PER_PAGE + 1)
            for p in placed(o, "user", [F.col("oid").desc()], "rn", "n_posts")]


def post_card(x: Column) -> Column:
    """The card of a post (a struct of its columns)."""
    oid = x["oid"].cast("string")
    bad_date = (x["o_orderpriority"] == "1-URGENT") & (x["o_orderstatus"] == "P")
    no_text = (x["o_orderpriority"] == "3-MEDIUM") & (x["o_orderstatus"] == "F")
    price = F.floor(x["o_totalprice"]).cast("bigint")
    mblog = F.struct(
        oid.alias("id"),
        F.when(bad_date, F.lit(BAD_DATE_TEXT)).otherwise(site_time_text(x["o_orderdate"])).alias("created_at"),
        F.when(~no_text, F.concat(x["o_orderpriority"], F.lit(" / "), x["o_orderstatus"])).alias("text"),
        F.floor(x["o_totalprice"] / 1000).cast("bigint").alias("reposts_count"),
        price.cast("string").alias("comments_count"),
        (F.round(x["o_totalprice"] * 100).cast("bigint") - price * 100).alias("attitudes_count"),
    )
    return F.struct(
        F.lit(9).alias("card_type"), oid.alias("itemid"),
        F.concat(F.lit("https://m.weibo.cn/status/"), oid, F.lit("?mblogid="), oid, F.lit("&luicode=10000011")).alias("scheme"),
        F.lit(0).alias("show_type"), mblog.alias("mblog"),
    )


def status_pages(orders: DataFrame) -> DataFrame:
    ordinary, *hot = status_posts(orders)
    return union_all([_status_pages(ordinary), *[_status_pages(posts, hot=True) for posts in hot]])


def _status_pages(posts: DataFrame, hot: bool = False) -> DataFrame:
    pages = posts.groupBy("user", "page_no").agg(
        F.collect_list(F.struct("pos", "oid", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")).alias("posts"),
        F.min("oid").alias("last_oid"),
        F.max("n_posts").alias("n_posts"),
    )
    # The request of page p carries the cursor of page p - 1 (for hot accounts by a page-level join).
    if hot:
        prev = pages.select("user", (F.col("page_no") + 1).alias("page_no"), F.col("last_oid").alias("cursor_in"))
        pages = pages.join(prev, ["user", "page_no"], "left")
    else:
        pages = pages.withColumn("cursor_in", F.lag("last_oid").over(Window.partitionBy("user").orderBy("page_no")))
    pages = pages.withColumn("cards", F.transform(
        "posts", lambda x: F.struct(x["pos"].alias("pos"), _json(post_card(x)).alias("json"))))
    promo = ('{"card_type":9,"itemid":"promo","scheme":"https://m.weibo.cn/p/promo",'
             '"mblog":{"id":"0"}}')
    label = '{"card_type":11,"itemid":"label","scheme":"https://m.weibo.cn/p/label","show_type":1,"title":"more"}'
    last_page = F.col("page_no") == F.floor((F.col("n_posts") - 1) / POSTS_PER_PAGE)
    cardlist = F.when(last_page, F.lit('{"total":')).otherwise(
        F.concat(F.lit('{"since_id":'), F.col("last_oid").cast("string"), F.lit(',"total":')))
    cardlist = F.concat(cardlist, F.col("n_posts").cast("string"), F.lit("}"))
    body = F.concat(F.lit('{"ok":1,"data":{"cardlistInfo":'), cardlist, F.lit(',"cards":['), F.lit(promo),
                    F.lit(","), _joined(F.col("cards")), F.lit(","), F.lit(label), F.lit("]}}"))
    user = F.col("user").cast("string")
    base = status_list_request(profile_request(user), container_of(F.col("user")))
    url = F.when(F.col("page_no") == 0, base).otherwise(
        F.concat(base, F.lit("&since_id="), F.col("cursor_in").cast("string")))
    return _pages(pages.select(
        F.concat(F.lit("status_list:"), user, F.lit(":"), F.col("page_no").cast("string")).alias("page_key"),
        F.lit("status_list").alias("kind"), user.alias("seed_key"), "page_no",
        url.alias("request_url"), F.lit(200).alias("http_status"), F.lit(1).alias("attempt"),
        _landed(F.col("user") + F.col("page_no")).alias("fetched_at"), body.alias("body")))


# --------------------------------------------------------------------------- profile

def profile_pages(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    verified = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")

    def body(followers: Column) -> Column:
        info = F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("screen_name"),
            F.col("c_nationkey").alias("follow_count"), followers.alias("followers_count"),
            F.when(F.col("c_acctbal") >= 0, F.concat(F.col("c_mktsegment"), F.lit(" buyer"))).alias("description"),
            (F.col("c_nationkey") + 1).alias("statuses_count"), verified.alias("verified"),
            F.concat(F.col("c_mktsegment"), F.lit(" expert")).alias("verified_reason"),
        )
        tabs = F.array(F.struct(F.concat(F.lit("100505"), key).alias("containerid")),
                       F.struct(container_of(F.col("c_custkey")).alias("containerid")))
        return _json(F.struct(F.lit(1).alias("ok"),
                              F.struct(info.alias("userInfo"), F.struct(tabs.alias("tabs")).alias("tabsInfo")).alias("data")))

    latest = customer.select(
        F.concat(F.lit("profile:"), key, F.lit(":1")).alias("page_key"),
        _landed(F.col("c_custkey") + 86400).alias("fetched_at"),
        body(F.floor("c_acctbal").cast("bigint")).alias("body"), "c_custkey")
    older = customer.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.concat(F.lit("profile:"), key, F.lit(":0")).alias("page_key"),
        _landed(F.col("c_custkey")).alias("fetched_at"),
        body(F.lit(0).cast("bigint")).alias("body"), "c_custkey")
    both = latest.unionByName(older)
    k = F.col("c_custkey").cast("string")
    return _pages(both.select("page_key", F.lit("profile").alias("kind"), k.alias("seed_key"),
                              profile_request(k).alias("request_url"), F.lit(200).alias("http_status"),
                              F.lit(1).alias("attempt"), "fetched_at", "body", F.lit(0).alias("page_no")))


# --------------------------------------------------------------------------- hot_comments

def comment_rows(lineitem: DataFrame, orders: DataFrame) -> list[DataFrame]:
    """Comment-level rows: ``oid, user, ln_rank, page_no, pos, n_lines``
    (ordinary posts, and hot ones if there are any)."""
    # Line numbers repeat within an order; the other columns make the order total.
    li = lineitem.select("l_orderkey", *LINE_ORDER)
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"),
                      "o_orderpriority", "o_orderstatus")
    page_no = F.floor(F.col("r") / COMMENTS_PER_PAGE).cast("int")
    return [rows.join(o, "l_orderkey").withColumn("page_no", page_no)
            .withColumn("pos", F.col("r") - F.col("page_no") * COMMENTS_PER_PAGE)
            for rows in placed(li, "l_orderkey", list(LINE_ORDER), "r", "n_lines")]


def comment_item(x: Column, oid: Column) -> Column:
    """The JSON of a comment (a struct of its columns) on a post."""
    user = F.struct(x["l_suppkey"].alias("id"),
                    F.concat(F.lit("Supplier#"), F.lpad(x["l_suppkey"].cast("string"), 9, "0")).alias("screen_name"))
    text = F.concat(F.lit("line "), x["l_linenumber"].cast("string"), F.lit(" of "), oid.cast("string"))
    common = [site_time_text(x["l_shipdate"]).alias("created_at"), text.alias("text")]
    likes = x["l_quantity"].cast("bigint").alias("like_count")
    total = x["l_linenumber"].alias("total_number")
    who = F.when(x["l_discount"] != 0, user).alias("user")
    return F.when(x["l_tax"] != 0, _json(F.struct(*common, likes, total, who), keep_nulls=True)) \
        .otherwise(_json(F.struct(*common, total, who), keep_nulls=True))


def comment_pages(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return union_all([_comment_pages(rows) for rows in comment_rows(lineitem, orders)])


def _comment_pages(rows: DataFrame) -> DataFrame:
    pages = rows.groupBy("l_orderkey", "page_no").agg(
        F.collect_list(F.struct("pos", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax"))
        .alias("lines"),
        F.first("user").alias("user"), F.first("n_lines").alias("n_lines"),
        F.first("o_orderpriority").alias("prio"), F.first("o_orderstatus").alias("status"))
    pages = pages.withColumn("items", F.transform(
        "lines", lambda x: F.struct(x["pos"].alias("pos"), comment_item(x, F.col("l_orderkey")).alias("json"))))
    last_page = F.col("page_no") == F.floor((F.col("n_lines") - 1) / COMMENTS_PER_PAGE)
    max_id = F.when(last_page, F.lit(0)).otherwise(F.col("l_orderkey") * 10 + F.col("page_no") + 1)
    no_cursor = (F.col("prio") == "2-HIGH") & (F.col("status") == "F")
    cursor = F.when(no_cursor, F.lit("")).otherwise(
        F.concat(F.lit(',"max_id":'), max_id.cast("string"), F.lit(',"max_id_type":0')))
    body = F.concat(F.lit('{"ok":1,"data":{"data":'), _assemble(F.col("items")), F.lit(',"total_number":'),
                    F.col("n_lines").cast("string"), cursor, F.lit("}}"))
    oid = F.col("l_orderkey").cast("string")
    url = F.when(F.col("page_no") == 0, comment_request(oid)).otherwise(
        F.concat(comment_request(oid), F.lit("&max_id="), (F.col("l_orderkey") * 10 + F.col("page_no")).cast("string"),
                 F.lit("&max_id_type=0")))
    return _pages(pages.select(
        F.concat(F.lit("hot_comments:"), oid, F.lit(":"), F.col("page_no").cast("string")).alias("page_key"),
        F.lit("hot_comments").alias("kind"), oid.alias("seed_key"),
        F.col("user").cast("string").alias("parent_user_id"), oid.alias("parent_status_id"), "page_no",
        url.alias("request_url"), F.lit(200).alias("http_status"), F.lit(1).alias("attempt"),
        _landed(F.col("l_orderkey") + F.col("page_no")).alias("fetched_at"), body.alias("body")))


# --------------------------------------------------------------------------- supertopic

def feed_of(source: Column) -> Column:
    return F.concat(F.lit("100808"), source)


def supertopic_pages(documents: DataFrame) -> DataFrame:
    d = rank_within(documents.select("doc_id", "text", "lang", "source", "n_chars"), ["source"], ["doc_id"], "r")
    d = d.withColumn("page_no", F.floor(F.col("r") / FEED_POSTS_PER_PAGE).cast("int"))
    d = d.withColumn("pos", F.col("r") - F.col("page_no") * FEED_POSTS_PER_PAGE)
    user = F.struct(
        F.col("n_chars").alias("id"), F.concat(F.lit("writes in "), F.col("lang")).alias("description"),
        F.concat(F.col("source"), F.lit("_"), F.col("lang")).alias("screen_name"),
        F.floor(F.col("n_chars") / 10).cast("bigint").alias("followers_count"),
        F.when(F.col("lang") != "en", F.concat(F.lit("voice of "), F.col("source"))).alias("verified_reason"))
    created = F.lit(FEED_EPOCH).cast("timestamp") + F.make_interval(mins=F.col("doc_id").cast("int"))
    mblog = F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("comments_count"),
                     site_time_text(created).alias("created_at"), F.col("lang").alias("source"),
                     "text", user.alias("user"))
    d = d.withColumn("json", _json(F.struct(F.lit("9").alias("card_type"), mblog.alias("mblog"))))
    pages = d.groupBy("source", "page_no").agg(F.collect_list(F.struct("pos", "json")).alias("items"))
    noise_inner = '{"card_type":"4","desc":"hint"}'
    noise_outer = '{"card_type":"6","title":"ad"}'
    group = F.concat(F.lit('{"card_type":"11","card_group":['), _joined(F.col("items")),
                     F.lit(","), F.lit(noise_inner), F.lit("]}"))
    nick = _json_string(F.concat(F.col("source"), F.lit(" fans")))
    body = F.concat(F.lit('{"ok":1,"data":{"nick":'), nick, F.lit(',"pageInfo":{"since_id":'),
                    (F.col("page_no") + 1).cast("string"), F.lit('},"cards":['), F.lit(noise_outer), F.lit(","),
                    group, F.lit("]}}"))
    last = pages.groupBy("source").agg((F.max("page_no") + 1).alias("page_no")) \
        .withColumn("body", F.lit('{"ok":0,"msg":"no more"}'))
    allp = pages.select("source", "page_no", body.alias("body")).unionByName(last)
    feed = feed_of(F.col("source"))
    url = F.when(F.col("page_no") == 0, supertopic_request(feed)).otherwise(
        supertopic_request(feed, F.col("page_no").cast("string")))
    return _pages(allp.select(
        F.concat(F.lit("supertopic:"), feed, F.lit(":"), F.col("page_no").cast("string")).alias("page_key"),
        F.lit("supertopic").alias("kind"), feed.alias("seed_key"), "page_no", url.alias("request_url"),
        F.lit(200).alias("http_status"), F.lit(1).alias("attempt"),
        _landed(F.col("page_no")).alias("fetched_at"), "body"))


# --------------------------------------------------------------------------- topics

def film_of(brand: Column) -> Column:
    return F.concat(F.lit("100120"), F.regexp_extract(brand, r"(\d+)", 1))


def topic_name_pages(part: DataFrame) -> DataFrame:
    film, title = film_of(F.col("p_brand")), F.col("p_brand")
    brand_no = F.regexp_extract(F.col("p_brand"), r"(\d+)", 1).cast("int")
    films = part.select("p_brand").distinct()
    name_body = F.concat(F.when(brand_no >= 23, F.lit("{")).otherwise(F.lit('{"ok":1,')),
                         F.lit('"data":{"pageInfo":'), F.to_json(F.struct(title.alias("nick"))), F.lit("}}"))
    return _topic_landing(films.select(
        F.concat(F.lit("topic_name:"), film).alias("page_key"), F.lit("topic_name").alias("kind"),
        film.alias("seed_key"), F.lit(0).alias("page_no"), topic_name_request(film).alias("request_url"),
        name_body.alias("body")))


def topic_search_pages(part: DataFrame) -> DataFrame:
    film, title = film_of(F.col("p_brand")), F.col("p_brand")
    p = rank_within(part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), ["p_brand"], ["p_partkey"], "r")
    p = p.withColumn("page_no", (F.floor(F.col("r") / TOPICS_PER_PAGE) + 1).cast("int"))
    p = p.withColumn("pos", F.col("r") - (F.col("page_no") - 1) * TOPICS_PER_PAGE)
    item = F.struct(F.lit(8).alias("card_type"), F.col("p_name").alias("title_sub"), F.col("p_type").alias("desc1"),
                    F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("desc2"),
                    F.concat(F.lit("https://img.example.com/p/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("pic"),
                    F.concat(F.lit("topic_"), F.col("p_partkey").cast("string")).alias("item_id"),
                    F.when(F.col("p_type") != "ECONOMY", F.concat(F.lit("size|"), F.col("p_size").cast("string")))
                    .alias("analysis_extra"))
    p = p.withColumn("json", _json(item))
    pages = p.groupBy("p_brand", "page_no").agg(F.collect_list(F.struct("pos", "json")).alias("items"))
    group = F.concat(F.lit('{"card_type":11,"card_group":['), _joined(F.col("items")),
                     F.lit(',{"card_type":9,"desc":"more"}]}'))
    body = F.concat(F.lit('{"ok":1,"data":{"cards":['), group, F.lit("]}}"))
    last = pages.groupBy("p_brand").agg((F.max("page_no") + 1).alias("page_no")) \
        .withColumn("body", F.lit('{"ok":0,"msg":"no more"}'))
    allp = pages.select("p_brand", "page_no", body.alias("body")).unionByName(last)
    return _topic_landing(allp.select(
        F.concat(F.lit("topic_search:"), film, F.lit(":"), F.col("page_no").cast("string")).alias("page_key"),
        F.lit("topic_search").alias("kind"), film.alias("seed_key"), title.alias("seed_name"), "page_no",
        topic_search_request(title, F.col("page_no")).alias("request_url"), "body"))


def _topic_landing(pages: DataFrame) -> DataFrame:
    return _pages(pages.withColumn("http_status", F.lit(200)).withColumn("attempt", F.lit(1))
                  .withColumn("fetched_at", _landed(F.col("page_no"))))


# --------------------------------------------------------------------------- fetch log

def fetch_log(events: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k")
    url = F.concat(status_list_request(profile_request(user), container_of(F.col("user_id"))),
                   F.lit("&since_id="), k)
    status = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(s)) for t, s in STATUS_BY_EVENT.items()],
                        F.lit(200))
    e = events.select("event_id", "ts", "user_id", url.alias("request_url"), status.alias("http_status"),
                      k.try_cast("int").alias("page_no"))
    e = keyed_running_count(e, ["request_url"], ["ts", "event_id"], None, name="attempt") \
        .withColumn("attempt", F.col("attempt").cast("int"))
    return _pages(e.select(
        F.concat(F.lit("fetch:"), F.col("event_id").cast("string")).alias("page_key"),
        F.lit("status_list").alias("kind"), user.alias("seed_key"), "page_no", "request_url",
        "http_status", "attempt", F.col("ts").cast("timestamp").alias("fetched_at"),
        F.when(F.col("http_status") != 200, F.lit("<html>error</html>")).alias("body")))


# --------------------------------------------------------------------------- all

BUILDERS = {
    "status_list": lambda t: status_pages(t("orders")),
    "profile": lambda t: profile_pages(t("customer")),
    "hot_comments": lambda t: comment_pages(t("lineitem"), t("orders")),
    "supertopic": lambda t: supertopic_pages(t("documents")),
    "topic_name": lambda t: topic_name_pages(t("part")),
    "topic_search": lambda t: topic_search_pages(t("part")),
}


def rendered(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The pages of ``kind`` as a ``raw_pages`` frame, not yet landed."""
    return BUILDERS[kind](lambda name: table(spark, sf_dir, name))


# --------------------------------------------------------------------------- landing once per session

_LANDINGS: dict[tuple, tuple[str, set[str]]] = {}


def _signature(sf_dir: str) -> tuple:
    """Sizes and modification times of the source tables (a changed table
    gives a new landing)."""
    import os

    sig = []
    for name in ("orders", "customer", "lineitem", "documents", "part", "events"):
        base = f"{sf_dir.rstrip('/')}/{name}.parquet"
        try:
            paths = [base] if os.path.isfile(base) else sorted(
                os.path.join(base, f) for f in os.listdir(base))
            sig.extend((p, os.path.getsize(p), int(os.path.getmtime(p))) for p in paths)
        except OSError:
            sig.append((base, None))
    return tuple(sig)


def landing(spark: SparkSession, sf_dir: str, kinds: list[str] | None = None) -> str:
    """Land the pages of ``kinds`` (all kinds if not given), each kind once per
    session, in a Parquet table partitioned by ``kind`` in the shared work
    folder; later calls reuse them.  A kind is written straight into its folder
    by the tasks that rendered it: no page is shuffled or sorted for it."""
    from pagelake.session import fresh_dir

    key = (spark.sparkContext.applicationId, sf_dir, _signature(sf_dir))
    path, done = _LANDINGS.setdefault(key, (fresh_dir(spark, "landing"), set()))
    for kind in kinds or BUILDERS:
        if kind not in done:
            rendered(spark, sf_dir, kind).drop("kind").write.mode("overwrite").parquet(f"{path}/kind={kind}")
            done.add(kind)
    return path


def landed(spark: SparkSession, sf_dir: str, kinds: list[str] | None = None) -> DataFrame:
    """The landed pages (of ``kinds``), read with ``read_pages``."""
    from pagelake.sources.pages import read_pages

    return read_pages(spark, landing(spark, sf_dir, kinds)).where(F.col("kind").isin(*(kinds or BUILDERS)))


_FETCH_LOGS: dict[tuple, str] = {}


def landed_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log, landed once per session (like the pages)."""
    from pagelake.session import fresh_dir
    from pagelake.sources.pages import read_pages

    key = (spark.sparkContext.applicationId, sf_dir, _signature(sf_dir))
    path = _FETCH_LOGS.get(key)
    if path is None:
        path = fresh_dir(spark, "fetch-log")
        fetch_log(table(spark, sf_dir, "events")).write.parquet(path)
        _FETCH_LOGS[key] = path
    return read_pages(spark, path)
