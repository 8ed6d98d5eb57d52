"""Order of pages from their cursors.

A fetcher follows cursors: every page names the cursor of the next one, and
the request of a page carries the cursor it was fetched with.  Page numbers
are a by-product that may be absent or wrong; the links are enough to put the
pages of an account (or the comment pages of a post) in order.

A node is a (key, cursor) pair that has landed; the first page's cursor is the
empty text.  Every node points at the page that named its cursor, and pointer
doubling turns the pointers into distances from the start of the chain: a
chain of ``k`` pages takes about log2(k) joins on (key, cursor), which spread
an account with a third of all pages over all tasks.  Each step writes the nodes
it moved to the shared work folder, so a lost executor repeats one step.

Pages whose cursor no landed page named start a broken piece; pages whose
cursors go round in a circle belong to no chain.  Both are numbered after the
whole chain and listed by ``broken_chains``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.operators import extract as ex
from pagelake.operators.ordinal import keyed_running_count
from pagelake.session import fresh_dir

HOT_PAGES = 100_000        # a key with more pages is numbered over many tasks
WHOLE, BROKEN, CIRCLE = "whole", "broken", "circle"
# The request parameter that carries the cursor, and whether later pages have smaller cursors.
CURSORS = {"status_list": ("since_id", True), "hot_comments": ("max_id", False)}


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def request_cursor(url: Column, parameter: str) -> Column:
    """The cursor of a request; the empty text for a first page."""
    return F.coalesce(F.regexp_extract(url, rf"[?&]{parameter}=([^&]*)", 1), F.lit(""))


def page_links(pages: DataFrame, kind: str = "status_list") -> DataFrame:
    """One row per landed page of ``kind``: ``chain_key`` (the account or the
    post), ``page_key``, ``cursor`` (of its request) and ``next_cursor`` (NULL
    on the last page).  A NULL key is a key of its own."""
    parameter, _ = CURSORS[kind]
    if kind == "status_list":
        found = ex.status_page_cursor(pages)
        key, named = F.col("seed_key"), F.col("since_id")
    else:
        found = ex.comment_pages(pages)
        key, named = F.col("parent_status_id"), F.when(F.col("has_cursor") & (F.col("max_id") != "0"), F.col("max_id"))
    return found.select(F.coalesce(F.concat(F.lit("="), key), F.lit("")).alias("chain_key"), "page_key",
                        request_cursor(F.col("request_url"), parameter).alias("cursor"),
                        F.when(named != "", named).alias("next_cursor"))


def chain_positions(links: DataFrame) -> DataFrame:
    """Per landed (``chain_key``, ``cursor``): ``chain_pos`` (pages before it
    in its piece), ``chain_head`` (cursor of the piece's first page; NULL in a
    circle) and ``chain_status`` (``whole``, ``broken`` or ``circle``).

    A page landed more than once is one node.  If several pages name the same
    cursor, the smallest of their own cursors counts.
    """
    named = links.where("next_cursor IS NOT NULL AND next_cursor <> cursor AND cursor IS NOT NULL") \
        .select("chain_key", F.col("next_cursor").alias("cursor"), F.col("cursor").alias("ptr"), F.lit(False).alias("landed"))
    own = links.select("chain_key", "cursor", F.lit(None).cast("string").alias("ptr"), F.lit(True).alias("landed"))
    nodes = own.union(named).groupBy("chain_key", "cursor") \
        .agg(F.min("ptr").alias("ptr"), F.max("landed").alias("landed")).where("landed")
    first = F.col("cursor") == ""
    live = _written(nodes.select(
        "chain_key", "cursor", F.when(~first, F.col("ptr")).alias("ptr"),
        F.when(first | F.col("ptr").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("chain_pos"),
        F.when(first | F.col("ptr").isNull(), F.col("cursor")).alias("chain_head")), "chain")
    ended = []  # nodes whose pointers have reached the start of their piece, by step: each is written once
    open_ = live.where("ptr IS NOT NULL").count()
    while open_:
        at = reduce(DataFrame.union, [*ended, live]).select(
            F.col("chain_key").alias("k2"), F.col("cursor").alias("c2"), F.col("ptr").alias("ptr2"),
            F.col("chain_pos").alias("pos2"), F.col("chain_head").alias("head2"))
        moved = live.where("ptr IS NOT NULL").join(at, (F.col("chain_key") == F.col("k2")) & (F.col("ptr") == F.col("c2"))) \
            .select("chain_key", "cursor", F.col("ptr2").alias("ptr"), (F.col("chain_pos") + F.col("pos2")).alias("chain_pos"),
                    F.col("head2").alias("chain_head"))
        ended.append(live.where("ptr IS NULL"))
        live = _written(moved, "chain")
        left = live.where("ptr IS NOT NULL").count()
        if left == open_:  # every step ends some pointer of a chain: what is left goes round
            break
        open_ = left
    table = reduce(DataFrame.union, [*ended, live])
    circle = F.col("ptr").isNotNull()
    return table.select("chain_key", "cursor", F.when(~circle, F.col("chain_pos")).alias("chain_pos"),
                        F.when(~circle, F.col("chain_head")).alias("chain_head"),
                        F.when(circle, CIRCLE).when(F.col("chain_head") == "", WHOLE).otherwise(BROKEN).alias("chain_status"))


def _cursor_order(cursor: str, falling: bool) -> list[Column]:
    number = F.col(cursor).try_cast("decimal(38,0)")
    return [number.desc_nulls_last() if falling else number.asc_nulls_last(), F.col(cursor).asc_nulls_last()]


def _numbered(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """``page_no`` from 0 inside each ``chain_key``: by a window, and for keys
    with more than ``HOT_PAGES`` nodes by ``keyed_running_count``, which spreads
    a key over many tasks."""
    found = nodes.groupBy("chain_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_PAGES).select("chain_key").collect()
    mine = Window.partitionBy("chain_key").orderBy(*order)
    number = (F.row_number().over(mine) - 1).cast("long")
    if not found:
        return nodes.withColumn("page_no", number)
    hot = F.broadcast(nodes.sparkSession.createDataFrame(found, "chain_key string"))  # at most 1 / HOT_PAGES of the nodes
    return nodes.join(hot, "chain_key", "left_anti").withColumn("page_no", number).unionByName(
        keyed_running_count(nodes.join(hot, "chain_key", "left_semi"), ["chain_key"], order, name="page_no", inclusive=False))


def chain_order(pages: DataFrame, kind: str = "status_list") -> DataFrame:
    """``page_key``, ``page_no``, ``chain_pos``, ``chain_head``,
    ``chain_status`` for every page of ``kind`` that has landed.

    ``page_no`` numbers the distinct pages of a key from 0: the whole chain
    first, then broken pieces in the order of their first cursor (post lists:
    newest, so greatest, first), then circles by cursor.  Pages at the same
    place (a list that changed between two fetches) follow each other in the
    same order.  Landings of one page share its number.
    """
    falling = CURSORS[kind][1]
    links = _written(page_links(pages, kind), "chain-links")
    placed = chain_positions(links)
    rank = F.when(F.col("chain_status") == WHOLE, 0).when(F.col("chain_status") == BROKEN, 1).otherwise(2)
    ranked = placed.withColumn("_rank", rank)
    order = [F.col("_rank"), *_cursor_order("chain_head", falling), F.col("chain_pos"), *_cursor_order("cursor", falling)]
    numbered = _numbered(ranked, order)
    return links.join(numbered.drop("_rank"), ["chain_key", "cursor"]).select(
        "page_key", "chain_key", "cursor", F.col("page_no").cast("int").alias("page_no"), "chain_pos", "chain_head", "chain_status")


def renumber(pages: DataFrame, kind: str = "status_list", broken: str = "after") -> DataFrame:
    """The pages of ``kind`` with ``page_no`` by their cursors, whatever it
    was: every operator that reads page numbers then works on pages without
    any.  ``broken='after'`` keeps pieces that no chain reaches behind the
    whole chain; ``'drop'`` leaves them out (``broken_chains`` lists them).
    Equal landings stay as many rows."""
    if broken not in ("after", "drop"):
        raise ValueError(f"unknown way with broken chains: {broken!r}")
    parameter, _ = CURSORS[kind]
    order = chain_order(pages, kind).select("chain_key", "cursor", "page_no", "chain_status").distinct()
    if broken == "drop":
        order = order.where(F.col("chain_status") == WHOLE)
    mine = pages.where(F.col("kind") == kind)
    key = F.col("seed_key") if kind == "status_list" else F.col("parent_status_id")
    keyed = mine.drop("page_no").withColumns({
        "chain_key": F.coalesce(F.concat(F.lit("="), key), F.lit("")), "cursor": request_cursor(F.col("request_url"), parameter)})
    return keyed.join(order, ["chain_key", "cursor"]).select(*pages.columns)


def broken_chains(pages: DataFrame, kind: str = "status_list") -> DataFrame:
    """Pieces that are not reached from a first page: ``chain_key`` as text
    (NULL for pages without one), ``chain_status``, ``chain_head`` (the cursor
    nobody named; NULL for circles) and ``n_pages`` (distinct pages)."""
    placed = chain_positions(_written(page_links(pages, kind), "chain-links")).where(F.col("chain_status") != WHOLE)
    return placed.groupBy("chain_key", "chain_status", "chain_head").agg(F.count(F.lit(1)).alias("n_pages")) \
        .withColumn("chain_key", F.when(F.col("chain_key") != "", F.substring("chain_key", 2, 1 << 30)))
