"""Queries over seed inputs: files written from the test tables, then read
back with the seed readers; global order and work shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.operators import links as ln
from pagelake.operators import ordinal as od
from pagelake.plans import fixtures as fx
from pagelake.plans import sql as S
from pagelake.plans.q_pages import comment_pages
from pagelake.plans.registry import query
from pagelake.session import fresh_dir
from pagelake.sources import seeds as sd
from pagelake.sources.seed_store import SeedStore

# Parameters of the registered queries.
RANK_LO, RANK_HI = 1200, 1400
RESUME_FROM = 1000


def write_lines(df: DataFrame, column: str, order: list[str], path: str) -> str:
    """One value per line, in ``order`` (range-sorted part files keep it)."""
    df.orderBy(*order).select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def id_list(spark: SparkSession, sf: str) -> DataFrame:
    """Account ids (customer keys, in key order) and their post counts, as two
    files paired by line."""
    cust = fx.table(spark, sf, "customer").select("c_custkey")
    posts = fx.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    counted = cust.join(posts, cust.c_custkey == posts.o_custkey, "left") \
        .select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))
    ids_path = write_lines(cust, "c_custkey", ["c_custkey"], fresh_dir(spark, "ids"))
    counts_path = write_lines(counted, "n", ["c_custkey"], fresh_dir(spark, "counts"))
    ids = sd.read_id_list(spark, ids_path, "id")
    counts = sd.read_id_list(spark, counts_path, "n_posts").withColumn("n_posts", F.col("n_posts").cast("bigint"))
    return sd.zip_lists(ids, counts)


LIST_SQL = """
lst AS (
  SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS ordinal, CAST(c_custkey AS VARCHAR) AS id,
         CAST(count(o_orderkey) AS BIGINT) AS n_posts, count(*) OVER () AS len
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)"""


@query("read_id_list", "WITH " + LIST_SQL + " SELECT ordinal, id, n_posts FROM lst")
def q_read_id_list(spark, sf):
    """Two text files, one value per line, paired by 0-based line number (``zip_lists``)."""
    return id_list(spark, sf)


@query("zip_lists", "WITH " + LIST_SQL + " SELECT ordinal, id, n_posts FROM lst")
def q_zip_lists(spark, sf):
    """Line *i* of the id list with line *i* of the count list."""
    return id_list(spark, sf).select("ordinal", "id", "n_posts")


@query("read_status_seeds", """
SELECT CAST(o_orderkey AS VARCHAR) AS statues_id, CAST(o_custkey AS VARCHAR) AS user_id FROM orders""")
def q_read_status_seeds(spark, sf):
    """JSON lines ``{statues_id, user_id, ...}``: ids read as text whether number or string."""
    path = fresh_dir(spark, "status-seeds")
    o = fx.table(spark, sf, "orders")
    o.select(F.col("o_orderkey").alias("statues_id"), F.col("o_custkey").cast("string").alias("user_id"),
             F.col("o_orderpriority").alias("note")).write.json(path)
    return sd.read_status_seeds(spark, path)


@query("read_seed_set", "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id FROM lineitem")
def q_read_seed_set(spark, sf):
    """Distinct ids of a stored set (commenters, with repeats, written as a table)."""
    path = fresh_dir(spark, "seed-set")
    fx.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("id")).write.parquet(path)
    return sd.read_seed_set(spark, path)


@query("sort_ids", """
SELECT CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS BIGINT) AS ordinal,
       CAST(c_custkey AS VARCHAR) AS id FROM customer""")
def q_sort_ids(spark, sf):
    """Ids in ascending text order ("10" before "9") with position."""
    ids = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return od.sort_ids(ids).select("ordinal", "id")


@query("add_ordinal", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS ordinal FROM orders""")
def q_add_ordinal(spark, sf):
    """Contiguous global position without a single-partition window."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return od.add_ordinal(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "ordinal")


@query("rank_slice", "WITH " + LIST_SQL + f""",
ranked AS (SELECT id, n_posts, CAST(row_number() OVER (ORDER BY n_posts, ordinal) - 1 AS BIGINT) AS rank FROM lst)
SELECT id, n_posts, rank FROM ranked WHERE rank >= {RANK_LO} AND rank < {RANK_HI}""")
def q_rank_slice(spark, sf):
    """Positions 1200-1399 of the accounts stably sorted by post count."""
    return od.rank_slice(id_list(spark, sf), "n_posts", RANK_LO, RANK_HI).select("id", "n_posts", "rank")


def listed(spark: SparkSession, sf: str) -> DataFrame:
    ids = id_list(spark, sf).select("id", F.col("ordinal").alias("line"))
    return od.add_ordinal(ids, ["line"], length="_len")


@query("fraction_slice", "WITH " + LIST_SQL + """
SELECT id, ordinal, CAST(((ordinal + 1) * 32 + len - 1) // len - 1 AS INTEGER) AS share FROM lst""")
def q_fraction_slice(spark, sf):
    """Every id with its share of 32 exact shares (cut at ``int(L·k/32)``)."""
    return od.fraction_slice(listed(spark, sf)).select("id", "ordinal", "share")


@query("skip_fraction", "WITH " + LIST_SQL + """,
sh AS (SELECT *, ((ordinal + 1) * 32 + len - 1) // len - 1 AS share FROM lst),
b AS (SELECT *, (len * share) // 32 AS lo, (len * (share + 1)) // 32 AS hi FROM sh)
SELECT id, CAST(share AS INTEGER) AS share FROM b
WHERE share < 16 OR ordinal - lo >= CAST(floor((hi - lo) * 0.15) AS BIGINT)""")
def q_skip_fraction(spark, sf):
    """Shares 16-31 start 15 % into their range."""
    return od.skip_fraction(od.fraction_slice(listed(spark, sf))).select("id", "share")


@query("fixed_slice", """
WITH s AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
                  CAST(row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS BIGINT) AS ordinal FROM orders)
SELECT id, ordinal, ordinal // 244078 AS slice, (ordinal - (ordinal // 244078) * 244078) // 4881 AS sub,
       (ordinal - (ordinal // 244078) * 244078) // 4881 < 50 AS covered FROM s""")
def q_fixed_slice(spark, sf):
    """Fixed slices of 244,078 ids in 50 sub-slices of 4,881 (with the uncovered tail flagged)."""
    ids = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return od.fixed_slice(od.sort_ids(ids)).select("id", "ordinal", "slice", "sub", "covered")


def done_list(spark: SparkSession, sf: str) -> DataFrame:
    """The done list (labelled document ids, one per line), read as a set."""
    path = write_lines(fx.table(spark, sf, "labels"), "doc_id", ["doc_id"], fresh_dir(spark, "done"))
    return sd.read_lines(spark, path, "id")


@query("exclude_done", """
SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer
WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""")
def q_exclude_done(spark, sf):
    """Account ids minus the done list (anti join)."""
    ids = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    return ln.exclude_done(ids, done_list(spark, sf))


@query("ids_minus_done", """
SELECT CAST(o_custkey AS VARCHAR) AS id FROM orders EXCEPT ALL SELECT CAST(doc_id AS VARCHAR) FROM labels""")
def q_ids_minus_done(spark, sf):
    """Seed rows (with repeats) minus done rows, as ``EXCEPT ALL``."""
    seeds = fx.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("id"))
    return ln.ids_minus_done(seeds, done_list(spark, sf).select("id"))


@query("id_at_least", f"SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey >= {RESUME_FROM}")
def q_id_at_least(spark, sf):
    """Resume from a numeric id bound."""
    ids = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    return fl.id_at_least(ids, "id", RESUME_FROM)


# --------------------------------------------------------------------------- the set across runs

KEPT_COMMENTS = "good AND NOT (page_no > 0 AND no_cursor)"


@query("seed_store_insert", S.with_(S.COMMENTS, f"""
first AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id FROM citems WHERE {KEPT_COMMENTS} AND page_no = 0),
every AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id FROM citems WHERE {KEPT_COMMENTS})
SELECT CAST(1 AS INTEGER) AS run, id FROM first
UNION ALL SELECT 2, id FROM every WHERE id NOT IN (SELECT id FROM first)"""))
def q_seed_store_insert(spark, sf):
    """New commenter ids of three inserts into one set: first pages, all pages, all pages again (none)."""
    store = SeedStore(spark, fresh_dir(spark, "seed-set"))
    comments = ex.extract_comments(comment_pages(spark, sf)).select("page_no", F.col("comment_people_id").alias("id"))
    runs = [comments.where(F.col("page_no") == 0), comments, comments]
    return reduce(DataFrame.unionByName, [store.insert(c).select(F.lit(k + 1).alias("run"), "id") for k, c in enumerate(runs)])


@query("seed_store_totals", S.with_(S.COMMENTS, f"""
g AS (SELECT CAST('2024-01-01' AS DATE) + page_no AS added_on, CAST(l_suppkey AS VARCHAR) AS id, page_no
      FROM citems WHERE {KEPT_COMMENTS}),
f AS (SELECT id, min(page_no) AS since FROM g GROUP BY 1),
d AS (SELECT added_on, page_no, count(*) AS n_given FROM g GROUP BY 1, 2)
SELECT added_on, n_given, (SELECT count(*) FROM f WHERE since = d.page_no) AS n_new,
       (SELECT count(*) FROM f WHERE since <= d.page_no) AS n_ids FROM d"""))
def q_seed_store_totals(spark, sf):
    """Growth of the set when comment pages come a page number a day; old ids are not read again."""
    store = SeedStore(spark, fresh_dir(spark, "seed-set"))
    comments = ex.extract_comments(comment_pages(spark, sf)).select("page_no", F.col("comment_people_id").alias("id"))
    for day in sorted(r.page_no for r in comments.select("page_no").distinct().collect()):
        store.insert(comments.where(F.col("page_no") == day), added_on=f"2024-01-{day + 1:02d}")
    return store.totals().withColumn("n_ids", F.col("n_ids").cast("long"))
