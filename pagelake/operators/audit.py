"""Audit and quality: rejected records with a reason, retry backlog, failure
streaks, completeness and cursor reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.operators import extract as ex

# HTTP statuses that are retried, and the retry budget.
RETRY_CODES = (500, 502, 503, 504, 522, 524, 408, 301, 302, 403, 418)
MAX_RETRIES = 12
# Fixed value: failures in a row that end a run.
STREAK_LIMIT = 15


REJECT = "array<struct<source_table: string, pos: bigint, reason: string, payload: string>>"


def _reject(table: str, pos, reason, payload):
    return F.struct(F.lit(table).alias("source_table"), pos.cast("bigint").alias("pos"), reason.alias("reason"),
                    payload.cast("string").alias("payload"))


def _page_reason(no_data):
    """Why a body can't be read at all; whether it is JSON is looked up only
    where it gave no data."""
    return F.when(F.col("body").isNull(), "null_body").when(
        no_data & F.from_json("body", "map<string,string>").isNull(), "body_not_json")


def _none():
    return F.array().cast(REJECT)


def _page_level(reason):
    return F.when(reason.isNotNull(), F.array(_reject("raw_pages", F.lit(None), reason, F.col("kind")))).otherwise(_none())


def _status_rejects(pages: DataFrame) -> DataFrame:
    p = pages.where(F.col("kind") == "status_list").select(
        "kind", "page_key", "body", F.from_json("body", "struct<data: struct<cards: array<string>>>")["data"].alias("_d"))
    cards = F.col("_d")["cards"]

    def classified(x):
        f = ex._status_fields(x["_m"], x["_mb"], x["card"])
        return F.struct(f["is_promo"].alias("is_promo"), _reject("statuses", x["pos"], f["reject_reason"], x["card"]).alias("r"))

    bad = F.filter(F.transform(ex.card_array(cards), classified), lambda x: ~x["is_promo"] & x["r"]["reason"].isNotNull())
    whole = F.coalesce(_page_reason(F.col("_d").isNull()), F.when(cards.isNull(), "no_cards"))
    return p.select("page_key", F.inline(F.concat(_page_level(whole), F.coalesce(F.transform(bad, lambda x: x["r"]), _none()))))


def _comment_rejects(pages: DataFrame) -> DataFrame:
    p = ex.parsed_comment_pages(pages)
    d = F.col("_d")
    bad = F.filter(F.transform(ex.comment_array(d["data"]), lambda x: _reject(
        "comments", x["pos"], ex.comment_reason(x["_c"], x["_u"]), x["item"])), lambda x: x["reason"].isNotNull())
    whole = F.coalesce(_page_reason(d.isNull()), F.when(d["data"].isNull(), "no_comment_list")
                       .when((F.col("page_no") > 0) & ~F.col("_has_cursor"), "no_cursor"))
    return p.select("page_key", F.inline(F.concat(_page_level(whole), F.coalesce(bad, _none()))))


def _profile_rejects(pages: DataFrame) -> DataFrame:
    p = pages.where(F.col("kind") == "profile")
    found = ex.extract_profiles(p.withColumn("_page", _page_reason(F.get_json_object("body", "$.data.userInfo").isNull())),
                                with_rejects=True, also=("_page",))
    record = F.when(F.col("reject_reason").isNotNull(), F.array(_reject("profiles", F.lit(None), F.col("reject_reason"), F.lit(None))))
    return found.select("page_key", F.inline(F.concat(_page_level(F.col("_page")), F.coalesce(record, _none()))))


def _other_rejects(pages: DataFrame) -> DataFrame:
    p = pages.where(~F.coalesce(F.col("kind").isin("status_list", "hot_comments", "profile"), F.lit(False)))
    whole = _page_reason(F.from_json("body", "struct<data: struct<none: string>>")["data"].isNull())
    return p.select("page_key", F.inline(_page_level(whole)))


def quarantine(pages: DataFrame) -> DataFrame:
    """Rejected pages, cards, comments and profiles, each with a reason.

    ``source_table``/``page_key``/``pos`` locate the reject; ``payload`` is the
    raw card or comment, or the kind of a page rejected as a whole:
    ``null_body``, ``body_not_json``, ``no_cards`` (a post list without its
    card list), ``no_comment_list``, and ``no_cursor`` (a follow-up comment page
    that is dropped for lack of one).

    Every kind is scanned once and its bodies parsed once: page and record
    reasons come from the same parse, as an array inside the page's row.
    """
    parts = [_status_rejects(pages), _comment_rejects(pages), _profile_rejects(pages), _other_rejects(pages)]
    return reduce(DataFrame.unionByName, parts).select("source_table", "page_key", "pos", "reason", "payload")


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("n"))


def last_attempts(fetches: DataFrame, url: str = "request_url") -> DataFrame:
    """Latest try per URL: ``max_by`` on the attempt number (hash aggregate)."""
    return fetches.groupBy(url).agg(
        F.max("attempt").alias("attempts"),
        F.max_by("http_status", "attempt").alias("last_status"),
        F.max_by("fetched_at", "attempt").alias("last_fetched_at"))


def retry_backlog(fetches: DataFrame, codes: Sequence[int] = RETRY_CODES,
                  max_retries: int = MAX_RETRIES) -> DataFrame:
    """URLs whose latest try got a retryable status and that have tries left
    (try 1 is the first; ``max_retries`` retries follow it)."""
    last = last_attempts(fetches)
    return (last.where(F.col("last_status").isin(*codes) & (F.col("attempts") <= max_retries))
                .withColumn("retries_left", F.lit(max_retries + 1) - F.col("attempts")))


def error_streaks(fetches: DataFrame, n: int = STREAK_LIMIT, by: Sequence[str] = ("seed_key",),
                  order: Sequence[str] = ("fetched_at", "page_key"),
                  failed=None, method: str = "balanced") -> DataFrame:
    """Runs of at least ``n`` failures in a row per ``by`` (gaps and islands):
    a running count of successes numbers the runs of failures between them.

    ``method='balanced'`` (default) computes the running count with
    ``keyed_running_count``, so a slice with a third of all fetches is still
    spread over many tasks; ``'window'`` uses one window per slice.

    Output: ``by`` columns, ``run`` (successes before the run), ``first_at``,
    ``last_at``, ``length``.
    """
    from pagelake.operators.ordinal import keyed_running_count

    failed = (F.col("http_status") != 200) if failed is None else failed
    marked = fetches.select(*by, *order, F.coalesce(failed, F.lit(False)).alias("_failed"))
    if method == "window":
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        marked = marked.withColumn("run", F.sum((~F.col("_failed")).cast("long")).over(w))
    else:
        marked = keyed_running_count(marked, list(by), list(order), ~F.col("_failed"), name="run")
    runs = marked.where("_failed").groupBy(*by, "run").agg(
        F.min(F.struct(*order))[order[0]].alias("first_at"),
        F.max(F.struct(*order))[order[0]].alias("last_at"),
        F.count(F.lit(1)).alias("length"))
    return runs.where(F.col("length") >= n)


def profile_outcomes(pages: DataFrame) -> DataFrame:
    """``seed_key``, ``page_key``, ``fetched_at``, ``failed`` of every profile
    page.  A fetch fails when the page gives no profile record or no post-list
    container, whatever its HTTP status."""
    p = ex.extract_profiles(pages, with_rejects=True, container=True)
    return p.select("seed_key", "page_key", "fetched_at",
                    (F.col("reject_reason").isNotNull() | F.col("container_id").isNull()).alias("failed"))


def check_complete(records: DataFrame, required: Sequence[str] | None = None,
                   rejects: bool = False) -> DataFrame:
    """Rows with every required column present (or, with ``rejects``, the
    others with the list of missing columns)."""
    required = list(required or records.columns)
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]),
                       lambda x: x.isNotNull())
    out = records.withColumn("_missing", missing)
    if rejects:
        return out.where(F.size("_missing") > 0).withColumnRenamed("_missing", "missing_columns")
    return out.where(F.size("_missing") == 0).drop("_missing")


def unset_fields(pages: DataFrame, kind: str) -> DataFrame:
    """``page_key``, ``pos`` (NULL for profiles) and ``unset``, the fields that
    the record's JSON does not name, for every record of ``kind`` (``profile``,
    ``status_list`` without promo cards, or ``hot_comments``).

    A field given as JSON null is set; an absent key is unset.  The names come
    from the parsed maps, so presence survives the casts of the typed records.
    Records that are no JSON objects have every field unset.
    """
    def lacks(m, fields, prefix=""):
        names = F.array(*[F.lit(prefix + f) for f in fields])
        keys = F.transform(F.coalesce(F.map_keys(m), F.array().cast("array<string>")), lambda k: F.concat(F.lit(prefix), k))
        return F.array_except(names, keys)

    if kind == "profile":
        p = pages.where(F.col("kind") == "profile").select("page_key", ex.as_map(F.get_json_object("body", "$.data.userInfo")).alias("_u"))
        verified = F.coalesce(ex.get(F.col("_u"), "verified") == "true", F.lit(False))
        return p.select("page_key", F.lit(None).cast("bigint").alias("pos"), F.concat(
            lacks(F.col("_u"), ex.PROFILE_FIELDS),
            F.when(verified, lacks(F.col("_u"), ["verified_reason"])).otherwise(F.array().cast("array<string>"))).alias("unset"))
    if kind == "status_list":
        cards = ex.parsed_cards(pages)
        f = ex._status_fields(F.col("_m"), F.col("_mb"), F.col("card"))
        return cards.where(~f["is_promo"]).select("page_key", "pos", F.concat(
            lacks(F.col("_mb"), ex.STATUS_FIELDS), lacks(F.col("_m"), ["scheme"])).alias("unset"))
    if kind == "hot_comments":
        p = ex.parsed_comment_pages(pages).select("page_key", F.inline(ex.comment_array(F.col("_d")["data"])))
        given = F.coalesce(F.map_contains_key("_c", F.lit("user")) & ex.get(F.col("_c"), "user").isNull(), F.lit(False))
        return p.select("page_key", "pos", F.concat(
            lacks(F.col("_c"), [*ex.COMMENT_FIELDS, "user"]),
            F.when(given, F.array().cast("array<string>")).otherwise(lacks(F.col("_u"), ex.COMMENT_USER_FIELDS, "user."))).alias("unset"))
    raise ValueError(f"no records in pages of kind {kind!r}")


def refused_records(pages: DataFrame, kind: str) -> DataFrame:
    """Records that the table sink refuses: those with an unset field."""
    return unset_fields(pages, kind).where(F.size("unset") > 0)


def missing_cursor_report(pages: DataFrame) -> DataFrame:
    """Counts of pages that lack ``cardlistInfo``, its ``since_id``, or ``ok``."""
    cur = ex.status_page_cursor(pages).select(
        "kind", F.when(~F.col("has_cardlist"), F.lit("no_cardlist"))
        .when(F.col("since_id").isNull(), F.lit("no_since_id")).alias("reason"))
    data = F.from_json("body", "map<string,string>")
    ok_kinds = pages.where(F.col("kind").isin("supertopic", "topic_name", "topic_search"))
    no_ok = ok_kinds.select("kind", F.when(~F.coalesce(F.map_contains_key(data, F.lit("ok")), F.lit(False)),
                                           F.lit("no_ok")).alias("reason"))
    both = cur.unionByName(no_ok).where(F.col("reason").isNotNull())
    return both.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n_pages"))
