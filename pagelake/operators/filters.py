"""Filters and ordered-prefix predicates.

``take_until`` is the one operator Catalyst has no primitive for ("emit in
order until the first row matching a predicate").  It is written as an
aggregate plus a join, not as a window: the first stop position per key is a
hash aggregate with map-side partial aggregation, so one key holding a third
of all rows is never sorted in one task; the join back is broadcast by AQE
when the per-key table is small (its size is measured at run time) and a
skew-aware sort-merge join when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_type(raw: Column | str, path: str) -> Column:
    """JSON type name of a path (``BIGINT``, ``STRING``, ``DOUBLE``, ...)."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(_c(raw)), path, "variant"))


NUMERIC_TYPES = ("BIGINT", "INT", "DOUBLE", "FLOAT", "SMALLINT", "TINYINT")


# --------------------------------------------------------------------------- C1, C2, C3

def drop_promo_cards(cards: DataFrame, card_col: str = "card") -> DataFrame:
    """Drop recommendation and label slots: a card with exactly 4 keys, or
    without an ``mblog`` key.  A text or list card has no such key and goes
    too; null, number and boolean cards pass (they are rejected later as bad
    cards)."""
    from pagelake.operators.extract import text_or_list

    keys = F.json_object_keys(_c(card_col))
    promo = (F.size(keys) == 4) | ~F.array_contains(keys, F.lit("mblog"))
    return cards.where(~F.coalesce(promo, text_or_list(_c(card_col)), F.lit(False)))


def drop_not_ok(pages: DataFrame, strict_type: bool = False) -> DataFrame:
    """Drop pages whose ``ok`` is 0 or false.  A page without ``ok`` goes on (it is
    reported by ``missing_cursor_report``).  ``strict_type`` keeps a page whose
    ``ok`` is the *text* ``"0"`` (a number-only comparison)."""
    ok = F.get_json_object("body", "$.ok")
    zero = ok.try_cast("double") == 0
    if strict_type:
        zero = zero & json_type("body", "$.ok").isin(*NUMERIC_TYPES)
    false = F.when(ok == "false", json_type("body", "$.ok") == "BOOLEAN")  # the text "false" is not
    return pages.where(~(F.coalesce(zero, F.lit(False)) | F.coalesce(false, F.lit(False))))


def keep_card_type(df: DataFrame, type_text: Column, raw_col: str, codes: Sequence[str | int],
                   strict_type: bool = False) -> DataFrame:
    """Keep rows whose card type is one of ``codes``.

    By default the type is compared as text, so ``8`` and ``"8"`` are equal.
    ``strict_type`` also requires the JSON type of the code: a ``str`` code
    matches only JSON text, an ``int`` code only a JSON number.
    """
    cond = F.lit(False)
    for code in codes:
        match = type_text == F.lit(str(code))
        if strict_type:
            jt = json_type(raw_col, "$.card_type")
            match = match & (jt == "STRING" if isinstance(code, str) else jt.isin(*NUMERIC_TYPES))
        cond = cond | match
    return df.where(F.coalesce(cond, F.lit(False)))


# --------------------------------------------------------------------------- C4, C5, C9

def take_until(df: DataFrame, keys: Sequence[str], order: Sequence[str], stop: Column,
               mode: str = "prefix", method: str = "join") -> DataFrame:
    """Rows of each key, in ``order``, strictly before the first row where
    ``stop`` holds (that row and everything after it are dropped).

    ``mode='filter'`` is the plain form: drop only the rows where ``stop``
    holds.  A NULL ``stop`` counts as false.  ``order`` must be unique within
    a key.  ``method='window'`` computes the same with a running sum over a
    window (one pass, but one task per key).
    """
    stop = F.coalesce(stop, F.lit(False))
    if mode == "filter":
        return df.where(~stop)
    if mode != "prefix":
        raise ValueError(f"unknown mode {mode!r}")
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return (df.withColumn("_stops", F.sum(stop.cast("int")).over(w))
                  .where(F.col("_stops") == 0).drop("_stops"))
    pos = F.struct(*[_c(o) for o in order])
    marked = df.withColumn("_pos", pos)
    first = (marked.where(stop).groupBy(*keys)
             .agg(F.min("_pos").alias("_first_stop")))
    # null-safe: rows without a key are one key of their own
    first = first.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_first_stop")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = marked.join(first, same, "left")
    return (joined.where(F.col("_first_stop").isNull() | (F.col("_pos") < F.col("_first_stop")))
                  .drop("_pos", "_first_stop", *[f"_key_{k}" for k in keys]))


def strict_page(cards: DataFrame, bad: Column | None = None, page_key: str = "page_key",
                order: Sequence[str] = ("pos",)) -> DataFrame:
    """The first bad card ends its page: earlier cards are kept, that card and
    the later ones are lost; other pages are not affected."""
    bad = F.col("reject_reason").isNotNull() if bad is None else bad
    return take_until(cards, [page_key], list(order), bad)


def year_cutoff(cards: DataFrame, min_year: int, keys: Sequence[str] = ("seed_key",),
                order: Sequence[str] = ("page_no", "pos"), strict: bool = False,
                mode: str = "prefix") -> DataFrame:
    """Posts newest first until the first one written before ``min_year``;
    that ends the page *and* the account's later pages.

    Input is ``status_cards``.  Promo slots are skipped first.  A card whose
    year is unreadable does not stop the account: by default it is left out
    (``quarantine`` lists it); ``strict=True`` makes it end its page.
    """
    cards = cards.where(~F.col("is_promo"))
    if strict:
        old = F.coalesce(F.col("year") < F.lit(min_year), F.lit(False))
        cards = strict_page(cards, F.col("reject_reason").isNotNull() & ~old)
    kept = take_until(cards, keys, order, F.col("year") < F.lit(min_year), mode=mode)
    return kept.where(F.col("reject_reason").isNull())


PAGE_CARDS = 1 << 31  # a page's number and a card's place in it, both 32-bit, make one 64-bit number


def _until_page(pages: DataFrame, stop, page_stop=None) -> DataFrame:
    """Posts before each account's first stop, decided page by page.

    Pages are cut at their own first stop while they are parsed, once, and the
    cut pages are written to the shared work folder; the account's first stop
    is a hash aggregate of one number per stopped page, and pages, not cards,
    are joined to it.  An account with a third of all pages is one row per task
    in the aggregate, and its pages are split by AQE in the join.  Pages without
    a number come before the numbered ones, as NULL does in ``take_until``.
    """
    from pagelake.operators import extract as ex
    from pagelake.session import fresh_dir

    spark = pages.sparkSession
    path = fresh_dir(spark, "prefix-pages")
    cut = ex.prefix_pages(pages, stop, page_stop)
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    place = F.coalesce(F.col("page_no").cast("long"), F.lit(-1)) * F.lit(PAGE_CARDS).cast("long")
    first = cut.where(F.col("stop_pos").isNotNull()).groupBy(F.col("seed_key").alias("_key")).agg(
        F.min(place + F.col("stop_pos")).alias("_first_stop"))
    joined = cut.join(first, F.col("seed_key").eqNullSafe(F.col("_key")), "left")
    near = joined.where(F.col("_first_stop").isNull() | (place < F.col("_first_stop")))
    keep = [c for c in cut.columns if c not in ("stop_pos", "posts")]
    posts = near.select(*keep, "_first_stop", F.inline("posts"))
    # a page landed twice: its other copy ends at the same place
    posts = posts.where(F.col("_first_stop").isNull() | (place + F.col("pos") < F.col("_first_stop")))
    return posts.withColumn("user_id", F.col("seed_key").try_cast("bigint")).drop("_first_stop")


def month_window_pages(pages: DataFrame, min_year: int = 2023, month: int = 4, strict: bool = False) -> DataFrame:
    """``month_window`` straight from ``status_list`` pages, page by page; with
    ``strict`` the first bad card also ends its page."""
    from pagelake.operators import extract as ex

    stop = month_stop(min_year, month)
    bad = ex.month_bad(min_year, month)
    posts = _until_page(pages, stop, bad if strict else None)
    fields = {k: F.col(k) for k in ("is_promo", *ex.POST_FIELDS)}
    return posts.where(~F.coalesce(bad(fields), F.lit(False)) & (F.col("month") == F.lit(month)))


def month_stop(min_year: int, month: int):
    """Stop rule of the month window, on a card's derived fields."""
    def rule(f) -> Column:
        y, mo = f["year"], f["month"]
        return F.coalesce(y < F.lit(min_year), F.lit(False)) | F.coalesce(
            (y >= F.lit(min_year)) & (mo < F.lit(month)), F.lit(False))
    return rule


def year_cutoff_pages(pages: DataFrame, min_year: int, strict: bool = False, mode: str = "prefix") -> DataFrame:
    """``year_cutoff`` straight from ``status_list`` pages, page by page.  With
    ``strict`` the first bad card also ends its page."""
    from pagelake.operators import extract as ex

    if mode == "filter":
        cards = ex.status_cards(pages, page_stop=ex.year_bad(min_year)) if strict else ex.status_cards(pages)
        return year_cutoff(cards, min_year, mode=mode)
    if mode != "prefix":
        raise ValueError(f"unknown mode {mode!r}")
    posts = _until_page(pages, lambda f: f["year"] < F.lit(min_year), ex.year_bad(min_year) if strict else None)
    return posts.where(F.col("reject_reason").isNull())


def month_window(cards: DataFrame, min_year: int = 2023, month: int = 4,
                 keys: Sequence[str] = ("seed_key",), order: Sequence[str] = ("page_no", "pos"),
                 strict: bool = False) -> DataFrame:
    """Three-way month rule over newest-first posts: stop at the first post
    written before ``min_year`` or in a month before ``month``; emit posts of
    ``month``; skip later months and go on.  Year and month are read in the
    written offset.  There is no upper year: ``month`` of a later year is
    emitted too, and an early month of a later year stops the account.
    """
    cards = cards.where(~F.col("is_promo"))
    y, mo, why = F.col("year"), F.col("month"), F.col("reject_reason")
    stop = (F.coalesce(y < F.lit(min_year), F.lit(False))
            | F.coalesce((y >= F.lit(min_year)) & (mo < F.lit(month)), F.lit(False)))
    # A post is bad when its date cannot be read, when its month name is
    # unknown, or when it is in the emitted month and lacks a field; later
    # months are skipped without reading their fields.
    bad = (why.isin("card_not_object", "mblog_not_object", "missing_created_at", "bad_created_at")
           | (F.coalesce(y >= F.lit(min_year), F.lit(False)) & mo.isNull())
           | ((mo == F.lit(month)) & why.isNotNull()))
    bad = F.coalesce(bad, F.lit(False)) & ~stop
    if strict:
        cards = strict_page(cards, bad)
    kept = take_until(cards, keys, order, stop)
    return kept.where(~bad & (mo == F.lit(month)))


# --------------------------------------------------------------------------- C6

def id_at_least(df: DataFrame, column: str, bound: int) -> DataFrame:
    """Resume point: rows whose numeric id is at least ``bound``."""
    return df.where(F.col(column).try_cast("bigint") >= F.lit(bound))


# --------------------------------------------------------------------------- C7, C8, C10

def drop_terminal_page(items: DataFrame) -> DataFrame:
    """Throw away a follow-up comment page whose ``max_id`` is ``'0'``, with
    its comments (first pages keep theirs)."""
    terminal = ~F.col("is_first") & (F.col("max_id") == "0")
    return items.where(~F.coalesce(terminal, F.lit(False)))


def require_cursor(items: DataFrame, mode: str = "follow_up") -> DataFrame:
    """A comment page without ``max_id``/``max_id_type`` emits nothing.

    ``mode``: ``'none'``, ``'follow_up'`` (only follow-up pages need it) or
    ``'all'``."""
    if mode == "none":
        return items
    if mode == "follow_up":
        return items.where(F.col("is_first") | F.col("has_cursor"))
    if mode == "all":
        return items.where(F.col("has_cursor"))
    raise ValueError(f"unknown mode {mode!r}")


def skip_bad_comments(items: DataFrame) -> DataFrame:
    """Skip a comment missing any field (or whose ``user`` is not an object);
    the rest of the page goes on."""
    return items.where(F.col("reject_reason").isNull())


# --------------------------------------------------------------------------- C11

def host_of(url: Column | str) -> Column:
    return F.lower(F.try_parse_url(_c(url), F.lit("HOST")))


def on_allowed_domain(df: DataFrame, url_col: str, domains: Sequence[str],
                      dont_filter_col: str | None = None) -> DataFrame:
    """Keep rows whose URL host is an allowed domain or under one; rows with
    ``dont_filter`` set always pass."""
    host = host_of(url_col)
    cond = F.lit(False)
    for d in domains:
        d = d.lower()
        cond = cond | (host == d) | host.endswith("." + d)
    cond = F.coalesce(cond, F.lit(False))
    if dont_filter_col:
        cond = cond | F.coalesce(F.col(dont_filter_col), F.lit(False))
    return df.where(cond)
