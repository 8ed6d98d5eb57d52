"""Page -> records.  All narrow (no shuffle): parse, explode, project.

Every nested object is parsed once into ``map<string,string>``: that gives
key presence (absent vs ``null``, as Python's ``in`` sees it) and the values
as text in one pass.  Cards are exploded with their position, because
several operators depend on order inside a page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.text import counter, strip_query
from pagelake.functions.time import created_month, created_ts, created_year

MAP = "map<string,string>"
PAGE_COLS = ["page_key", "kind", "seed_key", "seed_name", "parent_user_id", "parent_status_id",
             "page_no", "request_url", "fetched_at"]

# The fields each record reads; a missing one rejects the record.
STATUS_FIELDS = ("created_at", "text", "reposts_count", "comments_count", "attitudes_count", "id")
COMMENT_FIELDS = ("created_at", "text", "like_count", "total_number")
COMMENT_USER_FIELDS = ("id", "screen_name")
PROFILE_FIELDS = ("screen_name", "id", "follow_count", "followers_count", "description",
                  "statuses_count", "verified")
SUPERTOPIC_MBLOG_FIELDS = ("id", "comments_count", "created_at", "source", "text")
SUPERTOPIC_USER_FIELDS = ("id", "description", "screen_name", "followers_count", "verified_reason")
TOPIC_FIELDS = ("title_sub", "desc1", "desc2", "pic", "item_id", "analysis_extra")


def as_map(j: Column | str) -> Column:
    return F.from_json(F.col(j) if isinstance(j, str) else j, MAP)


def get(m: Column, key: str, default: str | None = None) -> Column:
    """``m[key]`` when the key is present (a JSON null gives NULL), else ``default``."""
    dflt = F.lit(default).cast("string")
    return F.when(F.map_contains_key(m, F.lit(key)), m[key]).otherwise(dflt)


def missing_any(m: Column, keys: Sequence[str]) -> Column:
    """True when ``m`` is not an object or lacks any of ``keys``."""
    present = [F.coalesce(F.map_contains_key(m, F.lit(k)), F.lit(False)) for k in keys]
    ok = present[0]
    for p in present[1:]:
        ok = ok & p
    return ~ok


def _keep(pages: DataFrame) -> list[str]:
    return [c for c in PAGE_COLS if c in pages.columns]


def tag_type(df: DataFrame, name: str, column: str = "type") -> DataFrame:
    """Constant table tag column."""
    return df.withColumn(column, F.lit(name))


# --------------------------------------------------------------------------- cards

def explode_cards(pages: DataFrame, path: Sequence[str] = ("data", "cards"),
                  kind: str | None = None) -> DataFrame:
    """One row per element of ``data.cards`` with its 0-based ``pos``.

    The body is parsed once with a schema that keeps each card as raw JSON
    text; a page without the list gives no rows.
    """
    if kind is not None:
        pages = pages.where(F.col("kind") == kind)
    schema = "array<string>"
    for key in reversed(path):
        schema = f"struct<`{key}`: {schema}>"
    arr = F.from_json("body", schema)
    for key in path:
        arr = arr[key]
    keep = [c for c in pages.columns if c != "body"]
    return pages.select(*keep, F.posexplode(arr).alias("pos", "card")) \
        .withColumn("pos", F.col("pos").cast("long"))


def explode_card_groups(pages: DataFrame, kind: str | None = None) -> DataFrame:
    """Two levels: ``data.cards[*]`` then each card's ``card_group[*]``.

    Output keeps the outer card's ``card_type`` (as text) and gives ``gpos``
    and ``item`` (raw JSON) per group element.  An absent or non-list group
    gives no rows.
    """
    cards = explode_cards(pages, kind=kind)
    outer = as_map("card")
    cards = cards.select(*[c for c in cards.columns if c != "card"],
                         get(outer, "card_type").alias("card_type"),
                         F.from_json(get(outer, "card_group"), "array<string>").alias("_group"))
    return cards.select(*[c for c in cards.columns if c != "_group"],
                        F.posexplode("_group").alias("gpos", "item")) \
        .withColumn("gpos", F.col("gpos").cast("long"))


# --------------------------------------------------------------------------- statuses

def card_array(raw: Column, nested: str = "mblog") -> Column:
    """Raw cards as structs: ``pos``, ``card``, the card as a map ``_m`` and its
    ``nested`` object as a map ``_mb``."""
    a = F.transform(raw, lambda c, i: F.struct(i.cast("long").alias("pos"), c.alias("card"),
                                               F.from_json(c, MAP).alias("_m")))
    return F.transform(a, lambda x: F.struct(x["pos"].alias("pos"), x["card"].alias("card"), x["_m"].alias("_m"),
                                             F.from_json(get(x["_m"], nested), MAP).alias("_mb")))


def parsed_cards(pages: DataFrame, kind: str = "status_list", nested: str = "mblog") -> DataFrame:
    """One row per card with its 0-based ``pos``, raw ``card`` text, the card
    as a map ``_m`` and its ``nested`` object as a map ``_mb``.

    Both parses happen inside the generator (``transform`` over the page's
    card list, then ``inline``), so every card is parsed exactly once: a
    filter on anything derived from ``_m``/``_mb`` can be pushed down to the
    generator but never below the parse, where Catalyst would substitute (and
    so repeat) the ``from_json`` calls once per predicate.
    """
    p = pages.where(F.col("kind") == kind)
    raw = F.from_json("body", "struct<data: struct<cards: array<string>>>")["data"]["cards"]
    a = card_array(raw, nested)
    return p.select(*_keep(p), F.inline(a))


def text_or_list(raw: Column) -> Column:
    """Whether a card that is no JSON object is a text or a list (a null, a
    number or a boolean is not)."""
    scalar = raw.try_cast("double").isNotNull() | raw.isin("true", "false", "null")
    return F.coalesce(raw.isNotNull() & ~scalar, F.lit(False))


def _bad_counters(m: Column) -> Column:
    """Whether a counter is given that is no whole number (a shortened text
    such as ``10k+``); it would be lost as a number."""
    out = F.lit(False)
    for name in ("reposts_count", "comments_count", "attitudes_count"):
        out = out | (get(m, name).isNotNull() & counter(get(m, name)).isNull())
    return out


def _status_fields(c: Column, m: Column, raw: Column) -> dict[str, Column]:
    """Derived fields of a post card from its map ``c``, ``mblog`` map ``m``
    and text ``raw``."""
    edit_at = get(m, "created_at")
    is_promo = (F.size(F.map_keys(c)) == 4) | ~F.map_contains_key(c, F.lit("mblog")) | (c.isNull() & text_or_list(raw))
    reason = (F.when(c.isNull(), "card_not_object")
              .when(m.isNull(), "mblog_not_object")
              .when(~F.map_contains_key(m, F.lit("created_at")), "missing_created_at")
              .when(created_year(edit_at).isNull(), "bad_created_at")
              .when(missing_any(m, STATUS_FIELDS) | ~F.map_contains_key(c, F.lit("scheme")),
                    "missing_field")
              .when(_bad_counters(m), "bad_counter"))
    return {
        "is_promo": F.coalesce(is_promo, F.lit(False)),
        "edit_at": edit_at,
        "created_ts": created_ts(edit_at),
        "text": get(m, "text"),
        "reposts_count": counter(get(m, "reposts_count")),
        "comments_count": counter(get(m, "comments_count")),
        "attitudes_count": counter(get(m, "attitudes_count")),
        "status_id": get(m, "id"),
        "origin_url": strip_query(get(c, "scheme")),
        "year": created_year(edit_at),
        "month": created_month(edit_at),
        "reject_reason": reason,
    }


def _cut_pages(pages: DataFrame, page_stop) -> DataFrame:
    """Cards of each page up to (not including) the first card for which
    ``page_stop(fields)`` holds, cut inside the page's own row: no shuffle."""
    p = pages.where(F.col("kind") == "status_list")
    raw = F.from_json("body", "struct<data: struct<cards: array<string>>>")["data"]["cards"]
    a = card_array(raw)
    a = F.transform(a, lambda x: F.struct(*[x[k].alias(k) for k in ("pos", "card", "_m", "_mb")],
                                          F.coalesce(page_stop(_status_fields(x["_m"], x["_mb"], x["card"])),
                                                     F.lit(False)).alias("_stop")))
    p = p.select(*_keep(p), a.alias("_cards"))
    first = F.array_min(F.transform(F.filter("_cards", lambda x: x["_stop"]), lambda x: x["pos"]))
    kept = F.filter("_cards", lambda x: first.isNull() | (x["pos"] < first))
    kept = F.transform(kept, lambda x: F.struct(*[x[k].alias(k) for k in ("pos", "card", "_m", "_mb")]))
    return p.select(*_keep(p), F.inline(kept))


def status_cards(pages: DataFrame, page_stop=None) -> DataFrame:
    """Every card of ``status_list`` pages, classified.

    Columns: page columns, ``pos``, ``is_promo`` (exactly 4 keys, or no
    ``mblog`` key: recommendation and label slots), the status fields, the
    written ``year`` / ``month`` and ``reject_reason`` (NULL for a good post).

    ``page_stop``: a function of the derived fields (a dict of Columns); each
    page keeps only its cards before the first one where it holds (the
    strict-page rule, C9), decided inside the page's row.
    """
    cards = parsed_cards(pages) if page_stop is None else _cut_pages(pages, page_stop)
    f = _status_fields(F.col("_m"), F.col("_mb"), F.col("card"))
    return cards.select(
        *_keep(cards), "pos", f["is_promo"].alias("is_promo"),
        F.col("seed_key").try_cast("bigint").alias("user_id"),
        *[f[k].alias(k) for k in ("edit_at", "created_ts", "text", "reposts_count", "comments_count",
                                  "attitudes_count", "status_id", "origin_url", "year", "month",
                                  "reject_reason")],
        "card",
    )


POST_FIELDS = ["edit_at", "created_ts", "text", "reposts_count", "comments_count", "attitudes_count",
               "status_id", "origin_url", "year", "month", "reject_reason"]


def prefix_pages(pages: DataFrame, stop, page_stop=None) -> DataFrame:
    """One row per ``status_list`` page: page columns, ``posts`` (its non-promo
    cards, classified, up to the page's first stop or, with ``page_stop``, its
    first bad card) and ``stop_pos`` (where ``stop`` first holds, else NULL).

    ``stop`` and ``page_stop`` are functions of a card's derived fields.
    Everything is decided inside the page's row: one parse, no shuffle.
    """
    p = pages.where(F.col("kind") == "status_list")
    raw = F.from_json("body", "struct<data: struct<cards: array<string>>>")["data"]["cards"]
    a = card_array(raw)

    def classified(x):
        f = _status_fields(x["_m"], x["_mb"], x["card"])
        return F.struct(x["pos"].alias("pos"), f["is_promo"].alias("is_promo"), *[f[k].alias(k) for k in POST_FIELDS])

    flag = lambda rule: lambda x: F.coalesce(rule(x), F.lit(False))
    first = lambda rule: F.array_min(F.transform(F.filter("_cards", flag(rule)), lambda x: x["pos"]))
    # each list and place is a projection of its own: used inside a lambda it would be computed per card
    p = p.select(*_keep(p), F.filter(F.transform(a, classified), lambda x: ~x["is_promo"]).alias("_cards"))
    end = first(page_stop) if page_stop else F.lit(None).cast("long")
    p = p.select(*_keep(p), "_cards", end.alias("_end"))
    p = p.select(*_keep(p), F.filter("_cards", lambda x: F.col("_end").isNull() | (x["pos"] < F.col("_end"))).alias("_cards"))
    p = p.select(*_keep(p), "_cards", first(stop).alias("stop_pos"))
    return p.select(*_keep(p), "stop_pos", F.filter("_cards", lambda x: F.col("stop_pos").isNull() | (
        x["pos"] < F.col("stop_pos"))).alias("posts"))


def month_bad(min_year: int, month: int):
    """Strict-page rule for the month window: a non-promo card whose date is
    unreadable or whose month name is unknown, or an emitted-month card that
    lacks a field; a stop card is not bad (it is read first)."""
    def rule(f: dict[str, Column]) -> Column:
        y, mo, why = f["year"], f["month"], f["reject_reason"]
        stop = (F.coalesce(y < F.lit(min_year), F.lit(False))
                | F.coalesce((y >= F.lit(min_year)) & (mo < F.lit(month)), F.lit(False)))
        bad = (why.isin("card_not_object", "mblog_not_object", "missing_created_at", "bad_created_at")
               | (F.coalesce(y >= F.lit(min_year), F.lit(False)) & mo.isNull())
               | ((mo == F.lit(month)) & why.isNotNull()))
        return ~f["is_promo"] & F.coalesce(bad, F.lit(False)) & ~stop
    return rule


def year_bad(min_year: int):
    """Strict-page rule for the year cutoff: a non-promo card that is bad and
    not already a stop (an old year is read before the other fields)."""
    def rule(f: dict[str, Column]) -> Column:
        old = F.coalesce(f["year"] < F.lit(min_year), F.lit(False))
        return ~f["is_promo"] & f["reject_reason"].isNotNull() & ~old
    return rule


STATUS_OUT = ["user_id", "edit_at", "created_ts", "text", "reposts_count", "comments_count",
              "attitudes_count", "status_id", "origin_url"]


def extract_statuses(pages: DataFrame, lineage: bool = True) -> DataFrame:
    """Post cards -> ``statuses`` rows (promo cards and bad cards left out).

    ``user_id`` comes from the request (``seed_key``), not from the card.
    """
    cards = status_cards(pages).where(~F.col("is_promo") & F.col("reject_reason").isNull())
    extra = ["page_key", "page_no", "pos"] if lineage else []
    return cards.select(*STATUS_OUT, *extra)


def status_page_cursor(pages: DataFrame) -> DataFrame:
    """``(page_key, has_cardlist, since_id)`` of ``status_list`` pages."""
    p = pages.where(F.col("kind") == "status_list")
    data = F.from_json("body", f"struct<data: {MAP}>")["data"]
    cl = as_map(get(data, "cardlistInfo"))
    return p.select(*_keep(p),
                    F.coalesce(F.map_contains_key(data, F.lit("cardlistInfo")), F.lit(False)).alias("has_cardlist"),
                    get(cl, "since_id").alias("since_id"))


# --------------------------------------------------------------------------- profiles

def extract_profiles(pages: DataFrame, with_rejects: bool = False, container: bool = False,
                     also: Sequence[str] = ()) -> DataFrame:
    """``data.userInfo`` -> one ``profiles`` row per profile page.

    ``verified_reason`` is kept only when ``verified`` is true (else ``''``).
    A page missing a field gives no row (``with_rejects`` shows it instead).
    ``container`` adds the post-list ``container_id`` from the same page;
    ``also`` names further columns of ``pages`` to keep.
    """
    p = pages.where(F.col("kind") == "profile")
    info = as_map(F.get_json_object("body", "$.data.userInfo"))
    p = p.withColumn("_u", info)
    u = F.col("_u")
    verified = get(u, "verified") == "true"
    reason = (F.when(u.isNull(), "no_user_info")
              .when(missing_any(u, PROFILE_FIELDS), "missing_field")
              .when(F.coalesce(verified, F.lit(False)) & ~F.map_contains_key(u, F.lit("verified_reason")),
                    "missing_verified_reason"))
    out = p.select(
        *_keep(p),
        get(u, "id").try_cast("bigint").alias("user_id"),
        get(u, "screen_name").alias("name"),
        counter(get(u, "follow_count")).alias("follow_count"),
        counter(get(u, "followers_count")).alias("followers_count"),
        get(u, "description").alias("description"),
        counter(get(u, "statuses_count")).alias("statuses_count"),
        verified.alias("verified"),
        verified_reason(verified, get(u, "verified_reason")).alias("verified_reason"),
        reason.alias("reject_reason"),
        *([extract_container_id("body").alias("container_id")] if container else []), *also,
    )
    if with_rejects:
        return out
    return out.where(F.col("reject_reason").isNull()).drop("reject_reason")


def verified_reason(verified: Column, reason: Column) -> Column:
    """The reason only for a verified account, else the empty string."""
    return F.when(F.coalesce(verified, F.lit(False)), reason).otherwise(F.lit(""))


def extract_container_id(body: Column | str = "body") -> Column:
    """Id of the second tab of a profile page, as text."""
    b = F.col(body) if isinstance(body, str) else body
    return F.get_json_object(b, "$.data.tabsInfo.tabs[1].containerid")


# --------------------------------------------------------------------------- comments

def comment_pages(pages: DataFrame) -> DataFrame:
    """``hot_comments`` pages with their cursor: ``has_cursor`` (both
    ``max_id`` and ``max_id_type`` present), ``max_id``, ``max_id_type``,
    ``is_first`` (page 0) and the raw comment list."""
    p = pages.where(F.col("kind") == "hot_comments")
    data = F.from_json("body", f"struct<data: {MAP}>")["data"]
    p = p.withColumn("_d", data)
    d = F.col("_d")
    has_cursor = F.coalesce(F.map_contains_key(d, F.lit("max_id")) & F.map_contains_key(d, F.lit("max_id_type")),
                            F.lit(False))
    return p.select(*_keep(p), has_cursor.alias("has_cursor"),
                    get(d, "max_id").alias("max_id"), get(d, "max_id_type").alias("max_id_type"),
                    (F.coalesce(F.col("page_no"), F.lit(0)) == 0).alias("is_first"),
                    get(d, "data").alias("_list"), d.isNull().alias("bad_page"))


COMMENT_PAGE = "struct<data: struct<max_id: string, max_id_type: string, data: array<string>>>"


def parsed_comment_pages(pages: DataFrame) -> DataFrame:
    """``hot_comments`` pages with ``_d`` (cursor fields and the comments as
    raw JSON, one typed parse of the body) and ``_has_cursor``.  Key presence
    is checked with a second, map parse only when a cursor field is NULL
    (absent and JSON null differ there)."""
    p = pages.where(F.col("kind") == "hot_comments")
    p = p.select(*_keep(p), "body", F.from_json("body", COMMENT_PAGE)["data"].alias("_d"))
    d = F.col("_d")
    both = d["max_id"].isNotNull() & d["max_id_type"].isNotNull()
    keys = F.from_json("body", f"struct<data: {MAP}>")["data"]
    has_cursor = F.when(both, F.lit(True)).otherwise(F.coalesce(
        F.map_contains_key(keys, F.lit("max_id")) & F.map_contains_key(keys, F.lit("max_id_type")), F.lit(False)))
    return p.select(*_keep(p), "body", "_d", has_cursor.alias("_has_cursor"))


def comment_array(raw: Column) -> Column:
    """Raw comments as structs: ``pos``, ``item``, the comment as a map ``_c``
    and its ``user`` as a map ``_u``."""
    a = F.transform(raw, lambda c, i: F.struct(i.cast("long").alias("pos"), c.alias("item"), F.from_json(c, MAP).alias("_c")))
    return F.transform(a, lambda x: F.struct(x["pos"].alias("pos"), x["item"].alias("item"), x["_c"].alias("_c"),
                                             F.from_json(get(x["_c"], "user"), MAP).alias("_u")))


def comment_reason(c: Column, u: Column) -> Column:
    """Why a comment gives no record (NULL for a good one)."""
    return (F.when(c.isNull(), "comment_not_object")
            .when(missing_any(c, COMMENT_FIELDS) | ~F.map_contains_key(c, F.lit("user")), "missing_field")
            .when(u.isNull(), "user_not_object")
            .when(missing_any(u, COMMENT_USER_FIELDS), "missing_user_field"))


def comment_items(pages: DataFrame) -> DataFrame:
    """Every element of ``data.data`` of comment pages, with ``reject_reason``.

    The page's cursor fields travel inside the generator with each comment,
    and each comment and its ``user`` are parsed once there (see
    ``parsed_cards``), so cursor and field filters never re-parse a body.
    """
    p = parsed_comment_pages(pages)
    a = F.transform(comment_array(F.col("_d")["data"]), lambda x: F.struct(
        *[x[k].alias(k) for k in ("pos", "item", "_c", "_u")], F.col("_has_cursor").alias("has_cursor"),
        F.col("_d")["max_id"].alias("max_id"), F.col("_d")["max_id_type"].alias("max_id_type")))
    items = p.select(*_keep(p), (F.coalesce(F.col("page_no"), F.lit(0)) == 0).alias("is_first"), F.inline(a))
    c, u = F.col("_c"), F.col("_u")
    reason = comment_reason(c, u)
    return items.select(
        *_keep(items), "is_first", "has_cursor", "max_id", "max_id_type", "pos",
        F.col("parent_user_id").alias("father_user_id"),
        F.col("parent_status_id").alias("father_status_id"),
        get(c, "created_at").alias("comment_time"),
        created_ts(get(c, "created_at")).alias("comment_ts"),
        get(c, "text").alias("text"),
        get(u, "id").try_cast("bigint").alias("comment_people_id"),
        get(u, "screen_name").alias("comment_people_name"),
        counter(get(c, "like_count")).alias("comment_likes"),
        counter(get(c, "total_number")).alias("total_number"),
        reason.alias("reject_reason"),
        F.col("item"),
    )


COMMENT_OUT = ["father_user_id", "father_status_id", "comment_time", "comment_ts", "text",
               "comment_people_id", "comment_people_name", "comment_likes", "total_number"]


def extract_comments(pages: DataFrame, terminal_page: str = "keep",
                     require_cursor: str = "follow_up", lineage: bool = True) -> DataFrame:
    """``data.data[*]`` of comment pages -> ``comments`` rows.

    ``require_cursor``: ``'follow_up'`` (default) drops follow-up pages without
    ``max_id``/``max_id_type``; ``'all'`` drops such first pages too; ``'none'``
    keeps all.  ``terminal_page='drop'`` also throws away a follow-up page whose
    ``max_id`` is ``'0'``, with its comments.  Comments missing a field are
    skipped (see ``quarantine`` for them).
    """
    from pagelake.operators.filters import drop_terminal_page, require_cursor as _require

    items = comment_items(pages)
    items = _require(items, require_cursor)
    if terminal_page == "drop":
        items = drop_terminal_page(items)
    items = items.where(F.col("reject_reason").isNull())
    extra = ["page_key", "page_no", "pos"] if lineage else []
    return items.select(*COMMENT_OUT, *extra)


# --------------------------------------------------------------------------- feeds and topics

def _page_ok(pages: DataFrame, strict_type: bool) -> DataFrame:
    from pagelake.operators.filters import drop_not_ok
    return drop_not_ok(pages, strict_type=strict_type)


def parsed_groups(pages: DataFrame) -> DataFrame:
    """One row per ``card_group`` element of every card, parsed inside the
    generator: ``pos`` (outer), ``gpos`` (inner), ``card_type`` (outer, text),
    ``card``, ``item`` (raw), ``_o`` / ``_i`` (maps) and the inner ``mblog`` and
    its ``user`` as maps ``_m`` / ``_u``.  An absent or non-list group gives
    no rows."""
    raw = F.from_json("body", "struct<data: struct<cards: array<string>>>")["data"]["cards"]
    outer = F.transform(raw, lambda c, i: F.struct(i.cast("long").alias("pos"), c.alias("card"),
                                                   F.from_json(c, MAP).alias("_o")))
    inner = F.flatten(F.transform(outer, lambda o: F.transform(
        F.coalesce(F.from_json(get(o["_o"], "card_group"), "array<string>"), F.array().cast("array<string>")),
        lambda g, j: F.struct(o["pos"].alias("pos"), j.cast("long").alias("gpos"), o["card"].alias("card"),
                              o["_o"].alias("_o"), g.alias("item"), F.from_json(g, MAP).alias("_i")))))
    inner = F.transform(inner, lambda x: F.struct(*[x[k].alias(k) for k in ("pos", "gpos", "card", "_o", "item", "_i")],
                                                  F.from_json(get(x["_i"], "mblog"), MAP).alias("_m")))
    inner = F.transform(inner, lambda x: F.struct(*[x[k].alias(k) for k in ("pos", "gpos", "card", "_o", "item", "_i",
                                                                           "_m")],
                                                  F.from_json(get(x["_m"], "user"), MAP).alias("_u")))
    keep = [c for c in pages.columns if c != "body"]
    out = pages.select(*keep, F.inline(inner))
    return out.withColumn("card_type", get(F.col("_o"), "card_type"))


def extract_supertopic_posts(pages: DataFrame, missing: str | None = "", strict_type: bool = False,
                             outer: str = "11", inner: str = "9", lineage: bool = False) -> DataFrame:
    """Feed posts of a super-topic (outer card 11, inner card 9), with author
    columns and the page's ``nick``.  A missing path gives ``missing``
    (``''`` like the original lookups; ``None`` for NULL)."""
    from pagelake.operators.filters import keep_card_type

    p = _page_ok(pages.where(F.col("kind") == "supertopic"), strict_type)
    data = F.from_json("body", f"struct<data: {MAP}>")["data"]
    p = p.withColumn("nick", get(data, "nick", missing))
    cards = parsed_groups(p)
    cards = keep_card_type(cards, F.col("card_type"), "card", [outer], strict_type)
    cards = keep_card_type(cards, get(F.col("_i"), "card_type"), "item", [inner], strict_type)
    m, u = F.col("_m"), F.col("_u")
    return cards.select(
        F.col("seed_key").alias("chaohua_id"),
        get(m, "id", missing).alias("cid"),
        F.col("nick"),
        get(m, "comments_count", missing).alias("comments_count"),
        get(m, "created_at", missing).alias("created_at"),
        get(m, "source", missing).alias("source"),
        get(m, "text", missing).alias("text"),
        get(u, "id", missing).alias("user_id"),
        get(u, "description", missing).alias("description"),
        get(u, "screen_name", missing).alias("screen_name"),
        get(u, "followers_count", missing).alias("followers_count"),
        get(u, "verified_reason", missing).alias("verified_reason"),
        *(["page_key", "page_no", "pos", "gpos"] if lineage else []),
    )


def extract_topics(pages: DataFrame, missing: str | None = "", strict_type: bool = False,
                   card_type: str | int = "8", lineage: bool = False) -> DataFrame:
    """Topic search results (inner card 8) of a film: film id and title from
    the request, six fields from the card."""
    from pagelake.operators.filters import keep_card_type

    p = _page_ok(pages.where(F.col("kind") == "topic_search"), strict_type)
    cards = parsed_groups(p)
    cards = keep_card_type(cards, get(F.col("_i"), "card_type"), "item", [card_type], strict_type)
    i = F.col("_i")
    return cards.select(
        F.col("seed_key").alias("weibo_movie_id"),
        F.col("seed_name").alias("weibo_movie_name"),
        *[get(i, k, missing).alias(k) for k in TOPIC_FIELDS],
        *(["page_key", "page_no", "pos", "gpos"] if lineage else []),
    )


def extract_topic_title(pages: DataFrame, missing: str | None = "", strict_type: bool = False) -> DataFrame:
    """``(film_id, title)`` from ``topic_name`` pages (``data.pageInfo.nick``)."""
    p = _page_ok(pages.where(F.col("kind") == "topic_name"), strict_type)
    info = as_map(F.get_json_object("body", "$.data.pageInfo"))
    data = F.from_json("body", f"struct<data: {MAP}>")["data"]
    has_info = F.coalesce(F.map_contains_key(data, F.lit("pageInfo")), F.lit(False))
    title = F.when(has_info, get(info, "nick", missing)).otherwise(F.lit(missing).cast("string"))
    return p.select(F.col("seed_key").alias("film_id"), title.alias("title"))
