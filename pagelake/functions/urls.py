"""Request URLs as column expressions (requests are data, not calls)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The site's API addresses and query shapes.
SITE = "https://m.weibo.cn"
PROFILE_URL = SITE + "/api/container/getIndex?type=uid&value="
COMMENT_URL = SITE + "/comments/hotflow?id=%s&mid=%s"
FEED_URL = SITE + "/api/container/getIndex?jumpfrom=weibocom&containerid="
CONTAINER_URL = SITE + "/api/container/getIndex?containerid="
TOPIC_QUERY = "100103type=38&q=%s&t=0"
TOPIC_TAIL = "&page_type=searchall&page="


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _s(c: Column | str) -> Column:
    return _c(c).cast("string")


def profile_request(user_id: Column | str) -> Column:
    return F.concat(F.lit(PROFILE_URL), _s(user_id))


def status_list_request(profile_url: Column | str, container_id: Column | str) -> Column:
    """A profile page's URL plus its post-list container."""
    return F.concat(_s(profile_url), F.lit("&containerid="), _s(container_id))


def next_status_page(url: Column | str, since_id: Column | str) -> Column:
    """Same list, next cursor: append ``&since_id=`` or replace its number.

    NULL when there is no cursor.
    """
    url, since = _s(url), _s(since_id)
    appended = F.concat(url, F.lit("&since_id="), since)
    replaced = F.regexp_replace(url, F.lit(r"since_id=\d+"),
                                F.concat(F.lit("since_id="), F.regexp_replace(since, r"([\\$])", r"\\$1")))
    return F.when(since.isNull(), F.lit(None).cast("string")).when(
        F.instr(url, "since_id") == 0, appended).otherwise(replaced)


def comment_request(status_id: Column | str) -> Column:
    """First hot-comment page of a post; the id is given twice.  NULL for a
    NULL id."""
    sid = _s(status_id)
    return F.when(sid.isNotNull(), F.format_string(COMMENT_URL, sid, sid))


def next_comment_page(status_id: Column | str, max_id: Column | str,
                      max_id_type: Column | str) -> Column:
    """Follow-up comment page; NULL when the cursor is ``'0'`` or absent."""
    mid, mtype = _s(max_id), _s(max_id_type)
    url = F.concat(comment_request(status_id), F.lit("&max_id="), mid, F.lit("&max_id_type="), mtype)
    return F.when(mid.isNotNull() & (mid != "0") & mtype.isNotNull(), url)


def supertopic_request(feed_id: Column | str, since_id: Column | str | None = None) -> Column:
    base = F.concat(F.lit(FEED_URL), _s(feed_id))
    if since_id is None:
        return base
    return F.concat(base, F.lit("&since_id="), _s(since_id))


def next_supertopic_page(feed_id: Column | str, since_id: Column | str) -> Column:
    """Next feed page by cursor; NULL when the cursor is absent or empty."""
    since = _s(since_id)
    return F.when(since.isNotNull() & (since != ""), supertopic_request(feed_id, since))


def topic_name_request(film_id: Column | str) -> Column:
    return F.concat(F.lit(CONTAINER_URL), _s(film_id))


def url_quote(s: Column | str) -> Column:
    """Percent-encoding with only letters, digits and ``_.-~`` left as is.

    ``url_encode`` is form encoding; three replacements turn it into that set:
    a space (``+``) becomes ``%20``, ``*`` is encoded, ``~`` is kept.
    """
    enc = F.url_encode(_s(s))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    return F.replace(enc, F.lit("%7E"), F.lit("~"))


def topic_search_request(title: Column | str, page_no: Column | str | int) -> Column:
    """Topic search for a film title; pages start at 1.  NULL for a NULL title."""
    page = F.lit(page_no) if isinstance(page_no, int) else _c(page_no)
    query = F.when(_s(title).isNotNull(), F.format_string(TOPIC_QUERY, _s(title)))
    return F.concat(F.lit(CONTAINER_URL), url_quote(query), F.lit(TOPIC_TAIL), page.cast("string"))
