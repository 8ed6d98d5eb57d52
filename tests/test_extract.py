"""Hand-made pages (invented ids and names) for every extraction edge case."""


from pagelake.operators import extract as ex
from pagelake.operators import filters as fl

from conftest import page

POST = {"card_type": 9, "itemid": "a", "scheme": "https://m.example.com/d/11?x=1", "show_type": 0,
        "mblog": {"id": "11", "created_at": "Fri Nov 18 16:39:14 +0800 2022", "text": "hello",
                  "reposts_count": 1, "comments_count": "2", "attitudes_count": 3}}


def status_page(cards, user="7", page_no=0, cardlist={"since_id": 1002}):
    data = {"cards": cards} if cards is not None else {}
    if cardlist is not None:
        data["cardlistInfo"] = cardlist
    return page("status_list", {"ok": 1, "data": data}, seed_key=user, page_no=page_no)


def test_example_status_page(spark, pages_df):
    cards = [{"card_type": 9, "itemid": "p", "scheme": "s", "mblog": {"id": "1"}}, POST,
             {"card_type": 11, "scheme": "s"}]
    out = ex.extract_statuses(pages_df([status_page(cards)])).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.status_id, r.origin_url, r.user_id) == ("11", "https://m.example.com/d/11", 7)
    assert str(r.created_ts) == "2022-11-18 08:39:14"
    assert (r.reposts_count, r.comments_count, r.attitudes_count) == (1, 2, 3)


def test_card_edge_cases(spark, pages_df):
    cards = [
        {"a": 1, "b": 2, "c": 3, "mblog": {"id": "x"}},          # 4 keys: promo
        {"card_type": 9, "scheme": "s", "k": 1, "j": 2, "t": 3},   # no mblog: promo
        {"card_type": 9, "scheme": "s", "k": 1, "j": 2, "mblog": None},  # mblog null: bad
        3, None, "text",                                           # number / null cards: bad; text: skipped
        dict(POST, mblog=dict(POST["mblog"], created_at="just now")),  # not a date
        dict(POST, mblog=dict(POST["mblog"], reposts_count="1.5", comments_count="many")),
        dict(POST, mblog={k: v for k, v in POST["mblog"].items() if k != "text"}),
    ]
    c = ex.status_cards(pages_df([status_page(cards)])).orderBy("pos").collect()
    assert [r.is_promo for r in c[:2]] == [True, True]
    assert c[2].reject_reason == "mblog_not_object" and not c[2].is_promo
    assert [r.reject_reason for r in c[3:6]] == ["card_not_object"] * 3 and [r.is_promo for r in c[3:6]] == [False, False, True]
    assert c[6].reject_reason == "bad_created_at"
    assert c[7].reject_reason == "bad_counter" and c[7].reposts_count is None and c[7].comments_count is None
    assert c[8].reject_reason == "missing_field"


def test_pages_without_cards_or_json(spark, pages_df):
    rows = [status_page(None, user="1"), page("status_list", "<html>oops</html>", seed_key="2"),
            status_page([], user="3")]
    assert ex.explode_cards(pages_df(rows)).count() == 0


def test_cursor_columns(spark, pages_df):
    rows = [status_page([POST], user="1"), status_page([POST], user="2", cardlist=None),
            status_page([POST], user="3", cardlist={"total": 4})]
    cur = {r.seed_key: r for r in ex.status_page_cursor(pages_df(rows)).collect()}
    assert cur["1"].has_cardlist and cur["1"].since_id == "1002"
    assert not cur["2"].has_cardlist and cur["2"].since_id is None
    assert cur["3"].has_cardlist and cur["3"].since_id is None


def profile(uid, verified, reason="film star", drop=None):
    info = {"screen_name": f"name{uid}", "id": uid, "follow_count": 5, "followers_count": "70",
            "description": "d", "statuses_count": 9, "verified": verified, "verified_reason": reason}
    if drop:
        info.pop(drop)
    body = {"ok": 1, "data": {"userInfo": info, "tabsInfo": {"tabs": [{"containerid": "a"}, {"containerid": f"c{uid}"}]}}}
    return page("profile", body, seed_key=str(uid))


def test_profiles(spark, pages_df):
    df = pages_df([profile(1, True), profile(2, False), profile(3, True, drop="description"),
                   profile(4, False, drop="verified_reason"), profile(5, True, drop="verified_reason")])
    out = {r.user_id: r for r in ex.extract_profiles(df).collect()}
    assert set(out) == {1, 2, 4}
    assert out[1].verified and out[1].verified_reason == "film star"
    assert not out[2].verified and out[2].verified_reason == ""
    assert out[1].followers_count == 70
    cids = {r.seed_key: r.c for r in df.select("seed_key", ex.extract_container_id("body").alias("c")).collect()}
    assert cids["1"] == "c1"


def comment_page(items, page_no=0, max_id=5, max_id_type=0, parent="900"):
    data = {"data": items}
    if max_id is not None:
        data["max_id"] = max_id
    if max_id_type is not None:
        data["max_id_type"] = max_id_type
    return page("hot_comments", {"ok": 1, "data": data}, seed_key=parent, page_no=page_no,
                parent_status_id=parent, parent_user_id="42")


C = {"created_at": "Sat Nov 19 10:00:00 +0800 2022", "text": "nice", "like_count": 3, "total_number": 0,
     "user": {"id": 501, "screen_name": "fan"}}


def test_comments_edge_cases(spark, pages_df):
    rows = [
        comment_page([C, dict(C, user=None), {k: v for k, v in C.items() if k != "like_count"},
                      dict(C, user={"id": 502}), C], page_no=0, max_id=0),   # first page, max_id 0: kept
        comment_page([C], page_no=1, max_id=0),                               # later, terminal
        comment_page([C], page_no=2, max_id=None, max_id_type=None),          # later, no cursor
        comment_page([C], page_no=3, max_id=7),
    ]
    df = pages_df(rows)
    default = ex.extract_comments(df)
    assert sorted(r.page_no for r in default.collect()) == [0, 0, 1, 3]
    assert all(r.father_status_id == "900" and r.father_user_id == "42" for r in default.collect())
    dropped = ex.extract_comments(df, terminal_page="drop")
    assert sorted(r.page_no for r in dropped.collect()) == [0, 0, 3]
    strict = ex.extract_comments(df, require_cursor="all")
    assert sorted(r.page_no for r in strict.collect()) == [0, 0, 1, 3]
    reasons = sorted(r.reject_reason or "" for r in ex.comment_items(df).where("page_no = 0").collect())
    assert reasons == ["", "", "missing_field", "missing_user_field", "user_not_object"]
    # the same commenter twice stays twice in comments, once in the commenter set
    from pagelake.operators.aggregates import distinct_commenters
    assert distinct_commenters(default).count() == 1


def feed_page(cards, ok=1, since=2, nick="fans"):
    body = {"data": {"nick": nick, "pageInfo": {"since_id": since}, "cards": cards}}
    if ok is not None:
        body = {"ok": ok, **body}
    return page("supertopic", body, seed_key="100808abc")


INNER = {"card_type": "9", "mblog": {"id": 77, "comments_count": 4, "created_at": "x", "source": "web",
                                     "text": "t", "user": {"id": 8, "screen_name": "s", "followers_count": 2,
                                                           "description": "d"}}}


def test_supertopic_types_ok_and_defaults(spark, pages_df):
    rows = [feed_page([{"card_type": "11", "card_group": [INNER, dict(INNER, card_type=9), {"card_type": "4"}]},
                       {"card_type": 11, "card_group": [INNER]}, {"card_type": "11"}]),
            feed_page([{"card_type": "11", "card_group": [INNER]}], ok=0),
            feed_page([{"card_type": "11", "card_group": [INNER]}], ok="0"),
            feed_page([{"card_type": "11", "card_group": [INNER]}], ok=None)]
    df = pages_df(rows)
    lenient = ex.extract_supertopic_posts(df).collect()
    # page 1: "9" and 9 under "11", plus 9 under 11; ok 0 and "0" dropped; absent ok kept
    assert len(lenient) == 3 + 1
    assert lenient[0].verified_reason == "" and lenient[0].nick == "fans"
    strict = ex.extract_supertopic_posts(df, strict_type=True).collect()
    # only text "11" / text "9"; the text "0" is not 0 when strict
    assert len(strict) == 1 + 1 + 1
    assert fl.drop_not_ok(df).count() == 2 and fl.drop_not_ok(df, strict_type=True).count() == 3


def test_topics_and_title(spark, pages_df):
    item = {"card_type": 8, "title_sub": "#topic#", "desc1": "a", "desc2": "b", "pic": "p", "item_id": "i"}
    rows = [page("topic_search", {"ok": 1, "data": {"cards": [{"card_group": [item, dict(item, card_type="8"),
                                                                               {"card_type": 9}]}]}},
                 seed_key="f1", seed_name="Film / 1", page_no=1),
            page("topic_name", {"ok": 1, "data": {"pageInfo": {"nick": "Film / 1"}}}, seed_key="f1"),
            page("topic_name", {"data": {}}, seed_key="f2")]
    df = pages_df(rows)
    t = ex.extract_topics(df).collect()
    assert len(t) == 2 and t[0].analysis_extra == "" and t[0].weibo_movie_name == "Film / 1"
    assert len(ex.extract_topics(df, strict_type=True, card_type=8).collect()) == 1
    titles = {r.film_id: r.title for r in ex.extract_topic_title(df).collect()}
    assert titles == {"f1": "Film / 1", "f2": ""}


def _dated(i, text_date):
    return dict(POST, itemid=str(i), mblog=dict(POST["mblog"], id=str(i), created_at=text_date))


def test_month_window_named_cases(spark, pages_df):
    """Months 5, 4, 3 of 2023 and 4, 1 of 2024, newest first."""
    a = [_dated(1, "Mon May 15 10:00:00 +0800 2023"), _dated(2, "Sat Apr 15 10:00:00 +0800 2023"),
         _dated(3, "Wed Mar 15 10:00:00 +0800 2023"), _dated(4, "Sat Apr 01 10:00:00 +0800 2023")]
    b = [_dated(5, "Mon Apr 15 10:00:00 +0800 2024"), _dated(6, "Mon Jan 15 10:00:00 +0800 2024"),
         _dated(7, "Sat Apr 15 10:00:00 +0800 2023")]
    df = pages_df([status_page(a, user="1"), status_page(b, user="2")])
    got = sorted(r.status_id for r in fl.month_window(ex.status_cards(df), 2023, 4).collect())
    assert got == ["2", "5"]  # May skipped, Mar stops user 1; Jan 2024 stops user 2 before 2023


def test_year_cutoff_first_middle_and_page_two(spark, pages_df):
    old = "Fri Nov 18 16:39:14 +0800 2016"
    new = "Fri Nov 18 16:39:14 +0800 2022"
    rows = [status_page([_dated(1, old), _dated(2, new)], user="1"),                       # old on top
            status_page([_dated(3, new), _dated(4, old), _dated(5, new)], user="2"),         # in the middle
            status_page([_dated(6, new)], user="3"),
            status_page([_dated(7, new), _dated(8, old)], user="3", page_no=1),              # on page 2
            status_page([_dated(9, new)], user="3", page_no=2)]
    got = sorted(r.status_id for r in fl.year_cutoff(ex.status_cards(pages_df(rows)), 2017).collect())
    assert got == ["3", "6", "7"]
