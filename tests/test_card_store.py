"""The clustered post store: the cutoff rules on random feeds, files that are not read, repeated and dead loads."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.sources.card_store import CardStore
from tests.conftest import page

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def card(sid, year, month, bad=False):
    mblog = {"created_at": f"Mon {MONTHS[month - 1]} 02 10:00:00 +0800 {year}" if year else "yesterday", "id": str(sid),
             "text": f"t{sid}", "reposts_count": 1, "comments_count": 2, "attitudes_count": 3}
    if bad:
        del mblog["text"]
    return {"card_type": 9, "scheme": f"https://s.example/{sid}?x=1", "itemid": "i", "show_type": 0, "mblog": mblog}


def feeds(seed, accounts=12):
    rnd = random.Random(seed)
    rows, sid = [], 0
    for a in range(accounts):
        key = None if a == 0 else "no-number" if a == 1 else str(1000 + a)
        for p in range(rnd.randint(1, 4)):
            cards = []
            for _ in range(rnd.randint(0, 5)):
                sid += 1
                cards.append(card(sid, rnd.choice([2015, 2016, 2017, 2023, 2023, 2024, 2024, None]), rnd.randint(3, 6),
                                  rnd.random() < 0.15))
            number = None if rnd.random() < 0.1 else p
            rows.append(page("status_list", {"ok": 1, "data": {"cards": cards}}, page_key=f"{a}:{p}", seed_key=key, page_no=number))
            if rnd.random() < 0.15:                                       # landed twice
                rows.append(dict(rows[-1]))
    return rows


def ids(df):
    return sorted(r.status_id for r in df.collect())


def fill(spark, pages_df, tmp_path, rows, loads=3, ranges=4):
    store = CardStore(spark, str(tmp_path / "store"), ranges)
    for k in range(loads):
        store.load(pages_df(rows[k::loads]), f"l{k}")
    return store


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_general_rules(spark, pages_df, tmp_path, seed):
    rows = feeds(seed)
    store, cards = fill(spark, pages_df, tmp_path, rows), ex.status_cards(pages_df(rows)).cache()
    for year in (2016, 2017, 2024, 2030):
        assert ids(store.until_year(year)) == ids(fl.year_cutoff(cards, year))
    for month in (3, 4, 6):
        assert ids(store.month_window(2023, month)) == ids(fl.month_window(cards, 2023, month))
    some = spark.createDataFrame([("1003",), ("1007",), ("unknown",)], "id string")
    mine = cards.join(some.withColumnRenamed("id", "seed_key"), "seed_key", "left_semi")
    assert ids(store.until_year(2017, some)) == ids(fl.year_cutoff(mine, 2017))


def test_files_without_kept_posts_are_not_read(spark, pages_df, tmp_path):
    """Files that can hold no kept post are made unreadable; the answer stays."""
    def feed(key, years):
        cards = [card(int(key) * 100 + i, y, 5) for i, y in enumerate(years)]
        return page("status_list", {"ok": 1, "data": {"cards": cards}}, seed_key=key)

    # ranges of one account each; account 3 ends before 2023 is met, account 4 asks for nothing
    rows = [feed("1", [2024, 2023, 2015, 2014]), feed("2", [2024, 2016]), feed("3", [2024, 2010, 2023, 2022]), feed("4", [2012, 2024])]
    store = fill(spark, pages_df, tmp_path, rows, loads=1, ranges=4)
    expected = ids(store.until_year(2020))
    assert expected == ["100", "101", "200", "300"]
    files = glob.glob(str(tmp_path / "store/posts/**/*.parquet"), recursive=True)
    kept = [r.folder for r in store.until_year(2020).select("folder").distinct().collect()]
    dead = [f for f in files if f.split("folder=")[1].split("/")[0] not in kept]
    assert (len(files), len(dead)) == (12, 8)
    for f in dead:
        with open(f, "wb") as out:
            out.write(b"not a parquet file")
    assert ids(store.until_year(2020)) == expected


def test_repeated_dead_and_empty_loads(spark, pages_df, tmp_path):
    rows = feeds(7)
    store = fill(spark, pages_df, tmp_path, rows, loads=2)
    before = ids(store.until_year(2017))
    store.load(pages_df(rows[0::2]), "l0")                                # the same load again
    assert ids(store.until_year(2017)) == before
    store.load(pages_df([]), "none")
    assert ids(store.until_year(2017)) == before
    store.load(pages_df(feeds(8)), "dead")
    store._drop(f"{store.path}/firsts/load=dead")                         # it died before its summary
    assert ids(store.until_year(2017)) == before
    empty = CardStore(spark, str(tmp_path / "new"))
    assert ids(empty.until_year(2017)) == []
    empty.load(pages_df([]), "none")
    assert ids(empty.until_year(2017)) == ids(empty.month_window()) == []
    with pytest.raises(ValueError):
        empty.load(pages_df([]), "a/b")


def test_later_loads_keep_the_ranges(spark, pages_df, tmp_path):
    rows = feeds(9)
    store = fill(spark, pages_df, tmp_path, rows, loads=2)
    ranges = store.firsts().where(F.col("seed_key").isNotNull()).groupBy("seed_key").agg(F.count_distinct("account_range").alias("n"))
    assert ranges.where(F.col("n") > 1).isEmpty()
