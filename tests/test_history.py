import datetime as dt
import random

from silverline.operators.history import category_analytics_as_of, category_validity, valid_on

CATEGORIES = "source string, region string, category_id long, category_title string, drop_date date, bronze_file string"
VIDEOS = "source string, region string, category_id long, trending_date date, view_count long"


def _day(d):
    return dt.date(2024, 1, d)


def _category(i, title, day, file="f"):
    return ("api", "us" if i == 1 else "US", i, title, day and _day(day), file)


def test_a_renamed_id_has_each_days_title(spark):
    drops = [
        _category(1, "Music", 5), _category(1, "Songs", 9, "f1"), _category(1, "Tunes", 9, "f2"),
        _category(1, "lost", None), _category(2, None, 3),
    ]
    validity = category_validity(spark.createDataFrame(drops, CATEGORIES))
    assert {(r.category_title, r.valid_from, r.valid_to) for r in validity.where("category_id = 1").collect()} == {
        ("Music", _day(5), _day(9)), ("Tunes", _day(9), None)
    }
    videos = [("api", "US", 1, _day(d), 10) for d in (4, 5, 8, 9, 20)] + [("api", "US", 2, _day(4), 7), ("api", "US", 3, _day(4), 1)]
    got = category_analytics_as_of(spark.createDataFrame(videos, VIDEOS), validity)
    rows = {(r.category_id, r.category_title, r.valid_from): (r.first_day, r.last_day, r.videos, r.total_views) for r in got.collect()}
    assert rows == {
        (1, None, None): (_day(4), _day(4), 1, 10),
        (1, "Music", _day(5)): (_day(5), _day(8), 2, 20),
        (1, "Tunes", _day(9)): (_day(9), _day(20), 2, 20),
        (2, None, _day(3)): (_day(4), _day(4), 1, 7),
        (3, None, None): (_day(4), _day(4), 1, 1),
    }


def test_lookup_equals_a_range_join(spark):
    rnd = random.Random(5)
    drops = [_category(rnd.randrange(4), f"t{n}", rnd.randrange(1, 29), f"f{n:03d}") for n in range(40)]
    validity = category_validity(spark.createDataFrame(drops, CATEGORIES)).cache()
    # One id holds most of the rows; days repeat.
    videos = [("api", "US", rnd.choice([0, 0, 0, 1, 2, 3, 4]), _day(rnd.randrange(1, 29)), n) for n in range(600)]
    days = spark.createDataFrame(videos, VIDEOS)
    keys = ["source", "region", "category_id"]
    got = valid_on(days, validity, keys)
    v, d = validity.alias("v"), days.select(*keys, "trending_date").distinct().alias("d")
    inside = (v.valid_from <= d.trending_date) & (v.valid_to.isNull() | (d.trending_date < v.valid_to))
    same = [v[k] == d[k] for k in keys]
    want = d.join(v, [*same, inside], "left").select(
        *[d[k] for k in keys], d.trending_date, v.category_title, v.valid_from, v.valid_to
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_no_drops_and_no_videos(spark):
    validity = category_validity(spark.createDataFrame([], CATEGORIES))
    videos = spark.createDataFrame([("api", "US", 1, _day(4), 3)], VIDEOS)
    assert category_analytics_as_of(videos, validity).first().category_title is None
    assert category_analytics_as_of(videos.limit(0), validity).count() == 0
