import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY, by_isrc, collected
from upswing import APPLE, SPOTIFY
from upswing.functions.scalar import grouped_thousands, released_in_window
from upswing.operators.alerts import alerts, average_velocity, eligible_trends
from upswing.operators.digests import digests, distinct_alerts, messages
from upswing.schemas import IMAGES, PRODUCTS, RELEASE_DATES, SUBSCRIPTIONS, trend_schema


def trend_table(spark, rows, partner=SPOTIFY):
    """Trends out of dictionaries; absent counts are 0, absent ranks and shares NULL."""
    schema = trend_schema(partner)
    defaults = {
        "report_date": DAY, "canopus_id": 1, "resource_rollup_id": 1, "track_artist": "A",
        "track_title": "T", "country_code": "SE", "country_name": "Sweden", "rank_adj_score": 1.0,
    }
    full = [
        tuple((defaults | row).get(f.name, 0 if f.name.startswith("streams") and
              not f.name.endswith("perc") else None) for f in schema)
        for row in rows
    ]
    return spark.createDataFrame(full, schema)


def subscription_table(spark, rows):
    defaults = {
        "userId": "u1", "firstname": "F", "lastname": "L", "email": "u1@example.com",
        "category": "artist", "artist": 1, "primaryTerritoryCode": "SE",
        "primaryTerritoryName": "Sweden", "partner": "Spotify",
    }
    full = [tuple((defaults | row).get(f) for f in SUBSCRIPTIONS.names) for row in rows]
    return spark.createDataFrame(full, SUBSCRIPTIONS)


def label(**changes):
    return {"category": "label", "artist": None, "label": "L1", "labelname": "One"} | changes


@pytest.fixture()
def make_alerts(spark):
    def make(trends, subscriptions, products=(), images=(), age=100, day=DAY):
        isrcs = {row["isrc"] for frame in trends.values() for row in frame.collect()}
        released = [(isrc, day - timedelta(age)) for isrc in sorted(isrcs)]
        return alerts(
            trends,
            subscription_table(spark, subscriptions),
            spark.createDataFrame(list(products), PRODUCTS),
            spark.createDataFrame(released, RELEASE_DATES),
            spark.createDataFrame(list(images), IMAGES),
            day,
        )

    return make


def test_release_window_edges(spark):
    def inside(day, released):
        row = spark.range(1).select(released_in_window(F.lit(released), day)).first()
        return row[0]

    assert not inside(DAY, DAY - timedelta(14))
    assert inside(DAY, DAY - timedelta(15))
    assert inside(DAY, date(2022, 1, 28)) and not inside(DAY, date(2022, 1, 27))
    assert inside(date(2024, 2, 29), date(2022, 2, 28))


def test_average_covers_positive_scores_and_equal_scores_pass_it(spark):
    third = 0.1 + 0.2
    rows = [{"isrc": f"i{n}", "rank_adj_score": third} for n in range(7)]
    rows += [{"isrc": "zero", "rank_adj_score": 0.0}, {"isrc": "none", "rank_adj_score": None}]
    trends = trend_table(spark, rows)
    assert average_velocity(trends).first()["avg_velocity"] == pytest.approx(third)
    released = spark.createDataFrame(
        [(r["isrc"], date(2023, 6, 1)) for r in rows], RELEASE_DATES
    )
    images = spark.createDataFrame([], IMAGES)
    assert eligible_trends({"Spotify": trends}, released, images, DAY).count() == 7


def test_territory_matches_once_whether_first_second_or_both(spark, make_alerts):
    rows = [
        {"userId": "first"},
        {"userId": "second", "primaryTerritoryCode": "DK", "secondaryTerritoryCode": "SE"},
        {"userId": "both", "secondaryTerritoryCode": "SE"},
        {"userId": "elsewhere", "primaryTerritoryCode": "DK"},
    ]
    made = make_alerts({"Spotify": trend_table(spark, [{"isrc": "i"}])}, rows)
    assert [r[0] for r in made.select("userId").orderBy("userId").collect()] == [
        "both", "first", "second",
    ]


def test_partner_and_both_paths(spark, make_alerts):
    rows = [
        {"userId": "a"}, {"userId": "b", "partner": "Apple"}, {"userId": "c", "artist": 2},
        label(userId="d"), label(userId="e", label="L2"),
    ]
    made = make_alerts(
        {"Spotify": trend_table(spark, [{"isrc": "i"}])}, rows, products=[("i", "L1"), ("i", "L1")]
    )
    got = sorted((r["userId"], r["category"]) for r in made.collect())
    # a track that is listed twice alerts twice, and the copies collapse in the digest
    assert got == [("a", "artist"), ("d", "label"), ("d", "label")]
    assert distinct_alerts(made).count() == 2


def test_second_partners_source_takes_the_slot_of_the_first_ones(spark, make_alerts):
    trends = trend_table(
        spark, [{"isrc": "i", "streams_radio_tw": 7, "streams_radio_lw": 3}], APPLE
    )
    made = make_alerts({"Apple": trends}, [{"partner": "Apple"}]).first()
    assert (made["streams_artist_tw"], made["streams_artist_lw"]) == (7, 3)
    assert "streams_radio_tw" not in made.asDict()


def test_digest_keeps_the_ten_best_in_order(spark, make_alerts):
    rows = [
        {"isrc": f"i{n:02d}", "rank_adj_score": 5.0, "track_title": "a\nb", "resource_rollup_id": n}
        for n in range(9)
    ]
    rows += [{"isrc": "best", "rank_adj_score": 9.0}, {"isrc": "next", "rank_adj_score": 8.0}]
    rows += [{"isrc": "last", "rank_adj_score": 5.0, "canopus_id": 1}]
    trends = trend_table(spark, rows)
    # lift the low scores over the average, so that all twelve are candidates
    trends = trends.unionByName(
        trend_table(spark, [{"isrc": "low", "canopus_id": 3, "rank_adj_score": 0.1}] * 30)
    )
    made = make_alerts({"Spotify": trends}, [{}], images=[("best", "img\n1"), ("best", "img")])
    document = digests(made).collect()
    assert len(document) == 1
    tracks = document[0]["isrcs"]
    assert [t["isrc"] for t in tracks] == ["best", "next", *(f"i{n:02d}" for n in range(8))]
    assert tracks[0]["track_image"] == "img1"
    assert tracks[1]["track_image"] == "No image"
    assert tracks[2]["track_title"] == "ab"
    assert document[0]["user"].asDict() == {
        "firstname": "F", "lastname": "L", "email": "u1@example.com",
    }


def test_keys_with_commas_stay_apart(spark, make_alerts):
    rows = [
        {"email": "x,Spotify", "userId": "1"},
        {"email": "x", "userId": "2"},
    ]
    made = make_alerts({"Spotify": trend_table(spark, [{"isrc": "i"}])}, rows)
    assert digests(made).count() == 2


def test_message_leaves_out_missing_values(spark, make_alerts):
    trends = trend_table(spark, [{"isrc": "i", "streams_lw": None, "rank_tw": 1}])
    row = messages(digests(make_alerts({"Spotify": trends}, [{}]))).first()
    assert len(row["attributes"].pop("message_id")) == 64
    assert row["attributes"] == {
        "email": "u1@example.com", "firstname": "F", "lastname": "L",
        "subject": "Velocity Alerts",
    }
    payload = json.loads(row["value"])
    assert list(payload) == ["report_date", "user", "territory", "partner", "isrcs"]
    assert payload["territory"] == {"country_code": "SE", "country_name": "Sweden"}
    track = payload["isrcs"][0]
    assert track["rank_tw"] == 1 and "streams_lw" not in track and "labelname" not in track
    assert track["first_stream_date"] == "2023-10-20"


def test_thousands(spark):
    texts = ["1234567", "12", "-4000", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    shown = [r[0] for r in rows.select(grouped_thousands(F.col("t"))).collect()]
    assert shown == ["1,234,567", "12", "-4,000", "0,000", "0,000"]


def test_labels_and_artists_collect_no_unrelated_countries(spark, make_alerts):
    trends = trend_table(spark, [{"isrc": "i"}, {"isrc": "j", "country_code": "DK"}])
    made = make_alerts({"Spotify": trends}, [{}, label()], products=[("i", "L1"), ("j", "L1")])
    assert collected(made, "category", "isrc") == {("artist", "i"), ("label", "i")}
    assert set(by_isrc(made)) == {"i"}
