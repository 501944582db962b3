import random
from datetime import timedelta
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY, base_table, by_isrc, collected, sorted_rows, stream_table
from upswing import APPLE, SPOTIFY
from upswing.functions.exact import exact_mean, exact_parts, exact_sum, exact_total
from upswing.operators.alerts import above_average, average_velocity
from upswing.operators.counting import count_window
from upswing.operators.trends import (
    difference_stats,
    ranked_by,
    ranked_pairs,
    regional_rows,
    with_rank_difference,
)
from upswing.plans.velocity import trending, velocity_base
from upswing.schemas import NAMES, RESOURCES
from upswing.sources.tables import staged
from verification.queries import base_of


def both_weeks(code, name, isrc, tw, lw, *region):
    rows = [(code, name, isrc, "TW", tw, *region)] if tw is not None else []
    return rows + ([(code, name, isrc, "LW", lw, *region)] if lw is not None else [])


def test_only_the_window_counts_and_labels_flip_between_the_weeks(spark):
    ages = {-1: None, 0: "TW", 6: "TW", 7: "LW", 13: "LW", 14: None}
    rows = [
        {"part_day": DAY - timedelta(age), "isrc": f"age{age}", "user_country_code": "SE"}
        for age in ages
    ]
    counted = count_window(stream_table(spark, rows), SPOTIFY, DAY)
    expected = {(f"age{age}", week) for age, week in ages.items() if week}
    assert collected(counted, "isrc", "week") == expected


def test_sources_are_split_per_partner(spark):
    rows = [
        {"part_day": DAY, "stream_source": "others_playlist", "source_uri": ""},
        {"part_day": DAY, "stream_source": "others_playlist", "source_uri": "uri:1"},
        {"part_day": DAY, "stream_source": "others_playlist", "source_uri": None},
        {"part_day": DAY, "stream_source": "playlist"},
        {"part_day": DAY, "stream_source": "radio"},
    ]
    streams = stream_table(spark, rows)
    spotify = count_window(streams, SPOTIFY, DAY).first()
    assert (spotify["streams"], spotify["streams_playlist"]) == (5, 1)
    assert spotify["streams_undeveloped_playlist"] == 1
    apple = count_window(streams, APPLE, DAY).first()
    assert (apple["streams_playlist"], apple["streams_radio"]) == (1, 1)
    assert apple["streams_undeveloped_playlist"] == 3


def test_rollups_keep_unknown_countries_globally_but_not_abroad(spark):
    rows = [
        {"part_day": DAY, "user_country_code": code, "user_country_name": "n"}
        for code in ("US", "SE", None)
    ]
    resources = spark.createDataFrame([("I1", 1, "T", 1)], RESOURCES)
    names = spark.createDataFrame([(1, "A")], NAMES)
    base = velocity_base(stream_table(spark, rows), resources, names, SPOTIFY, day=DAY)
    totals = {row["country_code"]: row["streams"] for row in base.collect()}
    assert totals == {"US": 1, "SE": 1, None: 1, "XX": 3, "EX-US": 1}


@pytest.fixture(scope="module")
def micro(spark):
    """Several small markets in one build."""
    rows = []
    rows += both_weeks("N1", "one week", "tw-only", 5, None)
    rows += both_weeks("N1", "one week", "lw-only", None, 3)
    rows += both_weeks("N1", "one week", "both", 4, 4)
    for isrc in ("t1", "t2", "t3"):
        rows += both_weeks("N2", "ties", isrc, 7, 1)
    rows += both_weeks("N2", "ties", "t4", 2, 9)
    rows += both_weeks("N3", "single", "s1", 9, 3)
    for isrc in ("e1", "e2"):
        rows += both_weeks("N4", "equal", isrc, 3, 3)
    # falls in streams although its rank improves
    rows += both_weeks("N5", "guard", "g1", 90, 100)
    rows += both_weeks("N5", "guard", "g2", 50, 300)
    rows += both_weeks("N5", "guard", "g3", 20, 200)
    rows += both_weeks("N5", "guard", "g4", 95, 10)
    # two codes share a name: ranks apart, mean and deviation together
    rows += both_weeks("P1", "shared", "p1", 5, 1) + both_weeks("P1", "shared", "p2", 1, 5)
    rows += both_weeks("P2", "shared", "p3", 8, 8) + both_weeks("P2", "shared", "p4", 2, 2)
    return trending(base_table(spark, rows), SPOTIFY).cache()


def market(micro, code):
    return by_isrc(micro.filter(F.col("country_code") == code))


def test_a_missing_week_is_null_not_zero(micro):
    rows = market(micro, "N1")
    new, gone = rows["tw-only"], rows["lw-only"]
    assert (new["streams_tw"], new["streams_lw"], new["streams_change"]) == (5, None, None)
    assert new["streams_collection_change_perc"] is None
    assert (new["rank_tw"], new["rank_lw"], new["rank_change"]) == (1, None, None)
    assert (gone["streams_tw"], gone["rank_tw"], gone["rank_lw"]) == (None, 3, 2)


def test_score_uses_the_raw_rank_of_items_without_last_week(micro):
    # raw ranks: tw-only 1/3, both 2/1, lw-only 3/2 -> differences 2, -1, -1
    d = np.arcsinh([2.0, -1.0, -1.0])
    z = (d[0] - d.mean()) / d.std(ddof=1) / np.arcsinh(1)
    assert market(micro, "N1")["tw-only"]["rank_adj_score"] == pytest.approx(z)


def test_ties_share_a_rank_and_the_next_one_is_skipped(micro):
    rows = market(micro, "N2")
    assert [rows[i]["rank_tw"] for i in ("t1", "t2", "t3", "t4")] == [1, 1, 1, 4]
    assert [rows[i]["rank_lw"] for i in ("t1", "t2", "t3", "t4")] == [2, 2, 2, 1]


def test_no_score_without_spread(micro):
    assert market(micro, "N3")["s1"]["rank_adj_score"] is None
    assert {r["rank_adj_score"] for r in market(micro, "N4").values()} == {None}


def test_positive_score_is_zeroed_when_streams_fell(micro):
    rows = market(micro, "N5")
    assert rows["g1"]["rank_change"] == 1 and rows["g1"]["rank_adj_score"] == 0.0
    assert rows["g4"]["rank_adj_score"] > 0
    assert rows["g2"]["rank_adj_score"] < 0


def test_mean_and_deviation_are_pooled_by_country_name(micro):
    d = np.arcsinh([1.0, -1.0, 0.0, 0.0])
    z = (d[0] - d.mean()) / d.std(ddof=1) / np.arcsinh(1)
    rows = market(micro, "P1")
    assert rows["p1"]["rank_tw"] == 1
    assert rows["p1"]["rank_adj_score"] == pytest.approx(z)


def test_shares(micro):
    row = market(micro, "N3")["s1"]
    assert row["streams_collection_change_perc"] == 1.0
    assert row["streams_album_change_perc"] == 0.0
    assert (row["collection_perc"], row["playlist_perc"]) == (1.0, 0.0)


def test_rank_change_sign_differs_for_the_second_partners_countries(spark):
    rows = both_weeks("SE", "s", "a", 9, 1, "SE-1") + both_weeks("SE", "s", "b", 1, 9, "SE-1")
    base = base_table(spark, rows, APPLE)
    assert by_isrc(trending(base, APPLE))["a"]["rank_change"] == -1
    assert by_isrc(trending(base, APPLE, regional=True))["a"]["rank_change"] == 1


def test_region_filter(spark):
    rows = [
        ("SE", "s", "1", "TW", 1, "SE-1"), ("SE", "s", "2", "TW", 1, "DK-1"),
        ("US", "u", "3", "TW", 1, "503"), ("US", "u", "4", "TW", 1, "US-1"),
        ("JP", "j", "5", "TW", 1, "JP-1"), ("SE", "s", "6", "TW", 1, ""),
        ("SE", "s", "7", "TW", 1, None),
    ]
    spotify = regional_rows(base_table(spark, rows), SPOTIFY)
    assert collected(spotify, "isrc") == {("1",), ("3",)}
    apple = regional_rows(base_table(spark, rows, APPLE), APPLE)
    assert collected(apple, "isrc") == {("1",), ("2",), ("3",), ("4",), ("5",)}


def random_rows(seed, items=3000):
    """A third of all items have one stream and no last week; one market holds most rows."""
    rng = np.random.default_rng(seed)
    tw = rng.zipf(1.6, items).clip(max=500).astype(float)
    lw = rng.zipf(1.6, items).clip(max=500).astype(float)
    hot = rng.random(items) < 0.34
    tw[hot], lw[hot] = 1.0, np.nan
    tw[rng.random(items) < 0.05] = np.nan
    code = np.where(rng.random(items) < 0.7, "XX", rng.choice(["SE", "DK", None], items))
    return pd.DataFrame({"code": code, "tw": tw, "lw": lw, "id": np.arange(items)})


def as_spark(spark, pdf):
    clean = pdf.astype(object).where(pdf.notna(), None)
    rows = [
        (r.id, r.code, None if r.tw is None else int(r.tw), None if r.lw is None else int(r.lw))
        for r in clean.itertuples()
    ]
    return spark.createDataFrame(
        rows, "id long, country_code string, streams_tw long, streams_lw long"
    )


def brute_rank(pdf, value):
    filled = pdf[value].fillna(-1)
    return filled.groupby(pdf["code"].fillna("?")).rank(method="min", ascending=False)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_brute_force(spark, seed):
    pdf = random_rows(seed)
    ranked = ranked_by(as_spark(spark, pdf), ["country_code"], "streams_lw", "rank_lw")
    got = {row["id"]: row["rank_lw"] for row in ranked.collect()}
    assert got == dict(zip(pdf["id"], brute_rank(pdf, "lw").astype(int)))


def test_mean_and_deviation_equal_brute_force(spark):
    pdf = random_rows(3)
    pairs = ranked_pairs(as_spark(spark, pdf), ["country_code"], ["country_code"])
    stats = difference_stats(with_rank_difference(pairs, 100), ["country_code"])
    tw = brute_rank(pdf, "tw").clip(upper=100)
    lw = brute_rank(pdf, "lw").clip(upper=100)
    d = np.arcsinh(lw - tw).groupby(pdf["code"].fillna("?"))
    for row in stats.collect():
        code = row["country_code"] or "?"
        assert row["mean_transformed_diff"] == pytest.approx(d.mean()[code], abs=1e-12)
        assert row["std_transformed_diff"] == pytest.approx(d.std()[code], rel=1e-12)


def test_hot_pair_gives_the_same_trends_when_every_join_shuffles_and_splits(spark, settings):
    pdf = random_rows(4)
    rows = []
    for r in as_spark(spark, pdf).collect():
        code = r["country_code"]
        rows += both_weeks(code, f"name {code}", f"i{r['id']}", r["streams_tw"], r["streams_lw"])
    base = base_table(spark, rows)
    plain = sorted_rows(trending(base, SPOTIFY, top_n=40))
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    assert sorted_rows(trending(base, SPOTIFY, top_n=40)) == plain


def test_sums_do_not_depend_on_the_order(spark):
    """Same bits under different partitionings, the mean of equal values is that value."""
    pick, rows = random.Random(3), []
    for group in range(30):
        size = pick.randint(1, 60)
        same = [pick.uniform(0, 3)] * size
        mixed = [pick.uniform(-10, 10) * 10 ** pick.randint(-9, 2) for _ in range(size)]
        rows += [(group, v, pick.randint(1, 10**6)) for v in (mixed if group % 3 else same)]
    table = spark.createDataFrame(rows + [(0, None, 5)], "g int, v double, n long")
    seen = []
    for parts in (1, 3, 17):
        dealt = table.repartition(parts, F.rand(parts)).withColumns(
            {"p": exact_parts(F.col("v")), "w": exact_parts(F.col("v"), F.col("n"))}
        )
        summed = dealt.groupBy("g").agg(
            exact_sum("p").alias("p"), exact_sum("w").alias("w"), F.count("v").alias("k"),
            F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("n"), F.max("v").alias("top"),
        )
        seen.append(
            {
                tuple(r)
                for r in summed.select(
                    "g", exact_mean(F.col("p"), F.col("k")), exact_mean(F.col("w"), F.col("n")),
                    exact_total(F.col("p")), "top",
                ).collect()
            }
        )
    assert seen[0] == seen[1] == seen[2]
    for group, mean, weighted, total, top in seen[0]:
        values = [(Fraction(v), n) for g, v, n in rows if g == group]
        exact = sum(v for v, _ in values)
        by_weight = sum(v * n for v, n in values) / sum(n for _, n in values)
        assert mean == pytest.approx(float(exact / len(values)), rel=1e-15, abs=1e-25)
        assert weighted == pytest.approx(float(by_weight), rel=1e-15, abs=1e-25)
        assert total == pytest.approx(float(exact), rel=1e-15, abs=1e-25) and mean <= top
        if group % 3 == 0:
            assert mean == weighted == top


def test_rebuilt_scores_have_the_same_bits(spark, sf_dir, settings):
    base = staged(base_of(spark, sf_dir, SPOTIFY), "base")
    first = {tuple(r) for r in trending(base, SPOTIFY).collect()}
    settings(spark__sql__shuffle__partitions="13")
    again = trending(base.repartition(7, F.rand(1)), SPOTIFY)
    assert {tuple(r) for r in again.collect()} == first


def test_averages_keep_days_apart(spark):
    rows = [(DAY, "SE", 1.0), (DAY, "SE", 3.0), (DAY - timedelta(1), "SE", 9.0), (DAY, "NO", -1.0)]
    trends = spark.createDataFrame(rows, "report_date date, country_code string, rank_adj_score double")
    assert collected(average_velocity(trends), "report_date", "avg_velocity") == {
        (DAY, 2.0), (DAY - timedelta(1), 9.0),
    }
    assert collected(above_average(trends), "rank_adj_score") == {(3.0,), (9.0,)}
