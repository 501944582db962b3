"""Properties of the physical plans that keep the work distributed."""

import random
import threading
from datetime import date, timedelta

import pytest

from pyspark.sql import functions as F

from tests.helpers import DAY, base_table, collected, executed_plan, planned, sorted_rows, stream_table
from upswing import APPLE, SPOTIFY
from upswing.operators.alerts import alert_columns
from upswing.operators.checks import footer_volumes
from upswing.operators.counting import (
    count_window,
    count_windows,
    dealt_by_track,
    on_report_days,
    on_seen_days,
    seen_weeks,
    sliding_weeks,
)
from upswing.operators.digests import distinct_alerts, top_alerts
from upswing.operators.fingerprints import whole_build_diff
from upswing.operators.trends import ranked_by, week_pivot
from upswing.plans import daily
from upswing.plans.daily import days_between
from upswing.plans.velocity import above_cut
from upswing.sources.tables import spread, staged, work_path, write_days
from verification import inputs, queries
from verification.queries import alerts_of, base_of, trends_of

STREAM_ROWS = [
    {"part_day": DAY, "user_country_code": "US", "user_country_name": "Country US"},
    {"part_day": DAY, "user_country_code": None, "user_country_name": None, "user_dma_name": None},
    {"part_day": DAY, "isrc": "I2", "user_dma_number": "501", "user_dma_name": "DMA, 501"},
]


@pytest.fixture()
def no_broadcast(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def test_raw_streams_are_scanned_and_counted_once(spark, sf_dir, no_broadcast):
    plan = executed_plan(base_of(spark, sf_dir, SPOTIFY))
    assert plan.count("l_linenumber") and plan.count("ReusedExchange") == 1
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_linenumber" in line]
    assert len(scans) == 1


@pytest.mark.parametrize("partner", [SPOTIFY, APPLE])
def test_a_days_counts_move_once_and_meet_metadata_unsorted(spark, sf_dir, monkeypatch, partner):
    monkeypatch.setattr("upswing.sources.tables.ROWS_PER_TASK", 1000)
    plan = executed_plan(base_of(spark, sf_dir, partner))
    deal = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert ["ReusedExchange" in line for line in deal] == [False, True]
    above, below = plan.split(deal[0])
    assert "ShuffledHashJoin" in above and "SortMergeJoin" not in above
    assert "ENSURE_REQUIREMENTS" not in above
    # The synthetic markets have no hash table beside that of the counts.
    assert below.split("ShuffleQueryStage")[0].count("HashAggregate") == 1


def test_dealt_counts_keep_their_market(spark):
    counted = count_window(stream_table(spark, STREAM_ROWS), SPOTIFY, DAY)
    dealt = dealt_by_track(counted, 3, SPOTIFY)
    assert dealt.dtypes == [(c, dict(counted.dtypes)[c]) for c in dealt.columns]
    assert counted.count() == 3 and sorted_rows(dealt) == sorted_rows(counted)


def test_partners_are_built_side_by_side(spark, sf_dir, monkeypatch):
    both, made = threading.Barrier(2), queries.staged_trends

    def met(*args):
        both.wait(60)
        return made(*args)

    monkeypatch.setattr(queries, "staged_trends", met)
    assert set(alerts_of(spark, sf_dir).columns) == set(alert_columns())


@pytest.mark.parametrize("regional", [False, True])
def test_no_window_over_items(spark, sf_dir, no_broadcast, regional):
    """Windows run over distinct stream counts only; the items' own plan has none."""
    plan = planned(trends_of(spark, sf_dir, SPOTIFY, regional))
    assert "Window" not in plan
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_items_below_the_cut_are_dropped_before_the_pair_join(spark, sf_dir, no_broadcast):
    lines = planned(trends_of(spark, sf_dir, SPOTIFY)).splitlines()
    cut = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "cut_tw" in line)
    pair_join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert pair_join < cut
    assert any("Exchange hashpartitioning" in line for line in lines[pair_join:cut])


def test_backfill_moves_counts_once(spark, sf_dir, no_broadcast):
    """Daily counts move to their key, as they are; rows per report day are made after that."""
    days = days_between("2024-01-20", "2024-01-28")
    lines = planned(count_windows(inputs.streams(spark, sf_dir), SPOTIFY, days)).splitlines()
    assert sum("Exchange hashpartitioning" in line for line in lines) == 2
    moved = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert sum("Generate" in line for line in lines[:moved]) == 3
    assert not any("Generate" in line for line in lines[moved:])
    changes = next(line for line in reversed(lines) if "Generate" in line)
    assert changes.count("date_add") == 3  # three changes per daily count, whatever the window


def test_items_are_pivoted_once(spark, sf_dir):
    """Cut and scores are looked up by items that are written already."""
    plan = planned(trends_of(spark, sf_dir, SPOTIFY))
    assert "week#" not in plan and "streams_tw" in plan
    assert "SortMergeJoin" not in plan  # the written pairs are known to be few, so items stay


def test_changes_fall_on_report_days(spark):
    """Counts that leave or enter between two report days, or after the last, cost no row of their own."""
    days = [date(2024, 1, 20), date(2024, 1, 21), date(2024, 1, 26)]
    rows = [(date(2024, 1, 1 + i), f"I{i % 3}", i + 1) for i in range(30)]
    daily = spark.createDataFrame(rows, "part_day date, isrc string, streams long")
    expected = {}
    for report in days:
        for day, isrc, n in rows:
            if 0 <= (age := (report - day).days) < 14:
                key = (report, isrc, "TW" if age < 7 else "LW")
                expected[key] = expected.get(key, 0) + n
    for dealt in (None, ["isrc"]):
        weeks = sliding_weeks(daily if dealt is None else spread(daily, 1, "isrc"), ["streams"], days, dealt)
        assert {row["since"] for row in weeks.select("since").collect()} <= set(days)
        made = on_report_days(weeks, days).select("report_date", "isrc", "week", "streams").collect()
        assert {tuple(row[:3]): row[3] for row in made} == expected and len(made) == len(expected)


@pytest.mark.parametrize("back", [[0], [0, 1, 2], [0, 3, 16]])
def test_few_report_days_side_by_side_equal_sliding_sums(spark, back):
    """Keys with NULLs, days without counts, weeks that are empty for a key or a counter."""
    pick, days = random.Random(3), sorted(DAY - timedelta(n) for n in back)
    rows = {
        (DAY - timedelta(pick.randrange(35)), pick.choice(["SE", "NO", None]), f"I{pick.randrange(9)}")
        for _ in range(120)
    }
    daily = spark.createDataFrame(
        [(*key, n := pick.randrange(1, 9), pick.randrange(n)) for key in sorted(rows, key=str)],
        "part_day date, country_code string, isrc string, streams long, streams_album long",
    )
    names = ["streams", "streams_album"]
    side_by_side = on_seen_days(seen_weeks(daily, names, days), days)
    sliding = on_report_days(sliding_weeks(daily, names, days), days)
    assert sorted_rows(side_by_side) == sorted_rows(sliding) != []
    columns = ["report_date", "country_code", "isrc", "week", *names]
    expected = {}
    for day, country, isrc, *counts in daily.collect():
        for report in days:
            if 0 <= (age := (report - day).days) < 14:
                key = (report, country, isrc, "TW" if age < 7 else "LW")
                expected[key] = [a + b for a, b in zip(expected.get(key, (0, 0)), counts)]
    assert collected(side_by_side, *columns) == {(*key, *sums) for key, sums in expected.items()}


@pytest.mark.parametrize("partner", [SPOTIFY, APPLE])
def test_few_report_days_are_neither_sorted_into_windows_nor_moved_to_be_written(
    spark, sf_dir, monkeypatch, settings, partner
):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr("upswing.sources.tables.ROWS_PER_TASK", 1000)
    written = []
    monkeypatch.setattr(daily, "write_days", lambda df, *a, **k: written.append((df, a[2], k)))
    monkeypatch.setattr(daily, "written_days", lambda *a: staged(written[0][0], "base"))
    tables = (
        inputs.streams, inputs.resources, inputs.names, inputs.subdivisions, inputs.zips,
    )
    days = days_between("2024-01-26", "2024-01-29")
    sources = daily.Sources(*(table(spark, sf_dir) for table in tables))
    daily.rebuild(spark, sources, partner, days, daily.Paths("b", "c", "r"))
    base, listed, options = written[0]
    assert listed == days and options == {"gathered": True} and len(written) == 3
    plan = executed_plan(base)
    deal = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert ["ReusedExchange" in line for line in deal] == [False, True]
    assert "Window" not in plan


def test_countries_and_regions_are_built_side_by_side(spark, sf_dir, monkeypatch):
    both, made = threading.Barrier(2), daily.trending

    def met(*args):
        both.wait(60)
        return made(*args)

    monkeypatch.setattr(daily, "trending", met)
    tables = (inputs.streams, inputs.resources, inputs.names)
    paths = daily.Paths(*(work_path(spark, n) for n in ("base", "countries", "regions")))
    daily.rebuild(spark, daily.Sources(*(table(spark, sf_dir) for table in tables)), SPOTIFY, [DAY], paths)
    assert all(not spark.read.parquet(path).isEmpty() for path in (paths.countries, paths.regions))


def test_gathered_rows_are_written_where_they_are(spark):
    rows = [(day, k) for day in (DAY, DAY - timedelta(1)) for k in range(40)]
    table = spark.createDataFrame(rows, "part_day date, k int").repartition(3, "k")
    path = work_path(spark, "gathered")
    for _ in range(2):
        write_days(table, path, days=[DAY, DAY - timedelta(1)], gathered=True)
        back = spark.read.parquet(path)
        assert collected(back, "part_day", "k") == set(rows) and back.count() == len(rows)
        assert len(back.inputFiles()) == 6  # two days out of each task


def test_items_are_hashed_once_each(spark, settings):
    """Items and keys of daily counts are far more than the table of first groups that Spark would keep
    beside the table of all holds."""
    settings(spark__sql__adaptive__enabled="false")
    items = week_pivot(spread(base_table(spark, [("SE", "Sweden", "I1", "TW", 3)]), 1, "report_date", "isrc"), ["streams"])
    counts = spark.createDataFrame([(DAY, "SE", "I1", 3)], "part_day date, country_code string, isrc string, streams long")
    weeks = seen_weeks(spread(counts, 1, "isrc"), ["streams"], [DAY])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    for df in (items, weeks):
        code = df._jdf.queryExecution().explainString(mode)
        assert "HashAggregate" in code and "FastHashMap" not in code
        assert planned(df).count("Exchange") == 1  # dealt by some of the keys, items stay


def test_tasks_are_sized_by_rows(spark, monkeypatch):
    table = spark.range(25).withColumnRenamed("id", "k")
    monkeypatch.setattr("upswing.sources.tables.ROWS_PER_TASK", 10)
    dealt = spread(table, 25, "k")
    assert dealt.rdd.getNumPartitions() == 3 and dealt.count() == 25
    assert spread(table, 0, "k").rdd.getNumPartitions() == 1


def test_volumes_come_from_footers(spark, sf_dir):
    path = work_path(spark, "volumes")
    write_days(inputs.streams(spark, sf_dir), path)
    plan = planned(footer_volumes(spark, {"streams": path}, "2024-01-10"))
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [part_day]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_diff_reads_only_days_that_differ(spark):
    rows = [(day, "SE", i, i) for day in range(1, 9) for i in range(20)]
    table = spark.createDataFrame(rows, "d int, country_code string, k int, v int").selectExpr(
        "make_date(2024, 1, d) AS part_day", "country_code", "k", "v"
    )
    paths = [work_path(spark, n) for n in ("one", "two")]
    write_days(table, paths[0])
    write_days(table.withColumn("v", F.expr("if(day(part_day) = 3 AND k = 7, 0, v)")), paths[1])
    one, two = (spark.read.parquet(p) for p in paths)
    keys = ["part_day", "country_code", "k"]
    diff = whole_build_diff(one, two, keys, ["part_day", "country_code"])
    assert collected(diff, "k", "rows_left", "rows_right", "changed") == {(7, 1, 1, "v")}
    plan = planned(diff)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "part_day" in line]
    builds = [line for line in scans if "v#" in line]
    assert len(builds) == 2 and all("= 2024-01-03)" in line for line in builds)
    assert whole_build_diff(one, one, keys, ["part_day", "country_code"]).isEmpty()


def test_the_cut_keeps_every_top_rank(spark):
    """Ties, markets without last or this week's streams, markets smaller than the cut."""
    pick, rows = random.Random(2), []
    for market in range(12):
        for item in range(pick.choice([1, 3, 40])):
            tw = None if market == 3 or pick.random() < 0.2 else pick.randrange(8)
            rows.append((market, item, tw))
    table = spark.createDataFrame(rows, "market int, item int, streams_tw long")
    ranked = ranked_by(table, ["market"], "streams_tw", "rank_tw")
    for top_n in (1, 5, 30):
        top = ranked.filter(ranked["rank_tw"] <= top_n)
        kept = above_cut(table, top.drop("item"), ["market"])
        assert sorted(map(str, kept.collect())) == sorted(
            map(str, top.select("market", "item", "streams_tw").collect())
        )


def test_territories_join_on_equality(spark, sf_dir, no_broadcast):
    plan = planned(alerts_of(spark, sf_dir))
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert all("SortMergeJoin" in line for line in joins)
    assert any("[artist" in line and "territory" in line for line in joins)
    assert any("[label" in line and "territory" in line for line in joins)
    assert "Python" not in plan


def test_digests_are_cut_before_the_shuffle(spark, sf_dir):
    made = staged(alerts_of(spark, sf_dir), "alerts")
    plan = planned(top_alerts(distinct_alerts(made)))
    assert plan.count("WindowGroupLimit") == 2


def test_flattening_needs_no_shuffle(spark, sf_dir):
    from upswing.operators.subscriptions import flatten_subscriptions

    docs = inputs.user_docs(spark, sf_dir)
    plan = planned(flatten_subscriptions(docs, inputs.APP, inputs.SUBSCRIPTION))
    assert "Exchange" not in plan
