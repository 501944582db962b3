from datetime import date, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY, collected, planned, sorted_rows, stream_table
from upswing import APPLE, SPOTIFY
from upswing.operators.checks import (
    audit_counts,
    build_diff,
    has_rows,
    readiness,
    tie_profile,
)
from upswing.operators.fingerprints import (
    changed_groups,
    fingerprints,
    report_days_of,
    whole_build_diff,
)
from upswing.plans import daily
from upswing.plans.daily import (
    Paths,
    Sources,
    days_between,
    days_listed,
    rebuild,
    rebuild_changed,
    written_days,
)
from upswing.plans.velocity import trending, velocity_base
from upswing.schemas import NAMES, STREAMS, conform
from upswing.sources import tables as tables_io
from upswing.sources.documents import broken_user_docs, read_user_docs
from upswing.sources.tables import create_day_table, read_table, swap_days, work_path, write_days
from verification import inputs

OTHER = DAY - timedelta(1)


def day_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "part_day date, v int")


def test_replacing_a_day_leaves_the_others(spark):
    path = work_path(spark, "days")
    write_days(day_rows(spark, (DAY, 1), (OTHER, 2)), path)
    for _ in range(2):
        write_days(day_rows(spark, (DAY, 3)), path, days=[DAY])
        assert collected(read_table(spark, path), "part_day", "v") == {(DAY, 3), (OTHER, 2)}


def test_a_day_without_rows_is_emptied(spark):
    path = work_path(spark, "days")
    write_days(day_rows(spark, (DAY, 1), (OTHER, 2)), path)
    write_days(day_rows(spark, (OTHER, 5)), path, days=[DAY, OTHER])
    assert collected(read_table(spark, path), "part_day", "v") == {(OTHER, 5)}


def test_day_filters_prune_partitions(spark):
    path = work_path(spark, "streams")
    rows = [{"part_day": DAY - timedelta(n)} for n in range(20)]
    write_days(stream_table(spark, rows), path)
    streams = read_table(spark, path, STREAMS)
    for frame, days in (
        (tables_io.stream_window(streams, DAY), 14),
        (tables_io.on_day(streams, DAY), 1),
        (tables_io.since_day(streams, OTHER), 2),
        (tables_io.in_days(streams, OTHER, DAY), 2),
    ):
        assert frame.count() == days
        filters = planned(frame).split("PartitionFilters: [")[1].split("]")[0]
        assert "part_day" in filters


def test_base_reads_only_its_columns_and_days(spark):
    path = work_path(spark, "streams")
    write_days(stream_table(spark, [{"part_day": DAY}]), path)
    streams = read_table(spark, path, STREAMS)
    from upswing.operators.counting import count_window, count_windows

    for frame in (count_window(streams, SPOTIFY, DAY), count_windows(streams, SPOTIFY, [DAY])):
        plan = planned(frame)
        assert "user_postal_code" not in plan
        assert "part_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_declared_schema_is_checked(spark):
    wrong = spark.createDataFrame([(1, "a")], "canopus_id long, title string")
    with pytest.raises(ValueError, match="default_name"):
        conform(wrong, NAMES)
    right = spark.createDataFrame([("a", 1)], "default_name string, canopus_id int")
    assert conform(right, NAMES).dtypes == [("canopus_id", "bigint"), ("default_name", "string")]


def test_create_day_table_once(spark):
    path, name = work_path(spark, "table"), "made_once"
    assert create_day_table(spark, name, STREAMS, path)
    assert not create_day_table(spark, name, STREAMS, path)
    assert spark.table(name).columns[-1] == "part_day"
    assert not has_rows(spark.table(name))


def test_catalog_table_shows_what_was_written(spark):
    path, name = work_path(spark, "it's a table"), "shown_days"
    schema = day_rows(spark, (DAY, 1)).schema
    assert create_day_table(spark, name, schema, path)
    write_days(day_rows(spark, (DAY, 1), (OTHER, 2)), path, table=name)
    write_days(day_rows(spark, (DAY, 3)), path, days=[DAY], table=name)
    other_session = spark.newSession()
    for session in (spark, other_session):
        assert collected(session.table(name), "part_day", "v") == {(DAY, 3), (OTHER, 2)}
    write_days(day_rows(spark, (DAY, 3)), path, days=[DAY, OTHER], table=name)
    assert collected(spark.table(name), "part_day", "v") == {(DAY, 3)}
    assert create_day_table(spark, "shown_again", schema, path)
    assert collected(spark.table("shown_again"), "part_day", "v") == {(DAY, 3)}


def test_rows_of_unlisted_days_stop_the_write(spark):
    path = work_path(spark, "days")
    write_days(day_rows(spark, (DAY, 1), (OTHER, 2)), path)
    with pytest.raises(Exception, match="not listed"):
        write_days(day_rows(spark, (DAY, 3), (OTHER, 9)), path, days=[DAY])
    assert collected(read_table(spark, path), "part_day", "v") == {(DAY, 1), (OTHER, 2)}


def test_diff_of_null_one_sided_and_repeated_keys(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, 1), (3, 9), (None, 4)], "k int, v int")
    right = spark.createDataFrame([(2, 5), (3, 9), (None, 4), (6, None), (6, None)], "k int, v int")
    diff = build_diff(left, right, ["k"], "v")
    assert collected(diff, "k", "v_left", "v_right", "rows_left", "rows_right") == {
        (1, None, None, 1, 0), (3, 1, None, 1, 0), (6, None, None, 0, 2),
    }


def test_work_dir_needs_a_shared_folder(spark):
    class Context:
        applicationId = "app-1"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf = {}
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables_io.work_dir(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert tables_io.work_dir(Session) == "hdfs:///shared/upswing-app-1"


def test_discard_deletes_an_intermediate_table(spark):
    path = work_path(spark, "gone")
    spark.range(3).write.parquet(path)
    tables_io.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_days():
    assert days_between("2024-01-30", "2024-02-02") == [
        date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1),
    ]
    assert days_between("2024-01-30", "2024-01-30") == []


def test_listed_days(spark):
    listed = spark.createDataFrame(
        [("2024-01-28",), ("2024-01-03",), ("2024-01-28",), (None,)], "partner_load_date string"
    )
    assert days_listed(listed) == [date(2024, 1, 3), DAY]
    assert days_listed(listed.limit(0)) == []


@pytest.fixture(scope="module")
def sources(spark, sf_dir):
    made = (
        inputs.streams, inputs.resources, inputs.names, inputs.subdivisions, inputs.zips,
    )
    return Sources(*(make(spark, sf_dir) for make in made))


def build_one(sources, partner, day):
    return velocity_base(
        sources.streams, sources.resources, sources.names, partner, day=day,
        subdivisions=sources.subdivisions, zips=sources.zips,
    )


@pytest.mark.parametrize("partner", [SPOTIFY, APPLE], ids=lambda p: p.name)
def test_many_days_at_once_equal_single_builds(spark, sources, partner):
    days = [DAY - timedelta(9), OTHER, DAY]
    paths = Paths(*(work_path(spark, n) for n in ("base", "countries", "regions")))
    rebuild(spark, sources, partner, days, paths)
    for day in days:
        one = tables_io.staged(build_one(sources, partner, day), "one")
        base = written_days(spark, paths.base, [day]).drop("part_day")
        assert sorted_rows(base) == sorted_rows(one)
        countries = written_days(spark, paths.countries, [day]).drop("part_day")
        assert sorted_rows(countries) == sorted_rows(trending(one, partner))
    rebuild(spark, sources, partner, [], paths)
    before = sorted_rows(spark.read.parquet(paths.regions))
    rebuild(spark, sources, partner, [DAY], paths)
    assert sorted_rows(spark.read.parquet(paths.regions)) == before


def test_checks(spark):
    table = day_rows(spark, (DAY, 1), (DAY, 2), (OTHER, 3))
    ready = readiness({"a": table, "b": table.limit(0)}, DAY, more_than=1)
    assert collected(ready, "name", "n_rows", "ready") == {("a", 2, True), ("b", 0, False)}
    alerts = spark.createDataFrame(
        [(DAY, "x"), (DAY, "x"), (DAY, "y"), (OTHER, "z")], "part_day date, email string"
    )
    audit = audit_counts({"a": table, "empty": table.limit(0)}, alerts, DAY)
    assert [tuple(r) for r in audit.select("name", "n_rows").collect()] == [
        ("a", 2), ("velocity alerts", 3), ("velocity emails", 2),
    ]


def test_ties_and_differences_of_builds(spark):
    schema = "country_code string, rank_lw long, streams_lw long"
    one = [("US", 1, 5), ("US", 1, 5), ("US", 3, None), ("US", 3, None), ("US", 9, 1), ("SE", 1, 5)]
    two = [("US", 1, 5), ("US", 1, 5), ("US", 3, None), ("US", 3, None), ("US", 3, None)]
    two += [("US", 6, 2), ("US", 6, 2)]
    left, right = (tie_profile(spark.createDataFrame(r, schema), "US") for r in (one, two))
    assert collected(left, "rank_lw", "streams_lw", "n_items") == {(1, 5, 2), (3, None, 2)}
    diff = build_diff(left, right, ["rank_lw", "streams_lw"], "n_items")
    assert collected(diff, "rank_lw", "streams_lw", "n_items_left", "n_items_right") == {
        (3, None, 2, 3), (6, 2, None, 2),
    }
    assert build_diff(left, left, ["rank_lw", "streams_lw"], "n_items").isEmpty()


def test_writing_nothing_at_all_empties_the_listed_days(spark):
    path = work_path(spark, "days")
    write_days(day_rows(spark, (DAY, 1), (OTHER, 2)), path)
    rows = day_rows(spark, (DAY, 1))
    write_days(rows.join(rows.filter("v > 1"), "v", "left_semi"), path, days=[DAY])
    assert collected(read_table(spark, path), "part_day", "v") == {(OTHER, 2)}
    write_days(rows.limit(0), path, days=[OTHER])
    assert read_table(spark, path, rows.schema).isEmpty()


@pytest.fixture()
def day_table(spark):
    path, name = work_path(spark, "it's swapped"), f"swapped_{uuid4().hex}"
    create_day_table(spark, name, day_rows(spark, (DAY, 1)).schema, path)
    swap_days(day_rows(spark, (DAY, 1), (OTHER, 2), (OTHER, 3)), name, path)
    return name, path


def test_swapped_days_replace_whole_days(spark, day_table):
    name, path = day_table
    swap_days(day_rows(spark, (DAY, 4)), name, path, days=[DAY])
    assert collected(spark.table(name), "part_day", "v") == {(DAY, 4), (OTHER, 2), (OTHER, 3)}
    with pytest.raises(Exception, match="not listed"):
        swap_days(day_rows(spark, (DAY, 5), (OTHER, 6)), name, path, days=[DAY])
    assert collected(spark.table(name), "part_day", "v") == {(DAY, 4), (OTHER, 2), (OTHER, 3)}
    swap_days(day_rows(spark, (DAY, 7)), name, path, days=[DAY, OTHER])
    assert collected(spark.newSession().table(name), "part_day", "v") == {(DAY, 7)}
    swap_days(day_rows(spark, (DAY, 7)).limit(0), name, path, days=[DAY])
    assert not has_rows(spark.table(name))


def test_a_failure_between_the_steps_leaves_the_old_days(spark, day_table, monkeypatch):
    name, path = day_table
    old = {(DAY, 1), (OTHER, 2), (OTHER, 3)}
    changed = tables_io._change_over

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(tables_io, "_change_over", lost)
    with pytest.raises(OSError):
        swap_days(day_rows(spark, (DAY, 8), (OTHER, 9)), name, path)
    assert collected(spark.table(name), "part_day", "v") == old

    def one_only(session, table, places):
        day = min(places)
        changed(session, table, {day: places[day]})
        raise OSError("driver lost")

    monkeypatch.setattr(tables_io, "_change_over", one_only)
    with pytest.raises(OSError):
        swap_days(day_rows(spark, (DAY, 8), (OTHER, 9)), name, path)
    assert collected(spark.table(name), "part_day", "v") == {(DAY, 1), (OTHER, 9)}


def test_fingerprints_do_not_depend_on_order_and_see_every_change(spark):
    rows = [(d, k, v) for d in range(4) for k, v in ((1, "a"), (1, "a"), (None, "b"), (2, None))]
    schema = "g int, k int, v string"
    before = fingerprints(spark.createDataFrame(rows, schema), ["g"])
    same = fingerprints(spark.createDataFrame(rows[::-1], schema).repartition(5), ["g"])
    assert changed_groups(before, same, ["g"]).isEmpty()
    later = rows[:4] + [(1, 1, "a"), (1, 1, "a"), (1, None, "b"), (1, None, "2")]
    later += [(2, 1, "c"), (2, 1, "c"), (2, None, "b"), (2, 2, None)] + [(None, 1, "a")] * 3
    found = changed_groups(before, fingerprints(spark.createDataFrame(later, schema), ["g"]), ["g"])
    assert collected(found, "g", "change", "rows_before", "rows_now") == {
        (1, "changed", 4, 4), (2, "changed", 4, 4), (3, "gone", 4, 0), (None, "new", 0, 3),
    }
    none = before.limit(0)
    assert changed_groups(none, none, ["g"]).isEmpty()
    assert changed_groups(none, before, ["g"]).count() == 4


def test_report_days_that_see_a_changed_day(spark):
    days = spark.createDataFrame([(DAY - timedelta(20),), (DAY,)], "part_day date")
    found = {r[0] for r in report_days_of(days, DAY - timedelta(9), DAY + timedelta(2)).collect()}
    assert found == {DAY - timedelta(n) for n in (-2, -1, 0, 7, 8, 9)}


def test_only_days_with_changed_streams_are_built_again(spark, sources, monkeypatch):
    built = []
    monkeypatch.setattr(daily, "rebuild", lambda *a, **k: built.append(a[3]))
    paths, marks = Paths("b", "c", "r"), work_path(spark, "marks")
    late = DAY - timedelta(11)
    early = sources.streams.filter((F.col("part_day") != late) | F.col("isrc").endswith("1"))
    for streams in (early, sources.streams, sources.streams):
        version = Sources(streams, sources.resources, sources.names)
        days = rebuild_changed(spark, version, SPOTIFY, DAY - timedelta(13), DAY + timedelta(3), paths, marks)
        assert built[-1] == days
    assert [len(days) for days in built] == [17, 14, 0]
    assert built[1] == days_between(late, DAY + timedelta(3))


def test_whole_builds_compared(spark):
    schema = "day int, k int, v int, s string"
    left = [(1, 1, 5, "a"), (1, 2, 5, "a"), (1, 2, 5, "a"), (1, None, 1, None), (2, 1, 1, "x")]
    right = [(1, 1, 5, "b"), (1, 2, 5, "a"), (1, None, None, "q"), (1, 9, 1, "n"), (2, 1, 1, "x")]
    one, two = (spark.createDataFrame(rows, schema) for rows in (left, right))
    diff = whole_build_diff(one, two, ["day", "k"], ["day"])
    assert collected(diff, "day", "k", "rows_left", "rows_right", "changed") == {
        (1, 1, 1, 1, "s"), (1, 2, 1, 0, None), (1, None, 1, 1, "v,s"), (1, 9, 0, 1, None),
    }
    assert whole_build_diff(one, one.repartition(3), ["day", "k"], ["day"]).isEmpty()
    assert whole_build_diff(one.limit(0), two, ["day", "k"], ["day"]).count() == 5


def test_broken_documents_are_kept_apart(spark):
    path = work_path(spark, "docs")
    lines = ['{"_id": "u1", "active": true}', '{"_id": "u2", "active": "yes"}', '{"id": "u3"}', "[]", "",
             '{"_id": "u4", "app', '[{"_id": "u5"}, {"_id": "u6"}]', '{"_id": null}']
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    assert collected(read_user_docs(spark, path), "_id", "active") == {("u1", True)}
    assert collected(broken_user_docs(spark, path), "reason", "record") == {
        ("a field has another type than declared", lines[1]), ("no _id", lines[2]),
        ("not a JSON object", lines[3]), ("not a JSON object", lines[5]),
        ("not a JSON object", lines[6]), ("no _id", lines[7]),
    }
