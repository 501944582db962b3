import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.helpers import collected
from upswing.operators.digests import message_id
from upswing.schemas import MESSAGES
from upswing.sources.documents import (
    broken_messages,
    publish,
    quarantine_stream,
    read_messages,
)
from upswing.sources.tables import work_path
from upswing.streaming.outbox import message_counter, message_total, outbox_stream


def message(n):
    attributes = {
        "email": f"u{n}@example.com", "firstname": "F", "lastname": f"L{n}",
        "subject": "Velocity Alerts",
    }
    return (f'{{"n":{n}}}', attributes)


def publish_some(spark, topic, *numbers):
    publish(spark.createDataFrame([message(n) for n in numbers], MESSAGES), topic)


def test_each_message_is_delivered_once(spark):
    topic, out, mark = (work_path(spark, n) for n in ("topic", "outbox", "mark"))
    publish_some(spark, topic, 1, 2)
    assert read_messages(spark, topic).count() == 2
    for _ in range(2):
        outbox_stream(spark, topic, out, mark).awaitTermination()
    publish_some(spark, topic, 3)
    outbox_stream(spark, topic, out, mark, files_per_trigger=1).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 3
    assert collected(rows.filter("to = 'u3@example.com'"), "subject", "html") == {
        ("Velocity Alerts for F L3", '<b>{"n":3}</b>')
    }


def test_switched_off_delivery_takes_messages_without_writing(spark):
    topic, out, mark = (work_path(spark, n) for n in ("topic", "outbox", "mark"))
    publish_some(spark, topic, 1)
    outbox_stream(spark, topic, out, mark, deliver=False).awaitTermination()
    publish_some(spark, topic, 2)
    outbox_stream(spark, topic, out, mark).awaitTermination()
    assert collected(spark.read.parquet(out), "to") == {("u2@example.com",)}


def test_running_count(spark):
    topic, counts, mark = (work_path(spark, n) for n in ("topic", "counts", "mark"))
    for numbers, total in (((1, 2), 2), ((3,), 3)):
        publish_some(spark, topic, *numbers)
        message_counter(spark, topic, counts, mark).awaitTermination()
        assert collected(message_total(spark, counts), "messages") == {(total,)}


def test_count_survives_failed_and_repeated_batches(spark, monkeypatch):
    topic, counts, mark = (work_path(spark, n) for n in ("topic", "counts", "mark"))
    publish_some(spark, topic, 1, 2)
    message_counter(spark, topic, counts, mark).awaitTermination()
    publish_some(spark, topic, 3, 4, 5)
    whole = DataFrameWriter.parquet

    def broken(writer, path, *rest):
        if path.startswith(counts):
            whole(writer, path, *rest)  # the row is there, the batch is not marked as done
            raise OSError("lost")
        return whole(writer, path, *rest)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(Exception, match="lost"):
        message_counter(spark, topic, counts, mark).awaitTermination()
    monkeypatch.setattr(DataFrameWriter, "parquet", whole)
    for _ in range(2):
        message_counter(spark, topic, counts, mark).awaitTermination()
        assert collected(message_total(spark, counts), "messages") == {(5,)}


def test_a_message_published_again_gives_one_mail(spark):
    topic, out, mark = (work_path(spark, n) for n in ("topic", "outbox", "mark"))
    named = [(v, {**a, "message_id": f"m{i % 2}"}) for i, (v, a) in enumerate(map(message, range(4)))]
    for rows in (named[:2], named[2:], [message(7)], [message(7), message(8)]):
        publish(spark.createDataFrame(rows, MESSAGES), topic)
        outbox_stream(spark, topic, out, mark).awaitTermination()
    mails = [r["to"] for r in spark.read.parquet(out).collect()]
    assert sorted(mails) == [f"u{n}@example.com" for n in (0, 1, 7, 8)]


def test_message_ids_tell_keys_apart(spark):
    rows = [("2024-01-28", "a", "b", None), ("2024-01-28", "a", None, "b"), ("2024-01-28", "a|1", "b", "c"),
            ("2024-01-28", "a", "1|b", "c"), ("2024-01-29", "a", "b", None), ("2024-01-28", "a", "b", "")]
    made = spark.createDataFrame(rows * 2, "d string, e string, p string, c string")
    ids = made.select(message_id(*map(F.col, "depc"))).collect()
    assert len(set(ids)) == len(rows)


def test_broken_messages_go_to_quarantine(spark):
    topic, out, bad, *marks = (work_path(spark, n) for n in ("topic", "outbox", "bad", "m1", "m2"))
    publish_some(spark, topic, 1)
    lines = ['{"value": "x"', '{"value": "x", "attributes": {"subject": "s"}}', '"text"', "  ",
             '{"value": null, "attributes": {"email": "e"}}', '{"value": "x", "attributes": 5}']
    spark.createDataFrame([(line,) for line in lines], "value string").write.mode("append").text(topic)
    outbox_stream(spark, topic, out, marks[0]).awaitTermination()
    assert collected(spark.read.parquet(out), "to") == {("u1@example.com",)}
    expected = {
        ("not a JSON object", lines[0]), ("no recipient", lines[1]), ("not a JSON object", lines[2]),
        ("no payload", lines[4]), ("a field has another type than declared", lines[5]),
    }
    for _ in range(2):
        quarantine_stream(spark, topic, bad, marks[1]).awaitTermination()
        found = [tuple(r) for r in spark.read.parquet(bad).select("reason", "record").collect()]
        assert sorted(found) == sorted(expected)
    assert collected(broken_messages(spark, topic), "reason", "record") == expected
    assert read_messages(spark, topic).count() == 1
