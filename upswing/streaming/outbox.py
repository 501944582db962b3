"""Messages to mail-ready rows, as a stream. Sending is left to whoever reads the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from upswing.sources.documents import subscribe

REPEAT_WINDOW = "14 days"


def _attribute(name: str) -> Column:
    return F.try_element_at("attributes", F.lit(name))


def mail_rows(messages: DataFrame) -> DataFrame:
    subject = F.concat(
        _attribute("subject"), F.lit(" for "), _attribute("firstname"), F.lit(" "),
        _attribute("lastname"),
    )
    html = F.concat(F.lit("<b>"), F.col("value"), F.lit("</b>"))
    return messages.select(
        _attribute("email").alias("to"), subject.alias("subject"), html.alias("html")
    )


def first_deliveries(messages: DataFrame, window: str = REPEAT_WINDOW) -> DataFrame:
    """Messages whose id has not come within `window` before. A message without an id is known by its
    content. The ids seen are state of the stream; those older than the window before the latest arrival
    are forgotten, so the state is bounded by what arrives in a window."""
    entries = F.array_sort(F.map_entries("attributes"))
    content = F.sha2(F.to_json(F.struct("value", entries.alias("attributes"))), 256)
    known = F.coalesce(_attribute("message_id"), content)
    return (
        messages.withColumn("id", known)
        .withWatermark("arrived", window)
        .dropDuplicatesWithinWatermark(["id"])
        .drop("id")
    )


def outbox_stream(
    spark: SparkSession,
    topic: str,
    outbox: str,
    checkpoint: str,
    deliver: bool = True,
    files_per_trigger: int | None = None,
    window: str = REPEAT_WINDOW,
) -> StreamingQuery:
    """Consume what is in the topic and stop. The checkpoint marks messages as taken, so a rerun
    writes none twice, and a message that is published again within `window` gives no second mail.
    Without `deliver` messages are taken but no rows are written; the sink stays
    the same, so delivery can be switched on again under the same checkpoint."""
    first = first_deliveries(subscribe(spark, topic, files_per_trigger), window)
    # Sound messages have attributes. A constant condition would take the ids' state out of the plan.
    delivered = first.filter(F.col("attributes").isNotNull() == F.lit(deliver))
    return (
        mail_rows(delivered)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", outbox)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def message_counter(
    spark: SparkSession, topic: str, counts: str, checkpoint: str
) -> StreamingQuery:
    """Count the messages of each batch into the table `counts`; `message_total` adds them up.

    A batch has a folder of its own. One that is repeated after a failure replaces its row, and one that
    fails leaves those of the batches before it."""

    def save(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("messages"))
        counted.write.mode("overwrite").parquet(f"{counts}/batch={batch_id}")

    return (
        subscribe(spark, topic)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def message_total(spark: SparkSession, counts: str) -> DataFrame:
    """The running number of messages, one row."""
    rows = spark.read.schema("messages long, batch long").parquet(counts)
    return rows.agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"))
