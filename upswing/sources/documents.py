"""Newline-delimited JSON: subscriber documents, exports and messages.

Lines that do not fit are not lost and do not pass as rows of NULLs: reading splits them off into a
quarantine table with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from upswing.schemas import MESSAGES, USER_DOCS

NOT_JSON = "not a JSON object"
WRONG_TYPE = "a field has another type than declared"
_CORRUPT = "_corrupt_record"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _judged(lines: DataFrame, schema: StructType, needs: dict[str, str]) -> DataFrame:
    """Lines with what they say under the schema (`parsed`) and why they cannot be used, NULL if they
    can (`reason`). `needs` has a text for each condition on `parsed` that a line may not meet."""
    line = F.col("value")
    checked = StructType([*schema.fields]).add(_CORRUPT, StringType())
    parsed = lines.filter(F.trim(line) != "").withColumn("parsed", F.from_json(line, checked, _OPTIONS))
    corrupt = F.col("parsed").getField(_CORRUPT).isNotNull()
    broken = ~line.rlike(r"^\s*\{") | (corrupt & F.try_parse_json(line).isNull())
    reason = F.when(broken, NOT_JSON).when(corrupt, WRONG_TYPE)
    for text, condition in needs.items():
        reason = reason.when(F.expr(condition), text)
    return parsed.withColumns({"reason": reason, "file": F.col("_metadata.file_name")})


def _good(judged: DataFrame, schema: StructType, *more: str) -> DataFrame:
    fields = [F.col("parsed").getField(name).alias(name) for name in schema.names]
    return judged.filter("reason IS NULL").select(*fields, *more)


def _bad(judged: DataFrame) -> DataFrame:
    """`reason, record, file`: the line as it is."""
    return judged.filter("reason IS NOT NULL").select(
        "reason", F.col("value").alias("record"), "file"
    )


def _user_docs(spark: SparkSession, path: str) -> DataFrame:
    return _judged(spark.read.text(path), USER_DOCS, {"no _id": "parsed._id IS NULL"})


def read_user_docs(spark: SparkSession, path: str) -> DataFrame:
    """Subscriber documents under the declared schema; absent fields come back as NULL. Documents that
    are not JSON objects, have fields of another type, or have no `_id` are in `broken_user_docs`."""
    return _good(_user_docs(spark, path), USER_DOCS)


def broken_user_docs(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_user_docs(spark, path))


def export_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def publish(messages: DataFrame, path: str) -> None:
    """Append messages to a topic folder that a streaming consumer reads."""
    messages.select(*MESSAGES.names).write.mode("append").json(path)


_MESSAGE_NEEDS = {
    "no payload": "parsed.value IS NULL",
    "no recipient": "try_element_at(parsed.attributes, 'email') IS NULL",
}


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages with a payload and a recipient; the others are in `broken_messages`."""
    return _good(_judged(spark.read.text(path), MESSAGES, _MESSAGE_NEEDS), MESSAGES)


def broken_messages(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_judged(spark.read.text(path), MESSAGES, _MESSAGE_NEEDS))


def _stream(spark: SparkSession, path: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    judged = _judged(reader.text(path), MESSAGES, _MESSAGE_NEEDS)
    return judged.withColumn("arrived", F.col("_metadata.file_modification_time"))


def subscribe(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Sound messages of the topic folder as an unbounded stream, with the time they `arrived`."""
    return _good(_stream(spark, path, files_per_trigger), MESSAGES, "arrived")


def quarantine_stream(
    spark: SparkSession, path: str, quarantine: str, checkpoint: str
) -> StreamingQuery:
    """Append what `subscribe` leaves out to the table `quarantine`, and stop."""
    return (
        _bad(_stream(spark, path, None))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", quarantine)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
