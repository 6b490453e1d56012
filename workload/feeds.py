"""Feeds that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion import storage
from medallion.operators.cdc import ChangeSpec

USER_COLUMNS = ["user_id", "event_type", "value"]
PERIODS = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def user_changes(**more) -> ChangeSpec:
    """Events as changes of a user: an error event deletes the user."""
    settings = {
        "keys": ["user_id"],
        "sequence_by": "ts",
        "apply_as_deletes": "event_type = 'error'",
        "column_list": USER_COLUMNS,
    }
    return ChangeSpec(**{**settings, **more})


def with_nulls(events: DataFrame) -> DataFrame:
    """Views carry no value and clicks no properties."""
    return events.withColumns(
        {
            "value": F.when(F.col("event_type") != "view", F.col("value")),
            "props": F.when(F.col("event_type") != "click", F.col("props")),
        }
    )


def user_snapshots(events: DataFrame) -> DataFrame:
    """Per period the last event of each user; users that end in an error are missing."""
    days = events.agg(F.min("ts").cast("date").alias("first"), F.max("ts").cast("date").alias("last")).first()
    first = F.lit(days["first"]).cast("date")
    width = F.ceil((F.datediff(F.lit(days["last"]).cast("date"), first) + 1) / PERIODS)
    period = F.floor(F.datediff("ts", first) / width).cast("int") + 1
    last = events.groupBy(period.alias("period"), "user_id").agg(
        F.max_by(F.struct("event_type", "value"), "ts").alias("e")
    )
    return last.select("period", "user_id", "e.event_type", "e.value").where("event_type <> 'error'")


def time_cuts(events: DataFrame, shares: list[float]) -> list:
    """Points in time at shares of the span of the events."""
    span = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    if span["first"] is None:
        return [None for _ in shares]
    return [span["first"] + (span["last"] - span["first"]) * share for share in shares]


def write_user_snapshots(events: DataFrame, folder: str) -> str:
    """One parquet folder per version, named as numbered snapshot files are."""
    snapshots = user_snapshots(events).persist()
    prefix = storage.join(folder, "LOAD_")
    for version in range(1, PERIODS + 1):
        rows = snapshots.where(F.col("period") == version).drop("period")
        rows.write.parquet(f"{prefix}{version}.parquet")
    snapshots.unpersist()
    return prefix


def topic(events: DataFrame) -> DataFrame:
    """Events as rows of a topic."""
    payload = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def json_lines(events: DataFrame) -> DataFrame:
    """Event lines of which some have unknown fields, wrong types or are cut off."""
    fields = [
        F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string")),
        F.concat(F.lit('"user_id":'), F.col("user_id").cast("string")),
        F.concat(F.lit('"event_type":"'), F.col("event_type"), F.lit('"')),
        F.when(F.col("event_type") == "view", F.lit('"value":"none"')).otherwise(
            F.concat(F.lit('"value":'), F.col("value").cast("string"))
        ),
        F.when(F.col("event_type") == "click", F.lit('"extra":"x"')),
    ]
    line = F.concat(F.concat_ws(",", *fields), F.when(F.col("event_type") == "error", F.lit("")).otherwise("}"))
    return events.select(line.alias("value"))


def odd_json_lines(events: DataFrame) -> DataFrame:
    """Event lines of which some hold fractions of whole numbers, padded numbers or more than one record."""
    kind = F.col("event_type")
    user = F.when(kind == "view", F.concat(F.col("user_id"), F.lit(".5"))).otherwise(F.col("user_id").cast("string"))
    value = F.when(kind == "purchase", F.concat(F.lit('"0'), F.col("value"), F.lit('"'))).otherwise(
        F.col("value").cast("string")
    )
    tail = F.when(kind == "click", '{"c":3}').when(kind == "error", " tail").otherwise("")
    line = F.concat(
        F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":'), user, F.lit(',"event_type":"'), kind,
        F.lit('","value":'), value, F.lit("}"), tail,
    )
    return events.select(line.alias("value"))
