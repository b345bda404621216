"""Ad click records: where the text comes from and how it is parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import dates


def kafka_lines(spark: SparkSession, brokers: str, topic: str, group: str = "group1",
                max_per_batch: int | None = None) -> DataFrame:
    """Subscribe to a topic from its newest records; offsets live in the checkpoint.

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topic)
              .option("kafka.group.id", group)
              .option("startingOffsets", "latest"))
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, max_per_batch: int | None = None) -> DataFrame:
    """Replay source: folders of text files under ``path``, picked up as they arrive."""
    reader = spark.readStream.schema("value string")
    if max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    return reader.text(path)


# Click times that are taken: 1970 up to the year 10000, in milliseconds.  Beyond, the
# conversion to a timestamp overflows or the number was not in milliseconds.
LAST_MS = 253402300799999


def parse(lines: DataFrame) -> DataFrame:
    """Fields of each record, plus ``reason`` (null for a good record).

    No line fails: what cannot be read or is out of range gets a reason.
    """
    part = lambda i: F.get(F.col("parts"), F.lit(i))
    number = lambda i: part(i).try_cast("bigint")
    # Exploding the one split keeps filters on the fields above it.  Pushed below, each
    # of them would split the text again.
    raw = lines.select("value", F.explode(F.array(F.split("value", " "))).alias("parts"))
    time = F.when(number(0).between(0, LAST_MS), number(0))
    blank = lambda i: F.coalesce(part(i), F.lit("")) == ""
    return raw.select(
        "value", time.alias("ts_ms"), F.timestamp_millis(time).alias("ts"),
        part(1).alias("province"), part(2).alias("city"),
        number(3).alias("userid"), number(4).alias("adid"),
        F.when(F.coalesce(F.size("parts"), F.lit(0)) < 5, "too few fields")
        .when(time.isNull(), "bad time")
        .when(blank(1) | blank(2), "bad place")
        .when(number(3).isNull(), "bad user")
        .when(number(4).isNull(), "bad ad").alias("reason"))


def good(parsed: DataFrame) -> DataFrame:
    """Valid clicks with their day key."""
    return (parsed.where(F.col("reason").isNull())
            .select("ts_ms", "ts", dates.date_key(F.col("ts")).alias("date"),
                    "province", "city", "userid", "adid"))


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")
