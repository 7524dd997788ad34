"""Traces of a profiler: a JSON document with an array of events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "traceEvents array<struct<name:string,cat:string,ph:string,ts:double,dur:double,pid:bigint,tid:bigint>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS).json(path, multiLine=True).select(F.explode("traceEvents").alias("e")).select("e.*")


def summary(events: DataFrame, top: int = 20) -> DataFrame:
    """Per name the count, total and mean duration in milliseconds, the ``top`` of the longest total."""
    own = events.filter("dur is not null").groupBy("name").agg(F.count("*").alias("count"), F.round(F.sum("dur") / 1000, 3).alias("total_ms"), F.round(F.avg("dur") / 1000, 3).alias("avg_ms"))
    return own.orderBy(F.desc("total_ms"), "name").limit(top)


def clip(events: DataFrame, seconds: float) -> DataFrame:
    """The events of the last ``seconds``, and those without a time."""
    last = events.agg(F.max("ts")).scalar()
    return events.filter(F.col("ts").isNull() | (F.col("ts") >= last - seconds * 1e6))
