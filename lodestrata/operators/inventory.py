"""The inventory of archives: one row for each locator, merged with each complete scan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import paths
from lodestrata.operators.numbering import numbered
from lodestrata.schemas import ARCHIVE, conform
from lodestrata.shared import fenced, written


class InventoryError(ValueError):
    """A scan contradicts itself or the inventory; nothing is written."""


def named(found: DataFrame) -> DataFrame:
    """Found archives with the parts of their names; those without are dropped."""
    p = F.col("locator_path")
    own = found.withColumns({"archive_key": paths.archive_key(p), "buno": paths.buno(p), "archive_datetime": paths.archive_datetime(p), "locator_key": paths.locator_key(p)})
    # the fence keeps the predicate from being moved below, which would take the names apart again
    return fenced(own, "archive_key").filter("archive_key is not null and archive_datetime is not null")


def one_of_each(scan: DataFrame) -> list[Column]:
    """Of the rows of a locator, whatever the order in which they came: the least values, and the latest time."""
    least = [c for c in ("archive_key", "buno", "archive_datetime", "locator_path", "locator_size_bytes") if c in scan.columns]
    return [*[F.min(c).alias(c) for c in least], F.max("locator_mtime_ns").alias("locator_mtime_ns")]


def one_per_locator(scan: DataFrame) -> DataFrame:
    """A row for each locator."""
    return scan.groupBy("locator_key").agg(*one_of_each(scan))


def conflicts(scan: DataFrame, key: str = "locator_key", size: str = "locator_size_bytes") -> DataFrame:
    """Locators that one scan gives several sizes."""
    return scan.groupBy(key).agg(F.count_distinct(size).alias("sizes")).filter("sizes > 1")


def resized(known: DataFrame, scan: DataFrame, key: str = "locator_key", size: str = "locator_size_bytes") -> DataFrame:
    """Locators whose size isn't what the inventory has: archives never change."""
    return known.select(key, F.col(size).alias("old_size")).join(scan.select(key, F.col(size).alias("new_size")), key).filter("old_size <> new_size")


def register(known: DataFrame, found: DataFrame, now) -> DataFrame:
    """The inventory after a complete scan.

    Raises without a result if the scan is empty while archives are present, gives a locator two sizes, or
    another size than the inventory. New rows get ids after the greatest, by locator. A changed path or time is
    taken over; what isn't found becomes absent and keeps its row.
    """
    # read once, with what contradicts beside it: names, scan and join are the work
    sized = named(found)
    scan = sized.groupBy("locator_key").agg(*one_of_each(sized), (F.count_distinct("locator_size_bytes") > 1).alias("_several"))
    a, b = known.alias("a"), scan.alias("b")
    both = a.join(b, F.col("a.locator_key") == F.col("b.locator_key"), "full")
    here, old = F.col("b.locator_key").isNotNull(), F.col("a.locator_key").isNotNull()
    time = F.lit(now).cast("timestamp_ntz")
    renewed = {c: F.coalesce(f"b.{c}", f"a.{c}") for c in ("locator_path", "locator_mtime_ns")}
    kept = {c: F.coalesce(f"a.{c}", f"b.{c}") for c in ("archive_key", "buno", "archive_datetime", "locator_key", "locator_size_bytes")}
    rows = both.select(
        F.col("a.id").alias("id"),
        *[v.alias(c) for c, v in (kept | renewed).items()],
        F.coalesce("a.first_seen_at", time).alias("first_seen_at"),
        F.when(here, time).otherwise(F.col("a.last_seen_at")).alias("last_seen_at"),
        here.alias("is_present"),
        *[F.col(f"a.{c}").alias(c) for c in ("cataloged_at", "catalog_signature")],
        F.coalesce("a.catalog_version", F.lit(0)).alias("catalog_version"),
        old.alias("_old"),
        F.coalesce(F.col("a.is_present"), F.lit(False)).alias("_was"),
        F.coalesce("b._several", F.lit(False)).alias("_several"),
        F.coalesce(F.col("a.locator_size_bytes") != F.col("b.locator_size_bytes"), F.lit(False)).alias("_resized"),
    )
    rows = written(rows)
    key = lambda test: F.min(F.when(test, F.col("locator_key")))
    told = rows.agg(F.coalesce(F.max("id"), F.lit(0)).alias("most"), F.coalesce(F.bool_or("is_present"), F.lit(False)).alias("found"), F.coalesce(F.bool_or("_was"), F.lit(False)).alias("was"), key(F.col("_several")).alias("several"), key(F.col("_resized")).alias("resized")).first()
    if told.was and not told.found:
        raise InventoryError("the scan found no archive although some are present")
    for what, at in (("several sizes in one scan", told.several), ("another size than before", told.resized)):
        if at is not None:
            raise InventoryError(f"{at}: {what}")
    # new rows are numbered and put beside the others, so nothing is sent for their numbers but themselves
    fresh = numbered(rows.filter("not _old").drop("id"), ["locator_key"], "id", told.most)
    return conform(rows.filter("_old").unionByName(fresh), ARCHIVE)
