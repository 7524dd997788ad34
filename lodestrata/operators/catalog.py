"""The members of archives: duplicates, signatures, and freezing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata import specs
from lodestrata.operators.numbering import numbered
from lodestrata.schemas import ARCHIVE, FILE, conform

FIELDS = ["relative_path", "file_size_bytes", "compressed_size_bytes", "crc32", "zip_depth"]


def needs_catalog(archives: DataFrame, version: int = specs.CATALOG_VERSION) -> DataFrame:
    return archives.filter(F.col("is_present") & (F.col("cataloged_at").isNull() | (F.col("catalog_version") < version)))


def duplicates(members: DataFrame, by: str = "archive_id", path: str = "relative_path", examples: int = 5) -> DataFrame:
    """Archives with a path that occurs more than once: how many such paths there are, and the first of them."""
    twice = members.groupBy(by, path).agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy(by).agg(F.count("*").alias("paths"), F.array_join(F.slice(F.sort_array(F.collect_list(path)), 1, examples), ", ").alias("examples"))


def signature_of(fields: list[str]) -> Column:
    """SHA-1 over the sorted members of a group, fields parted by NUL and members by line ends."""
    one = lambda x: F.concat(*[p for f in fields for p in (x[f].cast("string"), F.char(F.lit(0)))][:-1], F.lit("\n"))
    return F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*fields))), one), "").cast("binary"))


def signatures(members: DataFrame, by: str = "archive_id", fields: list[str] | None = None) -> DataFrame:
    return members.groupBy(by).agg(signature_of(fields or FIELDS).alias("signature"))


def cataloged(archives: DataFrame, files: DataFrame, members: DataFrame, now, version: int = specs.CATALOG_VERSION) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Archives and files after cataloging ``members`` (archive_id, the member fields, error), and errors
    (archive_id, message). An archive that can't be read, holds a path twice, or isn't what its signature says,
    stays as it was."""
    unread = members.filter("error is not null").select("archive_id", F.col("error").alias("message"))
    twice = duplicates(members.filter("error is null")).select("archive_id", F.concat(F.lit("Archive contains duplicate member paths: "), "examples", F.when(F.col("paths") > 5, F.concat(F.lit(" (+"), (F.col("paths") - 5).cast("string"), F.lit(" more)"))).otherwise("")).alias("message"))
    signed = signatures(members.filter("error is null"))
    before = archives.filter("cataloged_at is not null").select(F.col("id").alias("archive_id"), F.col("catalog_signature").alias("old"))
    stored = signatures(files.join(before.filter("old is null"), "archive_id", "left_semi")).select("archive_id", F.col("signature").alias("computed"))
    frozen = before.join(stored, "archive_id", "left").select("archive_id", F.coalesce("old", "computed").alias("old"))
    changed = signed.join(frozen, "archive_id").filter("signature <> old").select("archive_id", F.lit("Archive contents changed after cataloging").alias("message"))
    errors = unread.unionByName(twice).unionByName(changed).groupBy("archive_id").agg(F.min("message").alias("message"))
    seen = members.select("archive_id").distinct().join(errors, "archive_id", "left_anti")
    good = seen.join(signed, "archive_id", "left").withColumn("signature", F.coalesce("signature", F.sha1(F.lit("").cast("binary"))))
    new = members.filter("error is null").join(good.select("archive_id"), "archive_id", "left_semi").join(files.select("archive_id").distinct(), "archive_id", "left_anti")
    most = files.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first().m
    new = numbered(new, ["archive_id", "relative_path"], "id", most)
    new = new.withColumn("file_type", specs.file_type(F.col("relative_path")))
    mark = good.select(F.col("archive_id").alias("id"), F.col("signature").alias("_sig"))
    time = F.lit(now).cast("timestamp_ntz")
    done = F.col("_sig").isNotNull()
    stamped = archives.join(mark, "id", "left").withColumns({"cataloged_at": F.when(done, F.coalesce("cataloged_at", time)).otherwise(F.col("cataloged_at")), "catalog_version": F.when(done, F.lit(version)).otherwise(F.col("catalog_version")), "catalog_signature": F.coalesce("catalog_signature", "_sig")})
    return conform(stamped, ARCHIVE), files.unionByName(conform(new, FILE)), errors


def with_hash(files: DataFrame, hashes: DataFrame) -> DataFrame:
    """``files`` with the hashes of (file_id, content_hash) where they have none yet."""
    new = hashes.select(F.col("file_id").alias("id"), F.col("content_hash").alias("_hash"))
    return conform(files.join(new, "id", "left").withColumn("content_hash", F.coalesce("content_hash", "_hash")), FILE)
