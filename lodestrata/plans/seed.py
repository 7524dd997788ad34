"""Blue and green stores: seeding one from another, checking it, and putting it in the other's place."""

import contextlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.config import Stores
from lodestrata.functions import paths
from lodestrata.operators import catalog, runs
from lodestrata.operators.numbering import numbered
from lodestrata.operators.store import Store
from lodestrata.plans import planner
from lodestrata.schemas import CONTROL, LEAVES, missing_columns
from lodestrata.shared import scratch, written
from lodestrata.sources import archives as zips


def matches(dest: DataFrame, source: DataFrame, signed: DataFrame | None = None) -> DataFrame:
    """dest_id, source_id and match: by locator and size, else by signature; the least source id of several.

    ``signed`` has (dest_id, signature) of those that the locator doesn't tell; without it these stay unmatched.
    """
    by_key = source.groupBy(F.col("locator_key").alias("k"), F.col("size_bytes").alias("s")).agg(F.min("id").alias("by_key"))
    a = dest.join(by_key, (F.col("locator_key") == F.col("k")) & (F.col("size_bytes") == F.col("s")), "left").select(F.col("id").alias("dest_id"), "by_key")
    if signed is None:
        a = a.withColumn("by_sign", F.lit(None).cast("bigint"))
    else:
        by_sign = source.filter("signature is not null").groupBy("signature").agg(F.min("id").alias("by_sign"))
        a = a.join(signed.join(by_sign, "signature").select("dest_id", "by_sign"), "dest_id", "left")
    return a.select("dest_id", F.coalesce("by_key", "by_sign").alias("source_id"), F.when(F.col("by_key").isNotNull(), "locator").when(F.col("by_sign").isNotNull(), "signature").otherwise("none").alias("match"))


def new_members(matched: DataFrame, source: DataFrame, dest: DataFrame) -> DataFrame:
    """The source's members under the destination's archive ids, without those it has."""
    own = source.join(matched.filter("source_id is not null").select("dest_id", "source_id"), F.col("archive_id") == F.col("source_id")).drop("archive_id", "source_id").withColumnRenamed("dest_id", "archive_id")
    return own.join(dest.select("archive_id", "relative_path"), ["archive_id", "relative_path"], "left_anti")


def new_rows(rows: DataFrame, manifest: DataFrame, wanted: DataFrame, have: DataFrame, line: str) -> DataFrame:
    """Leaf rows of current artifacts for wanted hashes, without those that are there."""
    return rows.join(manifest.select("content_hash"), "content_hash", "left_semi").join(wanted.select("content_hash"), "content_hash", "left_semi").join(have.select("content_hash", line), ["content_hash", line], "left_anti")


def new_manifest(manifest: DataFrame, wanted: DataFrame, leaf: DataFrame, have: DataFrame, on: list[str]) -> DataFrame:
    """Manifest rows for wanted hashes that have a leaf row at least, without those that are there."""
    return manifest.join(wanted.select("content_hash"), "content_hash", "left_semi").join(leaf.select("content_hash"), "content_hash", "left_semi").join(have.select(*on), on, "left_anti")


def _sized(archives: DataFrame) -> DataFrame:
    return archives.select("id", "locator_key", "locator_path", F.col("locator_size_bytes").alias("size_bytes"), F.col("catalog_signature").alias("signature"))


def seed(source: Store, dest: Store, plan: bool = False) -> dict[str, int]:
    """Copies into ``dest``, whose archives are registered, what ``source`` has of them; counts only with ``plan``.

    The destination is locked from the first read to the commit; what is read of ZIP files is written once.
    """
    with contextlib.nullcontext() if plan else dest.lock(), scratch(dest.spark):
        return _seed(source, dest, plan)


def _seed(source: Store, dest: Store, plan: bool) -> dict[str, int]:
    there = source.read("metadata_archive").filter("cataloged_at is not null")
    own = dest.read("metadata_archive").filter("is_present and cataloged_at is null")
    sized = _sized(own)
    first = matches(sized, _sized(there))
    left = own.join(first.filter("match = 'none'").select(F.col("dest_id").alias("id")), "id", "left_semi")
    read = zips.member_rows(left).join(left.select(F.col("id").alias("archive_id"), "locator_path"), "locator_path").filter("error is null")
    signed = written(catalog.signatures(read).select(F.col("archive_id").alias("dest_id"), "signature"))
    matched = written(matches(sized, _sized(there), signed))
    files = written(new_members(matched, source.read("metadata_file"), dest.read("metadata_file")))
    wanted = files.select("content_hash").filter("content_hash is not null").distinct()
    counts = {r["match"]: r.n for r in matched.groupBy("match").agg(F.count("*").alias("n")).collect()} | {"files": files.count()}
    have = dest.read("metadata_artifact_manifest")
    theirs = planner.latest_manifest(source.read("metadata_artifact_manifest"), ["content_hash", "artifact_key"])
    leaves, rows = {}, None
    for key, (table, schema) in LEAVES.items():
        m = theirs.filter((F.col("artifact_key") == key) & (F.col("target_table") == table))
        leaf = new_rows(source.leaf(key), m, wanted, dest.leaf(key), f"`{schema.fields[1].name}`" if " " in schema.fields[1].name else schema.fields[1].name)
        leaves[key] = leaf
        part = new_manifest(m, wanted, leaf, have, ["content_hash", "artifact_key"])
        rows = part if rows is None else rows.unionByName(part)
    rows = written(rows)
    counts["artifacts"] = rows.count()
    if plan:
        return counts
    most = dest.read("metadata_file").agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first().m
    files = numbered(files.drop("id"), ["archive_id", "relative_path"], "id", most)
    stamp = matched.filter("source_id is not null").join(there.select(F.col("id").alias("source_id"), *[F.col(c).alias(f"_{c}") for c in ("cataloged_at", "catalog_version", "catalog_signature")]), "source_id").drop("source_id", "match")
    archives = dest.read("metadata_archive").join(stamp.withColumnRenamed("dest_id", "id"), "id", "left")
    archives = archives.withColumns({c: F.when(F.col("_cataloged_at").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) for c in ("cataloged_at", "catalog_version", "catalog_signature")})
    generation = f"seeded-{uuid.uuid4().hex}"
    dest.append_leaves(leaves, generation)
    dest.publish({"metadata_archive": archives, "metadata_file": dest.read("metadata_file").unionByName(files.select(*CONTROL["metadata_file"].names)), "metadata_artifact_manifest": have.unionByName(rows.withColumn("generation", F.lit(generation)).select(*have.columns))}, list(leaves), generation)
    return counts


def check(store: Store) -> dict:
    """Missing columns, running jobs and row counts; ``ok`` if the store may take another's place."""
    found = {t: store.spark.read.parquet(*store.folders(t)).columns for t in store.pointer()["tables"]}
    lacking = missing_columns(CONTROL, found)
    counts = {t: store.read(t).count() for t in CONTROL} if not lacking else {}
    open_ = F.col("status").isin(runs.PENDING, runs.RUNNING)
    running = store.read("processing_jobs").filter(open_).count() + store.read("processing_sessions").filter(open_).count() if not lacking else 0
    return {"ok": not lacking and not running, "missing": lacking, "running": running, "counts": counts}


def kind_of(spark, name: str, stores: Stores) -> str:
    """The class of a store's name; a name that isn't a plain identifier raises."""
    kind = spark.range(1).select(paths.schema_class(F.lit(name), tuple(stores.protected), tuple(stores.disposable)).alias("kind")).first().kind
    if kind is None:
        raise ValueError(f"unsafe name {name!r}")
    return kind


def promote(root: str, spark, candidate: str, target: str, archive: str, stores: Stores | None = None) -> None:
    """Renames folders below ``root``: target to archive, candidate to target; a failed second step undoes the first.

    A protected name may only be the target. Both stores are locked, so nobody writes to one that moves.
    """
    stores = stores or Stores()
    kinds = {n: kind_of(spark, n, stores) for n in (candidate, target, archive)}
    if len({n.lower() for n in kinds}) < 3 or "PROTECTED_SHARED" in (kinds[candidate], kinds[archive]):
        raise ValueError("the three must differ, and the candidate and archive not be protected")
    jvm = spark.sparkContext._jvm
    at = {n: jvm.org.apache.hadoop.fs.Path(f"{root}/{n}") for n in (candidate, target, archive)}
    fs = at[target].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at[archive]):
        raise ValueError(f"{archive} isn't empty")
    with Store(spark, f"{root}/{candidate}").lock(), Store(spark, f"{root}/{target}").lock() if fs.exists(at[target]) else contextlib.nullcontext():
        if not check(Store(spark, f"{root}/{candidate}"))["ok"]:
            raise ValueError(f"{candidate} doesn't pass its check")
        moved = fs.exists(at[target]) and fs.rename(at[target], at[archive])
        if not fs.rename(at[candidate], at[target]):
            if moved:
                fs.rename(at[archive], at[target])
            raise OSError(f"{candidate} can't be renamed")
    # the locks moved with their folders
    for n in (target, archive):
        Store(spark, f"{root}/{n}").unlock()


def cleanup(root: str, spark, name: str, confirm: str | None, stores: Stores | None = None, preview: bool = False) -> list[str]:
    """The tables of a store, which are dropped unless this is a preview; the name must be given twice, and not be protected."""
    kind = kind_of(spark, name, stores or Stores())
    store = Store(spark, f"{root}/{name}")
    to = store.pointer()
    tables = sorted([*to["tables"], *to["leaves"]])
    if preview:
        return tables
    if kind == "PROTECTED_SHARED" or confirm != name:
        raise ValueError(f"{name} is protected, or the confirmation differs")
    with store.lock():
        store._fs.delete(store._path(""), True)
    return tables
