"""Tables as immutable snapshots, published together.

A table is folders of Parquet files that are never written again; ``_CURRENT`` names those of each, and
is replaced in one rename, so readers see all of a commit or nothing. Leaf rows are appended by generation; a
row counts if the manifest names its generation for its hash, so replacing a hash rewrites nothing, and the
manifest is the commit. Everything goes through Hadoop's file system, so the root may be on any of them.
"""

import json
import os
import socket
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.schemas import CONTROL, LEAVES, conform
from lodestrata.shared import compiled


#: Hours after which a lock, a session or a job that runs is taken for dead.
STALE_HOURS = 24.0
#: Parts of a table beyond which they are written as one.
PARTS = 32


class Locked(RuntimeError):
    """Another process publishes to this store."""


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = compiled(spark), root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = lambda p: self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{p}" if p else self.root)
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def pointer(self) -> dict:
        at = self._path("_CURRENT")
        if not self._fs.exists(at):
            return {"tables": {}, "leaves": {}}
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _point(self, to: dict) -> None:
        draft = self._path(f"_CURRENT.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(to, sort_keys=True).encode()))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else self._fs.getUri())
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(draft, self._path("_CURRENT"), options)

    @contextmanager
    def lock(self, stale_hours: float = STALE_HOURS) -> Iterator[None]:
        """Holds the store against other writers. A lock whose owner hasn't published for ``stale_hours`` is taken over."""
        at, mine = self._path("_LOCK"), json.dumps({"host": socket.gethostname(), "pid": os.getpid(), "id": uuid.uuid4().hex})
        try:
            out = self._fs.create(at, False)
        except Exception as e:
            age = self.lock_age()
            if age is None or age < stale_hours:
                raise Locked(f"{self.root} is locked by {self.lock_owner()}") from e
            # of several that find it stale, one can rename it
            if not self._fs.rename(at, self._path(f"_LOCK.{uuid.uuid4().hex}.stale")):
                raise Locked(f"{self.root} is being taken over") from e
            out = self._fs.create(at, False)
        try:
            out.write(bytearray(mine.encode()))
        finally:
            out.close()
        try:
            yield
        finally:
            if self.lock_owner() == mine:
                self._fs.delete(at, False)

    def lock_owner(self) -> str | None:
        at = self._path("_LOCK")
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def lock_age(self) -> float | None:
        """Hours since the lock was taken or its owner last published; None without a lock."""
        at = self._path("_LOCK")
        return (time.time() - self._fs.getFileStatus(at).getModificationTime() / 1000) / 3600 if self._fs.exists(at) else None

    def unlock(self) -> bool:
        """Removes the lock of a run that is known to be dead."""
        return bool(self._fs.delete(self._path("_LOCK"), False))

    def initialise(self) -> list[str]:
        """Makes the control tables that aren't there; the names of those made."""
        new = [t for t in CONTROL if t not in self.pointer()["tables"]]
        if new:
            self.publish({t: self.spark.createDataFrame([], CONTROL[t]) for t in new})
        return new

    def read(self, table: str) -> DataFrame:
        parts = self.folders(table)
        return self.spark.read.schema(CONTROL[table]).parquet(*parts) if parts else self.spark.createDataFrame([], CONTROL[table])

    def folders(self, table: str) -> list[str]:
        """The folders that hold a control table now."""
        return [f"{self.root}/{at}" for _, at in sorted(self.pointer()["tables"].get(table, {}).items())]

    def leaf(self, artifact: str) -> DataFrame:
        """The rows of an artifact that the manifest holds."""
        table, schema = LEAVES[artifact]
        folders = [f"{self.root}/{p}" for p in self.pointer()["leaves"].get(table, {}).values()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("generation", T.StringType())])).parquet(*folders)
        named = self.read("metadata_artifact_manifest").filter((F.col("artifact_key") == artifact) & (F.col("target_table") == table)).select("content_hash", "generation")
        return rows.join(named, ["content_hash", "generation"], "left_semi").select(*[F.col(f"`{f.name}`") for f in schema])

    def append_leaves(self, leaves: dict[str, DataFrame], generation: str) -> None:
        """Writes rows by artifact key under a generation, which nobody sees until it is published."""
        for artifact, df in leaves.items():
            table, schema = LEAVES[artifact]
            conform(df, schema).withColumn("generation", F.lit(generation)).write.parquet(f"{self.root}/{table}/g={generation}")

    def generation(self, artifact: str, generation: str) -> DataFrame:
        table, schema = LEAVES[artifact]
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/g={generation}")

    def publish(self, tables: dict[str, DataFrame], artifacts: list[str] | None = None, generation: str | None = None, parts: dict[str, dict[str, DataFrame]] | None = None) -> None:
        """Writes the tables, then names these and the appended leaves of ``artifacts`` all at once.

        ``parts`` are added to tables, or replace parts of the same name; nothing else of these tables is written
        again, until they have more than PARTS.
        """
        to = self.pointer()

        def write(name: str, df: DataFrame) -> str:
            at = f"{name}/v={uuid.uuid4().hex}"
            conform(df, CONTROL[name]).write.parquet(f"{self.root}/{at}")
            return at

        for name, df in tables.items():
            to["tables"][name] = {"base": write(name, df)}
        for name, own in (parts or {}).items():
            there = to["tables"].setdefault(name, {})
            there |= {part: write(name, df) for part, df in own.items()}
            if len(there) > PARTS:
                to["tables"][name] = {"base": write(name, self.spark.read.schema(CONTROL[name]).parquet(*[f"{self.root}/{at}" for at in there.values()]))}
        for artifact in artifacts or []:
            table = LEAVES[artifact][0]
            to["leaves"].setdefault(table, {})[generation] = f"{table}/g={generation}"
        self._point(to)
        if self._fs.exists(lock := self._path("_LOCK")):
            self._fs.setTimes(lock, int(time.time() * 1000), -1)

    def compact(self, artifact: str) -> None:
        """One folder for an artifact, of the rows that count, in generations of their own."""
        table, schema = LEAVES[artifact]
        generation = uuid.uuid4().hex
        manifest = self.read("metadata_artifact_manifest")
        own = F.col("artifact_key") == artifact
        at = f"{table}/g={generation}"
        self.leaf(artifact).withColumn("generation", F.lit(generation)).write.parquet(f"{self.root}/{at}")
        changed = manifest.withColumn("generation", F.when(own, F.lit(generation)).otherwise(F.col("generation")))
        to = self.pointer()
        snapshot = f"metadata_artifact_manifest/v={uuid.uuid4().hex}"
        changed.write.parquet(f"{self.root}/{snapshot}")
        to["tables"]["metadata_artifact_manifest"] = {"base": snapshot}
        to["leaves"][table] = {generation: at}
        self._point(to)


def replaced(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``new``, and of ``old`` what has none of its keys."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def invalidated(manifest: DataFrame, artifacts: list[str], hashes: list[bytes] | None = None) -> DataFrame:
    """The manifest without the artifacts given, of all hashes or of those given."""
    gone = F.col("artifact_key").isin(artifacts)
    return manifest.filter(~(gone & F.col("content_hash").isin(hashes)) if hashes else ~gone)
