"""Refresh and backfill: from archives to typed leaf rows, doing only what is missing.

The plan is one DAG for all archives: register, catalog, find pending artifacts, read each wanted member
once, hash, keep one copy of each content, drop what the manifest has, parse, publish. The contents read are
written to the shared folder between, as a hash decides what must be parsed; the folder is emptied in the end. The
manifest is published with the leaves, in one step; session and jobs are published before the work as well.
"""

import getpass
import socket
import subprocess
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata import specs
from lodestrata.functions import clean
from lodestrata.operators import catalog, inventory, runs
from lodestrata.operators.parsers import PARSERS
from lodestrata.operators.store import STALE_HOURS, Store, replaced
from lodestrata.plans import planner
from lodestrata.schemas import LEAVES, MANIFEST, SESSION, conform
from lodestrata.shared import scratch, written
from lodestrata.sources import archives as zips


@dataclass
class Outcome:
    session_id: str | None = None
    items: int = 0
    failed: int = 0
    errors: list[str] = field(default_factory=list)
    row_counts: dict[str, int] = field(default_factory=dict)


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def context() -> dict[str, str]:
    """Who runs this, where, and of which commit."""
    try:
        commit = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10).stdout.strip()
    except OSError:
        commit = ""
    return {"git_hash": commit or "unknown", "user_name": getpass.getuser(), "host_name": socket.gethostname()}


Report = Callable[[str], None]


def _begin(store: Store, todo: DataFrame, session: str, at: datetime) -> None:
    """The session, which runs, and its jobs, which are pending: what a run that dies leaves behind."""
    row = store.spark.createDataFrame([(session, *context().values(), runs.RUNNING, at, None)], SESSION)
    store.publish({}, parts={"processing_sessions": {session: row}, "processing_jobs": {session: runs.jobs_of(todo, session, runs.PENDING)}})


def _hashed(store: Store, todo: DataFrame, force: bool) -> tuple[DataFrame, DataFrame]:
    """The contents of what ``todo`` wants (file_id, content, error, hash), and the items that are still to be made now
    that all hashes are known: a content that the manifest has is not parsed again."""
    contents = written(zips.member_content(todo.select("file_id", "locator_path", "relative_path").distinct()).withColumn("hash", clean.content_hash(F.col("content"))))
    items = todo.drop("content_hash").join(contents.select("file_id", F.col("hash").alias("content_hash"), F.col("error").alias("unread")), "file_id")
    return contents, written(items if force else planner.unmet(items, store.read("metadata_artifact_manifest"), ["content_hash", "artifact_key"]))


def until_failure(each: DataFrame) -> DataFrame:
    """Of each archive the items up to the first (path, parser) that failed (whose ``why`` isn't null), all of its outputs."""
    place = F.struct("relative_path", "parser_id")
    first = each.filter("why is not null").groupBy("archive_id").agg(F.min(place).alias("_first"))
    return each.join(first, "archive_id", "left").filter(F.col("_first").isNull() | (place <= F.col("_first"))).drop("_first")


def one_per_content(each: DataFrame) -> DataFrame:
    """Each artifact of a content once, at the least file that has it; what failed stays as it is."""
    own = each.filter("why is null")
    least = own.groupBy("content_hash", "artifact_key").agg(F.min("file_id").alias("file_id"))
    return own.join(least, ["content_hash", "artifact_key", "file_id"], "left_semi").unionByName(each.filter("why is not null"))


def _process(store: Store, todo: DataFrame, session: str, at: datetime, stop_at_failure: bool, force: bool, report: Report, failures_to: str | None) -> tuple[dict[str, DataFrame], dict[str, dict[str, DataFrame]], tuple[str, list[str]], DataFrame]:
    """Control tables, and parts of others, after making ``todo``, the generation and artifacts whose leaves are written, and the jobs.

    Items are in order of path and parser within an archive; with ``stop_at_failure`` those after an archive's
    first failed one are left for another run. What fails is copied to ``failures_to``, if that is given.
    """
    spark = store.spark
    files, manifest = store.read("metadata_file"), store.read("metadata_artifact_manifest")
    contents, items = _hashed(store, todo, force)
    report("read and hashed the members")
    start = F.lit(at).cast("timestamp_ntz")
    store.publish({}, parts={"processing_jobs": {session: runs.jobs_of(items, session, runs.RUNNING, start=start)}})
    one = contents.filter("content is not null").groupBy("hash").agg(F.min("file_id").alias("file_id"))
    kept = contents.join(one.select("file_id"), "file_id", "left_semi").select("file_id", F.col("hash").alias("content_hash"), "content")
    outputs: dict[str, DataFrame] = {}
    failures = spark.createDataFrame([], "content_hash binary, parser_id string, message string")
    for parser in sorted(r.parser_id for r in items.select("parser_id").distinct().collect()):
        own = kept.join(items.filter(F.col("parser_id") == parser).select("content_hash").distinct(), "content_hash", "left_semi").select("content_hash", "content")
        parsed = PARSERS[parser](own)
        outputs |= parsed.outputs
        failures = failures.unionByName(written(parsed.failed).select("content_hash", F.lit(parser).alias("parser_id"), "message"))
    each = items.join(failures, ["content_hash", "parser_id"], "left").withColumn("why", F.coalesce("unread", "message")).drop("unread", "message")
    each = written(one_per_content(until_failure(each) if stop_at_failure else each))
    bad = each.filter("why is not null")
    if failures_to and not bad.isEmpty():
        copies = bad.select("archive_id", "file_id", "relative_path", "parser_id", "why").distinct().join(contents.select("file_id", "hash", "content"), "file_id", "left")
        copies.select(runs.failure_name().alias("name"), F.col("hash").alias("content_hash"), "parser_id", "why", "content").write.parquet(f"{failures_to}/session={session}")
    good = each.filter("why is null").select("content_hash", "artifact_key", "target_table", "version").distinct()
    generation = uuid.uuid4().hex
    report("writing leaves")
    leaves = {key: rows.join(good.filter(F.col("artifact_key") == key).select("content_hash"), "content_hash", "left_semi") for key, rows in outputs.items()}
    counts = spark.createDataFrame([], "content_hash binary, row_count bigint, artifact_key string")
    if good.isEmpty():
        leaves = {}
    store.append_leaves(leaves, generation)
    for key in leaves:
        counts = counts.unionByName(store.generation(key, generation).groupBy("content_hash").agg(F.count("*").alias("row_count")).withColumn("artifact_key", F.lit(key)))
    made = good.join(counts, ["content_hash", "artifact_key"], "left")
    made = written(made.select("content_hash", "artifact_key", "target_table", F.col("version").alias("parser_version"), F.coalesce("row_count", F.lit(0)).alias("row_count"), start.alias("created_at"), F.lit(generation).alias("generation")))
    hashes = contents.select("file_id", F.col("hash").alias("content_hash")).filter("content_hash is not null")
    done = each.join(made.select("content_hash", "artifact_key", "row_count"), ["content_hash", "artifact_key"], "left")
    jobs = runs.jobs_of(done, session, F.when(F.col("why").isNull(), runs.COMPLETED).otherwise(runs.ERROR), start=start, end=F.lit(now()).cast("timestamp_ntz"), message=F.col("why"), rows=F.col("row_count"))
    tables, parts = {"metadata_file": catalog.with_hash(files, hashes)}, {}
    key = ["content_hash", "artifact_key"]
    # the manifest is only written again if something in it is replaced
    if manifest.join(made.select(*key), key, "left_semi").isEmpty():
        parts["metadata_artifact_manifest"] = {generation: conform(made, MANIFEST)}
    else:
        tables["metadata_artifact_manifest"] = replaced(conform(manifest, MANIFEST), conform(made, MANIFEST), key)
    return tables, parts, (generation, list(leaves)), written(jobs)


def _finish(store: Store, tables: dict[str, DataFrame], parts: dict[str, dict[str, DataFrame]], leaves: tuple[str, list[str]], jobs: DataFrame, session: str, at: datetime, out: Outcome) -> Outcome:
    generation, keys = leaves
    by = {r["session_id"]: r for r in runs.finished(jobs).collect()}.get(session)
    out.session_id, out.items, out.failed = session, by.jobs if by else 0, by.error if by else 0
    row = store.spark.createDataFrame([(session, *context().values(), runs.ERROR if out.failed or out.errors else runs.COMPLETED, at, now())], SESSION)
    store.publish(tables, keys, generation, parts | {"processing_sessions": {session: row}, "processing_jobs": {session: jobs}})
    out.row_counts = {r.artifact_key: r.n for r in store.read("metadata_artifact_manifest").filter(F.col("generation") == generation).groupBy("artifact_key").agg(F.sum("row_count").alias("n")).collect()}
    return out


def _run(store: Store, todo: DataFrame, at: datetime, out: Outcome, report: Report, *, stop_at_failure: bool, force: bool = False, failures_to: str | None = None) -> Outcome:
    """One session over ``todo``. An error that isn't of an archive or a file closes the session and its jobs, and is raised."""
    session = uuid.uuid4().hex
    _begin(store, todo, session, at)
    report(f"session {session} begins")
    try:
        done = _finish(store, *_process(store, todo, session, at, stop_at_failure, force, report, failures_to), session, at, out)
    except Exception as e:
        closed = runs.closed(store.read("processing_sessions"), store.read("processing_jobs"), session, now(), f"{type(e).__name__}: {e}"[:1000])
        store.publish(dict(zip(("processing_sessions", "processing_jobs"), closed)))
        raise
    report(f"session {session} ends: {done.items} items, {done.failed} failed")
    return done


def _quiet(phase: str) -> None:
    pass


def refresh(store: Store, root: str, *, workers: int = zips.WORKERS, report: Report = _quiet, failures_to: str | None = None, stale_hours: float = STALE_HOURS) -> Outcome:
    """Finds and registers archives, catalogs new ones and makes all pending artifacts. Without work no session is made.

    ``report`` is told of each phase. Sessions and jobs that have run for ``stale_hours``, and a lock so old, are dead.
    """
    spark, at = store.spark, now()
    with store.lock(stale_hours), scratch(spark):
        store.initialise()
        out = Outcome()
        sessions, jobs = store.read("processing_sessions"), store.read("processing_jobs")
        if not runs.stale_rows(sessions, jobs, at, stale_hours).isEmpty():
            store.publish(dict(zip(("processing_sessions", "processing_jobs"), runs.culled(sessions, jobs, at, stale_hours))))
            report("closed stale runs")
        found = zips.discovered(spark, root, workers)
        known = store.read("metadata_archive")
        store.publish({"metadata_archive": inventory.register(known, found, at)})
        archives, files = store.read("metadata_archive"), store.read("metadata_file")
        report(f"registered the archives; {requiring_work(store).count()} require work")
        new = catalog.needs_catalog(archives)
        if not new.isEmpty():
            listed = written(zips.member_rows(new.repartition("id")).join(new.select(F.col("id").alias("archive_id"), "locator_path"), "locator_path"))
            archives, files, errors = catalog.cataloged(archives, files, listed, at)
            out.errors = [f"{r.archive_id}: {r.message}" for r in errors.orderBy("archive_id").collect()]
            store.publish({"metadata_archive": archives, "metadata_file": files})
            archives, files = store.read("metadata_archive"), store.read("metadata_file")
            report("cataloged new archives")
        todo = written(planner.pending(archives, files, store.read("metadata_artifact_manifest"), specs.artifact_table(spark)))
        if todo.isEmpty() and not out.errors:
            return out
        return _run(store, todo, at, out, report, stop_at_failure=True, failures_to=failures_to)


def requiring_work(store: Store) -> DataFrame:
    """The archives to be cataloged or with pending artifacts, and why."""
    archives, files = store.read("metadata_archive"), store.read("metadata_file")
    todo = planner.pending(archives, files, store.read("metadata_artifact_manifest"), specs.artifact_table(store.spark))
    return planner.requiring_work(catalog.needs_catalog(archives).withColumnRenamed("id", "archive_id"), todo)


def sessions(store: Store) -> DataFrame:
    """Each session with its jobs by status and when the first of them was started."""
    jobs = store.read("processing_jobs")
    own = store.read("processing_sessions").select(F.col("id").alias("session_id"), "host_name", F.col("status").alias("session_status"), "start_time", "end_time")
    return own.join(runs.finished(jobs).drop("status"), "session_id", "left").join(runs.first_start(jobs, "session_id"), "session_id", "left")


def failing(store: Store) -> DataFrame:
    """The files whose last job (of the times at which they were tried) is an error."""
    tried = store.read("processing_jobs").withColumn("key", F.concat_ws("|", F.col("file_id").cast("string"), "target_table"))
    return runs.latest(tried.filter("start_time is not null"), "key", "start_time").filter(F.col("status") == runs.ERROR).drop("key")


def plan_backfill(store: Store, parser_id: str, limit: int | None = None, force: bool = False, hashes: list[bytes] | None = None) -> DataFrame:
    return planner.pending(store.read("metadata_archive"), store.read("metadata_file"), store.read("metadata_artifact_manifest"), specs.artifact_table(store.spark), parser_id=parser_id, hashes=hashes, limit=limit, force=force)


def backfill(store: Store, parser_id: str, limit: int | None = None, force: bool = False, hashes: list[bytes] | None = None, *, report: Report = _quiet, failures_to: str | None = None) -> Outcome:
    """Makes the pending artifacts of one parser for cataloged files; a failure doesn't stop the rest."""
    with store.lock(), scratch(store.spark):
        todo = written(plan_backfill(store, parser_id, limit, force, hashes))
        if todo.isEmpty():
            return Outcome()
        return _run(store, todo, now(), Outcome(), report, stop_at_failure=False, force=force, failures_to=failures_to)


def status(store: Store) -> DataFrame:
    artifacts = specs.artifact_table(store.spark)
    found = planner.candidates(store.read("metadata_archive"), store.read("metadata_file"), artifacts)
    return planner.status(found, store.read("metadata_artifact_manifest"), specs.handled_specs(store.spark))


def preview(spark, path: str, parser: str | None = None, head: int = 5) -> dict:
    """Rows, columns and first rows of each output of one file."""
    spec = specs.infer(path, parser)
    files = spark.read.format("binaryFile").load(path).select(clean.content_hash(F.col("content")).alias("content_hash"), "content")
    parsed = PARSERS[spec.parser_id](files)
    tables = {}
    for key, rows in parsed.outputs.items():
        line = LEAVES[key][1].fields[1].name
        first = rows.orderBy(line).limit(head).drop("content_hash")
        tables[LEAVES[key][0]] = {"rows": rows.count(), "columns": rows.columns[1:], "head": [r.asDict() for r in first.collect()]}
    return {"parser": spec.parser_id, "version": spec.version, "failed": [r.message for r in parsed.failed.collect()], "tables": tables}
