"""The audit of runs: sessions and jobs as an append-only log of events, of which the state is derived."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.schemas import JOB, conform

PENDING, RUNNING, COMPLETED, ERROR = "PENDING", "RUNNING", "COMPLETED", "ERROR"


def job_id(session: str) -> Column:
    """The id of a job: told by its session, file and artifact, so a task that is tried again gives the same."""
    return F.sha1(F.concat_ws("|", F.lit(session), F.col("file_id").cast("string"), F.col("artifact_key")).cast("binary"))


def jobs_of(items: DataFrame, session: str, status: Column | str, *, start: Column | None = None, end: Column | None = None, message: Column | None = None, rows: Column | None = None) -> DataFrame:
    """A job for each of ``items`` (archive_id, file_id, content_hash, file_type, parser_id, artifact_key, target_table, version)."""
    none = lambda c, kind: F.lit(None).cast(kind) if c is None else c
    own = items.select(F.lit(session).alias("session_id"), job_id(session).alias("id"), "archive_id", "file_id", "content_hash", "file_type", "parser_id", "target_table", F.col("version").alias("parser_version"), none(rows, "bigint").alias("rows_uploaded"), (F.lit(status) if isinstance(status, str) else status).alias("status"), none(message, "string").alias("message"), none(start, "timestamp_ntz").alias("start_time"), none(end, "timestamp_ntz").alias("end_time"))
    return conform(own, JOB)


def latest(events: DataFrame, key: str, at: str) -> DataFrame:
    """The last event of each key; of equal times the greater status counts."""
    own = Window.partitionBy(key).orderBy(F.desc(at), F.desc("status"))
    return events.withColumn("_n", F.row_number().over(own)).filter("_n = 1").drop("_n")


def first_start(events: DataFrame, key: str, start: str = "start_time") -> DataFrame:
    """A job keeps the first time at which it was started."""
    return events.groupBy(key).agg(F.min(start).alias("first_start"))


def finished(jobs: DataFrame, session: str = "session_id") -> DataFrame:
    """Of each session the jobs by status, and its own: an error if any job has one."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    return jobs.groupBy(session).agg(F.count("*").alias("jobs"), *[n(s) for s in (PENDING, RUNNING, COMPLETED, ERROR)], F.when(F.bool_or(F.col("status") == ERROR), ERROR).otherwise(COMPLETED).alias("status"))


def stale(jobs: DataFrame, sessions: DataFrame, cutoff: Column) -> DataFrame:
    """Ids of what is to be closed: jobs that run since before the cutoff, and open jobs of such sessions."""
    old = sessions.filter((F.col("status") == RUNNING) & (F.col("start_time") < cutoff)).select(F.col("id").alias("session_id"))
    own = jobs.filter((F.col("status") == RUNNING) & (F.col("start_time") < cutoff)).select("id")
    theirs = jobs.filter(F.col("status").isin(PENDING, RUNNING)).join(old, "session_id", "left_semi").select("id")
    return own.union(theirs).distinct()


def culled(sessions: DataFrame, jobs: DataFrame, now, hours: float = 24) -> tuple[DataFrame, DataFrame]:
    """Both tables with stale rows closed as errors; rows without a start are left."""
    if hours <= 0:
        raise ValueError("the age must be more than 0 hours")
    time = F.lit(now).cast("timestamp_ntz")
    cutoff = time - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours * 3600)))
    ids = stale(jobs, sessions, cutoff).withColumn("_stale", F.lit(True))
    close = {"status": F.when(F.col("_stale"), ERROR).otherwise(F.col("status")), "end_time": F.when(F.col("_stale"), time).otherwise(F.col("end_time"))}
    note = {"message": F.when(F.col("_stale"), "stale").otherwise(F.col("message"))}
    done = jobs.join(ids, "id", "left").withColumns(close | note).select(*jobs.columns)
    old = (F.col("status") == RUNNING) & (F.col("start_time") < cutoff)
    ended = sessions.withColumn("_stale", old).withColumns(close).select(*sessions.columns)
    return ended, done


def stale_rows(sessions: DataFrame, jobs: DataFrame, now, hours: float = 24) -> DataFrame:
    """The sessions and jobs that ``culled`` would close."""
    cutoff = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours * 3600)))
    return stale(jobs, sessions, cutoff).unionByName(sessions.filter((F.col("status") == RUNNING) & (F.col("start_time") < cutoff)).select("id"))


def closed(sessions: DataFrame, jobs: DataFrame, session: str, now, message: str) -> tuple[DataFrame, DataFrame]:
    """Both tables with a session and its open jobs ended as errors."""
    time = F.lit(now).cast("timestamp_ntz")

    def ended(rows: DataFrame, own: Column) -> DataFrame:
        return rows.withColumns({"end_time": F.when(own, time).otherwise(F.col("end_time")), "status": F.when(own, ERROR).otherwise(F.col("status"))})

    open_ = F.col("status").isin(PENDING, RUNNING)
    theirs = (F.col("session_id") == session) & open_
    noted = jobs.withColumn("message", F.when(theirs, message).otherwise(F.col("message")))
    return ended(sessions, (F.col("id") == session) & open_), ended(noted, theirs)


def failure_name() -> Column:
    """The name of a failed member's copy."""
    base = F.substring_index("relative_path", "/", -1)
    return F.concat(F.lit("archive_"), F.col("archive_id").cast("string"), F.lit("_file_"), F.col("file_id").cast("string"), F.lit("_hash_"), F.coalesce(F.lower(F.hex("hash")), F.lit("unhashed")), F.lit("_"), base)
