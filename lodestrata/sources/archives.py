"""ZIP archives: finding them, listing their members, reading some of them.

Archives are worked on side by side and one after the other within a task: the central directory is all that
is read of a leaf unless its content is asked for, nested archives are spooled (to disk beyond ``SPOOL`` bytes), and
members are given one at a time. What can't be read, of whatever kind of damage, is a row with an error.
"""

import os
import shutil
import tempfile
import zipfile
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import paths
from lodestrata.specs import RAW_ARCHIVE

MAX_NESTING, SPOOL, WORKERS = 3, 1 << 26, 64
FOUND = "locator_path string, locator_size_bytes bigint, locator_mtime_ns bigint"
MEMBERS = "locator_path string, relative_path string, file_size_bytes bigint, compressed_size_bytes bigint, crc32 bigint, zip_depth int"


@dataclass(frozen=True)
class Found:
    archives: list[tuple[str, int, int]]
    directories: int


def _listed(folder: str, suffix: str) -> tuple[list[str], list[tuple[str, int, int]]]:
    folders, archives = [], []
    with os.scandir(folder) as entries:
        for e in entries:
            if e.is_dir(follow_symlinks=False):
                folders.append(e.path)
            elif e.name.lower().endswith(suffix) and e.is_file(follow_symlinks=False):
                at = e.stat(follow_symlinks=False)
                archives.append((e.path, at.st_size, at.st_mtime_ns))
    return folders, archives


def discover(root: str, suffix: str = paths.ARCHIVE_SUFFIX, workers: int = WORKERS) -> Found:
    """Archives below ``root`` with size and time in nanoseconds, by path; none is opened, no link followed.

    Folders are listed by so many threads, as a share answers many at once. A missing root, or a folder that can't
    be listed, raises: half a scan would mark archives as absent.
    """
    if not os.path.isdir(root):
        raise FileNotFoundError(f"no folder {root}")
    out, seen = [], 0
    with ThreadPoolExecutor(max(1, workers)) as pool:
        open_ = {pool.submit(_listed, root, suffix)}
        try:
            while open_:
                done, open_ = wait(open_, return_when=FIRST_COMPLETED)
                for job in done:
                    folders, archives = job.result()
                    seen += 1
                    out += archives
                    open_ |= {pool.submit(_listed, f, suffix) for f in folders}
        finally:
            for job in open_:
                job.cancel()
    return Found(sorted(out), seen)


def discovered(spark: SparkSession, root: str, workers: int = WORKERS) -> DataFrame:
    """The archives below a folder, or below the URL of any of Hadoop's file systems, which Spark lists."""
    if "://" in root:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        own = files.filter(F.lower("path").endswith(paths.ARCHIVE_SUFFIX))
        return own.select(F.col("path").alias("locator_path"), F.col("length").alias("locator_size_bytes"), (F.unix_micros("modificationTime") * 1000).alias("locator_mtime_ns"))
    return spark.createDataFrame(discover(root, workers=workers).archives, FOUND)


def walk(archive: str, max_nesting: int = MAX_NESTING) -> Iterator[tuple[str, zipfile.ZipInfo, int, zipfile.ZipFile]]:
    """Path, entry, depth and open archive of every leaf; nested raw archives are opened under their stem, one at a time."""

    def inner(source: object, prefix: str, depth: int) -> Iterator[tuple[str, zipfile.ZipInfo, int, zipfile.ZipFile]]:
        if depth >= max_nesting:
            raise ValueError(f"archives are nested more than {max_nesting} deep")
        with zipfile.ZipFile(source) as z:
            for entry in z.infolist():
                if entry.is_dir():
                    continue
                if paths.matches(entry.filename, RAW_ARCHIVE):
                    stem = paths.normal(entry.filename).rpartition("/")[2].rpartition(".")[0]
                    with tempfile.SpooledTemporaryFile(SPOOL) as spool:
                        with z.open(entry) as packed:
                            shutil.copyfileobj(packed, spool)
                        spool.seek(0)
                        yield from inner(spool, stem, depth + 1)
                else:
                    yield paths.normal(f"{prefix}/{entry.filename}" if prefix else entry.filename), entry, depth, z

    yield from inner(archive.removeprefix("file://").removeprefix("file:"), "", 0)


def members(archive: str, max_nesting: int = MAX_NESTING) -> list[tuple[str, int, int, int, int]]:
    """Path, size, packed size, checksum and depth of each leaf, by path; no leaf is unpacked."""
    return sorted((p, e.file_size, e.compress_size, e.CRC, d) for p, e, d, _ in walk(archive, max_nesting))


def member_rows(archives: DataFrame) -> DataFrame:
    """The leaves of the archives in ``locator_path``, and a row with an error for one that can't be read."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                try:
                    rows, why = members(name), None
                except Exception as e:  # a damaged stream raises zlib.error, an encrypted archive RuntimeError, and others may follow
                    rows, why = [(None, None, None, None, None)], f"{type(e).__name__}: {e}"
                yield pa.record_batch([pa.array([name] * len(rows), pa.string()), *[pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()])], pa.array([why] * len(rows), pa.string())], ["locator_path", "relative_path", "file_size_bytes", "compressed_size_bytes", "crc32", "zip_depth", "error"])

    return archives.select("locator_path").mapInArrow(listed, MEMBERS + ", error string")


def contents(name: str, asked: list[tuple[int, str]]) -> Iterator[tuple[int, bytes | None, str | None]]:
    """File id, content and error of each member asked for as (file id, path), one after the other."""
    left = dict(asked)
    try:
        wanted = set(left.values())
        times = Counter(p for p, _, _, _ in walk(name) if p in wanted)
        for i, p in asked:
            if times[p] != 1:
                left.pop(i)
                yield i, None, f"Expected one archive member for {p}, found {times[p]}"
        by: dict[str, list[int]] = {}
        for i, p in left.items():
            by.setdefault(p, []).append(i)
        for path, entry, _, z in walk(name) if left else ():
            for i in by.get(path, []):
                left.pop(i)
                try:
                    row = i, z.read(entry), None
                except Exception as e:  # this member is damaged or encrypted, others may not be
                    row = i, None, f"{type(e).__name__}: {e}"
                yield row
    except Exception as e:
        for i in left:
            yield i, None, f"{type(e).__name__}: {e}"


def member_content(wanted: DataFrame) -> DataFrame:
    """``wanted`` (file_id, locator_path, relative_path) as file_id, content and error, an archive in one task.

    A wanted member that isn't there once, or can't be read, has no content and an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, asked in zip(*[batch.column(k).to_pylist() for k in (0, 1)]):
                for i, content, why in contents(name, [(a["file_id"], a["relative_path"]) for a in asked]):
                    yield pa.record_batch([pa.array([i], pa.int64()), pa.array([content], pa.binary()), pa.array([why], pa.string())], ["file_id", "content", "error"])

    by_archive = wanted.groupBy("locator_path").agg(F.array_sort(F.collect_list(F.struct("file_id", "relative_path"))).alias("asked"))
    return by_archive.mapInArrow(read, "file_id bigint, content binary, error string")
