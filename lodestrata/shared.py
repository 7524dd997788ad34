"""The shared folder in which intermediate results are written, so that a lost executor loses nothing."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """That of ``spark.checkpoint.dir``. Where none is named, a private one is made for a local session (tests); on a
    cluster that is an error, as no other machine would see it."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lodestrata-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, deleted at the end of the innermost ``scratch`` around it."""
    at = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(at)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


#: Bytes of files that a task reads at most.
READ = 16 << 20


def _bytes(spark: SparkSession, size: str) -> int:
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def compiled(spark: SparkSession) -> SparkSession:
    """``spark``, told to cut generated code into methods of at most 8000 bytes: the JVM never compiles a longer one,
    and interprets the steps that parse whole records in it some ten times slower. Tables that are dealt out by one of
    several keys aren't sent again to be joined by all. A task reads at most 16 MB of files: to deal out rows to over 200
    parts it holds all that it has read, which is many times what they take in files."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes")) > READ:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(READ))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def fenced(df: DataFrame, column: str) -> DataFrame:
    """``df`` as it is, but no predicate above is moved below, where it would work out again what the columns are made of.

    ``column`` must be wanted above, as what isn't is dropped.
    """
    return df.withColumn(column, F.when(F.monotonically_increasing_id() >= 0, F.col(column)))


def _passed_on(spark: SparkSession) -> int:
    """Parts to which a task writes rows as it reads them; to deal out to more it holds all of them until it has read the last."""
    return int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))


def spread(df: DataFrame, *keys: str, of: DataFrame | None = None, each: int = 4 << 20, rows: int | None = None) -> DataFrame:
    """``df`` by keys in as many parts as its size (or that of the tables ``of``) asks for, so that no task grows with it.

    With ``rows`` their number counts instead, as what a table takes in its files tells little of it: a part has no more of
    these on average, or up to eight times as many where there would be more parts than rows are passed on to. For what a
    task holds otherwise is a whole group of rows of a file at least, whatever a task is told to read at most.
    """
    own, spark = df if of is None else of, df.sparkSession
    if rows:
        n = own.count()
        parts = min(max(spark.sparkContext.defaultParallelism, -(-n // rows)), max(_passed_on(spark), -(-n // (8 * rows))))
    else:
        size = int(str(own._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        parts = max(spark.sparkContext.defaultParallelism, -(-size // each))
    return df.repartition(min(parts, 1 << 15), *keys)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is ``written`` within is deleted in the end, so nothing may be read from it any more."""
    _OPEN.append([])
    try:
        yield
    finally:
        for at in _OPEN.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
