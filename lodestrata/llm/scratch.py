"""The shared folder in which lineage is cut, taken from ``spark.checkpoint.dir``."""

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is named, a private one is made for a local session (tests);
    on a cluster that is an error, as no other machine would see it."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if named is None and not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="lodestrata-"))
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage replaced by files in the shared folder: a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
