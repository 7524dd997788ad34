"""What is still to be done: candidates, pending artifacts, work items, status. All archives in one query."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata import specs


def current(archives: DataFrame, version: int = specs.CATALOG_VERSION) -> DataFrame:
    return archives.filter(F.col("is_present") & F.col("cataloged_at").isNotNull() & (F.col("catalog_version") >= version))


def unmet(candidates: DataFrame, manifest: DataFrame, on: list[str], target: Column | None = None) -> DataFrame:
    """Candidates without a current artifact: of the candidate's version or later, and in its table. A null hash is met by none."""
    c, m = candidates.alias("c"), manifest.alias("m")
    same = F.col("m.parser_version") >= F.col("c.version")
    for k in on:
        same &= F.col(f"c.{k}") == F.col(f"m.{k}")
    table = F.col("c.target_table") if target is None else target
    return c.join(m, same & (F.col("m.target_table") == table), "left_anti")


def candidates(archives: DataFrame, files: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Every artifact that the cataloged files of present archives could give."""
    types = {s.file_type: s.parser_id for s in specs.HANDLED}
    parser = F.element_at(F.create_map(*[F.lit(x) for p in types.items() for x in p]), F.col("file_type"))
    own = files.filter(F.col("file_type").isin(list(types))).withColumn("parser_id", parser).select(F.col("id").alias("file_id"), "archive_id", "content_hash", "relative_path", "file_type", "parser_id")
    there = current(archives).select(F.col("id").alias("archive_id"), "locator_path")
    return own.join(there, "archive_id").join(F.broadcast(artifacts), "parser_id")


def pending(archives: DataFrame, files: DataFrame, manifest: DataFrame, artifacts: DataFrame, *, parser_id: str | None = None, hashes: list[bytes] | None = None, archive_ids: list[int] | None = None, limit: int | None = None, force: bool = False) -> DataFrame:
    """The artifacts to be made. ``limit`` keeps all rows of the first so many (hash, file, parser) groups."""
    own = candidates(archives, files, artifacts)
    for c, wanted in (("parser_id", [parser_id] if parser_id else None), ("content_hash", hashes), ("archive_id", archive_ids)):
        own = own.filter(F.col(c).isin(wanted)) if wanted else own
    own = own if force else unmet(own, manifest, ["content_hash", "artifact_key"])
    return own if limit is None else first_groups(own, limit, [F.coalesce("content_hash", F.lit(b"")), F.col("file_id"), F.col("parser_id")])


def first_groups(rows: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """All rows of the first ``limit`` distinct groups: these are found first, so that no task sorts all rows."""
    named = {f"_g{k}": c for k, c in enumerate(order)}
    groups = rows.select(*[c.alias(n) for n, c in named.items()]).distinct().orderBy(*named).limit(limit)
    same = None
    for n, c in named.items():
        same = c.eqNullSafe(groups[n]) if same is None else same & c.eqNullSafe(groups[n])
    return rows.join(groups, same, "left_semi")


def work_items(rows: DataFrame, by: list[str], key: str = "artifact_key") -> DataFrame:
    """One row for each group with its outputs in order."""
    return rows.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_set(key)), ",").alias("outputs"), F.count("*").alias("n_outputs"))


def requiring_work(uncataloged: DataFrame, todo: DataFrame, key: str = "archive_id") -> DataFrame:
    """Archives to be cataloged or with pending artifacts, each once; the first reason counts."""
    both = uncataloged.select(key, F.lit("catalog").alias("reason")).unionByName(todo.select(key, F.lit("pending").alias("reason")))
    return both.groupBy(key).agg(F.min("reason").alias("reason"))


def latest_manifest(manifest: DataFrame, key: list[str]) -> DataFrame:
    return manifest.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("parser_version"), F.desc("target_table")))).filter("_n = 1").drop("_n")


def status(found: DataFrame, manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Per parser: files, those hashed, distinct hashes, how many of these have all artifacts, how many files have
    not, and the rows of all current artifacts (each hash once).

    ``found`` has a row for each file and artifact (content_hash, parser_id, artifact_key, version, target_table); ``expected`` n_artifacts for each parser_id.
    """
    # files of one hash meet first, and those without a hash are one row for each artifact, so no key is hot
    each = found.groupBy("parser_id", "content_hash", "artifact_key", "version", "target_table").agg(F.count("*").alias("n"))
    c, m = each.alias("c"), manifest.alias("m")
    met = c.join(m, (F.col("c.content_hash") == F.col("m.content_hash")) & (F.col("c.artifact_key") == F.col("m.artifact_key")) & (F.col("m.parser_version") >= F.col("c.version")) & (F.col("m.target_table") == F.col("c.target_table")), "left")
    whole = met.groupBy(F.col("c.parser_id").alias("parser_id"), F.col("c.content_hash").alias("content_hash")).agg(F.max("c.n").alias("n"), F.count("m.artifact_key").alias("made"), F.sum("m.row_count").alias("row_count"))
    whole = whole.join(F.broadcast(expected.select("parser_id", "n_artifacts")), "parser_id").withColumn("whole", F.col("made") == F.col("n_artifacts"))
    there = F.col("content_hash").isNotNull()
    some = lambda x, n: F.coalesce(F.sum(F.when(x, n)), F.lit(0))
    return whole.groupBy("parser_id").agg(F.sum("n").alias("files"), some(there, F.col("n")).alias("hashed"), F.count("content_hash").alias("hashes"), F.count_if(F.col("whole") & there).alias("complete"), some(~(F.col("whole") & there), F.col("n")).alias("missing"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
