"""Globs, registry, cleaning, sources, commands and the stream."""

import datetime
import json

import pytest
from conftest import ENGINE, MCDATA, SEGMENTS, TMPTR, make_archive, whole_archive
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestrata import cli, specs
from lodestrata.functions import clean, paths
from lodestrata.operators import parsers, runs
from lodestrata.sources import archives, lines


@pytest.mark.parametrize("path,pattern,want", [("a/b/x_MCData", "*_MCData", True), ("_MCData", "*_MCData", True), ("x_mcdata", "*_MCData", False), ("x_MCData/y", "*_MCData", False), ("z/1_RSM_RawArchive/RSM/TMPTR_LOG", "*_RSM_RawArchive/RSM/TMPTR_LOG", True), ("RSM/TMPTR_LOG", "*_RSM_RawArchive/RSM/TMPTR_LOG", False)])
def test_globs(path, pattern, want):
    assert paths.matches(path, pattern) is want


def test_registry(spark):
    assert len(specs.SPECS) == 31 and len(specs.HANDLED) == 4
    assert sum(len(s.artifacts) for s in specs.HANDLED) == 12
    rows = spark.createDataFrame([("x\\y\\1_MCData",), ("./a//1_RSM_RawArchive/RSM/TMPTR_LOG",), ("q.bin",)], "p string")
    assert [r[0] for r in rows.select(specs.file_type(F.col("p"))).collect()] == ["MCDATA", "TMPTR_LOG", "UNKNOWN"]
    assert specs.resolve("MCD").parser_id == "mcdata" and specs.infer("/x/1_Engine").parser_id == "engine_on_off"
    with pytest.raises(LookupError):
        specs.resolve("none")
    assert specs.stage_patterns(["TMPTR_LOG"])[-1] == specs.RAW_ARCHIVE


def values(spark, f, xs):
    return [r[1] for r in spark.createDataFrame(list(enumerate(xs)), "k int, x string").coalesce(1).select("k", f(F.col("x")).alias("v")).orderBy("k").collect()]


def test_cleaning(spark):
    assert values(spark, clean.to_text, ["a ", "", "None", "nan", "  ", None]) == ["a", None, None, None, "", None]
    assert values(spark, lambda x: clean.to_text(x, True), ["", "None", None]) == ["<NA>", "<NA>", None]
    assert values(spark, lambda x: clean.to_int(x, F.max(clean.broken_int(x)).over(Window.partitionBy(F.lit(1)))), ["1", "2.0", "x", "", " 7 "]) == [1, 2, None, None, 7]
    assert values(spark, lambda x: clean.to_int(x, F.max(clean.broken_int(x)).over(Window.partitionBy(F.lit(1)))), ["1", "2.5"]) == [None, None]
    assert values(spark, clean.to_bool, ["T", "F", "TRUE", "1 ", "x", None, "0", ""]) == [True, False, True, None, None, None, False, None]
    at = datetime.datetime(2025, 1, 3, 1, 2, 3)
    assert values(spark, clean.to_time, ["1/3/2025 1:2:3", " 1/3/2025 1:2:3", "1/3/2025 24:2:3", "02/30/2025 1:2:3", "1/3/25 1:2:3", ""]) == [at, None, None, None, None, None]
    assert values(spark, clean.to_float, ["1e3", "inf", "+5", "-.5", "5.", "0x10", "1_000", "1,000", "True", "1d", "1f"]) == [1000.0, float("inf"), 5.0, -0.5, 5.0, *[None] * 6]
    assert values(spark, clean.seconds, ["100:59:59", "00:99:00", " 0:10:00 "]) == [363599, None, 600]
    assert values(spark, lambda x: clean.temperature("C", x, F.lit("")), ["029C", "085f", "bad", "C", " 30C ", "-05C", "29.5C"]) == [29, None, None, None, 30, -5, 29]


def test_lines(spark):
    files = spark.createDataFrame([(b"a", b"x\r\ny\rz"), (b"b", b"\xffq\n\n"), (b"c", b""), (b"d", None)], "content_hash binary, content binary")
    assert [(bytes(r[0]), r[1], r[2]) for r in lines.lines(files).orderBy("content_hash", "pos").collect()] == [(b"a", 0, "x"), (b"a", 1, "y"), (b"a", 2, "z"), (b"b", 0, "q"), (b"b", 1, "")]


def rows_of(spark, parse, text):
    p = parse(spark.createDataFrame([(b"a", text.encode())], "content_hash binary, content binary"))
    return {k: [tuple(r)[1:] for r in v.collect()] for k, v in p.outputs.items()}, [r.message for r in p.failed.collect()]


def test_parsers(spark):
    out, failed = rows_of(spark, parsers.parse_mcdata, MCDATA)
    assert not failed and out["mcdata.PfcDb"][0][1:] == (datetime.datetime(2024, 3, 9, 7, 15, 20), 41200, "PUMP B PRESSURE LOW", "FUEL", "NO")
    assert out["mcdata.LcsTemp"][0][1:] == (datetime.datetime(2024, 4, 6, 10, 20, 30), "71.2", "WARM", datetime.datetime(2024, 4, 6, 10, 20, 29))
    assert rows_of(spark, parsers.parse_mcdata, MCDATA + "1,PFC_DB:,few\n")[1]
    assert rows_of(spark, parsers.parse_segments, SEGMENTS)[0]["segments"][0][-1] == "PreFlight"
    assert rows_of(spark, parsers.parse_segments, "1,2\n")[1] and rows_of(spark, parsers.parse_segments, SEGMENTS.replace("02/20", "13/20", 1))[1]
    assert [r[0] for r in rows_of(spark, parsers.parse_engine, "A,L\n\n  \n" + ENGINE)[0]["engine_on_off"]] == [2]
    assert [r[0] for r in rows_of(spark, parsers.parse_tmptr, TMPTR + "too,short\n" + TMPTR.strip() + ",7,8\n")[0]["tmptr_log"]] == [1, 3]
    assert [r[0] for r in rows_of(spark, parsers.parse_tmptr, '"BMFC",00240406,10:20:30.250,"T,x",031C,088F\n')[0]["tmptr_log"]] == [1]


def test_zip_members(spark, tmp_path):
    a = whole_archive(tmp_path)
    assert len(archives.members(str(a))) == 4
    one = list(archives.contents(str(a), [(7, "169871_20250113_141336_001_Segments")]))
    assert one == [(7, SEGMENTS.encode(), None)]
    b = make_archive(tmp_path / "b.zip", {"x_a": "1"})
    import zipfile

    with zipfile.ZipFile(b, "a") as z, pytest.warns(UserWarning):
        z.writestr("x_a", "2")
    rows = archives.member_content(spark.createDataFrame([(1, str(b), "x_a"), (2, str(b), "none")], "file_id long, locator_path string, relative_path string")).orderBy("file_id").collect()
    assert all(r.content is None and r.error.startswith("Expected one archive member") for r in rows)


def test_stale_runs(spark):
    old, fresh = datetime.datetime(2025, 1, 1), datetime.datetime(2025, 1, 5)
    from lodestrata.schemas import JOB, SESSION, conform

    sessions = conform(spark.createDataFrame([("s", "RUNNING", old), ("t", "RUNNING", fresh)], "id string, status string, start_time timestamp_ntz"), SESSION)
    jobs = conform(spark.createDataFrame([("s", "a", "PENDING", None), ("t", "b", "RUNNING", old), ("t", "c", "RUNNING", fresh), ("s", "d", "COMPLETED", old)], "session_id string, id string, status string, start_time timestamp_ntz"), JOB)
    s, j = runs.culled(sessions, jobs, fresh)
    assert {r.id: r.status for r in s.collect()} == {"s": "ERROR", "t": "RUNNING"}
    assert {r.id: r.status for r in j.collect()} == {"a": "ERROR", "b": "ERROR", "c": "RUNNING", "d": "COMPLETED"}
    with pytest.raises(ValueError):
        runs.culled(sessions, jobs, fresh, 0)


def test_commands(spark, tmp_path):
    said = []
    assert cli.main(["parser", "list"], spark, said.append) == 0 and "tmptr_log" in said[-1]
    f = tmp_path / "TMPTR_LOG"
    f.write_text(TMPTR)
    assert cli.main(["parser", "preview", str(f)], spark, said.append) == 0
    assert json.loads(said[-1])["tables"]["rsmdata_tmptr"]["rows"] == 1
    assert cli.main(["--root", str(tmp_path), "parser", "backfill", "segments", "--plan"], spark, said.append) == 0
    assert cli.main(["--root", str(tmp_path), "schema", "init"], spark, said.append) == 0
    assert cli.main(["--root", str(tmp_path), "schema", "check"], spark, said.append) == 0


def test_commands_on_a_store(spark, tmp_path):
    """Refresh, what it leaves to look at, invalidation, and traces."""
    whole_archive(tmp_path / "scan")
    said = []

    def run(*args):
        said.clear()
        return cli.main(["--root", str(tmp_path / "stores"), *args], spark, said.append)

    assert run("refresh", str(tmp_path / "scan")) == 0 and json.loads(said[-1])["items"] == 12
    assert run("refresh", "--plan") == 0 and "pending" not in said[-1]
    assert run("parser", "status") == 0 and "mcdata" in said[-1]
    assert run("runs", "list") == 0 and "COMPLETED" in said[-1]
    assert run("runs", "failing") == 0 and len(said[-1].split("\n")) == 1
    assert run("parser", "invalidate", "segments", "--plan") == 0 and said[-1].startswith("1 ")
    with pytest.raises(SystemExit):
        run("parser", "invalidate", "segments")
    assert run("parser", "invalidate", "segments", "--yes") == 0
    assert run("refresh", "--plan") == 0 and "pending" in said[-1]
    assert run("parser", "backfill", "segments") == 0 and "segments" in "".join(said)
    with pytest.raises(SystemExit):
        run("schema", "unlock")
    assert run("schema", "unlock", "--yes") == 0 and said[-1] == "not locked"
    trace = tmp_path / "trace.json"
    trace.write_text(json.dumps({"traceEvents": [{"name": n, "ts": t, "dur": d} for n, t, d in (("a", 1e6, 2000.0), ("a", 5e6, 4000.0), ("b", 9e6, 1000.0))]}))
    assert run("trace", "summary", str(trace), "--top", "1") == 0 and said[-1].split("\n")[1].split() == ["a", "2", "6.0", "3.0"]
    assert run("trace", "clip", str(trace), str(tmp_path / "clipped"), "--seconds", "5") == 0
    assert sorted(r.name for r in spark.read.json(str(tmp_path / "clipped")).collect()) == ["a", "b"]


def test_stream_wakes_the_refresh(spark, tmp_path):
    from lodestrata.streaming import arrivals

    whole_archive(tmp_path / "scan")
    calls = []
    for _ in range(2):
        arrivals.watch(spark, str(tmp_path / "scan"), str(tmp_path / "state"), lambda: calls.append(1), every=None).awaitTermination(120)
    assert calls == [1]
