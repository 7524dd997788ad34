"""Queries on rows that the given tables don't hold, against their SQL; what once failed or grew too fast."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalogue import DIR, TABLES, plain

from lodestrata import specs
from lodestrata.operators import parsers
from lodestrata.plans import catalogue
from lodestrata.shared import compiled, spread
from lodestrata.sources import lines as text

ITEMS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


def same(spark, folder, name, **tables):
    """Whether a query and its SQL give the same rows, of the tables given and otherwise the smallest ones."""
    con = duckdb.connect()
    for t in TABLES:
        at = f"{DIR}/{t}.parquet"
        if t in tables:
            at = f"{folder}/{t}.parquet"
            tables[t].coalesce(1).write.parquet(at)
            at += "/*.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{at}')")
    df = catalogue.QUERIES[name](spark, str(folder))
    cur = con.execute(catalogue.SQL[name])
    columns = [d[0] for d in cur.description]
    want = sorted(repr([plain(x) for x in r]) for r in cur.fetchall())
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert want and got == want


def items(spark, **changed):
    """The line items of the smallest table, with columns replaced by SQL."""
    return spark.read.parquet(f"{DIR}/lineitem.parquet").filter("l_orderkey < 200").selectExpr(*[f"{changed.get(c, c)} as {c}" for c in (x.split()[0] for x in ITEMS.split(", "))])


def test_run_times_beyond_32_bits(spark, tmp_path):
    same(spark, tmp_path, "engine_rows", lineitem=items(spark, l_partkey="l_partkey + 1000000"))


@pytest.mark.parametrize("text", ["", "a\n", "a\r\nb\rc\n\n", " \n　 \n\t\nx"])
def test_line_numbers_of_odd_texts(spark, tmp_path, text):
    same(spark, tmp_path, "line_numbers", documents=spark.createDataFrame([(1, text), (2, "plain"), (3, None)], "doc_id long, text string"))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_are_neither_sorted_nor_sent(spark):
    files = spark.createDataFrame([(b"a", b"1,LCS_TEMP:,,04/06/2024 10:20:30,1.5, W ,10:20:29,,\n1,LCS_TEMP,,\n")], "content_hash binary, content binary")
    own = parsers.parse_mcdata(files).outputs["mcdata.LcsTemp"]
    assert "Window" not in plan_of(own) and "Repartition" not in plan_of(own)
    # an output reads the files, not what was parsed of all kinds, and other kinds aren't even cut
    assert "content#" in plan_of(own)
    assert "PRI_HI" not in plan_of(own)
    assert [(r[1], r[3], r[4]) for r in own.collect()] == [(0, "1.5", "W")]


def test_broken_numbers_and_bad_files(spark):
    discrete = "1,MC_IN_DISCR:,,04/06/2024 10:20:30,a,1,F,c,{},2,3,4,5,6,s,T,F,T,F,u,T,F,T,F,v,T,F,T,F,T,F,T,t,,\n"
    files = [(b"a", discrete.format("7") + discrete.format("7.5")), (b"b", discrete.format(" 8 ") + discrete.format("+9.0")), (b"c", discrete.format("1") + "1,MC_IN_DISCR:,,x\n")]
    own = parsers.parse_mcdata(spark.createDataFrame([(k, v.encode()) for k, v in files], "content_hash binary, content binary"))
    rows = own.outputs["mcdata.McInDiscr"].orderBy("content_hash", "LineNumber").collect()
    assert [(bytes(r[0]), r["External Temperature Sensor"], r["Dew Point"]) for r in rows] == [(b"a", None, 6), (b"a", None, 6), (b"b", 8, 6), (b"b", 9, 6)]
    assert [bytes(r.content_hash) for r in own.failed.collect()] == [b"c"]


def test_paths_are_made_normal_once(spark):
    own = spark.createDataFrame([("a//1_MCData",)], "p string").select(specs.file_type(F.col("p")).alias("t"))
    assert plan_of(own).count("regexp_replace") <= 4 and own.first().t == "MCDATA"


def sent_by(df):
    """What rows are dealt out by, in the plan that is run."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x]


def test_files_are_joined_only_if_something_is_told(spark, monkeypatch):
    line = "1,LCS_TEMP:,,04/06/2024 10:20:30,1.5, W ,10:20:29,,\n"
    discrete = "1,MC_IN_DISCR:,,04/06/2024 10:20:30,a,1,F,c,7.5,2,3,4,5,6,s,T,F,T,F,u,T,F,T,F,v,T,F,T,F,T,F,T,t,,"
    files = lambda *texts: spark.createDataFrame([(b"%d" % k, x.encode()) for k, x in enumerate(texts)], "content_hash binary, content binary")
    assert "Join" not in plan_of(parsers.parse_mcdata(files(line, "", line)).outputs["mcdata.LcsTemp"])
    for few in (0, 100):
        monkeypatch.setattr(parsers, "FEW", few)
        own = parsers.parse_mcdata(files(line, line + discrete, line + "1,PFC_DB:,x\n", discrete + "\r\n" + line.strip()))
        # contents are never sorted
        assert "SortMergeJoin" not in own.outputs["mcdata.LcsTemp"]._jdf.queryExecution().executedPlan().toString()
        assert sorted((bytes(r[0]), r[1]) for r in own.outputs["mcdata.LcsTemp"].collect()) == [(b"0", 0), (b"1", 0), (b"3", 1)]
        assert sorted((bytes(r[0]), r["External Temperature Sensor"], r["Dew Point"]) for r in own.outputs["mcdata.McInDiscr"].collect()) == [(b"1", None, 6), (b"3", None, 6)]


def test_times_of_segments_are_read_once(spark):
    text = "1,2,,1/2/2024 3:4:5:7,02/29/2024 03:04:05:125,x,y,z,,a,b,c,S,1,end\n"
    own = parsers.parse_segments(spark.createDataFrame([(b"a", text.encode()), (b"b", text.replace("02/29", "02/30").encode())], "content_hash binary, content binary"))
    assert plan_of(own.outputs["segments"]).count("RLIKE") <= 2
    assert [(r.event_start.isoformat(), r.event_stop.isoformat()) for r in own.outputs["segments"].collect()] == [("2024-01-02T03:04:05.700000", "2024-02-29T03:04:05.125000")]
    assert [(bytes(r[0]), r[1]) for r in own.failed.collect()] == [(b"b", "a time is malformed")]


def test_hashes_are_dealt_out_by_the_size_of_the_table(spark):
    assert "RepartitionByExpression [content_hash" in plan_of(catalogue.QUERIES["replace_by_hash"](spark, DIR))


def test_leaf_rows_are_sent_by_hash_alone(spark):
    own = catalogue.QUERIES["seed_leaf"](spark, DIR)
    assert sent_by(own) and not [x for x in sent_by(own) if "line#" in x.split("hashpartitioning", 1)[1].split(")")[0]]


def test_a_scan_is_named_once(spark):
    own = catalogue.QUERIES["mark_absent"](spark, DIR)
    assert "regexp_extract" not in plan_of(own) and "Join" not in plan_of(own)


def rpcs_line(words):
    return "3,RPCS:,,04/06/2024 10:20:30," + ",".join(f"{k},{w}" for k, w in words) + ",,\n"


def test_words_are_cut_and_read_once(spark):
    names = ["HUM_B", "SEC_HI_PRE", "HI_TEMP", "D_PRES", "HUM_A", "MAN_PRE", "PRI_HI_PRE"]
    odd = ["w x 101", "w x \t11\t", "w x 0", "w x 1 more", " x 111", "w x " + "1" * 63, "w x 0011"]
    bad = [["w x 102"], ["w x"], ["w x "], ["w x " + "1" * 64], ["w  x 1"]]
    text = rpcs_line([(k, "w x 10") for k in names]) + rpcs_line(zip(names, odd)) + "".join(rpcs_line(zip(names, [*b, *odd[1:]])) for b in bad) + rpcs_line([("OTHER", "w x 1"), *zip(names[1:], odd[1:])]) + "3,RPCS:,,x\n"
    # the last word has its line's end beside it
    text += rpcs_line([(k, "w x 10") for k in names]).rstrip(",\n") + "\n"
    own = parsers.parse_mcdata(spark.createDataFrame([(b"a", text.encode())], "content_hash binary, content binary")).outputs["mcdata.Rpcs"]
    want = [(0, [2] * 7), (1, [5, 3, 0, 1, 7, 2**63 - 1, 3]), (9, [2] * 7)]
    values = [(pos, [round(n * a + b, 3) for n, (a, b) in zip(ns, ({"HUM": (1.26, -175), "HI_": (0.67, 38), "D_P": (0.05, -2.5)}.get(k[:3], (0.51, -12.5)) for k in names))]) for pos, ns in want]
    assert [(r[1], list(r)[3:]) for r in own.orderBy("LineNumber").collect()] == values
    # a number is made of each word once, and isn't made a text to be read again
    values_of = plan_of(own).splitlines()[0]
    assert values_of.count("conv(") == 7 and "as string" not in values_of


def test_files_are_cut_once(spark, tmp_path):
    spark.createDataFrame([(b"a", b"x\ny"), (b"b", b""), (b"c", None)], "content_hash binary, content binary").write.parquet(str(tmp_path / "f"))
    own = text.ended_lines(spark.read.parquet(str(tmp_path / "f")))
    assert plan_of(own).count("split(") == 1
    assert sorted((bytes(r[0]), r[1], r[2]) for r in own.collect()) == [(b"a", 0, "x\n"), (b"a", 1, "y"), (b"b", 0, "")]


def test_parts_hold_so_many_rows_whatever_they_take_in_files(spark, tmp_path):
    spark.range(3000).selectExpr("id % 3 as k", "id").coalesce(1).write.parquet(str(tmp_path / "t"))
    own = spark.read.parquet(str(tmp_path / "t"))
    assert spread(own, "id", rows=100).rdd.getNumPartitions() == 30
    assert spread(own, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_tasks_read_little_as_they_hold_what_they_send(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for given, want in (("128MB", str(16 << 20)), ("8m", "8m")):
            spark.conf.set(name, given)
            assert compiled(spark).conf.get(name) == want
    finally:
        spark.conf.set(name, before)


def most_held(spark, df, group):
    """Bytes that tasks held to deal out rows, in each stage that did so, while ``df`` was worked out."""
    sc = spark.sparkContext
    sc.setJobGroup(group, "")
    df.write.format("noop").mode("overwrite").save()
    sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    stages = [sc._jsc.sc().statusStore().lastStageAttempt(k) for k in {k for job in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(job).stageIds}]
    return [x.peakExecutionMemory() for x in stages if x.shuffleWriteRecords()]


def test_tasks_pass_on_what_they_read_if_parts_of_rows_are_few_enough(spark, tmp_path):
    spark.range(3000).coalesce(1).write.parquet(str(tmp_path / "t"))
    own = spark.read.parquet(str(tmp_path / "t"))
    # 300 parts of ten rows would be held; parts of up to eighty are not, and only more rows take more parts
    assert spread(own, "id", rows=10).rdd.getNumPartitions() == 200
    assert spread(own, "id", rows=1).rdd.getNumPartitions() == 375
    assert most_held(spark, spread(own, "id", rows=10), "few") == [0]
    assert most_held(spark, spread(own, "id", rows=1), "many")[0] > 0
