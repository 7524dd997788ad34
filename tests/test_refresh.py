"""From folders of archives to leaf tables."""

import shutil

import pytest
from conftest import ENGINE, SEGMENTS, TMPTR, make_archive, whole_archive

from lodestrata.operators.inventory import InventoryError
from lodestrata.operators.store import Locked, Store
from lodestrata.plans import refresh as R
from lodestrata.plans import seed as S
from lodestrata.schemas import LEAVES

CONTROL = ["metadata_archive", "metadata_file", "metadata_artifact_manifest", "processing_sessions", "processing_jobs"]


def sizes(store):
    return {t.rpartition("_")[2]: store.read(t).count() for t in CONTROL}


def leaf_sizes(store):
    return {k: n for k in LEAVES if (n := store.leaf(k).count())}


def test_lifecycle(spark, tmp_path):
    scan = tmp_path / "scan"
    first = whole_archive(scan)
    store = Store(spark, str(tmp_path / "store"))
    out = R.refresh(store, str(scan))
    assert (out.items, out.failed, out.errors) == (12, 0, [])
    assert sizes(store) == {"archive": 1, "file": 4, "manifest": 12, "sessions": 1, "jobs": 12}
    assert sum(out.row_counts.values()) == 6
    leaves = {"mcdata.PfcDb": 1, "mcdata.RfcDb": 1, "mcdata.LcsTemp": 1, "segments": 1, "engine_on_off": 1, "tmptr_log": 1}
    assert leaf_sizes(store) == leaves
    assert store.read("metadata_artifact_manifest").filter("row_count = 0").count() == 6
    paths = {r.relative_path for r in store.read("metadata_file").collect()}
    assert "169871_20250113_141336_001_RSM_RawArchive/RSM/TMPTR_LOG" in paths

    # nothing to do: no session
    assert R.refresh(store, str(scan)).session_id is None
    assert sizes(store)["sessions"] == 1

    # moved: another locator, the same contents
    moved = scan / "moved" / first.name
    moved.parent.mkdir()
    shutil.move(first, moved)
    out = R.refresh(store, str(scan))
    # hashed, and found to be made already
    assert (out.items, out.failed) == (0, 0)
    assert sizes(store) == {"archive": 2, "file": 8, "manifest": 12, "sessions": 2, "jobs": 12}
    assert leaf_sizes(store) == leaves
    assert [r.is_present for r in store.read("metadata_archive").orderBy("id").collect()] == [False, True]
    rows = {r.parser_id: r for r in R.status(store).collect()}
    assert (rows["mcdata"].files, rows["mcdata"].hashes, rows["mcdata"].complete, rows["mcdata"].missing, rows["mcdata"].row_count) == (1, 1, 1, 0, 3)

    # another store takes over what this one has
    other = Store(spark, str(tmp_path / "other"))
    other.initialise()
    from lodestrata.operators import inventory
    from lodestrata.sources import archives

    other.publish({"metadata_archive": inventory.register(other.read("metadata_archive"), archives.discovered(spark, str(scan)), R.now())})
    assert S.seed(store, other, plan=True) == {"locator": 1, "files": 4, "artifacts": 6}
    S.seed(store, other)
    assert leaf_sizes(other) == leaves and S.check(other)["ok"]
    S.promote(str(tmp_path), spark, "other", "store", "old")
    assert leaf_sizes(Store(spark, str(tmp_path / "store"))) == leaves
    assert "metadata_archive" in S.cleanup(str(tmp_path), spark, "old", None, preview=True)
    with pytest.raises(ValueError):
        S.cleanup(str(tmp_path), spark, "old", "store")
    S.cleanup(str(tmp_path), spark, "old", "old")
    assert not (tmp_path / "old").exists()


def test_copies_are_parsed_once(spark, tmp_path):
    for n in (1, 2):
        p = f"169871_20250113_141336_00{n}"
        make_archive(tmp_path / "scan" / f"{p}_TransportRSM.fpkg.e2d.zip", {f"{p}_Segments": SEGMENTS, f"{p}_note.bin": str(n)})
    store = Store(spark, str(tmp_path / "store"))
    R.refresh(store, str(tmp_path / "scan"))
    assert sizes(store)["file"] == 4 and sizes(store)["manifest"] == 1
    assert leaf_sizes(store) == {"segments": 1}
    # of two equal members in one run one is parsed
    assert store.read("processing_jobs").filter("parser_id = 'segments'").count() == 1
    assert store.read("metadata_file").filter("content_hash is not null").select("content_hash").distinct().count() == 1


def test_failures(spark, tmp_path):
    scan = tmp_path / "scan"
    p = "169871_20250113_141336_001"
    # two members fail; what comes after the first waits
    make_archive(scan / f"{p}_TransportRSM.fpkg.e2d.zip", {f"{p}_Engine": ENGINE, f"{p}_MCData": "1,PFC_DB:,short\n", f"{p}_Segments": "1,2\n"})
    q = "169871_20250113_141336_002"
    make_archive(scan / f"{q}_TransportRSM.fpkg.e2d.zip", {f"{q}_Engine": ENGINE})
    (scan / "169871_20250113_141336_003_TransportRSM.fpkg.e2d.zip").write_bytes(b"no archive")
    store, told = Store(spark, str(tmp_path / "store")), []
    out = R.refresh(store, str(scan), report=told.append, failures_to=str(tmp_path / "dead"))
    assert leaf_sizes(store) == {"engine_on_off": 1}
    assert out.failed == 9 and len(out.errors) == 1
    jobs = store.read("processing_jobs")
    assert {(r.parser_id, r.status): r["count"] for r in jobs.groupBy("parser_id", "status").count().collect()} == {("engine_on_off", "COMPLETED"): 1, ("mcdata", "ERROR"): 9}
    assert store.read("processing_sessions").first().status == "ERROR"
    dead = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert len(dead) == 1 and bytes(dead[0].content) == b"1,PFC_DB:,short\n" and dead[0]["name"].endswith(f"{p}_MCData")
    assert any("registered" in t for t in told) and any("ends" in t for t in told)
    # nothing of the run is left in the shared folder
    assert not list((tmp_path / "store").glob("_LOCK*"))
    # a backfill goes on after a failure
    assert R.backfill(store, "segments").failed == 1
    assert R.backfill(store, "engine_on_off").session_id is None
    assert R.backfill(store, "engine_on_off", force=True).items == 1
    assert leaf_sizes(store) == {"engine_on_off": 1}
    store.compact("engine_on_off")
    assert leaf_sizes(store) == {"engine_on_off": 1}


def test_damaged_and_encrypted_archives_are_told(spark, tmp_path):
    scan = tmp_path / "scan"
    names = [f"169871_20250113_141336_00{k}" for k in range(1, 5)]
    good, broken, locked, nested = (make_archive(scan / f"{p}_TransportRSM.fpkg.e2d.zip", {f"{p}_Segments": SEGMENTS.replace("PreFlight", p[-3:]) * 50}, {"RSM/TMPTR_LOG": TMPTR * 50} if p == names[3] else None) for p in names)
    for path, member in ((broken, f"{names[1]}_Segments"), (nested, f"{names[3]}_RSM_RawArchive.zip")):
        # the deflate stream is overwritten behind its header
        data = bytearray(path.read_bytes())
        at = data.index(member.encode()) + len(member) + 4
        data[at : at + 60] = b"\xff" * 60
        path.write_bytes(bytes(data))
    data = bytearray(locked.read_bytes())
    data[data.index(b"PK\x03\x04") + 6] |= 1
    data[data.index(b"PK\x01\x02") + 8] |= 1
    locked.write_bytes(bytes(data))
    store = Store(spark, str(tmp_path / "store"))
    out = R.refresh(store, str(scan))
    # the nested one can't even be listed; members of the others can't be read
    assert len(out.errors) <= 1 and out.failed >= 2
    assert leaf_sizes(store) == {"segments": 50}
    assert {r.status for r in store.read("processing_jobs").collect()} == {"COMPLETED", "ERROR"}


def test_a_run_that_dies_is_closed_by_a_later_one(spark, tmp_path, monkeypatch):
    import datetime

    scan = tmp_path / "scan"
    whole_archive(scan)
    store = Store(spark, str(tmp_path / "store"))

    class Killed(BaseException):
        """As if the process had gone: nobody closes anything."""

    def dies(*args, **kwargs):
        raise Killed

    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(R, "until_failure", dies)
        R.refresh(store, str(scan))
    status = lambda t: {r.status for r in store.read(t).collect()}
    assert status("processing_sessions") == {"RUNNING"} and status("processing_jobs") == {"RUNNING"}
    assert not S.check(store)["ok"]
    # the lock that a dead run would leave holds for a while, then it is taken over
    store._fs.create(store._path("_LOCK"), False).close()
    with pytest.raises(Locked):
        R.refresh(store, str(scan))
    day = int((datetime.datetime.now().timestamp() - 25 * 3600) * 1000)
    store._fs.setTimes(store._path("_LOCK"), day, -1)
    old = R.now() - datetime.timedelta(hours=25)
    from pyspark.sql import functions as F

    early = lambda t: store.read(t).withColumn("start_time", F.lit(old).cast("timestamp_ntz"))
    store.publish({t: early(t) for t in ("processing_sessions", "processing_jobs")})
    store._fs.setTimes(store._path("_LOCK"), day, -1)
    out = R.refresh(store, str(scan))
    assert out.failed == 0 and out.items == 12
    assert {(r.status, r.n) for r in store.read("processing_jobs").groupBy("status").agg(F.count("*").alias("n")).collect()} == {("ERROR", 12), ("COMPLETED", 12)}
    assert store.lock_owner() is None and not store.unlock()
    # an error within a run closes its session at once
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(R, "one_per_content", lambda each: (_ for _ in ()).throw(RuntimeError("broken")))
        R.backfill(store, "segments", force=True)
    assert status("processing_sessions") == {"ERROR", "COMPLETED"} and store.lock_owner() is None


def test_first_failure_of_each_archive(spark):
    rows = [(1, "a", "p", "x", None), (1, "b", "p", "x", "bad"), (1, "b", "p", "y", None), (1, "b", "q", "x", None), (1, "c", "p", "x", "bad"), (2, "z", "p", "x", None)]
    each = spark.createDataFrame(rows, "archive_id long, relative_path string, parser_id string, artifact_key string, why string")
    assert sorted(tuple(r) for r in R.until_failure(each).select("archive_id", "relative_path", "parser_id", "artifact_key").collect()) == [(1, "a", "p", "x"), (1, "b", "p", "x"), (1, "b", "p", "y"), (2, "z", "p", "x")]


def test_protected_names(spark, tmp_path):
    from lodestrata import cli

    for name in ("core", "candidate_1"):
        Store(spark, str(tmp_path / name)).initialise()
    run = lambda *a: cli.main(["--root", str(tmp_path), *a], spark, lambda x: None)
    with pytest.raises(ValueError, match="protected"):
        run("--store", "core", "schema", "cleanup", "--confirm-schema", "core")
    with pytest.raises(ValueError, match="protected"):
        run("--store", "core", "schema", "promote", "other", "archive_1")
    with pytest.raises(ValueError, match="unsafe"):
        run("--store", "a-b", "schema", "cleanup", "--confirm-schema", "a-b")
    assert (tmp_path / "core").exists()
    run("--store", "candidate_1", "schema", "promote", "core", "archive_1")
    assert not (tmp_path / "candidate_1").exists() and not list(tmp_path.glob("*/_LOCK"))
    run("--store", "archive_1", "schema", "cleanup", "--confirm-schema", "archive_1")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["core"]


def test_numbering(spark):
    from lodestrata.operators.numbering import numbered

    rows = spark.createDataFrame([(k * 7919 % 1000, "x") for k in range(1000)], "k long, v string").repartition(5)
    got = numbered(rows, ["k"], "n", 10).collect()
    assert all(r.n == r.k + 11 for r in got) and len(got) == 1000
    assert numbered(rows.limit(0), ["k"], "n").count() == 0


def test_settings(tmp_path, capsys):
    from lodestrata import config

    own = tmp_path / "own.toml"
    own.write_text('[paths]\nscan_root = "/a"\nstore_root = "/b"\n[runtime]\ndiscovery_workers = 3\nunknown = 1\n')
    assert config.load(environment={}).stores.protected == ["core", "core_dev"]
    got = config.load(str(own), {"paths": {"store_root": "/d"}}, {"LODESTRATA_PATHS__SCAN_ROOT": "/c", "LODESTRATA_RUNTIME__STALE_HOURS": "2.5", "LODESTRATA_STORES__PROTECTED": "x, y"})
    assert (got.paths.scan_root, got.paths.store_root, got.runtime.discovery_workers, got.runtime.stale_hours, got.stores.protected) == ("/c", "/d", 3, 2.5, ["x", "y"])
    assert config.load(environment={"LODESTRATA_CONFIG": str(own)}).paths.scan_root == "/a"
    config.load(str(tmp_path / "none.toml"), environment={})
    assert "no configuration file" in capsys.readouterr().err
    with pytest.raises(ValueError):
        config.load(environment={"LODESTRATA_RUNTIME__DISCOVERY_WORKERS": "0"})
    log = config.logger(config.load(given={"logging": {"log_file": str(tmp_path / "log")}}, environment={}))
    log.info("something")
    assert "something" in (tmp_path / "log").read_text()


def test_guards(spark, tmp_path):
    scan = tmp_path / "scan"
    a = whole_archive(scan)
    store = Store(spark, str(tmp_path / "store"))
    R.refresh(store, str(scan))
    before = sizes(store)
    make_archive(a, {"x_Segments": SEGMENTS * 2})
    with pytest.raises(InventoryError, match="another size"):
        R.refresh(store, str(scan))
    a.unlink()
    with pytest.raises(InventoryError, match="no archive"):
        R.refresh(store, str(scan))
    with pytest.raises(FileNotFoundError):
        R.refresh(store, str(tmp_path / "nowhere"))
    assert sizes(store) == before
    with store.lock(), pytest.raises(Locked):
        R.refresh(store, str(scan))


def test_preview(spark, tmp_path):
    f = tmp_path / "TMPTR_LOG"
    f.write_text(TMPTR)
    out = R.preview(spark, str(f))
    assert out["tables"]["rsmdata_tmptr"]["rows"] == 1 and out["tables"]["rsmdata_tmptr"]["head"][0]["temp_f"] == 88
