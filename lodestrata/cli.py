"""Commands: refresh, watch, runs (list, failing), parser (list, status, preview, backfill, invalidate), trace (summary, clip), schema (init, check,
seed, promote, cleanup, unlock). What isn't given comes from the settings (lodestrata.config)."""

import argparse
import contextlib
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodestrata import config, specs
from lodestrata.operators.store import Store, invalidated
from lodestrata.plans import planner
from lodestrata.plans import refresh as R
from lodestrata.plans import seed as S
from lodestrata.sources import trace
from lodestrata.streaming import arrivals


def table(rows: list[list], head: list[str]) -> str:
    """Columns as wide as their widest value."""
    cells = [head, *[["" if x is None else str(x) for x in r] for r in rows]]
    widths = [max(len(r[k]) for r in cells) for k in range(len(head))]
    return "\n".join("  ".join(x.ljust(w) for x, w in zip(r, widths)).rstrip() for r in cells)


def parse_hash(text: str) -> bytes:
    if len(text) != 32:
        raise argparse.ArgumentTypeError("a content hash has 32 hexadecimal digits")
    try:
        return bytes.fromhex(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError("a content hash has 32 hexadecimal digits") from e


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestrata", description=__doc__)
    p.add_argument("--root", help="folder of the stores")
    p.add_argument("--store", help="name of the store")
    p.add_argument("--config", help="a TOML file of settings")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("refresh", "watch"):
        one = sub.add_parser(name)
        one.add_argument("scan_root", nargs="?")
        one.add_argument("--failure-dir", help="a folder for copies of members that fail")
        if name == "refresh":
            one.add_argument("--plan", action="store_true", help="tell what archives require work, and do nothing")
        else:
            one.add_argument("--checkpoint", required=True)
            one.add_argument("--once", action="store_true")
    one = sub.add_parser("runs").add_subparsers(dest="action", required=True)
    one.add_parser("list")
    one.add_parser("failing")
    one = sub.add_parser("trace").add_subparsers(dest="action", required=True)
    for name in ("summary", "clip"):
        own = one.add_parser(name)
        own.add_argument("file")
        own.add_argument("--top" if name == "summary" else "--seconds", type=int if name == "summary" else float, default=20 if name == "summary" else 30.0)
        if name == "clip":
            own.add_argument("output")
    parser = sub.add_parser("parser").add_subparsers(dest="action", required=True)
    parser.add_parser("list")
    parser.add_parser("status")
    one = parser.add_parser("preview")
    one.add_argument("file")
    one.add_argument("--parser")
    one.add_argument("--head", type=int, default=5)
    for name in ("backfill", "invalidate"):
        one = parser.add_parser(name)
        one.add_argument("parser")
        one.add_argument("--content-hash", type=parse_hash, action="append")
        one.add_argument("--plan", action="store_true")
        if name == "backfill":
            one.add_argument("--limit", type=int)
            one.add_argument("--force", action="store_true")
            one.add_argument("--failure-dir")
        else:
            one.add_argument("--yes", action="store_true")
    schema = sub.add_parser("schema").add_subparsers(dest="action", required=True)
    schema.add_parser("init")
    schema.add_parser("check")
    one = schema.add_parser("seed")
    one.add_argument("source")
    one.add_argument("--plan", action="store_true")
    one = schema.add_parser("promote")
    one.add_argument("target")
    one.add_argument("archive")
    one = schema.add_parser("cleanup")
    one.add_argument("--preview", action="store_true")
    one.add_argument("--confirm-schema")
    schema.add_parser("unlock").add_argument("--yes", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None, out=print) -> int:
    a = arguments().parse_args(argv)
    settings = config.load(a.config, {k: v for k, v in {"paths": {"store_root": a.root} if a.root else {}, "stores": {"name": a.store} if a.store else {}}.items() if v})
    root, name = settings.paths.store_root, settings.stores.name
    if a.command == "parser" and a.action == "list":
        out(table([[s.parser_id, s.version, s.file_type, ", ".join(s.patterns), len(s.artifacts)] for s in specs.HANDLED], ["parser", "version", "type", "patterns", "outputs"]))
        return 0
    if spark is None:
        builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
        if settings.runtime.shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(settings.runtime.shuffle_partitions))
        spark = builder.getOrCreate()
    if a.command == "trace":
        events = trace.read(spark, a.file)
        if a.action == "summary":
            out(table([list(r) for r in trace.summary(events, a.top).collect()], ["name", "count", "total ms", "mean ms"]))
        else:
            trace.clip(events, a.seconds).write.json(a.output)
        return 0
    if a.command == "parser" and a.action == "preview":
        if a.head < 1:
            raise SystemExit("--head must be 1 or more")
        found = R.preview(spark, a.file, a.parser, a.head)
        out(json.dumps(found, default=str))
        return int(bool(found["failed"]))
    if not root:
        raise SystemExit("give --root, or paths.store_root in the settings")
    store = Store(spark, f"{root}/{name}")
    log = config.logger(settings)
    failures = getattr(a, "failure_dir", None) or settings.paths.failures
    if a.command == "refresh" and a.plan:
        work = R.requiring_work(store).groupBy("reason").count().orderBy("reason")
        out(table([list(r) for r in work.collect()], ["reason", "archives"]))
        return 0
    if a.command == "runs":
        if a.action == "list":
            head = ["session_id", "host_name", "session_status", "start_time", "jobs", "completed", "error", "first_start"]
            rows = R.sessions(store).orderBy(F.desc("start_time"))
        else:
            head = ["archive_id", "file_id", "parser_id", "target_table", "start_time", "message"]
            rows = R.failing(store).orderBy("archive_id", "file_id", "target_table")
        out(table([list(r) for r in rows.select(*head).limit(1000).collect()], head))
        return 0
    if a.command in ("refresh", "watch"):
        where = a.scan_root or settings.paths.scan_root
        if not where:
            raise SystemExit("give the folder to scan, or paths.scan_root in the settings")
        work = lambda: R.refresh(store, where, workers=settings.runtime.discovery_workers, report=log.info, failures_to=failures, stale_hours=settings.runtime.stale_hours)
        if a.command == "watch":
            arrivals.watch(spark, where, a.checkpoint, work, None if a.once else "1 minute").awaitTermination()
            return 0
        done = work()
        out(json.dumps(vars(done)))
        return int(bool(done.failed or done.errors))
    if a.command == "parser" and a.action == "status":
        out(table([list(r) for r in R.status(store).orderBy("parser_id").collect()], ["parser", "files", "hashed", "hashes", "complete", "missing", "rows"]))
        return 0
    if a.command == "parser":
        spec = specs.resolve(a.parser)
        if not store.pointer()["tables"]:
            out(f"{name} has no tables yet")
            return 0
        if a.action == "backfill":
            todo = R.plan_backfill(store, spec.parser_id, a.limit, a.force, a.content_hash)
            items = planner.work_items(todo, ["archive_id", "file_id", "content_hash", "relative_path"])
            n = items.count()
            shown = items.orderBy("relative_path", "file_id").limit(20).collect()
            out(table([[r.archive_id, r.file_id, "-" if r.content_hash is None else bytes(r.content_hash).hex(), r.relative_path, r.outputs] for r in shown], ["archive", "file", "content_hash", "relative_path", "missing_outputs"]))
            out(f"{n} files" + (f", {n - 20} more than shown" if n > 20 else ""))
            if a.plan:
                return 0
            done = R.backfill(store, spec.parser_id, a.limit, a.force, a.content_hash, report=log.info, failures_to=failures)
            out(json.dumps(vars(done)))
            return int(bool(done.failed))
        # the manifest is read under the lock, so nothing that is published meanwhile is lost
        with contextlib.nullcontext() if a.plan or not a.yes else store.lock():
            manifest = store.read("metadata_artifact_manifest")
            rest = invalidated(manifest, spec.artifacts, a.content_hash)
            out(f"{manifest.count() - rest.count()} artifacts to be invalidated")
            if a.plan:
                return 0
            if not a.yes:
                raise SystemExit("give --yes to invalidate")
            store.publish({"metadata_artifact_manifest": rest})
        return 0
    if a.action == "init":
        out(", ".join(store.initialise()) or "nothing to make")
    elif a.action == "check":
        found = S.check(store)
        out(json.dumps(found))
        return int(not found["ok"])
    elif a.action == "seed":
        out(json.dumps(S.seed(Store(spark, f"{root}/{a.source}"), store, a.plan)))
    elif a.action == "promote":
        S.promote(root, spark, name, a.target, a.archive, settings.stores)
    elif a.action == "unlock":
        if not a.yes:
            raise SystemExit(f"locked by {store.lock_owner()}; give --yes to unlock" if store.lock_owner() else "not locked")
        out("unlocked" if store.unlock() else "not locked")
    else:
        out(", ".join(S.cleanup(root, spark, name, a.confirm_schema, settings.stores, a.preview)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
