"""File types by path patterns, and the parsers that some of them have."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from lodestrata.functions import paths
from lodestrata.schemas import LEAVES

CATALOG_VERSION = 1
RAW_ARCHIVE = "*RSM_RawArchive.zip"
_RSM, _MAINT, _DIA = "*_RSM_RawArchive/RSM", "*_RSM_RawArchive/RSM/*_MAINT_*", "*_RSM_RawArchive/DIA_MAINTENANCE/*_maintenance_data"


@dataclass(frozen=True)
class FileSpec:
    """A file type; with a parser it is handled, and each of its outputs is an artifact."""

    file_type: str
    patterns: tuple[str, ...]
    parser_id: str | None = None
    version: int | None = None

    @property
    def handled(self) -> bool:
        return self.parser_id is not None

    @property
    def artifacts(self) -> list[str]:
        return sorted(k for k in LEAVES if k.partition(".")[0] == self.parser_id)


def _specs() -> tuple[FileSpec, ...]:
    parsers = {"MCDATA": ("mcdata", 1), "SEGMENTS": ("segments", 1), "ENGINE_ON_OFF": ("engine_on_off", 2), "TMPTR_LOG": ("tmptr_log", 2)}
    top = [("MCDATA", "MCData"), ("SEGMENTS", "Segments"), ("VERSIONS", "Versions.xml"), ("GS_EVENTS", "GSEvents.xml"), ("FLIGHT_SYSTEMS", "FlightSystems"), ("AR", "AR.txt"), ("STATUS", "Status.txt"), ("ENGINE_ON_OFF", "Engine"), ("AIRCRAFT_CONFIGURATION", "AircraftConfiguration.xml")]
    rows = [(t, f"*_{x}") for t, x in top]
    rows += [("ACAWS_LOG", f"{_MAINT}/*_MAINT_DAT/*_ACAWS_LOG")]
    rows += [(f"MAINT_{x.upper()}", f"{_MAINT}/*_MAINT.{x}") for x in ("xml", "evt", "prm")]
    rows += [(t, f"{_RSM}/{t}") for t in ("TMPTR_LOG", "MAINT_LOG")] + [("METADATA_CSV", "*.csv"), ("CSFIR_DAT", f"{_MAINT}/*_CSFIR/*_CSFIR_DAT")]
    rows += [(f"{s}_EFF_DAT", f"{_MAINT}/*_ENG_EFF/*_{s}_EFF_DAT") for s in ("LENG", "RENG")]
    rows += [(f"{s}_PERF", f"{_MAINT}/*_ENG_PERF/*_{s}_PERF") for s in ("LENG", "RENG")]
    rows += [("SDRS_DAT", f"{_MAINT}/*_SDRS/*_SDRS_DAT"), ("ERR_1553", f"{_MAINT}/*_MAINT_DAT/*_1553_ERR")]
    rows += [(f"{s}_BIT", f"{_MAINT}/*_MAINT_DAT/*_{s}_BIT") for s in ("COMM", "INCDS", "LENG", "RENG", "VEHCL")]
    rows += [(f"DIA_MAINT_{t}", f"{_DIA}/{x}") for t, x in (("SUMMARY", "maint_summary_data.txt"), ("DETAIL", "*_detailed_data.txt"), ("STATUS", "system_snapshot_fault_status.txt"))]
    return tuple(FileSpec(t, (p,), *parsers.get(t, (None, None))) for t, p in rows)


SPECS = _specs()
HANDLED = tuple(s for s in SPECS if s.handled)


def file_type(path: Column) -> Column:
    """The first type, in the order of SPECS, one of whose patterns matches; else UNKNOWN."""
    return paths.first_match(path, [(s.file_type, s.patterns) for s in SPECS], "UNKNOWN")


def handled_specs(spark: SparkSession) -> DataFrame:
    """parser_id, version, rx and n_artifacts of the handled types: a table of a fixed size."""
    rows = [(s.parser_id, s.version, paths.glob_regex(p), len(s.artifacts)) for s in HANDLED for p in s.patterns]
    return spark.createDataFrame(rows, "parser_id string, version int, rx string, n_artifacts int")


def artifact_table(spark: SparkSession) -> DataFrame:
    """parser_id, version, artifact_key and target_table of every artifact."""
    rows = [(s.parser_id, s.version, k, LEAVES[k][0]) for s in HANDLED for k in s.artifacts]
    return spark.createDataFrame(rows, "parser_id string, version int, artifact_key string, target_table string")


def stage_patterns(types: list[str]) -> list[str]:
    """The patterns of the given types, and that of nested archives if one of them lies inside such."""
    own = [p for s in SPECS if s.file_type in types for p in s.patterns]
    return own + [RAW_ARCHIVE] * any("RSM_RawArchive/" in p for p in own)


def specificity(pattern: str) -> tuple:
    """A key by which more specific patterns come first."""
    parts = pattern.split("/")
    wild = sum(pattern.count(c) for c in "*?[")
    return (-sum(not set("*?[") & set(p) for p in parts), -len(parts), -(len(pattern) - wild), wild, -len(pattern), pattern)


def hint(spec: FileSpec) -> list[str]:
    """Short names of a type: the last parts of its patterns without wildcards."""
    return [p.rpartition("/")[2].replace("*", "").strip("_") for p in spec.patterns]


def resolve(name: str) -> FileSpec:
    """The handled type whose parser, type or hint is ``name``, without regard to case, or begins with it alone."""
    low = name.lower()
    names = {s: {s.parser_id.lower(), s.file_type.lower(), *(h.lower() for h in hint(s))} for s in HANDLED}
    for test in (lambda n: n == low, lambda n: n.startswith(low)):
        found = [s for s, own in names.items() if any(test(n) for n in own)]
        if len(found) == 1:
            return found[0]
        if found:
            raise LookupError(f"{name!r} may mean {', '.join(s.parser_id for s in found)}")
    raise LookupError(f"no parser {name!r}; there are {', '.join(s.parser_id for s in HANDLED)}")


def infer(path: str, name: str | None = None) -> FileSpec:
    """The parser of a file: the named one, or that of its path or a hint in its name."""
    if name:
        return resolve(name)
    parts = paths.normal(path).strip("/").split("/")
    for k in range(len(parts)):
        for s in HANDLED:
            if any(paths.matches("/".join(parts[k:]), p) for p in s.patterns):
                return s
    found = [s for s in HANDLED if any(h.lower() in parts[-1].lower() for h in hint(s))]
    if len(found) == 1:
        return found[0]
    raise LookupError(f"which parser reads {path!r}? There are {', '.join(s.parser_id for s in HANDLED)}")
