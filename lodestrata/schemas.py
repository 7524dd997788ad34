"""Schemas of the control tables and of the typed leaf tables."""

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "l": T.LongType(), "b": T.BooleanType(), "t": T.TimestampNTZType(), "h": T.BinaryType()}


def _struct(text: str, required: tuple[str, ...] = ()) -> T.StructType:
    """``name/type`` entries, one after the other with semicolons between."""
    pairs = [x.strip().rsplit("/", 1) for x in text.split(";") if x.strip()]
    return T.StructType([T.StructField(n, _TYPES[k], n not in required) for n, k in pairs])


ARCHIVE = _struct("id/l; archive_key/s; buno/s; archive_datetime/t; locator_key/s; locator_path/s; locator_size_bytes/l; locator_mtime_ns/l; first_seen_at/t; last_seen_at/t; is_present/b; cataloged_at/t; catalog_version/i; catalog_signature/s")
FILE = _struct("id/l; archive_id/l; content_hash/h; relative_path/s; file_type/s; file_size_bytes/l; compressed_size_bytes/l; crc32/l; zip_depth/i")
MANIFEST = _struct("content_hash/h; artifact_key/s; target_table/s; parser_version/i; row_count/l; created_at/t; generation/s")
SESSION = _struct("id/s; git_hash/s; user_name/s; host_name/s; status/s; start_time/t; end_time/t")
JOB = _struct("session_id/s; id/s; archive_id/l; file_id/l; content_hash/h; file_type/s; parser_id/s; target_table/s; parser_version/i; rows_uploaded/l; status/s; message/s; start_time/t; end_time/t")
CONTROL = {"metadata_archive": ARCHIVE, "metadata_file": FILE, "metadata_artifact_manifest": MANIFEST, "processing_sessions": SESSION, "processing_jobs": JOB}


def _numbered(name: str) -> str:
    return "; ".join(f"{name} ({k})/d" for k in range(1, 11))


_VALID = "Aircraft Navigation;Relative Navigation;Position;Altitude;Horizontal Velocity;Vertical Velocity;True Heading;Calibrated Airspeed;Ground Track;Ground Speed;Aircraft Roll;Aircraft Pitch;True Airspeed".split(";")
NAV_FLAGS = [f"{x} Go" for x in ("ADC", "GPS", "INS")] + [f"{x} Valid" for x in _VALID]
_MC = {
    "Rpcs": ("rsmdata_mc_rpcs", "Humidity B/d; Secondary High Pressure/d; High Temp/d; Delta Pressure/d; Humidity A/d; Manifold Pressure/d; Primary High Pressure/d"),
    "RpcsPres": ("rsmdata_mc_rpcs_pres", "Dataset TimeStamp/t; " + "; ".join(_numbered(x) for x in ("Primary high pressure", "Secondary High Pressure", "Manifold Pressure"))),
    "NavData": ("rsmdata_mc_nav_data", "Nav Mode/s; Magnetic Variation/d; True Air Speed/d; Calibrated Airspeed/d; True Heading/d; Magnetic Heading/d; Vertical Velocity/d; Altitude/d; Altitude Source/s; ADC Altitude/d; Ground Speed/d; O/S is Airborne/b; WindSpeed/d; WindDirection/d; " + "; ".join(f"{x}/b" for x in NAV_FLAGS) + "; O/S FOM/i; GPS FOM/i"),
    "RadarState": ("rsmdata_mc_radar_state", "; ".join(f"RSCP_{x}_Switch_State/s" for x in ("OFF", "ON", "STBY", "OPER")) + "; Radar_State/s; " + "; ".join(f"Transmitter_Power_is_{x}/b" for x in ("HIGH", "MED", "LOW", "ON_DECK")) + "; EMIRS_Power_Switch_State/s; EMIRS_Power_State/s"),
    "RotoScan": ("rsmdata_mc_rotoscan", "ScanMode/s; ScanRPM/d; RPM_Command/s; ScanTime/d"),
    "PfcDb": ("rsmdata_mc_pfc_db", "Processed Fault Code/i; Fault Description/s; Subsystem/s; Mission Critical Result/s"),
    "RfcDb": ("rsmdata_mc_rfc_db", "FCI Indicator/s; Raw Fault Code/s; Fault Status/s; TimeStamp/t; Bit Type Indicator/s; Consecutive True Count/i; Total True Count/i; Consecutive False Count/i; Total False Count/i; Total Count/i; System Fault Code/i; RDR Component/s; Appended Data/s"),
    "LcsTemp": ("rsmdata_mc_lcs_temp", "LCS Temp F/s; LCS Temp Status/s; LCS Time/t"),
    "McInDiscr": (
        "rsmdata_mc_mc_in_discr",
        "Power On/b; Cooling Air/b; External Temperature Sensor/i; " + "; ".join(f"Internal Temperature {k} Sensor/i" for k in (1, 2, 3)) + "; External Relative Humidity/i; Dew Point/i; "
        + "; ".join(f"{x}/b" for x in ("Air Valve Closed", "Air Valve Open", "Air Flow Enabled", "H Bridge Fault")) + "; "
        + "; ".join(f"PBIT Byte 1 {x} Fault/b" for x in ("DPR R", "DPR W", "DPR WR", "Air Valve")) + "; "
        + "; ".join(f"PBIT Byte 2 {x} Fault/b" for x in ("EXT H", "EXT T", "Valve Pos", "OPC", "INT T1", "INT T2", "INT T3", "NVSTORE")),
    ),
}
#: By artifact key, the leaf table and its schema; the first two columns are its key.
LEAVES: dict[str, tuple[str, T.StructType]] = {f"mcdata.{k}": (table, _struct("content_hash/h; LineNumber/i; System TimeStamp/t; " + text, ("content_hash", "LineNumber"))) for k, (table, text) in _MC.items()} | {
    "segments": ("rsmdata_segments", _struct("content_hash/h; line_number/i; group/i; event_start/t; event_stop/t; flight_status/s", ("content_hash", "line_number"))),
    "tmptr_log": ("rsmdata_tmptr", _struct("content_hash/h; line_number/i; afmc/s; datetime/t; category/s; temp_f/i; temp_c/i", ("content_hash", "line_number"))),
    "engine_on_off": ("rsmdata_engine_on_off", _struct("content_hash/h; line_number/i; engine_position/s; start_time/t; stop_time/t; run_time_seconds/l; segment_number/i; ifpm_version/s", ("content_hash", "line_number"))),
}


def conform(df, schema: T.StructType):
    """``df`` with the columns of ``schema``, in its order and types; what it lacks is null, what it has besides goes.

    A missing required column is an error.
    """
    from pyspark.sql import functions as F

    lacking = [f.name for f in schema if not f.nullable and f.name not in df.columns]
    if lacking:
        raise ValueError(f"missing required columns: {', '.join(lacking)}")
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def missing_columns(expected: dict[str, T.StructType], found: dict[str, list[str]]) -> list[str]:
    """``table.column`` of what is expected and not found."""
    return [f"{t}.{f.name}" for t, s in sorted(expected.items()) for f in s if f.name not in found.get(t, [])]
