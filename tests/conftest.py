"""One session for all tests, and small archives made here."""

import io
import os
import sys
import zipfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
os.environ.setdefault("OMP_NUM_THREADS", "1")

MCDATA = (
    "7,PFC_DB:,,,41200,PUMP B PRESSURE LOW,03/09/2024 07:15:20,FUEL,NO,,,,SET,,\n"
    "2,RFC_DB:,,04/06/2024 10:20:30,HYD,51733,LATCHED,10:20:31,BIT_A,run,2,all,4,off,1,sum,3,times,7,51733,BOARD 4,,,,\n"
    "2,LCS_TEMP:,,04/06/2024 10:20:30,71.2,WARM,10:20:29,,,\n"
)
SEGMENTS = "3,1,,02/20/2024 06:00:05:125,02/20/2024 07:30:45:125,02/20/2024 06:00:05:125,02/20/2024 07:30:40:125,01:30:40,,true,false,false,PreFlight,2,false,true,y,,\n"
ENGINE = "ENG_TIME,L,04/06/2024 10:20:30:000,04/06/2024 10:41:30:000,00:21:00,own\n"
TMPTR = "BMFC,00240406,10:20:30.250,TMPTR,031C,088F\n"


def make_archive(path: Path, members: dict[str, str], nested: dict[str, str] | None = None) -> Path:
    """A transport archive; ``nested`` members lie in a raw archive within it."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
        if nested:
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w") as n:
                for name, text in nested.items():
                    n.writestr(name, text)
            z.writestr(f"{next(iter(members)).rpartition('_')[0]}_RSM_RawArchive.zip", inner.getvalue())
    return path


def whole_archive(folder: Path, prefix: str = "169871_20250113_141336_001") -> Path:
    name = f"{prefix}_TransportRSM.fpkg.e2d.zip"
    return make_archive(folder / "169871/2025/01" / name, {f"{prefix}_Segments": SEGMENTS, f"{prefix}_Engine": ENGINE, f"{prefix}_MCData": MCDATA}, {"RSM/TMPTR_LOG": TMPTR})


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
