from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from farelake.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"

ZONES_CSV = (
    '"LocationID","Borough","Zone","service_zone"\r\n'
    '1,"EWR","Airport","EWR"\r\n'
    '2,"Queens","Bay","Boro Zone"\r\n'
    '56,"Queens","Corona","Boro Zone"\r\n'
    '57,"Queens","Corona","Boro Zone"\r\n'
    '264,"Unknown","N/A","N/A"\r\n'
    '265,"N/A","Outside","N/A"\r\n'
)


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        **{"spark.log.level": "OFF", "spark.driver.memory": "2g", "spark.sql.maxMetadataStringLength": "10000"},
    )
    yield session
    session.stop()


@pytest.fixture
def zones_dir(tmp_path):
    folder = tmp_path / "sample"
    folder.mkdir()
    (folder / "taxi_zones.csv").write_text(ZONES_CSV, newline="")
    return folder
