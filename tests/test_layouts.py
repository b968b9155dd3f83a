"""Layouts are read from footers once; any change of a file is noticed."""

from __future__ import annotations

import pyarrow as pa
import pytest

from farelake.sources import trips
from farelake.sources.layouts import logged
from farelake.sources.trips import read_union_by_name
from farelake.sources.views import register_views
from helpers import COLUMNS, trip, write_trips

NARROW = {**COLUMNS, "VendorID": pa.int32(), "passenger_count": pa.int64()}


@pytest.fixture
def reads(monkeypatch):
    """The paths whose footers are read."""
    seen = []
    plain = trips._schema
    monkeypatch.setattr(trips, "_schema", lambda spark, paths: (seen.extend(paths), plain(spark, paths))[1])
    return seen


def files(folder, count=3):
    return [
        write_trips([trip(VendorID=i)], folder / f"yellow_tripdata_2024-0{i}.parquet", NARROW if i == 2 else COLUMNS)
        for i in range(1, count + 1)
    ]


def test_second_run_reads_no_footer(spark, tmp_path, reads):
    paths, log = files(tmp_path), str(tmp_path / "log")
    first = read_union_by_name(spark, paths, log)
    assert sorted(reads) == paths
    reads.clear()
    again = read_union_by_name(spark, paths, log)
    assert reads == [] and again.schema == first.schema
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))
    assert first.schema == read_union_by_name(spark, paths).schema


def test_changed_and_new_files_are_read(spark, tmp_path, reads):
    paths, log = files(tmp_path), str(tmp_path / "log")
    read_union_by_name(spark, paths, log)
    write_trips([trip(extra_col=1)] * 9, paths[0], {**COLUMNS, "extra_col": pa.int32()})
    more = [*paths, write_trips([trip()], tmp_path / "yellow_tripdata_2024-09.parquet")]
    reads.clear()
    frame = read_union_by_name(spark, more, log)
    assert sorted(reads) == [more[0], more[3]]
    assert "extra_col" in frame.columns and frame.count() == 12
    assert len(logged(spark, log)) == 5


def test_parts_that_drift_inside_a_month(spark, tmp_path, reads):
    month, log = tmp_path / "yellow_tripdata_2024-01.parquet", str(tmp_path / "log")
    month.mkdir()
    for i in range(4):
        write_trips([trip(VendorID=i)], month / f"part-{i}.parquet", NARROW if i == 2 else COLUMNS)
    first = read_union_by_name(spark, [str(month)], log)
    reads.clear()
    again = read_union_by_name(spark, [str(month)], log)
    assert reads == [] and sorted(r.VendorID for r in again.collect()) == [0, 1, 2, 3] and again.schema == first.schema
    write_trips([trip(VendorID=9)], month / "part-4.parquet")
    assert read_union_by_name(spark, [str(month)], log).count() == 5 and reads


def test_views_use_the_log(spark, tmp_path, zones_dir, reads):
    files(tmp_path)
    for _ in range(2):
        assert register_views(spark, str(tmp_path), str(zones_dir), log_dir=str(tmp_path / "log")) == 3
        assert spark.sql("SELECT count(*) FROM trips").first()[0] == 3
    assert len(reads) == 3
