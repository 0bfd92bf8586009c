"""Incremental landing."""

import pytest
from conftest import rows

from ledgerlake.sources.layers import LakePaths
from ledgerlake.sources.subjects import SUBJECTS
from ledgerlake.streaming.landing import land_new_files

HEADER = "Employee ID,Store ID,Name,Position"


def drop(paths, name, *text_lines):
    folder = paths.root / "01_transient"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *text_lines]) + "\n")


class Lake:
    def __init__(self, root):
        self.root = root
        self.paths = LakePaths(str(root))

    def land(self, spark, load, **options):
        return land_new_files(
            spark, self.paths.landing_drops("employees"), SUBJECTS["employees"], load,
            self.paths.raw("employees"), str(self.root / "checkpoint"), **options,
        )

    def raw(self, spark):
        return rows(spark.read.parquet(self.paths.raw("employees")))


@pytest.fixture
def lake(tmp_path):
    return Lake(tmp_path)


def test_every_file_is_taken_in_once(spark, lake):
    drop(lake, "employees-1.csv", "1,2,Bo,Clerk", "2,2,Li,Clerk")
    lake.land(spark, "20240101000000")
    lake.land(spark, "20240115000000")
    drop(lake, "employees-2.csv", "3,2,Jo,Clerk")
    lake.land(spark, "20240201000000")
    assert lake.raw(spark) == [
        (1, 2, "Bo", "Clerk", 20240101000000),
        (2, 2, "Li", "Clerk", 20240101000000),
        (3, 2, "Jo", "Clerk", 20240201000000),
    ]


def test_files_are_removed_only_after_their_batch_was_committed(spark, lake):
    folder = lake.root / "01_transient"
    for number in range(1, 4):
        drop(lake, f"employees-{number}.csv", f"{number},2,Bo,Clerk")
        lake.land(spark, f"2024010{number}000000", clean="delete")
    left = {p.name for p in folder.glob("employees-*.csv")}
    assert "employees-3.csv" in left and "employees-1.csv" not in left
    assert [r[0] for r in lake.raw(spark)] == [1, 2, 3]


def test_small_batches(spark, lake):
    for number in range(1, 6):
        drop(lake, f"employees-{number}.csv", f"{number},2,Bo,Clerk")
    query = lake.land(spark, "20240101000000", files_per_batch=2)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    assert [r[0] for r in lake.raw(spark)] == [1, 2, 3, 4, 5]


def test_a_bad_file_stops_the_run_and_is_taken_in_after_repair(spark, lake):
    drop(lake, "employees-1.csv", "x,2,Bo,Clerk")
    with pytest.raises(Exception):
        lake.land(spark, "20240101000000")
    drop(lake, "employees-1.csv", "1,2,Bo,Clerk")
    lake.land(spark, "20240102000000")
    assert [r[0] for r in lake.raw(spark)] == [1]
