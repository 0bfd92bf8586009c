"""Landing files with differing headers."""

import pytest
from conftest import rows

from ledgerlake.sources.drift import EXTRA, HeaderMismatch, drift_report, header_lines, read_drifting
from ledgerlake.sources.landing import BAD_ROW
from ledgerlake.sources.subjects import SUBJECTS

SPEC = SUBJECTS["employees"]


def drop(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def read(spark, folder):
    fitting, rejected = read_drifting(spark, f"{folder}/*.csv", SPEC)
    return rows(fitting), rows(rejected)


def test_missing_added_and_reordered_columns(spark, tmp_path):
    drop(tmp_path, "a.csv", "Employee ID,Store ID,Name,Position", "1,2,Bo,Clerk", '2,2,"Li, Jr",')
    drop(tmp_path, "b.csv", "Position,name,Desk,EMPLOYEE_ID,Store ID", "Head,Jo,7,3,4", "Head,Al,,4,4")
    drop(tmp_path, "c.csv", "﻿Employee  ID,Name", "5,Su")
    drop(tmp_path, "d.csv", "Employee ID,Store ID,Name,Position", "6,2,Zo,Clerk")
    drop(tmp_path, "e.csv", "Employee ID,Store ID,Name,Position")
    (tmp_path / "f.csv").write_text("")
    fitting, rejected = read(spark, tmp_path)
    assert rejected == [] and fitting == [
        (1, 2, "Bo", "Clerk", None), (2, 2, "Li, Jr", None, None), (3, 4, "Jo", "Head", {"Desk": "7"}),
        (4, 4, "Al", "Head", None), (5, None, "Su", None, None), (6, 2, "Zo", "Clerk", None),
    ]
    report = {tuple(r["header"])[0]: r for r in drift_report(spark, f"{tmp_path}/*.csv", SPEC).collect()}
    assert report["Employee ID"]["files"] == 3 and not report["Employee ID"]["reordered"]
    assert report["Position"]["reordered"] and report["Position"]["extra"] == ["Desk"]
    assert report["Employee  ID"]["missing"] == ["Store ID", "Position"]


def test_rows_that_do_not_fit_are_kept_with_their_text(spark, tmp_path):
    drop(tmp_path, "a.csv", "Name,Employee ID,Shift", "Bo,1,x", "Li,none,y")
    fitting, rejected = read_drifting(spark, f"{tmp_path}/*.csv", SPEC)
    assert rows(fitting) == [(1, None, "Bo", None, {"Shift": "x"})]
    assert [(r[BAD_ROW], r["Name"], r[EXTRA]) for r in rejected.collect()] == [("Li,none,y", "Li", {"Shift": "y"})]


def test_a_file_without_its_key_stops_the_run(spark, tmp_path):
    drop(tmp_path, "a.csv", "Employee ID,Store ID,Name,Position", "1,2,Bo,Clerk")
    drop(tmp_path, "b.csv", "Store ID,Name,Position", "2,Bo,Clerk")
    with pytest.raises(HeaderMismatch, match="b.csv lacks"):
        read(spark, tmp_path)
    drop(tmp_path, "b.csv", "Employee ID,employee_id", "2,3")
    with pytest.raises(HeaderMismatch, match="twice"):
        read(spark, tmp_path)


def test_first_lines_of_files_of_several_blocks(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="1")
    for k in range(3):
        drop(tmp_path, f"{k}.csv", f"H{k},x", *[f"{n},{k}" for n in range(3000)])
    got = {r["file"].rsplit("/", 1)[1]: r["header"] for r in header_lines(spark, f"{tmp_path}/*.csv").collect()}
    assert got == {f"{k}.csv": f"H{k},x" for k in range(3)}


def test_no_files_with_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read(spark, tmp_path) == ([], [])
