"""Loads that are replaced as a whole, rows that are new, states that are kept."""

import json
import os
import random
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerlake.operators import seen
from ledgerlake.operators.book import BOOK, feature_book
from ledgerlake.operators.seen import SeenIndex, fingerprinted, may_be_held
from ledgerlake.operators.dedup import latest_load
from ledgerlake.operators.snapshot import SnapshotStore
from ledgerlake.operators.stage import stage_features
from ledgerlake.operators.states import StateStore, monthly_states, oldest_month, touched_months
from ledgerlake.operators.windows import recency_windows
from ledgerlake.plans.monthly_run import MonthlyRun, RunFailed, run_month
from ledgerlake.sources import manifest
from ledgerlake.sources.landing import BAD_ROW
from ledgerlake.sources.layers import LakePaths, read_table
from ledgerlake.sources.manifest import (
    commit,
    committed,
    committed_files,
    current,
    remove_replaced,
    write_load,
    write_loads,
    write_version,
)
from ledgerlake.sources.scratch import CLEANUP
from ledgerlake.sources.subjects import SUBJECTS
from ledgerlake.streaming.landing import land_new_files, take_batch

LOADS = ("20010630060000", "20010731060000", "20010831060000")
ENDS = (date(2001, 6, 30), date(2001, 7, 31), date(2001, 8, 31))


# The log

def numbers(spark, n, add=0):
    return spark.range(n).select((F.col("id") + add).alias("id"), (F.col("id") % 3).cast("int").alias("ref"))


def test_a_write_that_dies_leaves_the_load_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    write_load(numbers(spark, 10), path, LOADS[0], ("ref",))
    before = rows(read_table(spark, path))
    # In the middle of its tasks, with some of them through.
    dying = numbers(spark, 1000, 5).withColumn(
        "id", F.when(F.col("id") > 900, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("id"))
    )
    with pytest.raises(Exception, match="killed"):
        write_load(dying.repartition(20), path, LOADS[0], ("ref",))
    assert rows(read_table(spark, path)) == before
    # After all of its files and before its commit.
    write_version(numbers(spark, 99, 7), path, LOADS[0], ("ref",))
    assert rows(read_table(spark, path, LOADS[0])) == before
    assert write_load(numbers(spark, 4, 50), path, LOADS[0], ("ref",)) == 4
    assert [r.id for r in read_table(spark, path).orderBy("id").collect()] == [50, 51, 52, 53]
    assert read_table(spark, path).columns == ["id", "dt_proc", "ref"]


def test_a_reader_that_began_before_a_commit_reads_on(spark, tmp_path):
    path = str(tmp_path / "t")
    write_load(numbers(spark, 10), path, LOADS[0])
    older = read_table(spark, path)
    write_load(numbers(spark, 3), path, LOADS[0])
    assert older.count() == 10 and read_table(spark, path).count() == 3
    assert len(remove_replaced(spark, path)) == 1
    assert read_table(spark, path).count() == 3 and remove_replaced(spark, path) == []


def test_versions_that_add_and_that_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    for name, n in (("batch-0", 2), ("batch-1", 3)):
        commit(spark, path, write_version(numbers(spark, n), path, LOADS[0], version=name, adds=True))
    commit(spark, path, manifest.Version(LOADS[0], "batch-1", 3, True))
    assert read_table(spark, path).count() == 5
    write_load(numbers(spark, 1), path, LOADS[0])
    write_load(numbers(spark, 0), path, LOADS[1])
    assert read_table(spark, path).count() == 1 and read_table(spark, path, LOADS[1]).count() == 0
    assert [len(v) for v in current(committed(spark, path)).values()] == [1, 1]


def test_several_loads_in_one_write(spark, tmp_path):
    path = str(tmp_path / "t")
    by_ref = numbers(spark, 9).withColumn("ref", F.col("ref") + 1)
    assert write_loads(by_ref, path, "ref", ["1", "2", "3", "4"]) == {"1": 3, "2": 3, "3": 3, "4": 0}
    assert write_loads(by_ref.where("id < 2"), path, "ref", ["1", "2"]) == {"1": 1, "2": 1}
    counts = read_table(spark, path).groupBy("dt_proc").count().collect()
    assert {r.dt_proc: r["count"] for r in counts} == {1: 1, 2: 1, 3: 3}
    entries = [json.loads(line) for f in (tmp_path / "t" / "_loads").glob("*.json") for line in open(f)]
    assert sorted(e["entry"] for e in entries) == list(range(6))


def test_a_killed_run_keeps_the_load_of_the_run_before(spark, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path))
    deliver_employees(tmp_path, [(1, 2, "Bo", "Clerk"), (2, 2, "Li", "Clerk")])
    only = {"subjects": (SUBJECTS["employees"],)}
    run_month(spark, paths, LOADS[0], ENDS[0], **only)
    kept = rows(read_table(spark, paths.snapshot("employees")))
    deliver_employees(tmp_path, [(9, 9, "Zed", "None")])
    with monkeypatch.context() as broken:
        broken.setattr(manifest, "commit", lambda *_: 1 / 0)
        with pytest.raises(RunFailed):
            run_month(spark, paths, LOADS[0], ENDS[0], **only)
    assert rows(read_table(spark, paths.snapshot("employees"))) == kept
    run_month(spark, paths, LOADS[0], ENDS[0], **only)
    assert [r.employee_id for r in read_table(spark, paths.snapshot("employees")).collect()] == [9]


def test_a_lost_file_is_found(spark, tmp_path):
    path = str(tmp_path / "t")
    write_load(numbers(spark, 30).repartition(3), path, LOADS[0])
    write_load(numbers(spark, 7), path, LOADS[1])
    write_load(numbers(spark, 8), path, LOADS[1])
    write_load(numbers(spark, 0), path, LOADS[2])
    held = lambda: {
        r["dt_proc"]: (r["committed_rows"], r["found_rows"]) for r in committed_files(spark, path).collect()
    }
    assert held() == {LOADS[0]: (30, 30), LOADS[1]: (8, 8), LOADS[2]: (0, 0)}
    next((tmp_path / "t" / f"dt_proc={LOADS[0]}").rglob("*.parquet")).unlink()
    for file in (tmp_path / "t" / f"dt_proc={LOADS[1]}").rglob("*.parquet"):
        file.unlink()
    after = held()
    assert 0 < after.pop(LOADS[0])[1] < 30
    assert after == {LOADS[1]: (8, 0), LOADS[2]: (0, 0)}
    plan = committed_files(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


STEPS_OF_A_RUN = ("write_raw", "write_trusted", "write_snapshot", "write_stage", "write_book")


@pytest.mark.parametrize("failing", STEPS_OF_A_RUN)
def test_a_run_goes_on_at_the_step_that_failed(spark, tmp_path, monkeypatch, failing):
    paths, only = LakePaths(str(tmp_path)), {"subjects": (SUBJECTS["transactions"],), "book": SMALL_BOOK}
    (tmp_path / "01_transient").mkdir()
    header = [h for h, _, _ in SUBJECTS["transactions"].landing]
    sale = {"Invoice ID": "1", "Line": "1", "Customer ID": "2", "Date": "2001-08-02 10:00:00", "Currency": "USD"}
    (tmp_path / "01_transient" / "transactions.csv").write_text(
        ",".join(header) + "\n" + ",".join(sale.get(h, "") for h in header) + "\n"
    )
    with monkeypatch.context() as broken:
        broken.setattr(MonthlyRun, failing, lambda *_: 1 / 0)
        with pytest.raises(RunFailed):
            run_month(spark, paths, LOADS[2], ENDS[2], **only)
    report = run_month(spark, paths, LOADS[2], ENDS[2], resume=True, **only)
    tables = ["tb_raw_transactions", "tb_trusted_transactions", "tb_refined_data_viz_transactions",
              "tb_refined_stage", "tb_refined_book"]
    assert report.resumed == tables[: STEPS_OF_A_RUN.index(failing)]
    assert report.rows == dict.fromkeys(tables, 1)


# The snapshot by change

def test_loads_merged_one_by_one_are_the_latest_load(spark, tmp_path):
    rng = random.Random(4)
    schema = "k int, v string, w double, dt_proc string"
    loads = {
        load: [(rng.choice([None, *range(12)]), rng.choice("ab"), rng.choice([0.5, None]), load) for _ in range(14)]
        for load in LOADS
    }
    for null_keys in ("drop", "keep"):
        store = SnapshotStore(spark, str(tmp_path / null_keys), "k", buckets=5, null_keys=null_keys)
        seen_rows = []
        for load in LOADS:
            written = store.apply(spark.createDataFrame(loads[load], schema), load)
            seen_rows += loads[load]
            want = latest_load(spark.createDataFrame(seen_rows, schema), "k", null_keys=null_keys)
            assert rows(store.rows().select("k", "v", "w", "dt_proc")) == rows(want)
            assert set(written) <= set(range(5))
        # Again with other rows: the first application leaves nothing behind.
        again = [(1, "c", 9.0, LOADS[2])]
        store.apply(spark.createDataFrame(again, schema), LOADS[2])
        want = latest_load(spark.createDataFrame(loads[LOADS[0]] + loads[LOADS[1]] + again, schema), "k", null_keys=null_keys)
        assert rows(store.rows().select("k", "v", "w", "dt_proc")) == rows(want)
        with pytest.raises(ValueError):
            store.apply(spark.createDataFrame(again, schema), LOADS[0])


def test_untouched_buckets_are_carried_over(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), "k", buckets=16)
    df = lambda n, load: spark.range(n).select(F.col("id").alias("k"), F.lit(load).alias("dt_proc"))
    store.apply(df(200, LOADS[0]), LOADS[0])
    before = current(committed(spark, store.path))
    touched = store.apply(df(2, LOADS[1]), LOADS[1])
    after = current(committed(spark, store.path))
    assert len(touched) <= 2 and {int(b) for b in after if after[b] != before[b]} == set(touched)
    assert store.rows().groupBy("dt_proc").count().orderBy("dt_proc").collect()[1][1] == 2
    assert store.rows().count() == 200


# Rows that are new

def deliver_employees(folder, employees):
    (folder / "01_transient").mkdir(exist_ok=True)
    header = ",".join(h for h, _, _ in SUBJECTS["employees"].landing)
    text = "\n".join(",".join("" if v is None else str(v) for v in e) for e in employees)
    (folder / "01_transient" / "employees.csv").write_text(f"{header}\n{text}\n")


def some_employees(seed, n=60):
    rng = random.Random(seed)
    some = lambda *values: rng.choice(values)
    return [
        (some(1, 2, 3, 4, None), some(1, 2, None), some("Bo", "Li", None), some("Clerk", "Head"))
        for _ in range(n)
    ]


def deliver_customers(folder, ids):
    (folder / "01_transient").mkdir(exist_ok=True)
    header = ",".join(h for h, _, _ in SUBJECTS["customers"].landing)
    lines = [f"{i},N{i},,+{i},X,BR,F,19{50 + i}-07-15," for i in ids]
    (folder / "01_transient" / "customers.csv").write_text("\n".join([header, *lines]) + "\n")


def test_new_loads_have_the_rows_of_all_loads(spark, tmp_path, monkeypatch):
    """Three loads with copies, NULL keys and rows that come back, and a filter that grows."""
    monkeypatch.setattr(seen, "ROWS_PER_BLOCK", 8)
    monkeypatch.setattr(seen, "GROWTH", 1)
    only = {"subjects": (SUBJECTS["employees"],)}
    lakes = {loads: LakePaths(str(tmp_path / loads)) for loads in ("new", "all")}
    for number, (load, end) in enumerate(zip(LOADS, ENDS)):
        for loads, paths in lakes.items():
            (tmp_path / loads).mkdir(exist_ok=True)
            deliver_employees(tmp_path / loads, some_employees(number % 2) + some_employees(number, 20))
            run_month(spark, paths, load, end, loads=loads, steps=("raw", "trusted", "refined"), **only)
        trusted = read_table(spark, lakes["new"].trusted("employees")).drop("dt_proc")
        whole = read_table(spark, lakes["all"].trusted("employees"), load).drop("dt_proc")
        assert rows(trusted) == rows(whole)
        snapshots = [read_table(spark, p.snapshot("employees"), load) for p in lakes.values()]
        assert rows(snapshots[0]) == rows(snapshots[1])
    # A load that is run again, and one that is run again later, change nothing.
    for number in (2, 0):
        deliver_employees(tmp_path / "new", some_employees(number % 2) + some_employees(number, 20))
        run_month(spark, lakes["new"], LOADS[number], ENDS[number], steps=("raw", "trusted"), **only)
        assert rows(read_table(spark, lakes["new"].trusted("employees")).drop("dt_proc")) == rows(whole)


def test_ages_are_those_of_the_last_run(spark, tmp_path):
    only = {"subjects": (SUBJECTS["customers"],)}
    paths = LakePaths(str(tmp_path))
    for load, end, ids in zip(LOADS, ENDS, ([1, 2], [2, 3], [4])):
        deliver_customers(tmp_path, ids)
        run_month(spark, paths, load, end, **only)
    got = {r.customer_id: r.age for r in read_table(spark, paths.snapshot("customers"), LOADS[2]).collect()}
    assert got == {1: 50, 2: 49, 3: 48, 4: 47}
    trusted = {(r.customer_id, r.dt_proc): r.age for r in read_table(spark, paths.trusted("customers")).collect()}
    assert trusted[1, int(LOADS[0])] == 49


def test_older_loads_are_not_read(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    only = {"subjects": (SUBJECTS["employees"],)}
    for number, (load, end) in enumerate(zip(LOADS, ENDS)):
        deliver_employees(tmp_path, some_employees(number))
        run_month(spark, paths, load, end, steps=("raw", "trusted"), **only)
    run = MonthlyRun(spark, paths, LOADS[2], ENDS[2], **only)
    raw = run._loads_since(read_table(spark, paths.raw("employees")), LOADS[1])
    index = SeenIndex(spark, paths.seen("employees"))
    assert index.previous(LOADS[2]) == LOADS[1]
    new = index.new_rows(raw.drop("dt_proc").distinct(), LOADS[2])
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "03_trusted/tb_employees" not in plan
    read = [r[0] for r in raw.select(F.input_file_name()).distinct().collect()]
    assert read and all(f"dt_proc={LOADS[2]}" in name for name in read)


def test_equal_fingerprints_are_compared_by_all_columns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "fingerprinted", lambda df: df.withColumn(seen.FINGERPRINT, F.lit(7).cast("bigint")))
    index = SeenIndex(spark, str(tmp_path / "i"))
    schema = "a int, b double, c string"
    one = spark.createDataFrame([(1, 0.0, None), (1, None, ""), (None, float("nan"), "x")], schema)
    two = spark.createDataFrame([(1, -0.0, None), (1, None, None), (None, float("nan"), "x"), (2, 0.0, None)], schema)
    assert index.take(one, LOADS[0]) == 3
    assert index.take(two, LOADS[1]) == 2
    assert rows(index.rows(LOADS[1])) == [(1, None, None), (2, 0.0, None)]


def test_the_filter_never_denies_a_row(spark, tmp_path):
    data = fingerprinted(spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("z")))
    bits = seen.filter_bits(data.select(seen.FINGERPRINT), 10)
    assert may_be_held(data, bits, 10).where("NOT _maybe").count() == 0
    others = fingerprinted(spark.range(20_000, 40_000).select("id", F.lit(0.0).alias("z")))
    assert may_be_held(others, bits, 10).where("_maybe").count() < 400
    assert data.select(seen.FINGERPRINT).distinct().count() == 20_000


# Rejected rows of a stream

def test_rejected_rows_of_a_stream_are_kept_once(spark, tmp_path, monkeypatch):
    paths, spec = LakePaths(str(tmp_path)), SUBJECTS["employees"]
    folder = tmp_path / "01_transient"
    folder.mkdir()
    header = ",".join(h for h, _, _ in spec.landing)
    drop = lambda name, *lines: (folder / name).write_text("\n".join([header, *lines]) + "\n")

    def land(load):
        land_new_files(
            spark, paths.landing_drops("employees"), spec, load, paths.raw("employees"), str(tmp_path / "c"),
            on_bad_row="reject", rejected_path=paths.rejected("employees"),
        )
        raw, rejected = (read_table(spark, p("employees")) for p in (paths.raw, paths.rejected))
        return rows(raw), rows(rejected.select("Name", BAD_ROW, "dt_proc"))

    drop("employees-1.csv", "1,2,Bo,Clerk", "x,2,Li,Clerk", "3,4")
    raw, rejected = land(LOADS[0])
    assert raw == [(1, 2, "Bo", "Clerk", int(LOADS[0]))]
    assert [r[1] for r in rejected] == ["3,4", "x,2,Li,Clerk"] or len(rejected) == 2
    assert land(LOADS[1]) == (raw, rejected)
    # The run dies between the two tables; it is repeated under another stamp.
    drop("employees-2.csv", "5,2,Jo,Clerk", "y,2,Al,Clerk")
    real, calls = manifest.commit, []

    def dies(session, path, *versions):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("killed")
        real(session, path, *versions)

    with monkeypatch.context() as broken:
        broken.setattr("ledgerlake.streaming.landing.commit", dies)
        with pytest.raises(Exception):
            land(LOADS[1])
    after = land(LOADS[2])
    assert [r[0] for r in after[0]] == [1, 5] and len(after[1]) == 3
    assert {r[1]: r[2] for r in after[1]}["y,2,Al,Clerk"] == int(LOADS[1])
    # The same batch once more changes nothing.
    again = spark.createDataFrame([(8, 2, "Si", "Clerk", None, LOADS[2])],
                                  f"{spec.landing_schema}, `{BAD_ROW}` string, dt_proc string")
    take_batch(again, 1, LOADS[2], paths.raw("employees"), paths.rejected("employees"))
    assert land(LOADS[2]) == after


def test_a_run_with_a_stream_that_rejects(spark, tmp_path):
    paths, spec = LakePaths(str(tmp_path)), SUBJECTS["employees"]
    (tmp_path / "01_transient").mkdir()
    header = ",".join(h for h, _, _ in spec.landing)
    for number, load in enumerate(LOADS[:2]):
        (tmp_path / "01_transient" / f"employees-{number}.csv").write_text(
            f"{header}\n{number},2,Bo,Clerk\n7,2,Li,Clerk\nx{number},1,No,Clerk\n"
        )
        report = run_month(spark, paths, load, ENDS[number], landing="stream", on_bad_row="reject", subjects=(spec,))
        assert report.rows["tb_raw_employees"] == 2 and report.rows["tb_raw_rejected_employees"] == 1
    assert report.rows["tb_trusted_employees"] == 1 and report.rows["tb_refined_data_viz_employees"] == 3


# Monthly states

SCHEMA = (
    "invoice_id string, line int, customer_id bigint, date date, hour int, discount double, currency string, "
    "transaction_type string, payment_method string, line_total double, ref string"
)


# One dimension with all measures.
SMALL_BOOK = BOOK.only("fbc_moeda", [m for m, _ in BOOK.measures])


def some_sales(seed, n=250):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = date(2000, 6, 1) + timedelta(days=rng.randrange(470))
        if rng.random() < 0.2:
            day = day.replace(day=28)
        out.append((
            rng.choice([None, *map(str, range(60))]), rng.randint(1, 4), rng.choice([None, 1, 2, 3, 4, 5, 6]),
            rng.choice([day, day, day, day, None]), rng.randrange(24), rng.choice([0.0, 0.2, None]),
            rng.choice(["USD", "EUR", "BRL", None]), rng.choice(["Sale", "Return"]),
            rng.choice(["Cash", "Credit Card", "Voucher"]), rng.choice([None, round(rng.random() * 1000, 2)]),
            f"{day:%Y%m}",
        ))
    return out


def test_the_book_of_states_is_the_book_of_lines(spark, tmp_path):
    sales = spark.createDataFrame(some_sales(1), SCHEMA)
    store = StateStore(spark, str(tmp_path / "s"), SMALL_BOOK)
    store.replace(stage_features(sales, LOADS[2], ENDS[2]))
    for as_of, future in ((date(2001, 2, 11), True), (date(2001, 4, 30), False), (date(2001, 9, 1), True)):
        stage = stage_features(sales, LOADS[2], as_of)
        windows = recency_windows(stage, as_of, include_future=future)
        form = "wide" if future else "cells"
        assert rows(store.book(as_of, include_future=future)) == rows(feature_book(windows, SMALL_BOOK, form))


def test_late_lines_change_the_states_of_their_months_only(spark, tmp_path):
    as_of = ENDS[2]
    everything = spark.createDataFrame(some_sales(2), SCHEMA).cache()
    is_late = (F.col("ref") == "200103") & (F.col("line") <= 2) & (F.col("invoice_id") < "3")
    store = StateStore(spark, str(tmp_path / "s"), SMALL_BOOK)
    store.replace(stage_features(everything.where(~F.coalesce(is_late, F.lit(False))), LOADS[1], as_of))
    before = current(committed(spark, store.months_path))
    late = everything.where(is_late)
    months = touched_months(late, everything)
    assert store.refresh(everything, late, LOADS[2], as_of) == months
    after = current(committed(spark, store.months_path))
    assert {m for m in after if after[m] != before.get(m)} == {str(m) for m in months}
    assert 200103 in months and set(after) >= set(before)
    whole = feature_book(recency_windows(stage_features(everything, LOADS[2], as_of), as_of), SMALL_BOOK)
    assert rows(store.book(as_of)) == rows(whole)
    assert store.refresh(everything, late.limit(0), LOADS[2], as_of) == []


def test_a_book_opens_the_months_of_its_windows(spark, tmp_path):
    stage = stage_features(spark.createDataFrame(some_sales(3), SCHEMA), LOADS[2], ENDS[2])
    store = StateStore(spark, str(tmp_path / "s"), SMALL_BOOK)
    store.replace(stage)
    assert oldest_month(ENDS[2]) == 200008 and min(m for m in store.months() if m) < 200008
    read = store.book(ENDS[2]).inputFiles()
    read_months = {int(f.split("dt_proc=")[1].split("/")[0]) for f in read if "/months/" in f}
    assert min(read_months) == 200008


def test_sums_do_not_depend_on_the_order(spark):
    """A skewed customer with amounts that doubles cannot add up exactly."""
    rng = random.Random(5)
    data = [
        ("i", k, 1, date(2001, 8, 2), 9, 0.0, "USD", "Sale", "Cash", round(rng.random() * 1e6, 2), "200108")
        for k in range(3000)
    ]
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        stage = stage_features(spark.createDataFrame(data, SCHEMA).repartition(7), LOADS[2], ENDS[2])
        results.append(rows(feature_book(recency_windows(stage, ENDS[2]), SMALL_BOOK)))
    assert results[0] == results[1]
    total = sum(round(r[9] * 100) for r in data) / 100
    assert results[0][0][2:4] == (total, total / 3000)  # dollars: sum, average


def test_runs_that_keep_states(spark, tmp_path):
    """Three deliveries, the second with late lines; the book is that of the snapshot's lines."""
    paths = LakePaths(str(tmp_path))
    os.makedirs(f"{paths.root}/01_transient")
    spec = SUBJECTS["transactions"]
    header = [h for h, _, _ in spec.landing]
    rng = random.Random(9)
    sales = []
    for k in range(120):
        day = date(2001, 1, 1) + timedelta(days=rng.randrange(240))
        sale = {h: "" for h in header} | {
            "Invoice ID": k // 3, "Line": k % 3 + 1, "Customer ID": rng.randrange(6), "Quantity": 1,
            "Date": f"{day} 10:00:00", "Discount": 0.1, "Line Total": round(rng.random() * 99, 2),
            "Currency": "USD", "Transaction Type": "Sale", "Payment Method": "Cash",
        }
        sales.append(",".join(str(sale[h]) for h in header))
    for number, (load, end) in enumerate(zip(LOADS, ENDS)):
        delivery = sales[: 40 * (number + 1)] if number != 1 else sales[20:60]
        with open(paths.landing("transactions"), "w") as file:
            file.write("\n".join([",".join(header), *delivery]) + "\n")
        run_month(spark, paths, load, end, book_from="states", book=SMALL_BOOK, subjects=(spec,))
        stage = stage_features(read_table(spark, paths.snapshot("transactions"), load), load, end)
        want = feature_book(recency_windows(stage, end), SMALL_BOOK)
        assert rows(read_table(spark, paths.book, load).drop("dt_proc").select(*want.columns)) == rows(want)
    with pytest.raises(ValueError):
        run_month(spark, paths, LOADS[2], ENDS[2], book_from="states", loads="all")


# Rows that are there once are not shuffled

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sent", [0, 2, 1_000])
def test_distinct_rows_are_those_of_distinct(spark, monkeypatch, sent):
    monkeypatch.setattr(seen, "SENT", sent)
    schema = "a int, b double, c string"
    nan = float("nan")
    data = [(1, 0.0, None), (1, -0.0, None), (1, None, ""), (1, None, None), (None, nan, "x"), (None, nan, "x"),
            (2, -0.0, "y"), (3, 1.0, "z"), (3, 1.0, "z"), (4, 2.5, "once")]
    df = spark.createDataFrame(data, schema).repartition(3)
    got, want = seen.distinct_rows(df), df.distinct()
    assert [str(r) for r in rows(got)] == [str(r) for r in rows(want)]


def test_rows_without_copies_stay_in_their_tasks(spark):
    single = spark.range(1_000).select("id", F.col("id").cast("string").alias("text"))
    assert "Exchange" not in _plan(seen.distinct_rows(single))
    few = single.unionByName(single.limit(3))
    plan = _plan(seen.distinct_rows(few))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert seen.distinct_rows(few).count() == 1_000


@pytest.mark.parametrize("sent", [0, 4, 1_000])
def test_new_rows_whatever_the_number_of_known_ones(spark, tmp_path, monkeypatch, sent):
    """None known, few that every task gets, and too many for that."""
    monkeypatch.setattr(seen, "SENT", sent)
    index = SeenIndex(spark, str(tmp_path / "i"))
    made = lambda first, end: spark.range(first, end).select("id", (F.col("id") % 3).alias("third"))
    assert index.take(made(0, 40), LOADS[0]) == 40
    assert index.take(made(40, 60).unionByName(made(40, 42)), LOADS[1]) == 20
    assert index.take(made(38, 63).unionByName(made(60, 61)), LOADS[2]) == 3
    assert rows(index.rows(LOADS[2])) == [(60, 0), (61, 1), (62, 2)]


def test_a_filter_is_shuffled_as_fingerprints(spark):
    """Blocks that every task begins would be tasks times blocks, of 4 KB each."""
    data = fingerprinted(spark.range(0, 20_000, 1, 4).select("id")).select(seen.FINGERPRINT)
    plan = _plan(seen.filter_bits(data, 3_000))
    assert plan.count("Exchange") == 1 and "hashpartitioning(block" in plan
    assert "bitmap_construct_agg" not in plan[plan.index("Exchange") :]


def test_many_copies_are_merged_in_their_tasks(spark):
    copies = spark.range(30).select((F.col("id") % 5).alias("id")).repartition(3).unionByName(spark.range(7, 9))
    distinct = seen.distinct_rows(copies)
    assert "BroadcastHashJoin" not in _plan(distinct)
    assert rows(distinct) == [(n,) for n in (0, 1, 2, 3, 4, 7, 8)]


def test_a_run_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    during = []
    step = MonthlyRun.write_trusted
    monkeypatch.setattr(
        MonthlyRun, "write_trusted", lambda run, spec: (during.append(spark.conf.get(CLEANUP)), step(run, spec))[1]
    )
    before = spark.conf.get(CLEANUP, None)
    deliver_employees(tmp_path, some_employees(1))
    only = {"subjects": (SUBJECTS["employees"],), "steps": ("raw", "trusted")}
    run_month(spark, LakePaths(str(tmp_path)), LOADS[0], ENDS[0], **only)
    assert during == ["true"] and spark.conf.get(CLEANUP, None) == before


# Loads that are worked through part by part

def test_many_known_rows_are_compared_part_by_part(spark, tmp_path, monkeypatch):
    """Every part shuffles its share of load and index; all of them are the load's new rows."""
    monkeypatch.setattr(seen, "SENT", 4)
    monkeypatch.setattr(manifest, "PARTS", 3)
    index = SeenIndex(spark, str(tmp_path / "i"))
    made = lambda first, end: spark.range(first, end, 1, 2).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text")
    )
    assert index.take(made(0, 400), LOADS[0]) == 400
    load = made(100, 500).unionByName(made(480, 500)).distinct()
    parts = index.new_parts(load, LOADS[1])
    assert len(parts) == 3
    assert sorted(r.id for part in parts for r in part.collect()) == list(range(400, 500))
    assert all(_plan(part).count("pmod(xxhash64(_fingerprint") >= 2 for part in parts)
    assert index.take(load, LOADS[1]) == 100
    folder = manifest.version_folder(index.path, LOADS[1], index.loads()[LOADS[1]][0].version)
    assert spark.read.parquet(folder).count() == 100


def test_a_filter_in_parts_is_the_whole_filter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "PARTS", 3)
    made = lambda first, end: spark.range(first, end, 1, 2).select("id")
    filters = []
    for rows_of_part in (10**9, 100):
        monkeypatch.setattr(manifest, "PART_ROWS", rows_of_part)
        monkeypatch.setattr(seen, "ROWS_PER_BLOCK", 64)
        index = SeenIndex(spark, str(tmp_path / str(rows_of_part)))
        for number, load in enumerate(LOADS):  # the filter is made, added to and made anew
            index.take(made(number**3 * 300, number**3 * 300 + 500), load)
        bits, blocks = index._filter()
        filters.append((blocks, rows(bits.select("block", F.hex("bits")))))
    assert filters[0] == filters[1] and len(filters[0][1]) > 8


def test_a_load_written_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "PARTS", 2)
    path, ids = str(tmp_path / "t"), lambda df: [r.id for r in df.orderBy("id").collect()]
    parts = manifest.in_parts(numbers(spark, 100), "ref", rows=10 * manifest.PART_ROWS)
    assert len(parts) == 2 and len(manifest.in_parts(numbers(spark, 9), "ref", rows=9)) == 1
    assert write_load(parts, path, LOADS[0], ("ref",)) == 100
    assert ids(read_table(spark, path)) == list(range(100))
    assert write_load([part.where("id < 3") for part in parts], path, LOADS[0], ("ref",)) == 3
    assert ids(read_table(spark, path)) == [0, 1, 2]
    assert write_load([part.where("id < 0") for part in parts], path, LOADS[0], ("ref",)) == 0
    assert read_table(spark, path).columns == ["id", "dt_proc", "ref"] and ids(read_table(spark, path)) == []


def deliver_sales(folder, lines=60):
    """Lines of invoices over several months; every fourth line has no invoice."""
    (folder / "01_transient").mkdir()
    header = [h for h, _, _ in SUBJECTS["transactions"].landing]
    text = [",".join(header)]
    for n in range(lines):
        sale = {"Invoice ID": "" if n % 4 == 0 else str(n // 7), "Line": n % 7, "Customer ID": n % 5, "Currency": "USD",
                "Date": f"2001-0{n % 8 + 1}-02 10:00:00", "Line Total": n / 4}
        text.append(",".join(str(sale.get(h, "")) for h in header))
    (folder / "01_transient" / "transactions.csv").write_text("\n".join(text) + "\n")


def test_trusted_and_stage_in_parts_are_those_of_one_part(spark, tmp_path, monkeypatch):
    only = {"subjects": (SUBJECTS["transactions"],), "null_keys": "keep"}
    monkeypatch.setattr(manifest, "PARTS", 3)
    tables, appended = [], []
    for part_rows in (1_000, 10):
        monkeypatch.setattr(manifest, "PART_ROWS", part_rows)
        paths = LakePaths(str(tmp_path / str(part_rows)))
        (tmp_path / str(part_rows)).mkdir()
        deliver_sales(tmp_path / str(part_rows))
        written = (paths.trusted("transactions"), paths.stage)
        write, jobs = manifest._write, []
        with monkeypatch.context() as spied:
            spied.setattr(manifest, "_write", lambda *a: (jobs.append((a[1], a[2])), write(*a))[1])
            run_month(spark, paths, LOADS[2], ENDS[2], steps=("raw", "trusted", "refined"), **only)
            assert MonthlyRun(spark, paths, LOADS[2], ENDS[2], **only).write_stage() == 60
        appended.append([sum(f.startswith(f"{path}/dt_proc") and mode == "append" for f, mode in jobs) for path in written])
        tables.append([rows(read_table(spark, path)) for path in written])
    assert tables[0] == tables[1] and len(tables[0][0]) == len(tables[0][1]) == 60
    assert appended == [[0, 0], [2, 2]]
    files = list((tmp_path / "10" / "03_trusted" / "tb_transactions").rglob("ref=*/*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 8  # each month in one part


@pytest.mark.parametrize("replaced", ["remove", "keep"])
def test_a_repeated_run_leaves_no_replaced_files(spark, tmp_path, replaced):
    options = {"subjects": (SUBJECTS["employees"],), "steps": ("raw", "trusted", "refined"), "replaced": replaced}
    paths = LakePaths(str(tmp_path))
    tables = [paths.raw("employees"), paths.trusted("employees"), paths.snapshot("employees"), paths.seen("employees")]
    versions = lambda load: [len(os.listdir(f"{path}/dt_proc={load}")) for path in tables]
    deliver_employees(tmp_path, some_employees(1))
    run_month(spark, paths, LOADS[1], ENDS[1], **options)
    first = [rows(read_table(spark, path)) for path in tables]
    # A version that never came to its commit, of another load, is not this run's to remove.
    write_version(numbers(spark, 3), tables[0], LOADS[0])
    run_month(spark, paths, LOADS[1], ENDS[1], **options)
    assert [rows(read_table(spark, path)) for path in tables] == first
    assert versions(LOADS[1]) == ([1, 1, 1, 1] if replaced == "remove" else [2, 2, 2, 1])
    assert len(os.listdir(f"{tables[0]}/dt_proc={LOADS[0]}")) == 1
    kept = os.listdir(f"{tables[3]}/_filter/dt_proc={SeenIndex(spark, tables[3])._filter()[1]}")
    assert len(kept) == 1


def test_a_run_that_dies_removes_nothing(spark, tmp_path, monkeypatch):
    only = {"subjects": (SUBJECTS["employees"],), "steps": ("raw", "trusted", "refined")}
    paths = LakePaths(str(tmp_path))
    deliver_employees(tmp_path, some_employees(1))
    run_month(spark, paths, LOADS[0], ENDS[0], **only)
    tables = [paths.raw("employees"), paths.trusted("employees"), paths.snapshot("employees")]
    kept = [rows(read_table(spark, path)) for path in tables]
    with monkeypatch.context() as broken:
        broken.setattr(manifest, "commit", lambda *_: 1 / 0)
        with pytest.raises(RunFailed):
            run_month(spark, paths, LOADS[0], ENDS[0], **only)
    assert [rows(read_table(spark, path)) for path in tables] == kept
