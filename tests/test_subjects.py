"""Landing schemas, trusted projections, CSV reading."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import latest_load
from ledgerlake.operators.ingest import ingest_subject
from ledgerlake.operators.standardise import standardise
from ledgerlake.sources.landing import read_landing
from ledgerlake.sources.subjects import SUBJECTS

AS_OF = date(2025, 4, 11)
LOAD = "20250411080000"


def write_text(path, *text_lines):
    path.write_text("\n".join(text_lines) + "\n", encoding="utf-8")
    return str(path)


def test_trusted_columns_of_all_subjects(spark):
    counts = {
        "customers": 11, "discounts": 9, "employees": 5, "products": 13, "stores": 9,
        "transactions": 23,
    }
    for name, spec in SUBJECTS.items():
        raw = spark.createDataFrame([], spec.landing_schema)
        out = standardise(raw.withColumn("dt_proc", F.lit(LOAD)), spec, LOAD, AS_OF)
        assert out.columns == [*spec.order, "dt_proc"]
        assert len(out.columns) == counts[name]
        assert dict(out.dtypes)["dt_proc"] == "string"
        assert spec.key in out.columns


def test_customers(spark, tmp_path):
    path = write_text(
        tmp_path / "customers.csv",
        "Customer ID,Name,Email,Telephone,City,Country,Gender,Date Of Birth,Job Title",
        '7,"Silva, Ana",a@x.com,+55,Recife,Brasil,F,1990-04-12,',
        '7,"Silva, Ana",a@x.com,+55,Recife,Brasil,F,1990-04-12,',
        "8,Li Wei,l@x.com,,北京,中国,M,1990-04-11,Engineer",
    )
    raw = ingest_subject(spark, path, SUBJECTS["customers"], LOAD)
    assert raw.columns[-1] == "dt_proc"
    got = standardise(raw, SUBJECTS["customers"], LOAD, AS_OF).orderBy("customer_id").collect()
    assert [(r.customer_id, r.name, r.job_title, r.birthdate, r.age) for r in got] == [
        (7, "Silva, Ana", None, date(1990, 4, 12), 34),
        (8, "Li Wei", "Engineer", date(1990, 4, 11), 35),
    ]
    with pytest.raises(ValueError):
        standardise(raw, SUBJECTS["customers"], LOAD)


def test_discount_without_a_subcategory_has_no_id_and_is_lost(spark):
    spec = SUBJECTS["discounts"]
    data = [
        (date(2024, 1, 1), date(2024, 1, 9), 0.4, "Winter", "Coats", "Wool"),
        (date(2024, 2, 1), date(2024, 2, 9), 0.5, "Winter", "Coats", "Wool"),
        (date(2024, 2, 1), None, 0.5, "All", None, None),
    ]
    raw = spark.createDataFrame(data, spec.landing_schema).withColumn("dt_proc", F.lit(LOAD))
    trusted = standardise(raw, spec, LOAD)
    assert [(r.ref, r.discount_id) for r in trusted.orderBy("start", "discount_id").collect()] == [
        ("202401", "Winter - Coats - Wool"),
        ("202402", None),
        ("202402", "Winter - Coats - Wool"),
    ]
    assert latest_load(trusted, "discount_id").count() == 2
    assert latest_load(trusted, "discount_id", null_keys="keep").count() == 3


def test_transactions(spark, tmp_path):
    headers = [h for h, _, _ in SUBJECTS["transactions"].landing]
    path = write_text(
        tmp_path / "transactions.csv",
        ",".join(headers),
        "INV-1,1,7,3,M,RED,10.5,2,2023-01-01 15:42:00,0.0,21.0,1,9,USD,$,SKU1,Sale,Cash,21.0",
    )
    raw = ingest_subject(spark, path, SUBJECTS["transactions"], LOAD)
    row = standardise(raw, SUBJECTS["transactions"], LOAD).first()
    assert (row.invoice_id, row.date_hour, row.date, row.hour, row.ref) == (
        "INV-1", datetime(2023, 1, 1, 15, 42), date(2023, 1, 1), 15, "202301",
    )
    assert (row.line_total, row.quantity, row.currency_symbol) == (21.0, 2, "$")


def test_landing_headers_have_to_match(spark, tmp_path):
    path = write_text(tmp_path / "e.csv", "Store ID,Employee ID,Name,Position", "1,2,Bo,Clerk")
    with pytest.raises(Exception):
        read_landing(spark, path, SUBJECTS["employees"]).collect()


def test_bad_values_are_an_error_unless_asked_for(spark, tmp_path):
    path = write_text(tmp_path / "e.csv", "Employee ID,Store ID,Name,Position", "x,2,Bo,Clerk")
    with pytest.raises(Exception):
        read_landing(spark, path, SUBJECTS["employees"]).collect()
    lenient = read_landing(spark, path, SUBJECTS["employees"], on_bad_row="PERMISSIVE")
    assert rows(lenient) == [(None, 2, "Bo", "Clerk")]


def test_inference_is_available(spark, tmp_path):
    path = write_text(tmp_path / "e.csv", "Employee ID,Store ID,Name,Position", "1,2,Bo,Clerk")
    inferred = read_landing(spark, path, SUBJECTS["employees"], infer=True)
    assert dict(inferred.dtypes) == {
        "Employee ID": "int", "Store ID": "int", "Name": "string", "Position": "string",
    }


def test_business_dedup_ignores_the_load_and_with_load_does_not(spark):
    spec = SUBJECTS["employees"]
    raw = spark.createDataFrame([(1, 2, "Bo", "Clerk")], spec.landing_schema)
    twice = raw.withColumn("dt_proc", F.lit("1")).unionByName(raw.withColumn("dt_proc", F.lit("2")))
    assert standardise(twice, spec, LOAD).count() == 1
    with_load = standardise(twice, spec, LOAD, dedup="with_load")
    assert with_load.count() == 2
    assert {r.dt_proc for r in with_load.collect()} == {LOAD}
    assert latest_load(with_load, spec.key).count() == 2
