"""Bulk load with ledger and rejects, and tables replaced as a whole."""

import uuid

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskforge.session import warehouse_path
from riskforge.sources.bulk_load import copy_into, ledger, loaded, rejects
from riskforge.sources.raw import read_csv
from riskforge.sources.versions import drop_old, publish

HEADER = "loan_id,exposure_amount,reporting_date,unknown"


@pytest.fixture
def base(spark):
    return warehouse_path(spark, f"loading/{uuid.uuid4().hex}")


def put(tmp_path, name, *records):
    (tmp_path / name).write_text("\n".join([HEADER, *records]) + "\n")
    return f"file://{tmp_path}"


def ids(df):
    return sorted(r.loan_id for r in df.collect())


def test_files_load_once_and_bad_records_are_kept(spark, base, tmp_path):
    folder = put(tmp_path, "a.csv", "L1,10.5,2024-03-31,x", "L2,ten,2024-03-31,x", "L3,,2024-13-31,x", "L4,,,", "L5,1", "L6,1,2024-03-31,x,y")
    assert copy_into(spark, "loan_portfolio", folder, base) == 1
    assert copy_into(spark, "loan_portfolio", folder, base) == 0
    assert ids(loaded(spark, base, "loan_portfolio")) == ["L1", "L4"]
    refused = {r.record.split(",")[0]: r for r in rejects(spark, base, "loan_portfolio").collect()}
    assert {k: list(r.columns) for k, r in refused.items()} == {"L2": ["exposure_amount"], "L3": ["reporting_date"], "L5": [], "L6": []}
    assert all(r.file.endswith("a.csv") for r in refused.values())
    put(tmp_path, "b.csv", "L7,2,2024-03-31,")
    assert copy_into(spark, "loan_portfolio", folder, base) == 1
    assert ids(loaded(spark, base, "loan_portfolio")) == ["L1", "L4", "L7"]
    assert ledger(spark, base, "loan_portfolio").count() == 2


def test_a_load_that_fails_has_loaded_nothing(spark, base, tmp_path):
    folder = put(tmp_path, "a.csv", "L1,1,2024-03-31,x")
    (tmp_path / "b.csv").write_text("exposure_amount,loan_id,reporting_date,unknown\n1,L2,2024-03-31,x\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        copy_into(spark, "loan_portfolio", folder, base)
    assert loaded(spark, base, "loan_portfolio").count() == 0 and ledger(spark, base, "loan_portfolio").count() == 0
    (tmp_path / "b.csv").unlink()
    assert copy_into(spark, "loan_portfolio", folder, base) == 1
    assert ids(loaded(spark, base, "loan_portfolio")) == ["L1"]


def test_an_empty_folder_loads_nothing(spark, base, tmp_path):
    assert copy_into(spark, "loan_portfolio", f"file://{tmp_path}", base) == 0
    assert loaded(spark, base, "loan_portfolio").count() == 0 and rejects(spark, base, "loan_portfolio").count() == 0


def test_one_csv_file_has_several_tasks(spark, tmp_path):
    folder = put(tmp_path, "a.csv", *[f"L{i},{i},2024-03-31,x" for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert read_csv(spark, folder, "loan_portfolio", multi_line=False).rdd.getNumPartitions() > 2
        assert read_csv(spark, folder, "loan_portfolio").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_failed_write_leaves_the_old_rows(spark, base):
    schema = f"kept_{uuid.uuid4().hex}"
    rows = lambda: sorted((r.d, r.n) for r in spark.table(f"{schema}.t").collect())
    frame = spark.createDataFrame([("2024-03-31", 1), ("2024-06-30", 2)], "d string, n int")
    publish(frame, base, schema, "t", ("d",))
    held = spark.table(f"{schema}.t")  # planned before the next version
    bad = frame.withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("no")).cast("int")).otherwise(9))
    with pytest.raises(PySparkException):
        publish(bad, base, schema, "t", ("d",))
    assert rows() == [("2024-03-31", 1), ("2024-06-30", 2)]
    publish(frame.filter("n = 2").withColumn("m", F.lit(0.5)), base, schema, "t", ("d",))
    assert rows() == [("2024-06-30", 2)] and held.count() == 2
    assert spark.table(f"{schema}.t").dtypes == [("d", "string"), ("n", "int"), ("m", "double")]
    assert drop_old(spark, base, schema, "t") == 2 and rows() == [("2024-06-30", 2)]
    publish(frame.limit(0), base, schema, "t", ("d",))
    assert rows() == [] and spark.table(f"{schema}.t").columns == ["d", "n"]
