import pytest
from pyspark.sql import functions as F

from riskforge.operators import quality as Q


def run(spark, rows, schema, checks, name="t"):
    df = spark.createDataFrame(rows, schema)
    return {r["check"]: (r["status"], r["detail"]) for r in Q.run_suite(name, df, checks).collect()}


def test_empty_table_semantics(spark):
    checks = [Q.not_null("a"), Q.unique("a"), Q.between("x", 0, 1), Q.in_set("a", ["k"]),
              Q.positive("x"), Q.row_count_between(1, 10), Q.a_less_than_b("x", "y")]
    res = run(spark, [], "a string, x double, y double", checks)
    assert res["not_null(a)"] == ("FAIL", "Null pct: nan% (max allowed: 0.0%)")
    assert res["unique(a)"] == ("PASS", "Duplicate count: 0")
    assert res["between(x, 0, 1)"][0] == "FAIL"
    assert res["in_set(a)"] == ("PASS", "Invalid values: 0 | Examples: []")
    assert res["positive(x)"][0] == "FAIL"
    assert res["row_count_between(1, 10)"] == ("FAIL", "Actual row count: 0")
    assert res["x_less_than_y"][0] == "FAIL"


def test_null_and_duplicate_rules(spark):
    rows = [("a", 0.5, 1.0), ("a", None, 2.0), (None, 2.0, 1.0), (None, -1.0, None)]
    checks = [Q.not_null("a", threshold=50.0), Q.unique("a"), Q.between("x", 0, 1), Q.positive("x"),
              Q.a_less_than_b("x", "y"), Q.in_set("a", ["b"])]
    res = run(spark, rows, "a string, x double, y double", checks)
    assert res["not_null(a)"] == ("PASS", "Null pct: 50.00% (max allowed: 50.0%)")
    assert res["unique(a)"] == ("FAIL", "Duplicate count: 2")  # second 'a' and second NULL
    assert res["between(x, 0, 1)"] == ("FAIL", "Out-of-range pct: 50.00% (max allowed: 0.0%)")
    assert res["positive(x)"] == ("FAIL", "Non-positive pct: 25.00%")
    assert res["x_less_than_y"] == ("FAIL", "Violation pct: 25.00%")
    assert res["in_set(a)"] == ("FAIL", "Invalid values: 4 | Examples: ['a', nan]")


def test_text_numbers_are_coerced(spark):
    res = run(spark, [("0.5",), ("abc",), ("7",)], "x string", [Q.between("x", 0, 1)])
    assert res["between(x, 0, 1)"] == ("FAIL", "Out-of-range pct: 33.33% (max allowed: 0.0%)")


def test_examples_are_first_three_sorted(spark):
    rows = [(v,) for v in ["z", "y", "x", "w", "w", "ok"]]
    res = run(spark, rows, "a string", [Q.in_set("a", ["ok"])])
    assert res["in_set(a)"] == ("FAIL", "Invalid values: 5 | Examples: ['w', 'x', 'y']")


def test_summary_and_gate(spark):
    df = spark.createDataFrame([("a",), ("a",)], "a string")
    results = Q.run_suite("s", df, [Q.not_null("a"), Q.unique("a")])
    summ = {r["suite"]: r for r in Q.summarize(results).collect()}
    assert (summ["s"]["passed"], summ["s"]["failed"], summ["s"]["total"]) == (1, 1, 2)
    assert float(summ["ALL"]["pass_rate_pct"]) == 50.0
    with pytest.raises(Q.ValidationFailed):
        Q.gate(results)
    Q.gate(results.filter(F.col("status") == "PASS"))


def test_schema_test_semantics(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.0), (2, None, -1.0), (None, "zz", 5.0)],
                               "k int, v string, x double")
    tests = [Q.SchemaTest("m", "k", "unique"), Q.SchemaTest("m", "k", "not_null"),
             Q.SchemaTest("m", "v", "accepted_values", ("a", "b")),
             Q.SchemaTest("m", "x", "expression_is_true", ">= 0"),
             Q.SchemaTest("m", "x", "expression_is_true", "between 0 and 1")]
    out = {r["test_no"]: r["failures"] for r in Q.run_schema_tests({"m": df}, tests).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 1, 5: 3}


def test_declared_counts():
    assert sum(len(c) for c in Q.SUITES.values()) == 42
    assert len(Q.SCHEMA_TESTS) == 47
    kinds = [t.test for t in Q.SCHEMA_TESTS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"),
            kinds.count("expression_is_true")) == (22, 6, 6, 13)
