"""Quality checks against a brute-force pandas evaluation on random tables
(NULLs, duplicates, out-of-range and non-numeric text)."""

from fractions import Fraction

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskforge.operators import quality as Q

VALUES = ["A", "B", "C", "Z", None]
NUMS = ["0.5", "1", "-2", "abc", "0", None, "3.25"]


def pct_text(count: int, n: int) -> str:
    if n == 0:
        return "nan"
    q = Fraction(count * 100, n)
    h = int(q * 100 + Fraction(1, 2))  # half-up, non-negative
    return f"{h // 100}.{h % 100:02d}"


def brute(df: pd.DataFrame) -> dict:
    n = len(df)
    num = pd.to_numeric(df["x"], errors="coerce")
    num2 = pd.to_numeric(df["y"], errors="coerce")
    out = {}
    nulls = int(df["k"].isna().sum())
    out["not_null(k)"] = ("PASS" if n and nulls == 0 else "FAIL", f"Null pct: {pct_text(nulls, n)}% (max allowed: 0.0%)")
    dups = int(df.duplicated(subset=["k"]).sum())
    out["unique(k)"] = ("PASS" if dups == 0 else "FAIL", f"Duplicate count: {dups}")
    oob = int(((num < 0) | (num > 1)).sum())
    out["between(x, 0, 1)"] = ("PASS" if n and oob == 0 else "FAIL",
                               f"Out-of-range pct: {pct_text(oob, n)}% (max allowed: 0.0%)")
    bad = df["k"][~df["k"].isin(["A", "B"])]
    shown = sorted({v for v in bad if v is not None}) + (["nan"] if bad.isna().any() else [])
    ex = "[" + ", ".join(v if v == "nan" else f"'{v}'" for v in shown[:3]) + "]"
    out["in_set(k)"] = ("PASS" if len(bad) == 0 else "FAIL", f"Invalid values: {len(bad)} | Examples: {ex}")
    nonpos = int((num <= 0).sum())
    out["positive(x)"] = ("PASS" if n and nonpos * 100 <= 10 * n else "FAIL", f"Non-positive pct: {pct_text(nonpos, n)}%")
    viol = int((num >= num2).sum())
    out["x_less_than_y"] = ("PASS" if n and viol == 0 else "FAIL", f"Violation pct: {pct_text(viol, n)}%")
    out["row_count_between(2, 6)"] = ("PASS" if 2 <= n <= 6 else "FAIL", f"Actual row count: {n}")
    return out


CHECKS = [Q.not_null("k"), Q.unique("k"), Q.between("x", 0, 1), Q.in_set("k", ["A", "B"]),
          Q.positive("x", threshold=10.0), Q.a_less_than_b("x", "y"), Q.row_count_between(2, 6)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(VALUES), st.sampled_from(NUMS), st.sampled_from(NUMS)), max_size=8))
def test_suite_matches_pandas(spark, rows):
    pdf = pd.DataFrame(rows, columns=["k", "x", "y"], dtype=object)
    sdf = spark.createDataFrame(rows, "k string, x string, y string")
    got = {r["check"]: (r["status"], r["detail"]) for r in Q.run_suite("p", sdf, CHECKS).collect()}
    assert got == brute(pdf)
