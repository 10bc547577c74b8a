"""Oracle SQL for the quality suites, their summary and the schema tests."""

from __future__ import annotations

from oracle.ctes import with_ctes
from oracle.declared import SCHEMA_TESTS, SUITES

SRC = {
    "loan_portfolio": "src_loans",
    "counterparties": "src_counterparties",
    "rwa_components": "src_rwa",
    "capital_components": "src_capital",
    "stress_scenarios": "src_stress",
}
MODEL = dict(SRC, **{
    "stg_loan_portfolio": "stg_loans",
    "stg_counterparties": "stg_cpty",
    "int_credit_risk_enriched": "enriched",
    "fct_basel3_rwa_report": "rwa_report",
    "fct_capital_adequacy": "capital_adequacy",
    "fct_ccar_stress_test": "ccar",
})


def lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def inlist(vals) -> str:
    return "(" + ", ".join(lit(v) for v in vals) + ")"


def pct_text(m: str) -> str:
    h = f"((2 * {m} * 10000 + n) // (2 * n))"
    return f"CASE WHEN n = 0 THEN 'nan' ELSE printf('%d.%02d', {h} // 100, {h} % 100) END"


def within(m: str, t: float) -> str:
    return f"CASE WHEN n > 0 AND {m} * 100 <= {t!r} * n THEN 'PASS' ELSE 'FAIL' END"


def suite_sql(name: str) -> str:
    checks = SUITES[name]
    src = SRC[name]
    measures = ["count(*) AS n"]
    rows = []
    for i, ck in enumerate(checks):
        c, m = ck.column, f"m{i}"
        if ck.kind == "not_null":
            measures.append(f"count(*) FILTER (WHERE {c} IS NULL) AS {m}")
            st, det = within(m, ck.threshold), f"'Null pct: ' || {pct_text(m)} || '% (max allowed: {ck.threshold}%)'"
        elif ck.kind == "unique":
            measures.append(f"count(DISTINCT {c}) AS {m}")
            measures.append(f"coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS e{i}")
            dup = f"(n - {m} - e{i})"
            st, det = f"CASE WHEN {dup} = 0 THEN 'PASS' ELSE 'FAIL' END", f"'Duplicate count: ' || CAST({dup} AS VARCHAR)"
        elif ck.kind == "between":
            lo, hi = ck.args
            measures.append(f"count(*) FILTER (WHERE coalesce({c} < {lo!r} OR {c} > {hi!r}, false)) AS {m}")
            st = within(m, ck.threshold)
            det = f"'Out-of-range pct: ' || {pct_text(m)} || '% (max allowed: {ck.threshold}%)'"
        elif ck.kind == "in_set":
            bad = f"NOT coalesce({c} IN {inlist(ck.args)}, false)"
            measures.append(f"count(*) FILTER (WHERE {bad}) AS {m}")
            ex = f"""(SELECT '[' || coalesce(string_agg(s, ', ' ORDER BY z, v), '') || ']' FROM (
                SELECT v, v IS NULL AS z,
                       CASE WHEN v IS NULL THEN 'nan' ELSE '''' || v || '''' END AS s
                FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {src} WHERE {bad}) dv
                ORDER BY v NULLS LAST LIMIT 3) ex)"""
            st = f"CASE WHEN {m} = 0 THEN 'PASS' ELSE 'FAIL' END"
            det = f"'Invalid values: ' || CAST({m} AS VARCHAR) || ' | Examples: ' || {ex}"
        elif ck.kind == "positive":
            measures.append(f"count(*) FILTER (WHERE coalesce({c} <= 0, false)) AS {m}")
            st, det = within(m, ck.threshold), f"'Non-positive pct: ' || {pct_text(m)} || '%'"
        elif ck.kind == "row_count_between":
            lo, hi = ck.args
            st = f"CASE WHEN n >= {lo} AND n <= {hi} THEN 'PASS' ELSE 'FAIL' END"
            det = "'Actual row count: ' || CAST(n AS VARCHAR)"
        elif ck.kind == "a_less_than_b":
            b = ck.args[0]
            measures.append(f"count(*) FILTER (WHERE coalesce({c} >= {b}, false)) AS {m}")
            st, det = within(m, ck.threshold), f"'Violation pct: ' || {pct_text(m)} || '%'"
        else:
            raise ValueError(ck.kind)
        rows.append(
            f"SELECT '{name}' AS suite, CAST({i + 1} AS BIGINT) AS check_no, {lit(ck.name)} AS \"check\", "
            f"{st} AS status, {det} AS detail FROM agg_{name}"
        )
    agg = f"agg_{name} AS (SELECT {', '.join(measures)} FROM {src})"
    body = "\nUNION ALL\n".join(rows)
    return agg, body


def dq_suite(name: str) -> str:
    agg, body = suite_sql(name)
    full = with_ctes("SELECT 1", (SRC[name],))
    head = full[: full.rindex("SELECT 1")].rstrip()
    return f"{head},\n{agg}\n{body}"


def text_numerics() -> str:
    """Numbers given as text, where ratings NR and CCC stand for text that is none."""
    is_number = "internal_rating NOT IN ('NR', 'CCC')"
    rows = [
        ("positive(exposure_amount)", "exposure_amount <= 0", 0.0, "Non-positive pct: ", "%"),
        ("between(pd_estimate, 0, 0.2)", "pd_estimate < 0 OR pd_estimate > 0.2", 0.0, "Out-of-range pct: ", "% (max allowed: 0.0%)"),
        ("outstanding_balance_less_than_committed_amount", "outstanding_balance >= committed_amount", 5.0, "Violation pct: ", "%"),
    ]
    parts = [
        f"""SELECT 'text_numerics' AS suite, CAST({i} AS BIGINT) AS check_no, {lit(name)} AS "check", {within('m', limit)} AS status,
            {lit(before)} || {pct_text('m')} || {lit(after)} AS detail
          FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {is_number} AND coalesce({bad}, false)) AS m FROM src_loans) a{i}"""
        for i, (name, bad, limit, before, after) in enumerate(rows, start=1)
    ]
    return with_ctes("\nUNION ALL\n".join(parts), ("src_loans",))


def dq_summary() -> str:
    aggs, bodies = [], []
    for name in SUITES:
        a, b = suite_sql(name)
        aggs.append(a)
        bodies.append(b)
    full = with_ctes("SELECT 1", tuple(SRC[n] for n in SUITES))
    head = full[: full.rindex("SELECT 1")].rstrip()
    allrows = "\nUNION ALL\n".join(bodies)
    return f"""{head},
{', '.join(aggs)},
results AS ({allrows}),
per AS (SELECT suite, count(*) FILTER (WHERE status = 'PASS') AS passed,
               count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) AS total
        FROM results GROUP BY suite),
both_ AS (SELECT * FROM per UNION ALL
          SELECT 'ALL', sum(passed), sum(failed), sum(total) FROM per)
SELECT suite, CAST(passed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed,
       CAST(total AS BIGINT) AS total,
       CAST(((2 * passed * 1000 + total) // (2 * total)) AS DOUBLE) / 10 AS pass_rate_pct
FROM both_"""


def _expr(col: str, text: str) -> str:
    return f"{col} {text}"


def schema_tests() -> str:
    parts = []
    deps = []
    for no, t in enumerate(SCHEMA_TESTS, start=1):
        tbl = MODEL[t.model]
        deps.append(tbl)
        c = t.column
        if t.test == "not_null":
            f = f"(SELECT count(*) FROM {tbl} WHERE {c} IS NULL)"
        elif t.test == "expression_is_true":
            f = f"(SELECT count(*) FROM {tbl} WHERE NOT ({_expr(c, t.arg)}))"
        elif t.test == "accepted_values":
            f = f"(SELECT count(DISTINCT CASE WHEN {c} NOT IN {inlist(t.arg)} THEN {c} END) FROM {tbl})"
        elif t.test == "unique":
            f = (f"(SELECT count(*) FROM (SELECT {c} FROM {tbl} WHERE {c} IS NOT NULL "
                 f"GROUP BY {c} HAVING count(*) > 1) u)")
        else:
            raise ValueError(t.test)
        parts.append(
            f"SELECT CAST({no} AS BIGINT) AS test_no, {lit(t.model)} AS model, {lit(c)} AS column_name, "
            f"{lit(t.test)} AS test, {lit(t.args_text)} AS test_args, CAST({f} AS BIGINT) AS failures"
        )
    body = "SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (\n" + \
        "\nUNION ALL\n".join(parts) + "\n) st"
    return with_ctes(body, tuple(dict.fromkeys(deps)))


def registry() -> dict[str, str]:
    out = {f"dq_{n}": dq_suite(n) for n in SUITES}
    out["dq_landed"] = " UNION ALL ".join(f"SELECT * FROM ({sql}) t{i}" for i, sql in enumerate(out.values()))
    out["dq_summary"] = dq_summary()
    out["dq_text_numerics"] = text_numerics()
    out["schema_tests"] = schema_tests()
    return out
