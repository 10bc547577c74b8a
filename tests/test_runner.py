import glob
import os
import tempfile

import pytest

from riskforge.operators.quality import ValidationFailed
from riskforge.plans import runner


def test_gate_stops_the_run(spark, build):
    wh = tempfile.mkdtemp(prefix="rf-wh-")
    with pytest.raises(ValidationFailed):  # the test tables carry dirty rows on purpose
        runner.run(spark, build, wh)
    assert glob.glob(os.path.join(wh, "_validation", "validation_*", "summary", "*.json"))
    assert not os.path.exists(os.path.join(wh, "analytics_intermediate"))


def test_run_materializes_everything(spark, build):
    wh = tempfile.mkdtemp(prefix="rf-wh-")
    res = runner.run(spark, build, wh, enforce_gate=False)
    assert set(res["timings"]) >= {"int_credit_risk_enriched", "fct_basel3_rwa_report", "report_watch_list"}
    counts = res["row_counts"]
    assert counts["INT_CREDIT_RISK_ENRICHED"] == build.credit_risk_enriched.count()
    assert counts["FCT_BASEL3_RWA_REPORT"] == build.basel3_rwa_report.count()
    assert os.path.isdir(os.path.join(wh, "analytics_credit_risk", "fct_basel3_rwa_report"))
    assert glob.glob(os.path.join(wh, "_validation", "validation_*", "details", "*.json"))
    assert res["report_rows"]["watch_list"] == 100
    # rerun replaces the partition instead of appending
    res2 = runner.run(spark, build, wh, enforce_gate=False)
    assert res2["row_counts"] == counts


def test_prod_tables_answer_analyst_sql(spark, build):
    wh = tempfile.mkdtemp(prefix="rf-wh-")
    runner.run(spark, build, wh, target_name="prod", enforce_gate=False)
    assert os.path.isdir(os.path.join(wh, "liquidity", "fct_liquidity_coverage"))
    stored = spark.sql("SELECT * FROM capital.fct_capital_adequacy")
    rows = {(r.entity_id, r.reporting_period): r for r in stored.collect()}
    model = build.capital_adequacy.collect()
    assert len(rows) == len(model) == stored.count()
    for m in model[:50]:
        r = rows[m.entity_id, m.reporting_period]
        assert (r.cet1_ratio, r.cet1_ratio_qoq_change, r.lcr) == (m.cet1_ratio, m.cet1_ratio_qoq_change, m.lcr)
        assert r.capital_adequacy_status == m.capital_adequacy_status and r.fully_compliant == m.fully_compliant


def test_validation_report_document(spark, build, tmp_path):
    import json

    from riskforge.operators import quality
    from riskforge.sources.sinks import write_validation_report

    path, details = write_validation_report(quality.run_suites(build.raw), str(tmp_path), quality.summarize)
    files = glob.glob(os.path.join(path, "report", "*.json"))
    doc = json.loads(open(files[0]).read().strip())
    assert set(doc) == {"summary", "details", "run_ts"}
    assert len(doc["details"]) == 42 and len(doc["summary"]) == 6
    assert {d["status"] for d in doc["details"]} <= {"PASS", "FAIL"}


def test_sql_on_registered_views(spark, build):
    names = build.register_views()
    assert "fct_liquidity_coverage" in names and "loan_portfolio" in names
    counted = spark.sql("SELECT lcr_status, count(*) AS n, min(lcr) AS least FROM fct_liquidity_coverage GROUP BY lcr_status")
    model = build.liquidity_coverage.collect()
    for r in counted.collect():
        own = [m.lcr for m in model if m.lcr_status == r.lcr_status]
        assert (r.n, r.least) == (len(own), min(own))
    assert spark.table("fct_liquidity_coverage").count() == len(model)
