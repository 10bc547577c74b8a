import datetime as dt
from decimal import Decimal

from riskforge.operators import staging
from riskforge.schemas import COUNTERPARTIES, LOAN_PORTFOLIO, STRESS_SCENARIOS

R = dt.date(2024, 3, 31)


def loan(**kw):
    row = {f.name: None for f in LOAN_PORTFOLIO.fields}
    row.update(loan_id="L1", counterparty_id="C1", exposure_amount=100.0, reporting_date=R,
               is_defaulted=False, is_impaired=False)
    row.update(kw)
    return row


def test_loan_filters(spark):
    rows = [loan(), loan(loan_id=None), loan(exposure_amount=0.0), loan(exposure_amount=0.001),
            loan(reporting_date=None)]
    df = spark.createDataFrame(rows, LOAN_PORTFOLIO)
    out = staging.stg_loan_portfolio(df).collect()
    # 0.001 passes the raw filter and then rounds to 0.00 in the cast
    assert len(out) == 2
    assert sorted(r["exposure_amount"] for r in out) == [Decimal("0.00"), Decimal("100.00")]
    assert "_loaded_at" in out[0].asDict()


def test_sanctioned_and_unknown_flag_dropped(spark):
    base = {f.name: None for f in COUNTERPARTIES.fields}
    rows = [dict(base, counterparty_id="A", is_sanctioned=False),
            dict(base, counterparty_id="B", is_sanctioned=True),
            dict(base, counterparty_id="C", is_sanctioned=None),
            dict(base, counterparty_id=None, is_sanctioned=False)]
    out = staging.stg_counterparties(spark.createDataFrame(rows, COUNTERPARTIES), audit=False).collect()
    assert [r["counterparty_id"] for r in out] == ["A"]


def test_stress_filters(spark):
    base = {f.name: None for f in STRESS_SCENARIOS.fields}
    ok = dict(base, scenario_id="S", scenario_name="Adverse", stressed_pd=0.5, stressed_lgd=1.0)
    rows = [ok, dict(ok, scenario_name="Mild"), dict(ok, stressed_pd=1.5), dict(ok, stressed_lgd=None),
            dict(ok, scenario_id=None)]
    out = staging.stg_stress_scenarios(spark.createDataFrame(rows, STRESS_SCENARIOS), audit=False).collect()
    assert len(out) == 1
