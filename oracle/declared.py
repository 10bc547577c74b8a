"""What the oracle checks: the declared source checks and schema tests, written
down on their own, without the code under test.

Fixed values: tables, columns, bounds, value sets and their order.
"""

from __future__ import annotations

from typing import NamedTuple


class Check(NamedTuple):
    kind: str
    column: str | None = None
    args: tuple = ()
    threshold: float = 0.0

    @property
    def name(self) -> str:
        if self.kind == "row_count_between":
            return "row_count_between(%s, %s)" % self.args
        if self.kind == "between":
            return "between(%s, %s, %s)" % (self.column, *self.args)
        if self.kind == "a_less_than_b":
            return f"{self.column}_less_than_{self.args[0]}"
        return f"{self.kind}({self.column})"


class Test(NamedTuple):
    model: str
    column: str
    test: str
    arg: object = None

    @property
    def args_text(self) -> str:
        return ", ".join(map(str, self.arg)) if isinstance(self.arg, tuple) else self.arg or ""


SCENARIO_NAMES = ("Baseline", "Adverse", "Severely Adverse")
KYC = ("Verified", "Pending", "Failed")

SUITES: dict[str, list[Check]] = {
    "loan_portfolio": [
        Check("row_count_between", None, (100, 10000)),
        *(Check("not_null", c) for c in ("loan_id", "counterparty_id", "exposure_amount", "reporting_date")),
        Check("unique", "loan_id"),
        *(Check("positive", c) for c in ("exposure_amount", "ead_estimate")),
        *(Check("between", c, (0, 1)) for c in ("pd_estimate", "lgd_estimate")),
        Check("in_set", "asset_class", (
            "Corporate Loan", "Retail Mortgage", "SME Loan", "Sovereign Bond", "Credit Card", "Auto Loan",
            "Commercial Real Estate", "Interbank")),
        Check("in_set", "currency", ("USD", "EUR", "GBP", "JPY", "CHF")),
        Check("a_less_than_b", "outstanding_balance", ("committed_amount",), 5.0),
    ],
    "counterparties": [
        Check("row_count_between", None, (10, 10000)),
        Check("not_null", "counterparty_id"),
        Check("unique", "counterparty_id"),
        Check("not_null", "kyc_status"),
        Check("in_set", "kyc_status", KYC),
        Check("positive", "credit_limit"),
        Check("in_set", "counterparty_type", ("Corporate", "Financial Institution", "Sovereign", "Retail", "SME")),
    ],
    "rwa_components": [
        Check("row_count_between", None, (100, 10000)),
        *(Check("not_null", c) for c in ("loan_id", "total_rwa")),
        Check("between", "risk_weight", (0, 2.0)),
        Check("positive", "ead"),
        Check("in_set", "approach", ("Standardized", "IRB Foundation", "IRB Advanced")),
    ],
    "capital_components": [
        Check("row_count_between", None, (1, 500)),
        *(Check("not_null", c) for c in ("entity_id", "reporting_period")),
        *(Check("positive", c) for c in ("cet1_capital", "risk_weighted_assets")),
        Check("between", "cet1_ratio", (0, 50)),
        Check("between", "lcr", (50, 500)),
        Check("between", "nsfr", (50, 300)),
        Check("a_less_than_b", "cet1_capital", ("total_capital",)),
    ],
    "stress_scenarios": [
        Check("row_count_between", None, (100, 100000)),
        Check("not_null", "scenario_id"),
        Check("unique", "scenario_id"),
        Check("in_set", "scenario_name", SCENARIO_NAMES),
        *(Check("between", c, (0, 1)) for c in ("stressed_pd", "stressed_lgd")),
        Check("positive", "expected_loss"),
    ],
}

# model -> column -> tests, in declared order; a text is an expression, a tuple the accepted values
DECLARED: dict[str, dict[str, list]] = {
    "loan_portfolio": {
        "loan_id": ["not_null", "unique"], "counterparty_id": ["not_null"], "exposure_amount": ["not_null", ">= 0"],
        "pd_estimate": ["not_null", "between 0 and 1"], "lgd_estimate": ["not_null", "between 0 and 1"],
        "reporting_date": ["not_null"],
    },
    "counterparties": {"counterparty_id": ["not_null", "unique"], "kyc_status": [KYC]},
    "rwa_components": {"loan_id": ["not_null"], "total_rwa": ["not_null", ">= 0"]},
    "capital_components": {"entity_id": ["not_null"], "cet1_ratio": ["not_null", "> 0"]},
    "stress_scenarios": {
        "scenario_id": ["not_null", "unique"], "scenario_name": [SCENARIO_NAMES], "stressed_pd": ["between 0 and 1"],
    },
    "stg_loan_portfolio": {
        "loan_id": ["not_null", "unique"], "exposure_amount": ["not_null", "> 0"], "pd_estimate": ["between 0 and 1"],
    },
    "stg_counterparties": {"counterparty_id": ["not_null", "unique"], "is_sanctioned": [(False,)]},
    "int_credit_risk_enriched": {
        "loan_id": ["not_null", "unique"], "expected_loss": ["not_null", ">= 0"],
        "rating_bucket": ["not_null", (
            "Investment Grade — High", "Investment Grade — Upper Mid", "Investment Grade — Lower Mid",
            "Sub-Investment Grade — High", "Sub-Investment Grade — Low", "Unrated")],
    },
    "fct_basel3_rwa_report": {
        "reporting_date": ["not_null"], "total_rwa": ["not_null", ">= 0"], "total_capital_requirement": [">= 0"],
    },
    "fct_capital_adequacy": {
        "entity_id": ["not_null"], "cet1_ratio": ["not_null", "> 0"],
        "capital_adequacy_status": [(
            "Below Minimum — Regulatory Action Required", "Within Buffer — Restricted Distributions",
            "Adequate — Monitor Closely", "Well Capitalised")],
    },
    "fct_ccar_stress_test": {"scenario_name": [SCENARIO_NAMES], "total_expected_loss": [">= 0"]},
}


def _test(model: str, column: str, what) -> Test:
    if isinstance(what, tuple):
        return Test(model, column, "accepted_values", what)
    return Test(model, column, what) if what in ("not_null", "unique") else Test(model, column, "expression_is_true", what)


SCHEMA_TESTS = [_test(m, c, what) for m, columns in DECLARED.items() for c, tests in columns.items() for what in tests]
