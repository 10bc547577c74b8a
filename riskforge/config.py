"""Project configuration: regulatory thresholds and layer naming."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Thresholds:
    """Basel III minimums, all in percent (ratios are stored as percent)."""

    # The regulatory minimums the reports are defined against.
    cet1_minimum_ratio: Decimal = Decimal("4.5")
    tier1_minimum_ratio: Decimal = Decimal("6.0")
    total_capital_minimum_ratio: Decimal = Decimal("8.0")
    capital_conservation_buffer: Decimal = Decimal("2.5")
    lcr_minimum: Decimal = Decimal("100.0")
    nsfr_minimum: Decimal = Decimal("100.0")
    # Band widths above the minimum used by the status labels.
    adequate_band: Decimal = Decimal("2")
    lcr_watch_band: Decimal = Decimal("10")
    nsfr_watch_band: Decimal = Decimal("5")


@dataclass(frozen=True)
class StressConfig:
    """Stress-test parameters of the CCAR mart."""

    # Baseline PD and LGD of the incremental-loss formula, and
    # the capital buffer that flags a segment.
    baseline_pd: Decimal = Decimal("0.02")
    baseline_lgd: Decimal = Decimal("0.40")
    capital_buffer: Decimal = Decimal("1000000000")
    scenario_order: tuple = field(
        default=(("Baseline", 1), ("Adverse", 2), ("Severely Adverse", 3))
    )


DEFAULT_THRESHOLDS = Thresholds()
DEFAULT_STRESS = StressConfig()

# Layer -> custom schema name of each model folder.
LAYER_SCHEMAS = {
    "staging": "staging",
    "intermediate": "intermediate",
    "credit": "credit_risk",
    "capital": "capital",
    "liquidity": "liquidity",
}


def schema_name(custom: str | None, target_schema: str, target_name: str) -> str:
    """Where a model lands: default schema when no custom one is set; the
    custom schema in production; otherwise ``<default>_<custom>`` so a
    development run never overwrites production tables."""
    if custom is None:
        return target_schema
    if target_name == "prod":
        return custom.strip()
    return f"{target_schema}_{custom.strip()}"
