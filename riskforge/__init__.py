"""riskforge: bank risk and capital reporting as Spark DataFrame operators.

Every public operator is a plain function from DataFrames to a DataFrame.
Money is exact decimal arithmetic; nothing row-level runs in Python.
"""

from riskforge.config import Thresholds, StressConfig, DEFAULT_THRESHOLDS

__all__ = ["Thresholds", "StressConfig", "DEFAULT_THRESHOLDS"]
__version__ = "0.1.0"
