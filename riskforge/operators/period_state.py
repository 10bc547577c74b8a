"""Period-on-period marts from carried state instead of the whole capital history.

A run over one reporting period needs, besides that period's rows, only the
last earlier row of each entity. ``carry`` folds a period into that state and
``at_period`` builds a capital mart for one period from the state and the
period's rows. ``PeriodStore`` keeps the history partitioned by
``reporting_period`` and the states partitioned by the period ``after`` which
they hold, so a run reads one partition of each, whatever the history's length.

The state is one row an entity, in the columns of the staged capital rows.
Periods are taken in rising order.

Edge cases: an entity without an earlier row has no prior values; one that skips
periods is compared with its last row, however old, as a full build does; a
period without rows leaves the state as it is; rows without a period come before
all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.sources.sinks import _join

PERIOD = "reporting_period"


def carry(state: DataFrame | None, capital: DataFrame) -> DataFrame:
    """The last row of each entity over ``state`` and the rows of the next period."""
    rows = capital if state is None else state.unionByName(capital)
    order = F.struct(F.col(PERIOD).isNotNull(), PERIOD)
    return rows.groupBy("entity_id").agg(F.max_by(F.struct(*capital.columns), order).alias("last")).select("last.*")


def at_period(
    mart: Callable[[DataFrame], DataFrame], state: DataFrame | None, capital: DataFrame, period: str
) -> DataFrame:
    """``mart`` over one period's rows, looking back into ``state`` only."""
    rows = capital if state is None else state.unionByName(capital)
    return mart(rows).filter(F.col(PERIOD) == period)


class PeriodStore:
    """History and states of the staged capital rows under ``base``."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType):
        self.spark, self.schema = spark, schema
        self.history, self.states = _join(base, "history"), _join(base, "states")

    def append(self, capital: DataFrame) -> None:
        """Store rows of periods that the history does not hold yet."""
        capital.write.mode("append").partitionBy(PERIOD).parquet(self.history)

    def rows(self, period: str) -> DataFrame:
        return self._read(self.history).filter(F.col(PERIOD) == period)

    def start(self, before: str) -> None:
        """The state after ``before`` from the history, once, for a store that has none."""
        old = self._read(self.history).filter(F.col(PERIOD).isNull() | (F.col(PERIOD) <= before))
        self._keep(carry(None, old), before)

    def state(self, after: str) -> DataFrame:
        typed = T.StructType([*self.schema.fields, T.StructField("after", T.StringType())])
        return self.spark.read.schema(typed).parquet(self.states).filter(F.col("after") == after).drop("after")

    def build(self, mart: Callable[[DataFrame], DataFrame], period: str, after: str) -> DataFrame:
        """``mart`` for ``period``; ``after`` names the last period before it."""
        return at_period(mart, self.state(after), self.rows(period), period)

    def advance(self, period: str, after: str) -> None:
        """Store the state after ``period``."""
        self._keep(carry(self.state(after), self.rows(period)), period)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path).select(self.schema.names)

    def _keep(self, state: DataFrame, period: str) -> None:
        state.write.mode("overwrite").parquet(_join(self.states, f"after={period}"))
