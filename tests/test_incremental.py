"""The RWA mart from partial sums: random changes against the full build."""

import random

import pytest
from pyspark.sql import functions as F

from riskforge.operators import incremental, marts


def check(spark, then, now, changed_old, changed_new):
    mart = marts.basel3_rwa_report(then, audit=False)
    got, state = incremental.refresh(mart, incremental.segment_state(then), changed_old, changed_new)
    want = marts.basel3_rwa_report(now, audit=False).select(got.columns)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    full = incremental.segment_state(now)
    live = [c for c in full.columns if c in marts.RWA_SEGMENT_KEYS or c == "rows" or c.startswith("n_")]
    assert state.select(live).exceptAll(full.select(live)).isEmpty() and full.select(live).exceptAll(state.select(live)).isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_random_changes_equal_a_full_build(spark, build, seed):
    rnd = random.Random(seed)
    now = build.enriched_table
    n, salt = rnd.choice((2, 3, 9)), F.lit(seed)
    part = lambda k: F.pmod(F.xxhash64("loan_id", salt), F.lit(k)) == 0
    changed = part(n)
    none = lambda c: F.when(part(4 * n), F.lit(None)).otherwise(F.col(c)).cast(now.schema[c].dataType).alias(c)
    nulled = {"ead_estimate", "total_rwa", "region", "approach", "is_defaulted", "pd_estimate", "reporting_date"}
    before = now.filter(changed).select(*[none(c) if c in nulled else F.col(c) for c in now.columns])
    before = before.filter(~part(7 * n)).unionByName(now.limit(20).withColumn("region", F.lit("gone")).withColumn("loan_id", F.lit("closed")))
    then = now.filter(~changed).unionByName(before)
    check(spark, then, now, before, now.filter(changed))


def test_no_change_new_book_and_empty_book(spark, build):
    now, none = build.enriched_table, build.enriched_table.limit(0)
    check(spark, now, now, none, none)
    check(spark, none, now, none, now)
    check(spark, now, none, now, none)


def test_untouched_segments_are_passed_on(spark, build):
    now = build.enriched_table
    mart = marts.basel3_rwa_report(now, audit=False).withColumn("loan_count", F.lit(-1).cast("long"))
    got, _ = incremental.refresh(mart, incremental.segment_state(now), now.limit(0), now.filter("currency = 'USD'"))
    touched = now.filter("currency = 'USD'").select(*marts.RWA_SEGMENT_KEYS).distinct().count()
    assert got.filter("loan_count > 0").count() == touched < got.count()
