"""A counterparty holding a third of all loans: the enrichment join must be
split by AQE's skew handling, not run as one giant task, and stay exact."""

from pyspark.sql import functions as F

from riskforge.operators import marts

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def test_hot_counterparty_is_split(spark, build):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        # At scale the loans arrive in many files, i.e. many map tasks: AQE
        # splits a skewed partition by ranges of map outputs. The tiny
        # fixture is one file, so spread it first.
        loans = build.stg_loan_portfolio.repartition(8)
        n = loans.count()
        # a third of the loans move onto one counterparty
        hot = loans.withColumn(
            "counterparty_id",
            F.when(F.xxhash64("loan_id") % 3 == 0, F.lit("CPTY-HOT")).otherwise(F.col("counterparty_id")),
        )
        cpty = build.stg_counterparties.unionByName(
            build.stg_counterparties.limit(1).withColumn("counterparty_id", F.lit("CPTY-HOT"))
        )
        enriched = marts.credit_risk_enriched(hot, cpty, build.stg_rwa_components)
        assert enriched.count() == n
        assert len(enriched.collect()) == n  # runs this plan; AQE re-plans it
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
