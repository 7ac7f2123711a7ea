"""Tables that take many passes are read once, for narrow copies of what is needed."""

from pyspark.sql import functions as F

from feira.operators import statistics
from feira.plans import report


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_outliers_pass_over_a_copy_of_the_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.sqrt("id")).alias("v"))
    found = statistics.iqr_outliers(df, "v")
    assert "Range" not in optimized(found) and "SQRT" not in optimized(found)
    assert found.first().outliers == 0


def test_findings_of_one_variable_share_a_copy(spark):
    items = spark.range(50).select(F.sqrt("id").alias("price"), F.cbrt("id").alias("freight_value"))
    payments = spark.range(50).select(F.col("id").alias("payment_value"), (F.col("id") % 5).alias("payment_installments"), F.lit("x").alias("payment_type"))
    found = report.distribution_findings({"items": items, "payments": payments, "reviews": spark.range(3).withColumnRenamed("id", "score")})
    for name in ("outliers_price", "outliers_freight_value", "histogram_price", "histogram_freight_value"):
        assert "SQRT" not in optimized(found[name]) and "CBRT" not in optimized(found[name])
    assert found["histogram_price"].agg(F.sum("n")).first()[0] == 50


def test_flows_between_states_are_joined_once(market):
    long = statistics.origin_destination(market.order, market.order_item, market.customer, market.seller, 3)
    assert optimized(long).count("Join") <= 2  # the grid with the flows, and its margins
