"""Documents whose checks take long are dealt to many tasks."""

from pyspark.sql import functions as F

from feira.queries import validators
from feira.session import tasks


def test_documents_are_dealt_to_many_tasks(spark):
    rows = spark.range(0, 50, 1, 1).select(F.col("id").cast("string").alias("key"), (F.col("id") + 1).alias("k"))
    plan = validators.report(rows, "reviews", {"review_id": F.lit('"r"')})._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {tasks(spark)}, true" in plan
