"""tidemark: product analytics (funnels, cohorts, experiments, churn, data quality) on Spark.

Every public function takes and returns a ``pyspark.sql.DataFrame``; parameters such as
event names, funnel steps, feature prefix, period, alpha and the as-of instant are
arguments, never hidden constants.
"""

__version__ = "0.1.0"
