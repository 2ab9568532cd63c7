"""tallyspark: Spark-native cleaning, enrichment, reporting and data-quality
operators for sales data (customers, products, order lines).

Every operator is a function of DataFrames built from JVM-side expressions,
so Catalyst prunes, pushes down and code-generates the whole plan.
"""

from tallyspark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
