"""shelfline — a Spark-native product-catalog engine.

Retailer feeds and web pages go in; one clean, de-duplicated product table
comes out and is kept current. Every operator is a DataFrame -> DataFrame
function built from ``pyspark.sql.functions`` so Catalyst can push filters
and projections into the scan and keep the work inside whole-stage codegen.
"""

from shelfline.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
