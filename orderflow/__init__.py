"""orderflow: order, shipment-tracking and landing-zone processing on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL API, so Catalyst plans it and Tungsten runs it.  No Python
UDF is used anywhere in the library.
"""

from orderflow.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
