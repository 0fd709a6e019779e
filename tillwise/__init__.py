"""tillwise: product, pricing and demand-planning analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, window functions, joins and aggregations; grouped-map pandas
functions are used only where a per-key numeric fit is required.
"""

from tillwise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
