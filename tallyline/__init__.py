"""tallyline: service-time and staffing analytics as Spark DataFrame plans.

Subpackages
-----------
functions   pure ``Column -> Column`` scalar expressions (parsing, calendar, rounding)
sources     CSV scan/sink, model-table store, derived fixture views over the test tables
operators   cleaning, joins, features, exact medians, hierarchical models, reports
plans       train / score / validate jobs and the query catalog
streaming   stream-static scoring with Structured Streaming
"""

from tallyline.session import configure, checkpoint_dir  # noqa: F401

__all__ = ["configure", "checkpoint_dir"]
